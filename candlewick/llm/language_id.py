"""Language identification by rank-order n-gram profiles.

A text's letters are lower-cased; anything else is a word border.  All 1-, 2- and
3-grams inside words (borders count as a character) are ranked by frequency, ties by code
points.  A language's profile is the ``TOP`` most frequent n-grams over all its training
documents; a document's is the same over its whole text.  The out-of-place distance sums
the differences of ranks, ``TOP`` for an n-gram the profile lacks; the nearest language
wins (ties: the smaller name).

Training counts every document of the training fold, inside tasks first, then by n-gram.
Null texts and texts without a letter are ``und`` with score 0, as is everything if no
language was learned.  Null doc_ids are kept and count as held out; rows with a null lang
teach nothing; repeated rows each get a row (and teach each); an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm._common import crc_mod, plain, text_slices

TOP = 400
UNKNOWN = "und"
#: Text handled at once: every character makes three n-grams of eight bytes.
SLICE = 2 << 20
CODE_BITS = 21


@lru_cache(1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def gram_counts(texts: list[str], group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, n-gram, count), by length of n-gram, group and n-gram; group[i] is the group of texts[i].

    An n-gram is its code points, 21 bits each, the first highest; a border is 0.
    """
    low = [t.lower() for t in texts]
    chars = np.frombuffer(("\n" + "".join([t + "\n" for t in low])).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.concatenate([[0], np.repeat(group, [len(t) + 1 for t in low])]).astype(np.int64)
    is_letter = letters()[chars]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # of a run of borders, the first
    keep[0] = True
    is_letter, owner = is_letter[keep], owner[keep]
    alphabet, code = np.unique(np.where(is_letter, chars[keep], 0), return_inverse=True)
    if alphabet[0] != 0:
        alphabet, code = np.concatenate([[0], alphabet]), code + 1
    bits = max(1, int(len(alphabet) - 1).bit_length())
    if 3 * bits + max(1, int(groups).bit_length()) > 63:
        return _in_parts(texts, group, groups)
    code = code.astype(np.int64)
    base = owner << (3 * bits)
    one = np.flatnonzero(is_letter)
    two = np.flatnonzero(is_letter[:-1] | is_letter[1:])
    mid = one[(one > 0) & (one < len(code) - 1)]
    keys = [
        base[one] | code[one] << (2 * bits),
        np.where(is_letter[two], base[two], base[np.minimum(two + 1, len(base) - 1)])
        | code[two] << (2 * bits) | code[two + 1] << bits,
        base[mid] | code[mid - 1] << (2 * bits) | code[mid] << bits | code[mid + 1]]
    out = []
    for n, own in enumerate(keys, 1):
        own = np.sort(own)
        new = np.ones(len(own), bool)
        new[1:] = own[1:] != own[:-1]
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(own)))
        own = own[at]
        mask = (1 << bits) - 1
        a, b, c = (alphabet[(own >> (k * bits)) & mask].astype(np.int64) for k in (2, 1, 0))
        if n == 1:
            gram = a
        elif n == 2:
            gram = (a + 1) << CODE_BITS | b
        else:
            gram = ((a + 1) << CODE_BITS | b) << CODE_BITS | c
        out.append((own >> (3 * bits), gram, count))
    return tuple(np.concatenate(x) for x in zip(*out))


def _in_parts(texts, group, groups):
    """Very many different letters: each half for itself (one text alone has no group bits)."""
    if len(texts) > 1:
        half = len(texts) // 2
        parts = [gram_counts(texts[:half], group[:half], groups), gram_counts(texts[half:], group[half:], groups)]
    else:
        half = len(texts[0]) // 2  # cut inside a text: only n-grams over the cut are lost to the border
        cut = next((k for k in range(half, len(texts[0])) if not texts[0][k].isalpha()), half)
        parts = [gram_counts([t], group, groups) for t in (texts[0][:cut], texts[0][cut:])]
    g, n, c = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((n, g))
    g, n, c = g[order], n[order], c[order]
    if not len(g):
        return g, n, c
    new = np.concatenate([[True], (g[1:] != g[:-1]) | (n[1:] != n[:-1])])
    return g[new], n[new], np.add.reduceat(c, np.flatnonzero(new))


def profiles(train: DataFrame, top: int = TOP) -> dict[str, np.ndarray]:
    """lang → its most frequent n-grams in order, from all rows (text, lang) of ``train``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, text in text_slices(batch, limit=SLICE):
                coded = rows.column(1).dictionary_encode()
                g, gram, count = gram_counts(text.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
                                             len(coded.dictionary))
                yield pa.RecordBatch.from_arrays(
                    [coded.dictionary.take(pa.array(g)).cast(pa.string()), pa.array(gram), pa.array(count, pa.int64())],
                    names=["lang", "gram", "n"])

    counted = train.where("lang is not null and text is not null").select("text", "lang").mapInArrow(
        run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counted.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "rank", "gram").collect()
    out: dict[str, list[int]] = {}
    for r in sorted(best):
        out.setdefault(r.lang, []).append(r.gram)
    return {k: np.array(v, np.int64) for k, v in out.items()}


def nearest(texts: list[str], names: list[str], grams: np.ndarray, ranks: np.ndarray, top: int):
    """(best language number or -1, score) of every text.  ranks: (language, gram), top where absent."""
    n = len(texts)
    doc, gram, count = gram_counts(texts, np.arange(n), n)
    # Rows come by length and n-gram, so a stable sort leaves ties in the order of n-grams.
    order = np.argsort((doc << 32) - np.minimum(count, 1 << 31), kind="stable")
    doc, gram = doc[order], gram[order]
    start = np.searchsorted(doc, np.arange(n))
    place = np.arange(len(doc)) - start[doc]
    head = place < top
    doc, gram, place = doc[head], gram[head], place[head]
    used = np.bincount(doc, minlength=n)
    if not len(names):
        return np.full(n, -1), np.zeros(n)
    at = np.minimum(np.searchsorted(grams, gram), len(grams) - 1)
    known = grams[at] == gram
    distance = np.stack([np.bincount(doc, np.where(known & (r[at] < top), np.abs(r[at] - place), top), minlength=n)
                         for r in ranks], axis=1)
    best = distance.argmin(axis=1)
    score = 1 - distance[np.arange(n), best] / np.maximum(used * top, 1)
    return np.where(used > 0, best, -1), np.where(used > 0, score, 0.0)


def predict(docs: DataFrame, learned: dict[str, np.ndarray], top: int = TOP) -> DataFrame:
    """doc_id, lang_pred, score for rows (doc_id, text)."""
    names = sorted(learned)
    grams = np.unique(np.concatenate([learned[k] for k in names])) if names else np.zeros(0, np.int64)
    ranks = np.full((len(names), len(grams)), top)
    for k, name in enumerate(names):
        ranks[k, np.searchsorted(grams, learned[name])] = np.arange(len(learned[name]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, text in text_slices(batch, limit=SLICE):
                best, score = nearest(text.to_pylist(), names, grams, ranks, top)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array([names[k] if k >= 0 else UNKNOWN for k in best.tolist()]), pa.array(score)],
                    names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, fold: int = 0, folds: int = 5, top: int = TOP, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out (crc32 of the id mod ``folds`` is ``fold``), lang_pred, score; learns from the other folds."""
    src = plain(docs, doc_id=id_col, text=text_col, lang=lang_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    held = F.coalesce(crc_mod("doc_id", folds) == fold, F.lit(True))
    learned = profiles(src.where(~held), top)
    out = predict(src, learned, top)
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
