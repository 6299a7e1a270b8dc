"""Repeated passages by seed and extend, seeds being winnowed anchors.

A window is ``window`` consecutive words of a document.  A window's anchor is the k-gram
of least hash inside it (the rightmost of equals), so equal windows have equal anchors
at equal places: whatever repeats over the length threshold meets in an anchor's list.
Consecutive windows with the same anchor form one seed: the anchor extended both ways
over all windows it stands for.

1. Seeds are made per document and shuffled by anchor.  Of seeds whose whole extension is
   equal, the first (by doc_id, start) is the representative; every other one is a
   repeat, words and all.  Equal seeds of one slice are reduced to their first before
   the shuffle, so a passage or document with very many copies does not pile up.
2. Representatives that share an anchor but differ in extension match in part at most.
   Their windows are compared one by one (by 128 bits of hash: the anchor's and the
   window's), again in a shuffle by content.  A window of a represented seed that has an
   earlier equal is always found here or in step 1, so the result is exact.
   An anchor with ``hot`` different extensions in one slice already differs there: its
   seeds skip step 1 and go to this comparison at once, and the slice sends a single
   witness to the anchor's list, which makes the seeds of other slices be compared too.
   So a phrase that a third of all documents hold in different surroundings is spread
   by the content around it, and its list gets less than ``hot`` rows a slice.
3. The marked windows return to their documents, which drop the covered words.

Words are runs of anything but ASCII white space, unchanged.  Null and empty texts have
no words; documents with fewer words than a window keep all.  A null doc_id sorts before
all others.  Rows that repeat a doc_id are documents of the same place: equal starts of
equal doc_ids are not earlier than each other, and each row gets a result (rows equal in
text too get the same one).  An empty table gives an empty table; other columns pass by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from candlewick.llm._common import coded, expand, gathered, materialise, plain, shuffle_parts, split_words, text_slices, total_bytes

WINDOW, GRAM = 20, 5
#: Different extensions of one anchor in a slice from which on its seeds are spread by content.
HOT = 8

U = np.uint64
_BASE = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F))
_INVERSE = tuple(U(pow(int(b), -1, 1 << 64)) for b in _BASE)
_SALT = U(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * _SALT
    x = (x ^ (x >> U(29))) * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(32))


class Sequences:
    """Hashes of any word range of a slice in constant time, by sums of word hash times power."""

    def __init__(self, words: pa.Array):
        codes, distinct = coded(words)
        own = np.fromiter((xxh64_intdigest(w.as_buffer()) for w in distinct), U, len(distinct))
        self.sums, self.back = [], []
        n = len(words)
        for k, (base, inverse) in enumerate(zip(_BASE, _INVERSE)):
            word = (_mix(own + U(k)) if len(own) else own)[codes] if n else np.zeros(0, U)
            power = np.cumprod(np.full(n, base))
            self.sums.append(np.concatenate([[U(0)], np.cumsum(word * power)]))
            self.back.append(np.cumprod(np.full(n + 1, inverse)))

    def hash(self, start: np.ndarray, end: np.ndarray, salt: np.ndarray | int = 0) -> np.ndarray:
        """64 well-mixed bits from two independent sums over words [start, end)."""
        a, b = ((s[end] - s[start]) * p[start] for s, p in zip(self.sums, self.back))
        return _mix(_mix(a) + (b ^ (b >> U(31))) * U(0xFF51AFD7ED558CCD) + np.asarray(salt).astype(U) * _SALT)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the least of values[i:i + width] for every i (the rightmost of equals)."""
    at, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        a, b = at[: len(at) - step], at[step:]
        at = np.where(values[b] <= values[a], b, a)
        span += step
    return at


def seeds(words: pa.Array, offs: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """(document, first window, last window, anchor hash, extension hash) of all seeds of a slice."""
    seq = Sequences(words)
    n = len(words)
    if n < window:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(U), none.astype(U), seq
    at = np.arange(n - gram + 1)
    key = seq.hash(at, at + gram)
    anchor = sliding_least(key, window - gram + 1)
    per = np.maximum(np.diff(offs) - window + 1, 0)
    first = expand(offs[:-1], per)
    doc = np.repeat(np.arange(len(per)), per)
    if not len(first):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(U), none.astype(U), seq
    own = anchor[first]
    new = np.concatenate([[True], (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])])
    begin = np.flatnonzero(new)
    last = first[np.append(begin[1:], len(first)) - 1]
    begin_word = first[begin]
    whole = seq.hash(begin_word, last + window, own[begin] - begin_word)
    return doc[begin], begin_word, last, key[own[begin]], whole, seq


#: How far a seed has come: to be compared with its anchor's list, a repeat, or to be compared by windows.
OPEN, REPEAT, CHECK = 0, 1, 2
SEED = "far byte, key long, whole long, doc_id long, tie long, first int, last int"
NAMES = ["far", "key", "whole", "doc_id", "tie", "first", "last"]
MARK = "doc_id long, tie long, first int, last int, check boolean"
#: First rows of one extension (rows of one doc_id with different texts) that are held until the next extension is seen.
RUN_LIMIT = 1 << 16


def _text_tie(text: pa.Array) -> np.ndarray:
    """Tells apart rows of one doc_id with different texts."""
    return np.fromiter((xxh64_intdigest(t.as_buffer(), 42) for t in text), U, len(text)).view(np.int64)


def _earliest(group: list[np.ndarray], doc: np.ndarray, null: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For every row, whether it is its group's first by (doc_id, start); equals of the first are first too."""
    order = np.lexsort((start, doc, ~null, *group[::-1]))
    g = [x[order] for x in group]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in g])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    d, z, s = doc[order], null[order], start[order]
    out = np.empty(len(order), bool)
    out[order] = (z == z[lead]) & (z | (d == d[lead])) & (s == s[lead])
    return out


def _cut(window: int, gram: int, hot: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, text in text_slices(batch):
                words, offs = split_words(text)
                doc, first, last, key, whole, _ = seeds(words, offs, window, gram)
                ids = rows.column(0)
                null = pc.is_null(ids).to_numpy(zero_copy_only=False)[doc]
                doc_id = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)[doc]
                tie = _text_tie(text)[doc]
                lead = _earliest([key, whole], doc_id, null, first - offs[doc])
                far = np.where(lead, OPEN, REPEAT).astype(np.int8)
                own = np.flatnonzero(lead)
                anchors, place, n = np.unique(key[own], return_inverse=True, return_counts=True)
                far[own[n[place] >= hot]] = CHECK
                yield pa.RecordBatch.from_arrays(
                    [pa.array(far), pa.array(key.view(np.int64)), pa.array(whole.view(np.int64)),
                     pa.array(doc_id, mask=null), pa.array(tie),
                     pa.array((first - offs[doc]).astype(np.int32)), pa.array((last - offs[doc]).astype(np.int32))],
                    names=NAMES)
                # A witness has an extension of its own and stands nowhere (first is -1).
                seen = anchors[n >= hot]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(seen), OPEN, np.int8)), pa.array(seen.view(np.int64)),
                     pa.array((~seen).view(np.int64)), pa.nulls(len(seen), pa.int64()), pa.array(np.full(len(seen), -1)),
                     *[pa.array(np.full(len(seen), -1, np.int32)) for _ in range(2)]], names=NAMES)
    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (far, key, whole, place).  Holds the first rows of one extension between batches.

    Rows that are not OPEN pass.  Of the others, a row that is not the first of its
    (key, whole) is a repeat; the first ones (several if a doc_id repeats with different
    texts) must all be checked if their key has another whole.  Over RUN_LIMIT first rows
    of one extension are checked in any case, which costs work and changes nothing.
    """
    held: list[pa.Table] = []   # first rows of the last (key, whole)
    lead = None  # (key, whole, doc_id, first) of the current first row
    run_key, run_whole, decided = None, None, False   # that extension, and whether its first rows are checked

    def marks(rows: pa.Table, check: np.ndarray):
        return pa.RecordBatch.from_arrays(
            [rows.column(k).combine_chunks() for k in ("doc_id", "tie", "first", "last")] + [pa.array(check)],
            names=["doc_id", "tie", "first", "last", "check"])

    def checked() -> Iterator[pa.RecordBatch]:
        for rows in held:
            yield marks(rows, np.ones(rows.num_rows, bool))
        held.clear()

    for batch in batches:
        far = batch.column(0).to_numpy(zero_copy_only=False)
        rows = pa.Table.from_batches([batch])
        near = rows.filter(pa.array(far == OPEN))
        if (far != OPEN).any():
            done = rows.filter(pa.array(far != OPEN))
            yield marks(done, far[far != OPEN] == CHECK)
        if not near.num_rows:
            continue
        key, whole = near["key"].to_numpy(), near["whole"].to_numpy()
        null = near["doc_id"].is_null().to_numpy()
        doc, first = near["doc_id"].fill_null(0).to_numpy(), near["first"].to_numpy()
        n = len(key)
        new = np.ones(n, bool)
        new[1:] = (key[1:] != key[:-1]) | (whole[1:] != whole[:-1])
        at = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        l_null, l_doc, l_first = null[at], doc[at], first[at]
        if lead is not None and (key[0], whole[0]) == lead[:2]:
            new[0] = False
            stop = int(np.argmax(new)) if new.any() else n
            l_null[:stop], l_doc[:stop], l_first[:stop] = lead[2], lead[3], lead[4]
        leads = (null == l_null) & (null | (doc == l_doc)) & (first == l_first)
        k = np.flatnonzero(leads)
        if (~leads).any():
            yield marks(near.filter(pa.array(~leads)), np.zeros(int((~leads).sum()), bool))
        lead = (key[-1], whole[-1], l_null[-1], l_doc[-1], l_first[-1])
        if not len(k):
            continue
        firsts = near.take(pa.array(k))
        fk, fw = firsts["key"].to_numpy(), firsts["whole"].to_numpy()
        # Runs of one extension; a run's key has another whole if a run beside it has the same key.
        cut = np.flatnonzero(np.concatenate([[True], (fk[1:] != fk[:-1]) | (fw[1:] != fw[:-1])]))
        ends = np.append(cut[1:], len(fk))
        if (fk[0], fw[0]) == (run_key, run_whole):
            more = firsts.slice(0, int(ends[0]))
            if decided:
                yield marks(more, np.ones(more.num_rows, bool))
            else:
                held.append(more)
                if sum(x.num_rows for x in held) > RUN_LIMIT:
                    yield from checked()
                    decided = True
            cut, ends = cut[1:], ends[1:]
        if not len(cut):
            continue
        keys = fk[cut]
        beside = np.zeros(len(cut), bool)
        beside[1:] |= keys[1:] == keys[:-1]
        beside[:-1] |= keys[1:] == keys[:-1]
        if keys[0] == run_key:
            yield from checked()
            beside[0] = True
        held.clear()
        now = np.repeat(beside, ends - cut)
        if now.any():
            yield marks(firsts.slice(int(cut[0])).filter(pa.array(now)), np.ones(int(now.sum()), bool))
        run_key, run_whole, decided = keys[-1], fw[cut[-1]], bool(beside[-1])
        if not decided:
            held.append(firsts.slice(int(cut[-1])).combine_chunks())


def _windows(window: int, gram: int):
    """Documents with the seeds to check → their windows, each with anchor and window hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, text in text_slices(batch):
                words, offs = split_words(text)
                seq = Sequences(words)
                lists = rows.column(rows.schema.get_field_index("spans"))
                spans = lists.flatten()
                per = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(len(per)), per)
                lo = spans.field(0).to_numpy().astype(np.int64) + offs[doc]
                hi = spans.field(1).to_numpy().astype(np.int64) + offs[doc]
                at = expand(lo, hi - lo + 1)
                doc = np.repeat(doc, hi - lo + 1)
                null = pc.is_null(rows.column(0)).to_numpy(zero_copy_only=False)[doc]
                ids = pc.fill_null(rows.column(0), 0).to_numpy(zero_copy_only=False)[doc]
                tie = rows.column(1).to_numpy()[doc]
                a, b = seq.hash(at, at + window), seq.hash(at, at + window, 1)
                lead = _earliest([a, b], ids, null, at - offs[doc])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.where(lead, OPEN, REPEAT).astype(np.int8)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(ids, mask=null),
                     pa.array(tie), pa.array((at - offs[doc]).astype(np.int32)),
                     pa.array((at - offs[doc]).astype(np.int32))],
                    names=NAMES)
    return run


def _sorted(seeds_: DataFrame) -> DataFrame:
    """Open seeds by content; the others go anywhere."""
    place = F.when(F.col("far") != OPEN, F.xxhash64("doc_id", "first")).otherwise(F.col("key"))
    return seeds_.repartition(shuffle_parts(seeds_.sparkSession), place).sortWithinPartitions(
        "far", "key", "whole", F.col("doc_id").asc_nulls_first(), "first", "tie")


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM,
                     id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, size: int | None = None) -> DataFrame:
    """Ranges of windows (doc_id, tie, first, last: word numbers of their starts) that have an earlier equal.

    ``size``: the bytes of all texts, if they are known.
    """
    if gram > window:
        raise ValueError("an anchor must fit into a window")
    src = plain(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    size = total_bytes(src, "text") if size is None else size
    marks = _sorted(src.mapInArrow(_cut(window, gram, hot), SEED)).mapInArrow(_compare, MARK).where("first >= 0")
    marks = materialise(gathered(marks, size=size), "seed_marks")
    repeats = marks.where("not check").drop("check")
    check = marks.where("check")
    tied = _with_spans(src, check, "inner").select("doc_id", "tie", "text", "spans")
    windows = _sorted(tied.mapInArrow(_windows(window, gram), SEED)).mapInArrow(_compare, MARK)
    # No two windows of equal hash differ, so nothing is left to check.
    return repeats.unionByName(windows.where("not check").drop("check"))


def tie_of(text_col: str = "text"):
    """The number that tells apart different texts of one doc_id, as a column (see ``_text_tie``)."""
    return F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))


def _with_spans(src: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """src (doc_id, text and any others) with the marked ranges of its document, in column spans."""
    # Repeated rows mark the same ranges: each counts once, in every task's part first.
    spans = marks.groupBy("doc_id", "tie").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    spans = spans.withColumnsRenamed({"doc_id": "_doc", "tie": "_own"})
    tied = src.withColumn("tie", tie_of())
    return tied.join(spans, tied["doc_id"].eqNullSafe(spans["_doc"]) & (tied["tie"] == spans["_own"]), how).drop("_doc", "_own")


def _covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in one of the ranges [start, end)."""
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, starts, 1)
    np.add.at(delta, ends, -1)
    return np.cumsum(delta[:-1]) > 0


def _left(text: pa.Array, lists: pa.Array, window: int) -> Iterator[tuple[int, int, bytes]]:
    """(words, words removed, words left joined by one space) of every text."""
    for t, spans in zip(text, lists):
        words = t.as_buffer().to_pybytes().split()
        n, removed = len(words), 0
        if spans.is_valid:
            lo = spans.values.field(0).to_numpy().astype(np.int64)
            hi = spans.values.field(1).to_numpy().astype(np.int64) + window
            gone = _covered(lo, hi, n)
            removed = int(gone.sum())
            words = [words[k] for k in np.flatnonzero(~gone).tolist()]
        yield n, removed, b" ".join(words)


CLEAN = "doc_id long, n_words long, n_removed long, kept string"


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM,
                   id_col: str = "doc_id", text_col: str = "text", digest: bool = False, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept: words left, joined by one space (its SHA-256 with ``digest``)."""
    src = plain(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    joined = _with_spans(src, repeated_windows(docs, window, gram, id_col, text_col, hot), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, text in text_slices(batch):
                total, removed, left = zip(*_left(text, rows.column(2), window))
                kept = [hashlib.sha256(x).hexdigest() if digest else x.decode() for x in left]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept"])

    return joined.select("doc_id", "text", "spans").mapInArrow(run, CLEAN)


def drop_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id",
                 text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with repeated passages cut from their texts; a text without any stays as it is, byte for byte.

    All rows and columns stay; ``size_col``, if there is one, follows the text's length.
    """
    src = docs.select(F.struct("*").alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      F.col(f"`{text_col}`").alias("text"))
    size = total_bytes(src, "text")
    joined = _with_spans(src, repeated_windows(docs, window, gram, id_col, text_col, size=size), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, text in text_slices(batch):
                lists = rows.column(rows.schema.get_field_index("spans"))
                new = [left.decode() if removed else None for _, removed, left in _left(text, lists, window)]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(new, pa.string())], names=["row", "left"])

    row_type = src.schema["row"].dataType.simpleString()
    done = joined.select("row", "text", "spans").mapInArrow(run, f"row {row_type}, left string")
    cut = F.col("left").isNotNull()
    columns = []
    for c in docs.columns:
        own = F.col("row").getField(c)
        if c == text_col:
            own = F.coalesce("left", own)
        elif c == size_col:
            own = F.when(cut, F.length("left").cast(docs.schema[c].dataType)).otherwise(own)
        columns.append(own.alias(c))
    return gathered(done.select(columns), size=size)
