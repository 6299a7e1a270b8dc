"""Quality scores: naive Bayes support vectors.

Indicators of n-grams (n = 1 to 3) over word shapes: the case and script class of a
word's letters, its other characters, and whether it repeats the word before.  Indicators
are scaled by the log ratio of their smoothed shares in the two classes; a linear
hinge-loss model on the scaled indicators is fitted by dual coordinate descent, and the
margin is turned into a probability by a logistic curve through zero.

The model learns from at most ``MAX_TRAIN`` labelled documents outside the held-out fold;
every document is scored in one pass without a shuffle.  Null and empty texts have no
n-gram and get the score of the intercept; null doc_ids are kept and count as held out;
repeated rows each get a row; without labels of both classes every score is the share of
label 1 (0.5 without any); an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from candlewick.llm._common import coded, crc_mod, plain, split_words, text_slices
from candlewick.llm.labelled import MAX_TRAIN, training_rows

FOLD, FOLDS = 1, 3
ORDER = 3
MIN_DOCS, MAX_FEATURES = 3, 1 << 16
SMOOTH, COST, ROUNDS, SEED = 1.0, 1.0, 20, 3
SLICE = 4 << 20

_CLASS = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 else 48 if 48 <= c <= 57 else 0x7E if c >= 0x80 else c
               for c in range(256))


def shapes(words: list[str]) -> list[bytes]:
    """a: lower case, A: upper case, 0: digits, ~: letters beyond ASCII; other runs keep two characters."""
    text = "\n".join(words)
    upper = text.upper()
    # Upper-case letters beyond ASCII count as A: they differ from their lower case and equal their upper case.
    if not text.isascii():
        low = text.lower()
        if len(low) == len(text) == len(upper):
            text = "".join([c if c < "\x80" else ("A" if c == u != w else "a") for c, u, w in zip(text, upper, low)])
    raw = text.encode("utf-8", "surrogatepass").translate(_CLASS)
    raw = re.sub(rb"a+", b"a", raw)
    raw = re.sub(rb"A+", b"A", raw)
    raw = re.sub(rb"0+", b"0", raw)
    return re.sub(rb"([^\n])\1{2,}", rb"\1\1", raw).split(b"\n")


def indicators(text: pa.Array, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, n-gram hash) of a slice."""
    words, offs = split_words(text)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes, distinct = coded(words)
    kinds, kind = np.unique(np.array(shapes(distinct.to_pylist()), dtype=object), return_inverse=True)
    shape = kind[codes].astype(np.int64)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    same = np.zeros(len(codes), bool)
    same[1:] = (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
    shape = 2 * shape + same
    names = np.array([xxh64_intdigest(k + (b"=" if r else b"")) for k in kinds for r in (0, 1)], np.uint64)
    out_doc, out_gram = [], []
    base = len(names)
    gram, hashed = shape, None
    for n in range(1, order + 1):
        if n > 1:
            # Codes of longer n-grams are made dense before they grow again.
            ok = doc[: len(gram) - 1] == doc[n - 1:] if len(gram) > 1 else np.zeros(0, bool)
            gram = gram[:-1] * base + shape[n - 1:]
            own_doc, own = doc[: len(gram)][ok], gram[ok]
        else:
            own_doc, own = doc, gram
        if not len(own):
            break
        local, place = np.unique(own, return_inverse=True)
        pair = np.unique(own_doc * len(local) + place)
        if n == 1:
            hashed = names[local]
        else:
            parts, hashed = local.copy(), np.zeros(len(local), np.uint64)
            for k in range(n):
                part = names[parts % base]
                parts //= base
                hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + part + np.uint64(n)
            hashed ^= hashed >> np.uint64(29)
        out_doc.append(pair // len(local))
        out_gram.append(hashed[pair % len(local)].view(np.int64))
    return np.concatenate(out_doc), np.concatenate(out_gram)


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, features: int,
                            cost: np.ndarray, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Weights (the last is the intercept) of a linear model under hinge loss.

    One dual variable in [0, cost] a row; each step solves its one-dimensional problem
    exactly and moves the weights along the row.
    """
    w, alpha = np.zeros(features + 1), np.zeros(len(rows))
    norm = np.array([float(v @ v) + 1.0 for _, v in rows])
    pick = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in pick.permutation(len(rows)):
            f, v = rows[i]
            slope = y[i] * (w[f] @ v + w[-1]) - 1.0
            new = min(max(alpha[i] - slope / norm[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[f] += step * v
                w[-1] += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


class Model:
    def __init__(self, grams: np.ndarray, weights: np.ndarray, intercept: float, slope: float):
        self.grams, self.weights, self.intercept, self.slope = grams, weights, intercept, slope

    def scores(self, text: pa.Array) -> np.ndarray:
        doc, gram = indicators(text)
        at = np.minimum(np.searchsorted(self.grams, gram), max(0, len(self.grams) - 1))
        weight = np.where(self.grams[at] == gram, self.weights[at], 0.0) if len(self.grams) else np.zeros(len(gram))
        margin = np.bincount(doc, weight, minlength=len(text)) + self.intercept
        return 1 / (1 + np.exp(-np.clip(self.slope * margin, -500, 500)))


def fit(train: DataFrame, min_docs: int = MIN_DOCS, max_features: int = MAX_FEATURES) -> Model:
    """A model from (doc_id, y, text); terms are counted by Spark, the bounded sample is fitted on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, text in text_slices(batch.select(["y", "text"]), limit=SLICE):
                doc, gram = indicators(text)
                order = np.argsort(doc, kind="stable")
                bounds = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(text)))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.ListArray.from_arrays(pa.array(bounds), pa.array(gram[order]))], names=["y", "grams"])

    rows = train.mapInArrow(run, "y int, grams array<long>")
    gram = rows.select("y", F.explode("grams").alias("gram")).groupBy("gram").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("n1")).where(F.col("n") >= min_docs)
    kept = gram.orderBy(F.desc("n"), "gram").limit(max_features).toPandas().sort_values("gram")
    sizes = train.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("n1")).first()
    grams = kept["gram"].to_numpy(np.int64)
    if not len(kept) or sizes.n1 in (0, sizes.n):
        share = (sizes.n1 + 0.5) / (sizes.n + 1) if sizes.n else 0.5
        return Model(grams[:0], np.zeros(0), float(np.log(share / (1 - share))), 1.0)
    p = SMOOTH + kept["n1"].to_numpy(float)
    q = SMOOTH + (kept["n"] - kept["n1"]).to_numpy(float)
    ratio = np.log((p / p.sum()) / (q / q.sum()))

    samples, y = [], []
    for r in rows.toLocalIterator():
        own = np.array(r.grams, np.int64)
        at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
        at = at[grams[at] == own]
        samples.append((at, ratio[at]))
        y.append(1.0 if r.y else -1.0)
    y = np.array(y)
    # Rows of either class weigh as much in sum.
    cost = COST * np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))
    w = dual_coordinate_descent(samples, y, len(grams), cost)
    margin = np.array([w[f] @ v + w[-1] for f, v in samples])
    slopes = np.linspace(0.1, 5, 50)
    loss = [np.logaddexp(0, -s * y * margin).mean() for s in slopes]
    return Model(grams, w[:-1] * ratio, float(w[-1]), float(slopes[int(np.argmin(loss))]))


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", fold: int = FOLD, folds: int = FOLDS,
          max_train: int = MAX_TRAIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out (crc32 of the id mod ``folds`` is ``fold``), score, predicted."""
    src = plain(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    model = fit(training_rows(src, labels, label, fold, folds, max_train))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, text in text_slices(batch, limit=SLICE):
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(model.scores(text))], names=["doc_id", "score"])

    held = F.coalesce(crc_mod("doc_id", folds) == fold, F.lit(True))
    return src.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
