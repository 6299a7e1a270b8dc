"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Grades 0 (clean) to ``GRADES`` - 1.  Labels say toxic or not; a toxic training document's
grade is the part of toxic documents (by thirds, with 4 grades) into which its share of
toxic words falls, where a word is toxic if its odds between the classes are over
``TOXIC_ODDS``, and counts by its evidence.  Features are indicators of words (letters only, lower case) and of their
first 4, 5 and 6 letters.  Each is scaled by its evidence: the standard errors by which its
share differs between the classes, as a part of the strongest term's, squared.  So the penalty falls
hardest on weak terms, and no term has to pass an absolute figure that few labels can't
reach.  P(grade >= k) = logistic(w.x - t_k) with one weight vector for
all thresholds t_1 < t_2 < ...; the weights are fitted by full-batch gradient steps with
an L2 penalty.  Results: expected severity (the sum of P(grade >= k), 0 to GRADES - 1),
the likeliest grade, and toxic: w.x over the cut with the fewest errors on the training
rows (the grades' spread makes P(grade >= 1) too cautious to be cut at one half).

The model learns from at most ``MAX_TRAIN`` labelled documents outside the held-out fold
and keeps the ``MAX_FEATURES`` terms of most evidence; terms are counted by Spark; every document is scored in one pass without a shuffle.
Null and empty texts have no feature (w.x = 0);
null doc_ids are kept and count as held out; repeated rows each get a row; without labels
of both classes nothing is toxic; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm._common import coded, crc_mod, plain, split_words, text_slices, translated
from candlewick.llm.labelled import MAX_TRAIN, training_rows

FOLD, FOLDS = 1, 3
GRADES = 4
PREFIXES = (4, 5, 6)
MIN_DOCS, MAX_FEATURES = 3, 20_000
TOXIC_ODDS = 10.0
PENALTY, ROUNDS, RATE = 1e-3, 300, 0.1
SLICE = 6 << 20

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0x80 else 32 for c in range(256))


def slice_terms(text: pa.Array) -> tuple[np.ndarray, np.ndarray, list[pa.Array]]:
    """(word code, document) of every word, and the term of every distinct word in each kind (null: none)."""
    words, offs = split_words(translated(text, _LETTERS))
    codes, distinct = coded(words)
    distinct = pc.utf8_lower(distinct)
    length = pc.utf8_length(distinct)
    kinds = [distinct]
    for n in PREFIXES:
        kinds.append(pc.if_else(pc.greater(length, n), pc.binary_join_element_wise(
            pc.utf8_slice_codeunits(distinct, 0, n), pa.scalar("", pa.large_string()),
            pa.scalar("*", pa.large_string())), pa.scalar(None, pa.large_string())))
    return codes, np.repeat(np.arange(len(text)), np.diff(offs)), kinds


class Vocabulary:
    def __init__(self, terms: list[str]):
        self.terms = pa.array(terms, pa.large_string())

    def pairs(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, feature) of a slice."""
        codes, doc, kinds = slice_terms(text)
        out = []
        for kind in kinds:
            own = pc.fill_null(pc.index_in(kind, value_set=self.terms, skip_nulls=True), -1).to_numpy(zero_copy_only=False)
            f = own[codes] if len(codes) else codes
            hit = f >= 0
            out.append(doc[hit].astype(np.int64) * max(1, len(self.terms)) + f[hit])
        pair = np.unique(np.concatenate(out))
        return pair // max(1, len(self.terms)), pair % max(1, len(self.terms))


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit_ordinal(doc: np.ndarray, feature: np.ndarray, grade: np.ndarray, features: int, grades: int = GRADES,
                rounds: int = ROUNDS, rate: float = RATE, penalty: float = PENALTY,
                scale: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of the cumulative-link model; (doc, feature) are the indicators that are set.

    ``scale`` is the value of each feature's indicator (1 without it); the weights returned include it.
    The log-likelihood of grade g is log(F(t_g+1 - s) - F(t_g - s)), s = w.x; thresholds are a first value
    plus steps kept positive through their logarithms.  Adaptive-moment gradient steps on all rows.
    """
    n = len(grade)
    scale = np.ones(features) if scale is None else scale
    value = scale[feature]
    share = np.array([(np.sum(grade >= k) + 0.5) / (n + 1) for k in range(1, grades)])
    start = -np.log(share / (1 - share))
    x = np.concatenate([np.zeros(features), [start[0]], np.log(np.maximum(np.diff(start), 0.05))])
    m, v = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, rounds + 1):
        w, first, gaps = x[:features], x[features], np.exp(x[features + 1:])
        t = first + np.concatenate([[0.0], np.cumsum(gaps)])
        s = np.bincount(doc, w[feature] * value, minlength=n)
        edge = np.concatenate([[-np.inf], t, [np.inf]])
        hi, lo = logistic(edge[grade + 1] - s), logistic(edge[grade] - s)
        p = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi) / p, lo * (1 - lo) / p
        slope_s = (d_hi - d_lo) / n  # of the loss -log p
        g_t = np.zeros(grades - 1)
        for k in range(grades - 1):
            g_t[k] = (d_lo[grade == k + 1].sum() - d_hi[grade == k].sum()) / n
        g = np.concatenate([np.bincount(feature, slope_s[doc] * value, minlength=features) + penalty * w, [g_t.sum()],
                            gaps * np.cumsum(g_t[::-1])[::-1][1:]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    gaps = np.exp(x[features + 1:])
    return x[:features] * scale, x[features] + np.concatenate([[0.0], np.cumsum(gaps)])


class Model:
    def __init__(self, vocabulary: Vocabulary, weights: np.ndarray, thresholds: np.ndarray, cut: float):
        self.vocabulary, self.weights, self.thresholds, self.cut = vocabulary, weights, thresholds, cut

    def scores(self, text: pa.Array) -> np.ndarray:
        """w.x of every text."""
        doc, feature = self.vocabulary.pairs(text)
        return np.bincount(doc, self.weights[feature] if len(feature) else None, minlength=len(text)).astype(float)


def best_cut(s: np.ndarray, y: np.ndarray) -> float:
    """The cut of fewest errors (toxic at or above it), midway between the scores beside it; ties: the highest."""
    values = np.unique(s)
    at = np.searchsorted(values, s)
    ones, zeros = (np.bincount(at, y == k, minlength=len(values)) for k in (1, 0))
    # Cut j lies below values[j]; the last one is above all.
    errors = np.concatenate([[0], np.cumsum(ones)]) + np.concatenate([np.cumsum(zeros[::-1])[::-1], [0]])
    j = len(errors) - 1 - int(np.argmin(errors[::-1]))
    if j == len(values):
        return float(values[-1]) + 1.0
    return float((values[j] + values[j - 1]) / 2) if j else float(values[0])


def fit(train: DataFrame, grades: int = GRADES) -> Model:
    """A model from (doc_id, y, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, text in text_slices(batch.select(["y", "text"]), limit=SLICE):
                y = rows.column(0).to_numpy()
                codes, doc, kinds = slice_terms(text)
                for kind in kinds:
                    term = kind.dictionary_encode()
                    own = pc.fill_null(term.indices, -1).to_numpy(zero_copy_only=False)[codes] if len(codes) else codes
                    hit = own >= 0
                    size = max(1, len(term.dictionary))
                    pair = np.unique(doc[hit].astype(np.int64) * size + own[hit])
                    n = np.bincount(pair % size, minlength=size)
                    n1 = np.bincount(pair % size, y[pair // size] if len(pair) else None, minlength=size)
                    k = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays(
                        [term.dictionary.take(pa.array(k)).cast(pa.string()), pa.array(n[k].astype(np.int64)),
                         pa.array(n1[k].astype(np.int64))], names=["term", "n", "n1"])

    sizes = train.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("n1")).first()
    if sizes.n1 in (0, sizes.n):
        return Model(Vocabulary([]), np.zeros(0), np.full(grades - 1, 50.0), np.inf)
    counted = train.mapInArrow(run, "term string, n long, n1 long").groupBy("term").agg(
        F.sum("n").alias("n"), F.sum("n1").alias("n1")).where(F.col("n") >= MIN_DOCS)
    p1, p0 = F.col("n1") / F.lit(sizes.n1), (F.col("n") - F.col("n1")) / F.lit(sizes.n - sizes.n1)
    p = F.col("n") / F.lit(sizes.n)
    z = F.abs(p1 - p0) / F.sqrt(p * (1 - p) * F.lit(1 / sizes.n1 + 1 / (sizes.n - sizes.n1)) + F.lit(1e-12))
    odds = ((F.col("n1") + 0.5) / F.lit(sizes.n1)) / ((F.col("n") - F.col("n1") + 0.5) / F.lit(sizes.n - sizes.n1))
    best = counted.select("term", z.alias("z"), odds.alias("odds")).orderBy(F.desc("z"), "term").limit(MAX_FEATURES).collect()
    vocabulary = Vocabulary([r.term for r in best])
    evidence = np.array([r.z for r in best], float)
    scale = (evidence / max(evidence.max(initial=0.0), 1e-12)) ** 2
    is_toxic = np.array([r.odds > TOXIC_ODDS and not r.term.endswith("*") for r in best], bool)

    def set_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, text in text_slices(batch.select(["y", "text"]), limit=SLICE):
                doc, feature = vocabulary.pairs(text)
                bounds = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(text)))]).astype(np.int32)
                words = np.diff(split_words(text)[1])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(words, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(feature.astype(np.int32)))],
                    names=["y", "words", "features"])

    y, words, sets = [], [], []
    for r in train.mapInArrow(set_features, "y int, words long, features array<int>").toLocalIterator():
        y.append(r.y)
        words.append(r.words)
        sets.append(np.array(r.features, np.int64))
    y, words = np.array(y), np.array(words)
    doc = np.repeat(np.arange(len(y)), [len(s) for s in sets])
    feature = np.concatenate(sets) if sets else np.zeros(0, np.int64)
    rate = np.bincount(doc, (is_toxic * scale)[feature] if len(feature) else None, minlength=len(y)) / np.maximum(words, 1)
    cuts = np.quantile(rate[y == 1], np.arange(1, grades - 1) / (grades - 1))
    grade = np.where(y == 1, 1 + np.searchsorted(cuts, rate, side="left"), 0)
    weights, thresholds = fit_ordinal(doc, feature, grade, len(best), grades, scale=scale)
    s = np.bincount(doc, weights[feature] if len(feature) else None, minlength=len(y)).astype(float)
    return Model(vocabulary, weights, thresholds, best_cut(s, y))


def severity(docs: DataFrame, labels: DataFrame, label: str = "toxic", fold: int = FOLD, folds: int = FOLDS,
             max_train: int = MAX_TRAIN, grades: int = GRADES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, severity (expected), grade, toxic."""
    src = plain(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    model = fit(training_rows(src, labels, label, fold, folds, max_train), grades)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, text in text_slices(batch, limit=SLICE):
                s = model.scores(text)
                above = logistic(s[:, None] - model.thresholds)
                each = -np.diff(np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], axis=1))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(above.sum(axis=1)), pa.array(each.argmax(axis=1).astype(np.int32)),
                     pa.array(s >= model.cut)], names=["doc_id", "severity", "grade", "toxic"])

    held = F.coalesce(crc_mod("doc_id", folds) == fold, F.lit(True))
    return src.mapInArrow(run, "doc_id long, severity double, grade int, toxic boolean").select(
        "doc_id", held.alias("held_out"), "severity", "grade", "toxic")


def remove_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not toxic (all columns as they were)."""
    src = plain(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    model = fit(training_rows(src, labels, "toxic", FOLD, FOLDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, text in text_slices(batch, column=text_col, limit=SLICE):
                yield rows.filter(pa.array(model.scores(text) < model.cut))

    return docs.mapInArrow(run, docs.schema)
