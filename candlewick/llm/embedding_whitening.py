"""Whitening of embeddings from an exact scatter matrix, by bit-sliced cross-products.

Each entry c becomes the integer x = floor(64 c) + 1000000.  The fit list holds every
distinct x vector once.  Its sums and cross-products are exact integers:

1. Vectors are packed into short binary keys (x less its constant, in the narrowest
   integer type that holds them all), which a partial and a final aggregate make distinct.
2. Each task takes its keys in blocks of ``BLOCK`` rows.  In a block each dimension is
   shifted to start at 0 and cut into bit planes, and every plane is packed across rows
   into 64-bit words.  The cross-product of two dimensions is the sum over their planes a,
   b of 2^(a+b) times the popcount of the AND of the two planes' words.  The shift is undone
   with integer sums.
3. Tasks send one number for each pair of dimensions; Spark adds them up as decimals (high
   and low halves, so nothing overflows).  The driver gets d(d+1)/2 pairs, whatever the rows.
4. n * C - S S^T is the scatter, n^2 times the covariance, centred in integers; its
   correctly rounded quotient goes to ``eigh``.
5. Rows are projected where they lie; the model is d x 16 numbers.  The covariance of the
   whitened fit list is measured on its rows, as sums of products over the fit list again.

Defined results: rows whose vector is null, empty or holds a null or non-finite entry are
dropped, as are rows with an entry whose x is no long.  Vectors must have one length; of
several lengths, that of most rows counts (of equals the greater) and other rows are
dropped.  Components whose eigenvalue is not above rounding (1e-12 of the greatest) have no
scale and are left out: a table with one distinct vector has no rows, nor has an empty one.
``deviation`` is null where it is no long.  Equal eigenvalues share a plane, in which any
basis is right.  Repeated rows each get their rows; null ids are kept; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from candlewick.llm._common import materialise, plain

SCALE, CONSTANT = 64, 1_000_000
#: Components returned.
COMPONENTS = 16
#: Rows of one bit-sliced block (a multiple of 64).
BLOCK = 1 << 14
#: Rows projected at once.
SLICE_ROWS = 4096
_RANK = 1e-12
_LONG = 1 << 63


# -- packed keys ------------------------------------------------------------

def _integers(vectors: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows whose vector counts, and their z = floor(64 c), grouped by length: (row numbers, z) for each length."""
    vectors = vectors.cast(pa.large_list(pa.float64()))
    size = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    offsets = vectors.offsets.to_numpy()
    flat = vectors.values
    nulls = flat.is_null().to_numpy(zero_copy_only=False)
    c = flat.fill_null(0.0).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        z = np.floor(c * SCALE)
    # x = z + CONSTANT must be a long.
    bad = nulls | ~np.isfinite(z) | (z < -float(_LONG)) | (z >= float(_LONG) - 2 * CONSTANT)
    wrong = np.concatenate([[0], np.cumsum(bad)])
    fine = (size > 0) & (wrong[offsets[1:]] == wrong[offsets[:-1]])
    z = np.where(bad, 0, z).astype(np.int64)
    out = []
    for d in np.unique(size[fine]):
        rows = np.flatnonzero(fine & (size == d))
        out.append((rows, z[offsets[rows][:, None] + np.arange(int(d))]))
    return out


def _pack(z: np.ndarray) -> list[bytes]:
    """A key for each row: its integers in the narrowest of 1, 2, 4 and 8 bytes that holds them, after that width."""
    top = np.maximum(z.max(axis=1), ~z.min(axis=1))
    width = np.select([top < 1 << 7, top < 1 << 15, top < 1 << 31], [1, 2, 4], 8)
    keys: list[bytes] = [b""] * len(z)
    for w in np.unique(width):
        for i in np.flatnonzero(width == w):
            keys[i] = bytes([w]) + z[i].astype(f"<i{w}").tobytes()
    return keys


def _unpack(keys: list[bytes], d: int) -> np.ndarray:
    z = np.empty((len(keys), d), np.int64)
    for i, k in enumerate(keys):
        z[i] = np.frombuffer(k, f"<i{k[0]}", d, 1)
    return z


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            for _, z in _integers(batch.slice(at, SLICE_ROWS).column(0)):
                yield pa.RecordBatch.from_arrays([pa.array([z.shape[1]] * len(z), pa.int32()), pa.array(_pack(z), pa.binary())],
                                                 names=["d", "key"])


# -- exact scatter ----------------------------------------------------------

def bit_sliced(z: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Exact sums and cross-products (upper triangle, from the diagonal) of integer rows."""
    n, d = z.shape
    low = z.min(axis=0)
    # The difference of two longs may be no long: as unsigned words it always fits.
    y = z.astype(np.uint64) - low.astype(np.uint64)
    bits = [int(t).bit_length() for t in y.max(axis=0)]
    words = -(-n // 64)
    dims = np.repeat(np.arange(d), bits)
    planes = np.zeros((len(dims), words * 8), np.uint8)
    at = 0
    for j in range(d):
        for b in range(bits[j]):
            row = np.packbits((y[:, j] >> np.uint64(b)).astype(np.uint8) & 1)
            planes[at, :len(row)] = row
            at += 1
    planes = planes.view(np.uint64)
    starts = np.concatenate([[0], np.cumsum(bits)])
    ones = np.bitwise_count(planes).sum(axis=1, dtype=np.int64) if len(dims) else np.zeros(0, np.int64)
    sums = [sum(int(v) << b for b, v in enumerate(ones[starts[j]:starts[j + 1]])) for j in range(d)]
    cross: list[list[int]] = []
    # Sums of 2^(a+b) * count fit a long when the planes of both sides and the rows do.
    narrow = 2 * max(bits, default=0) + n.bit_length() < 62
    weight = np.concatenate([np.arange(b) for b in bits]).astype(np.int64) if len(dims) else np.zeros(0, np.int64)
    for j in range(d):
        own = slice(int(starts[j]), int(starts[j + 1]))
        rest = slice(int(starts[j]), len(dims))
        if narrow:
            total = np.zeros(d, np.int64)
            for b, plane in enumerate(planes[own]):
                shared = np.bitwise_count(planes[rest] & plane).sum(axis=1, dtype=np.int64)
                np.add.at(total, dims[rest], shared << (weight[rest] + b))
            cross.append([int(v) for v in total[j:]])
        else:
            exact = [0] * d
            for b, plane in enumerate(planes[own]):
                shared = np.bitwise_count(planes[rest] & plane).sum(axis=1, dtype=np.int64)
                for k, w, v in zip(dims[rest], weight[rest], shared):
                    exact[k] += int(v) << (int(w) + b)
            cross.append(exact[j:])
    # Undo the shift: z = y + low.
    low = [int(v) for v in low]
    for j in range(d):
        for k in range(j, d):
            cross[j][k - j] += low[j] * sums[k] + low[k] * sums[j] + n * low[j] * low[k]
    return [s + n * m for s, m in zip(sums, low)], cross


def _scatter(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross = 0, [0] * d, [[0] * (d - j) for j in range(d)]
        held: list[bytes] = []

        def add() -> None:
            nonlocal n
            s, c = bit_sliced(_unpack(held, d))
            n += len(held)
            for j in range(d):
                sums[j] += s[j]
                cross[j] = [a + b for a, b in zip(cross[j], c[j])]
            held.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                held += batch.slice(at, BLOCK).column(0).to_pylist()
                if len(held) >= BLOCK:
                    add()
        if held:
            add()
        if not n:
            return
        # i = -1: n; j = -1: the sums; else the cross-product of i and j.
        rows = [(-1, -1, n)] + [(i, -1, s) for i, s in enumerate(sums)] + [
            (i, i + k, v) for i, c in enumerate(cross) for k, v in enumerate(c)]
        i, j, v = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(x >> 64) for x in v], pa.string()),
             pa.array([str(x & (1 << 64) - 1) for x in v], pa.string())], names=["i", "j", "high", "low"])
    return run


class Whitening:
    """n, S (of z = x - constant) and the exact scatter; eigenvectors and eigenvalues of the covariance."""

    def __init__(self, n: int, sums: list[int], cross: dict[tuple[int, int], int], components: int):
        d = len(sums)
        self.n, self.sums, self.d = n, sums, d
        v = np.empty((d, d))
        for i in range(d):
            for j in range(i, d):
                # Centred as integers; Python divides integers with correct rounding.
                v[i, j] = v[j, i] = (n * cross[i, j] - sums[i] * sums[j]) / (n * n)
        values, vectors = np.linalg.eigh(v)
        order = np.argsort(-values, kind="stable")
        values, vectors = values[order], vectors[:, order]
        self.trace = float(np.trace(v))
        k = int((values[:components] > _RANK * max(float(values[0]), 0.0)).sum()) if self.trace > 0 else 0
        self.values, self.vectors = values[:k], vectors[:, :k]
        self.explained = self.values / self.trace if k else self.values
        self.axes = self.vectors / np.sqrt(self.values)

    def centred(self, z: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """(x - S / n as doubles, exact sum of (n x - S)^2 or None where it is no long)."""
        n, big = self.n, max((abs(s) for s in self.sums), default=0)
        most = max(int(z.max(initial=0)), -int(z.min(initial=0)))
        if (n * most + big) ** 2 * self.d < _LONG:
            m = z * n - np.array(self.sums, np.int64)
            return m / n, (m * m).sum(axis=1).tolist()
        m = z.astype(object) * n - np.array(self.sums, object)
        total = [int(t) for t in (m * m).sum(axis=1)]
        return (m / n).astype(np.float64), [t if t < _LONG else None for t in total]


def fit_list(vectors: DataFrame, embedding: str = "embedding") -> tuple[DataFrame, int]:
    """(each distinct vector of the chosen length once, as a key; that length).  Written once."""
    keys = plain(vectors, embedding=embedding).mapInArrow(_keys, "d int, key binary")
    once = materialise(keys.groupBy("d", "key").agg(F.count(F.lit(1)).alias("rows")), "whitening_fit")
    # One row for each length.
    most = once.groupBy("d").agg(F.sum("rows").alias("rows")).orderBy(F.desc("rows"), F.desc("d")).head()
    d = most.d if most else 0
    return once.where(F.col("d") == d).select("key"), d


def fit(once: DataFrame, d: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a fit list; None if that is empty."""
    if not d:
        return None
    parts = once.mapInArrow(_scatter(d), "i int, j int, high string, low string")
    whole = T.DecimalType(38, 0)
    totals = parts.groupBy("i", "j").agg(F.sum(F.col("high").cast(whole)).alias("high"), F.sum(F.col("low").cast(whole)).alias("low"))
    found = {(r.i, r.j): (int(r.high) << 64) + int(r.low) for r in totals.collect()}
    return Whitening(found[-1, -1], [found[i, -1] for i in range(d)], found, components)


def identity_error(once: DataFrame, model: Whitening) -> float:
    """Greatest absolute entry of the whitened fit list's covariance less the identity, over its rows."""
    k, d = len(model.values), model.d

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                w = model.centred(_unpack(batch.slice(at, SLICE_ROWS).column(0).to_pylist(), d))[0] @ model.axes
                total += w.T @ w
                sums += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()]), pa.array([sums.tolist()])], names=["total", "sums"])

    parts = once.mapInArrow(run, "total array<double>, sums array<double>")
    # One row a task comes in; k * k + k sums come back.
    flat = parts.select(F.posexplode(F.concat("total", "sums")).alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v"))
    v = np.zeros(k * k + k)
    for r in flat.collect():
        v[r["at"]] = r["v"]
    mean = v[k * k:] / model.n
    return float(np.abs(v[:k * k].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each vector and component: its whitened coordinate, with the figures of the fit."""
    rows = plain(vectors, vec_id=vec_id, embedding=embedding)
    key = T.StructField("vec_id", rows.schema["vec_id"].dataType)
    schema = T.StructType([key, T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
                           T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    once, d = fit_list(vectors, embedding)
    model = fit(once, d, components)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    error, k, arrow = identity_error(once, model), len(model.values), to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                for taken, z in _integers(part.column(1)):
                    if z.shape[1] != d:
                        continue
                    m, deviation = model.centred(z)
                    again = np.repeat(np.arange(len(taken)), k)
                    one = np.ones(len(again))
                    yield pa.RecordBatch.from_arrays([
                        part.column(0).take(pa.array(taken[again])).cast(arrow.field(0).type),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(taken))),
                        pa.array((one * model.n).astype(np.int64)), pa.array(deviation, pa.int64()).take(pa.array(again)),
                        pa.array((m @ model.axes).ravel()), pa.array(np.tile(model.explained, len(taken))),
                        pa.array(one * error)], schema=arrow)

    return rows.mapInArrow(run, schema)
