"""Embedding near-duplicates by Euclidean p-stable hashing and exact cosine checks.

Vectors are brought to length 1; in each of ``TABLES`` tables, ``DIRECTIONS`` Gaussian
projections plus an offset are cut into steps of ``WIDTH`` and together name a bucket.
Vectors in one bucket of one label are compared by cosine in double precision.  Two
vectors at distance c fall into one step with probability
p = 1 - 2 N(-w/c) - 2c / (w sqrt(2 pi)) (1 - exp(-w^2 / 2c^2)); ``miss_chance`` gives
(1 - p^k)^tables for the threshold, and the number of tables is chosen from it.

Projections are taken in whole numbers (vectors and directions are scaled and rounded),
so a vector has the same buckets wherever they are computed; a pair is counted only in
the first table where the two meet.  Equal vectors of a label are one class, so copies
cost a group-by.  A bucket that is too large for a task is cut in blocks that are
compared block against block.  A task returns counts and the links that join groups,
not all pairs.

Vectors that are null, zero, or hold null or non-finite components, and rows with a null
label or a null vec_id, link with nothing (a null vec_id has a null component).  Rows
that share a vec_id are one vertex of the components and share its number of links.
Vectors of different lengths never link.  An empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm._common import materialise, plain, shuffle_parts
from candlewick.llm.components import components
from candlewick.llm.runs import Forest, block_pairs, buckets

THRESHOLD = 0.98
DIRECTIONS, WIDTH, SEED = 10, 1.5, 7
#: Chance that one pair exactly at the threshold is in no common bucket.
MISS = 1e-9
#: Vectors of one bucket held at once.
BUCKET_LIMIT = 2048
#: Buckets of up to this size are compared across buckets at once.
SMALL = 24
#: Whole-number scales of vectors and directions: products stay exact in double precision.
UNIT, STEP = 1 << 20, 1 << 12


def step_chance(distance: float, width: float = WIDTH) -> float:
    """Chance that one projection puts two vectors at this distance into one step."""
    if distance <= 0:
        return 1.0
    r = width / distance
    below = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def tables_for(threshold: float, miss: float = MISS) -> int:
    together = step_chance(math.sqrt(2 - 2 * threshold)) ** DIRECTIONS
    return 1 if together >= 1 else max(1, math.ceil(math.log(miss) / math.log1p(-together)))


def miss_chance(threshold: float) -> float:
    together = step_chance(math.sqrt(2 - 2 * threshold)) ** DIRECTIONS
    return (1 - together) ** tables_for(threshold)


class Hasher:
    def __init__(self, dim: int, tables: int, seed: int = SEED):
        g = np.random.default_rng([seed, dim])
        self.tables = tables
        self.directions = np.rint(g.standard_normal((dim, tables * DIRECTIONS)) * STEP)
        self.width = float(round(WIDTH * UNIT * STEP))
        self.offsets = np.floor(g.random(tables * DIRECTIONS) * self.width)
        self.mix = g.integers(1, 1 << 62, DIRECTIONS, dtype=np.uint64) | np.uint64(1)

    def buckets(self, unit: np.ndarray) -> np.ndarray:
        """(vectors, tables) bucket names of unit vectors."""
        whole = np.rint(unit * UNIT)
        steps = np.floor((whole @ self.directions + self.offsets) / self.width).astype(np.int64)
        cells = steps.view(np.uint64).reshape(len(unit), self.tables, DIRECTIONS)
        x = (cells * self.mix).sum(axis=2, dtype=np.uint64)
        x ^= x >> np.uint64(31)
        return (x * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


_hashers: dict[tuple[int, int], Hasher] = {}


def hasher(dim: int, tables: int) -> Hasher:
    if (dim, tables) not in _hashers:
        _hashers[dim, tables] = Hasher(dim, tables)
    return _hashers[dim, tables]


def _unit(raw: np.ndarray) -> np.ndarray:
    """Scaled first by the largest component, so that no square overflows or vanishes."""
    x = raw.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


BUCKET = "key long, tab int, rep long, copies long, vector binary"
FOUND = "a long, b long, links long, key long, block long, tab int, copies long, vector binary"


def _found(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    kinds = {"a": pa.int64(), "b": pa.int64(), "links": pa.int64(), "key": pa.int64(), "block": pa.int64(),
             "tab": pa.int32(), "copies": pa.int64(), "vector": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[k], t) if k in columns else pa.nulls(n, t) for k, t in kinds.items()], names=list(kinds))


def _comparer(threshold: float, tables: int, limit: int, stored: str):
    """Counts and joining links of complete buckets; rows of too large ones come out as blocks."""

    def compare(key, tab, rep, copies, unit, part):
        """part: None, or the block of every row: only pairs of different blocks count (or of the one block)."""
        names = hasher(unit.shape[1], tables).buckets(unit)
        links, forest, found = np.zeros(len(rep), np.int64), Forest(len(rep)), []

        def take(i, j):
            first = (names[i] == names[j]).argmax(axis=1) == tab[i]
            i, j = i[first & (rep[i] != rep[j])], j[first & (rep[i] != rep[j])]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            found.append(forest.join(i, j))

        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(starts, len(key)))
        small = np.repeat(sizes <= SMALL, sizes)
        at, step = np.flatnonzero(small), 1
        while len(at):
            at = at[at + step < len(key)]
            at = at[key[at] == key[at + step]]
            for a in range(0, len(at), 50_000):
                i = at[a:a + 50_000]
                j = i + step
                good = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
                if part is not None:
                    good &= part[i] != part[j]
                if good.any():
                    take(i[good], j[good])
            step += 1
        for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
            for a in range(s, s + n, 512):
                b = min(a + 512, s + n)
                cosine = unit[a:b] @ unit[a:s + n].T
                i, j = np.nonzero(cosine >= threshold)
                good = i < j
                if part is not None:
                    good &= part[a + i] != part[a + j]
                if good.any():
                    take(a + i[good], a + j[good])
        if found:
            i, j = (np.concatenate(x) for x in zip(*found))
            if len(i):
                yield _found(a=rep[i], b=rep[j])
        some = np.flatnonzero(links)
        if len(some):
            own, place = np.unique(rep[some], return_inverse=True)
            yield _found(a=own, links=np.bincount(place, links[some]).astype(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, rows, block in buckets(batches, limit):
            key, tab, rep, copies = (rows[c].to_numpy() for c in ("key", "tab", "rep", "copies"))
            vectors = rows["vector"]
            if kind == "hot":
                yield _found(a=rep, key=key, block=block, tab=tab, copies=copies, vector=vectors.combine_chunks())
                continue
            # Buckets of one vector compare with nothing.
            shared = np.zeros(len(key), bool)
            shared[1:] = key[1:] == key[:-1]
            shared[:-1] |= key[1:] == key[:-1]
            if not shared.any():
                continue
            part = rows["part"].to_numpy() if "part" in rows.column_names else None
            raw = vectors.filter(pa.array(shared)).to_pylist()
            width = np.array([len(x) for x in raw])
            own = [x[shared] for x in (key, tab, rep, copies)] + [part[shared] if part is not None else None]
            for w in np.unique(width):
                same = np.flatnonzero(width == w)
                unit = _unit(np.frombuffer(b"".join([raw[k] for k in same]), stored).reshape(len(same), -1))
                yield from compare(*(x[same] for x in own[:4]), unit, own[4][same] if own[4] is not None else None)

    return run


def vector_classes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept: see the module's text."""
    spark = vectors.sparkSession
    parts, tables = shuffle_parts(spark), tables_for(threshold)
    src = plain(vectors, vec_id=id_col, vector=vector_col, label=label_col).withColumns(
        {"vec_id": F.col("vec_id").cast("long")})
    # Vectors travel in the width they are stored in; all sums are in double precision.
    single = src.schema["vector"].dataType.elementType.typeName() == "float"
    stored = "<f4" if single else "<f8"
    src = src.withColumn("vector", F.col("vector").cast("array<float>" if single else "array<double>"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(
        finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    src = src.withColumn("usable", usable)
    good = src.where("usable")
    classes = materialise(good.groupBy("label", "vector").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "vector_classes")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                rows = batch.slice(a, 500)
                raw = [np.asarray(v, stored) for v in rows.column(1).to_pylist()]
                label = np.array([xxhash.xxh64_intdigest(str(x)) & (2**63 - 1) for x in rows.column(0).to_pylist()], np.int64)
                rep, copies = rows.column(2).to_numpy(), rows.column(3).to_numpy()
                width = np.array([len(x) for x in raw])
                for w in np.unique(width):
                    k = np.flatnonzero(width == w)
                    names = hasher(int(w), tables).buckets(_unit(np.stack([raw[x] for x in k])))
                    # A bucket is named by label, dimension, table and steps.
                    tab = np.tile(np.arange(tables, dtype=np.int32), len(k))
                    key = names.ravel() ^ (np.repeat(label[k], tables) * np.int64(0x5851F42D4C957F2D)
                                           + (tab.astype(np.int64) + tables * int(w)) * np.int64(0x2545F4914F6CDD1D))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(tab), pa.array(np.repeat(rep[k], tables)),
                         pa.array(np.repeat(copies[k], tables)),
                         pa.array([raw[x].tobytes() for x in k for _ in range(tables)], pa.binary())],
                        names=["key", "tab", "rep", "copies", "vector"])

    hashed = classes.select("label", "vector", "rep", "copies").mapInArrow(index, BUCKET)
    hashed = hashed.repartition(parts, "key").sortWithinPartitions("key")
    found = materialise(hashed.mapInArrow(_comparer(threshold, tables, BUCKET_LIMIT, stored), FOUND), "vector_links")
    hot = found.where("block is not null")
    results = found.where("block is null").select("a", "b", "links")
    if not hot.isEmpty():
        pairs = block_pairs(hot.withColumnRenamed("a", "rep"))
        pairs = pairs.select(F.xxhash64("key", "lo", "hi").alias("key"), "tab", "rep", "copies", "vector",
                             # Rows of one block against itself each are a part of their own.
                             F.when(F.col("lo") < F.col("hi"), F.col("block")).otherwise(
                                 F.row_number().over(_within("key", "lo", "hi"))).cast("long").alias("part"))
        pairs = pairs.repartition(parts, "key").sortWithinPartitions("key")
        again = materialise(pairs.mapInArrow(_comparer(threshold, tables, 1 << 62, stored), FOUND), "vector_links")
        results = results.unionByName(again.select("a", "b", "links"))
    linked = components(results.where("b is not null"))
    counts = results.where("links is not null").groupBy("a").agg(F.sum("links").alias("links"))
    named = classes.join(counts, classes["rep"] == counts["a"], "left").join(
        linked, classes["rep"] == linked["vertex"], "left").select(
        "label", "vector", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    joined = good.join(named, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    rest = src.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _within(*columns: str):
    from pyspark.sql import Window
    return Window.partitionBy(*columns).orderBy("rep")
