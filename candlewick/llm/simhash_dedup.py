"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Fingerprints at most d bits apart differ in at most d of their 8 bytes, so they share at
least 8 - d bytes at equal positions: the guaranteed count.  The index is keyed by
combinations of positional bytes rather than by single ones (256 values a position
would make every list a fixed share of the corpus): two fingerprints that share 8 - d
bytes share r of any 8 - (8 - d) + r positions, so keys are the r-subsets of those
positions, r = min(3, 8 - d).  In each list the shared positional bytes of a pair are
tallied, pairs that reach the count are kept, and the bit distance is verified.

Only distinct fingerprints are indexed, so copies cost one group-by.  A list too long for
a task's memory is cut in blocks that are compared block against block.  A list gives the
links that join its groups, not all its pairs; components follow from those.

Null and empty texts have fingerprint zero and link like any other; repeated rows each
get a row; a null doc_id is kept, and never names a component unless all its members are
null; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm._common import LOWER, gathered, materialise, plain, shuffle_parts, split_words, text_slices, translated
from candlewick.llm.components import components
from candlewick.llm.runs import Forest, block_pairs, buckets

SHINGLE, DISTANCE, SEED = 4, 4, 42
#: Fingerprints of one list held at once.
LIST_LIMIT = 8192
#: Text split into words at once, and shingles hashed and counted at once: a worker's arrays and
#: lists take 20 to 60 times the text, and workers keep much of what they once took.
SLICE = 1 << 20
BIT_ROWS = 1 << 14


def fingerprints(text: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """64-bit SimHash (uint64) of every text of a slice."""
    from xxhash import xxh64_intdigest as xxh

    words, offs = split_words(translated(text, LOWER))
    n = np.diff(offs)
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offs), words), pa.scalar(" ", pa.large_string()))
    _, where, data = joined.buffers()
    where = np.frombuffer(where, np.int64, len(joined) + 1, joined.offset * 8)
    size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size + 1)
    starts = ends - size - 1
    full = n > 0
    # Where each text's first word begins in the joined bytes, less where it would without other texts' gaps.
    shift = np.zeros(len(n), np.int64)
    shift[full] = where[:-1][full] - starts[offs[:-1][full]]
    per = np.where(full, np.maximum(n - shingle + 1, 1), 0)
    raw = memoryview(data)[: where[-1]] if data is not None else memoryview(b"")

    counts = np.zeros((len(n), 64), np.int64)
    bounds = np.concatenate([[0], np.cumsum(per)])
    for at in range(0, int(bounds[-1]), BIT_ROWS):
        to = min(int(bounds[-1]), at + BIT_ROWS)
        a = int(np.searchsorted(bounds, at, side="right")) - 1
        b = int(np.searchsorted(bounds, to, side="left"))
        own = np.arange(a, b)[per[a:b] > 0]
        begin = np.maximum(bounds[own] - at, 0)
        doc = np.repeat(own, np.diff(np.append(begin, to - at)))
        first = offs[doc] + np.arange(at, to) - bounds[doc]
        last = np.minimum(first + shingle, offs[doc + 1]) - 1
        lo, hi = starts[first] + shift[doc], starts[last] + size[last] + shift[doc]
        hashes = np.fromiter((xxh(raw[x:y], SEED) for x, y in zip(lo.tolist(), hi.tolist())), np.uint64, to - at)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts[own] += np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
    set_bits = (2 * counts > per[:, None]).astype(np.uint8)
    return np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64).ravel()


def list_keys(distance: int) -> tuple[list[tuple[int, ...]], int]:
    """Byte positions of every key, and the guaranteed number of shared positional bytes."""
    need = 8 - distance
    if not 0 <= distance < 8:
        raise ValueError("distance must be 0 to 7: beyond, two fingerprints may share no byte")
    r = min(3, need)
    return list(combinations(range(distance + r), r)), need


def _pairs(fp: np.ndarray, key: np.ndarray, need: int, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of equal key that reach the count and the distance, by how far apart they stand."""
    at, step = np.arange(len(fp) - 1), 1
    while len(at):
        at = at[at + step < len(fp)]
        at = at[key[at] == key[at + step]]
        x = fp[at] ^ fp[at + step]
        tally = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        good = at[tally >= need]
        good = good[np.bitwise_count(fp[good] ^ fp[good + step]) <= distance]
        if len(good):
            yield good, good + step
        step += 1


LINKS = "a long, b long, key long, block long"


def _linker(need: int, distance: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, rows, block in buckets(batches, limit):
            key, fp = rows.column(0).to_numpy(), rows.column(1).to_numpy().view(np.uint64)
            if kind == "hot":
                none = pa.nulls(len(fp), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), none, pa.array(key), pa.array(block)],
                                                 names=["a", "b", "key", "block"])
                continue
            forest, found = Forest(len(fp)), []
            for i, j in _pairs(fp, key, need, distance):
                found.append(forest.join(i, j))
            if found:
                i, j = (np.concatenate(x) for x in zip(*found))
                none = pa.nulls(len(i), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp[i].view(np.int64)), pa.array(fp[j].view(np.int64)), none, none],
                    names=["a", "b", "key", "block"])
    return run


def links(distinct: DataFrame, distance: int = DISTANCE, limit: int = LIST_LIMIT, most: int | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect all within ``distance``.

    ``most``: how many fingerprints there are at most, if that is known.
    """
    spark = distinct.sparkSession
    subsets, need = list_keys(distance)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 20_000):
                fp = batch.column(0).slice(part, 20_000).to_numpy(zero_copy_only=False).view(np.uint64)
                byte = fp.view(np.uint8).reshape(-1, 8).astype(np.int64)
                keys = []
                for k, s in enumerate(subsets):
                    value = np.full(len(fp), k, np.int64)
                    for p in s:
                        value = (value << 8) | byte[:, p]
                    keys.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.tile(fp.view(np.int64), len(subsets)))],
                    names=["key", "fp"])

    listed = distinct.select("fp").mapInArrow(index, "key long, fp long")
    listed = listed.repartition(shuffle_parts(spark), "key").sortWithinPartitions("key", "fp")
    found = listed.mapInArrow(_linker(need, distance, limit), LINKS)
    found = materialise(found if most is None else gathered(found, most * len(subsets)), "simhash_links")
    out = found.where("b is not null").select("a", "b")
    hot = found.where("b is null").select("key", F.col("a").alias("fp"), "block")
    if not hot.isEmpty():
        pairs = block_pairs(hot).select(F.xxhash64("key", "lo", "hi").alias("key"), "fp")
        pairs = pairs.repartition(shuffle_parts(spark), "key").sortWithinPartitions("key", "fp")
        # A pair of blocks holds 2 * limit rows at most.
        again = pairs.mapInArrow(_linker(need, distance, 1 << 62), LINKS)
        out = out.unionByName(again.select("a", "b"))
    return out


def _marker(own: list[str], shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprints(text, shingle) for _, text in text_slices(batch, limit=SLICE)]
            fp = np.concatenate([np.zeros(0, np.uint64), *prints]).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.select(own).columns, pa.array(fp)], names=[*own, "fp"])
    return run


def _marked(src: DataFrame, shingle: int) -> DataFrame:
    """The columns of ``src`` besides text, and fp: written once."""
    own = [c for c in src.columns if c != "text"]
    schema = ", ".join(f"{c} {src.schema[c].dataType.simpleString()}" for c in own) + ", fp long"
    return materialise(src.mapInArrow(_marker(own, shingle), schema), "fingerprints")


def _least(marked: DataFrame, value, distance: int) -> DataFrame:
    """fp, least: the least ``value`` in the component of every fingerprint."""
    n = marked.count()
    classes = marked.groupBy("fp").agg(F.min(value).alias("least"))
    # A fingerprint has a row in each list, and a list gives less links than it has rows.
    linked = components(links(classes.select("fp"), distance, most=n), most=n * len(list_keys(distance)[0]))
    linked = linked.withColumnsRenamed({"vertex": "fp", "component": "root"})
    # Only fingerprints with a link need their component's least.  Both sides of the join by
    # root are read from written tables, so a component that holds many of them is split.
    members = materialise(gathered(classes.join(linked, "fp"), n), "members")
    least = materialise(gathered(members.groupBy("root").agg(F.min("least").alias("shared")), n), "least")
    shared = members.join(least, "root").select("fp", "shared")
    named = classes.join(shared, "fp", "left").select("fp", F.coalesce("shared", "least").alias("least"))
    return materialise(gathered(named, n), "classes")


def simhash_classes(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    src = plain(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    marked = _marked(src, shingle)
    named = _least(marked, F.col("doc_id"), distance).withColumnRenamed("least", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component (all columns as they were): the least by (doc_id, text hash), null ids last.

    A row is known by its id and text, so texts that share an id are told apart; of rows
    equal in both any one stays.
    """
    row_id = F.col(f"`{id_col}`").cast("long")
    tie = F.xxhash64(F.col(f"`{text_col}`"))
    marked = _marked(docs.select(row_id.alias("doc_id"), tie.alias("tie"), F.col(f"`{text_col}`").alias("text")), shingle)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")
    # Rows equal in id and text are one from here on, and how many there are.
    rows = marked.groupBy("fp", "doc_id", "tie").agg(F.count(F.lit(1)).alias("n")).join(_least(marked, place, distance), "fp")
    # Names that no column of the input has.
    free = "_" * (1 + max(len(c) for c in docs.columns))
    d, t = f"{free}doc", f"{free}tie"
    away = rows.where(~place.eqNullSafe(F.col("least")) | (F.col("n") > 1)).select(F.col("doc_id").alias(d), F.col("tie").alias(t))
    many = rows.where(place.eqNullSafe(F.col("least")) & (F.col("n") > 1)).select(F.col("doc_id").alias(d), F.col("tie").alias(t))
    same = row_id.eqNullSafe(F.col(d)) & (tie == F.col(t))
    kept = docs.join(away, same, "left_anti").select(docs.columns)
    # A partial aggregate: each task sends one of the equal rows it holds.
    once = docs.join(many, same, "left_semi").groupBy(row_id.alias(d), tie.alias(t)).agg(
        F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row")).select("row.*")
    return kept.unionByName(once)
