"""Runs of equal keys in sorted partitions, with a bound on what is held.

``buckets`` reads a partition sorted by its first column and yields row groups in which
every key is complete, so keys can be handled together in numpy.  A key with over
``limit`` rows is never held: its rows come out as numbered blocks, to be shuffled again
by pairs of blocks (``block_pairs``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def buckets(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[str, pa.Table, np.ndarray | None]]:
    """("whole", rows, None): complete keys; ("hot", rows, blocks): part of one large key."""
    held: pa.Table | None = None
    hot, seen = None, 0

    def blocks(rows: pa.Table):
        nonlocal seen
        number = (seen + np.arange(rows.num_rows)) // limit
        seen += rows.num_rows
        return "hot", rows, number

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if hot is not None:
            keys = rows.column(0).to_numpy()
            same = int(np.searchsorted(keys, hot, side="right"))
            if same:
                yield blocks(rows.slice(0, same))
            if same == rows.num_rows:
                continue
            rows, hot = rows.slice(same), None
        if held is not None:
            rows = pa.concat_tables([held, rows])
        keys = rows.column(0).to_numpy()
        last = int(np.searchsorted(keys, keys[-1], side="left"))
        # Keys that are over the limit inside this stretch leave it as blocks too.
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(starts, len(keys)))
        at = 0
        for s, n in zip(starts[sizes > limit], sizes[sizes > limit]):
            if s > at:
                yield "whole", rows.slice(at, s - at), None
            seen = 0
            yield blocks(rows.slice(s, n))
            at = s + n
            if at == len(keys):
                hot = keys[-1]
        if hot is not None:
            held = None
            continue
        if last > at:
            yield "whole", rows.slice(at, last - at), None
        held = rows.slice(max(last, at)).combine_chunks()
    if held is not None and held.num_rows:
        yield "whole", held, None


def block_pairs(hot: DataFrame, key: str = "key", block: str = "block") -> DataFrame:
    """Copies each row of a large key to the pairs of blocks it takes part in: columns lo, hi.

    The pairs of blocks of one key go to different tasks; a pair holds two blocks at most.
    """
    last = hot.groupBy(key).agg(F.max(block).alias("last_block"))
    other = F.explode(F.sequence(F.lit(0), F.col("last_block").cast("int"))).alias("other")
    out = hot.join(last, key).select(*hot.columns, other)
    return out.withColumns({"lo": F.least(block, "other"), "hi": F.greatest(block, "other")}).drop("other")


class Forest:
    """Union-find over row numbers, for arrays of links at a time."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        p = self.parent[x]
        while True:
            q = self.parent[p]
            if (q == p).all():
                break
            p = q
        self.parent[x] = p
        return p

    def join(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Adds links; returns those that joined two trees (a spanning set of them, not all links)."""
        kept_i, kept_j = [], []
        while len(i):
            a, b = self.roots(i), self.roots(j)
            apart = a != b
            i, j = i[apart], j[apart]
            if not len(i):
                break
            hi, lo = np.maximum(a, b)[apart], np.minimum(a, b)[apart]
            # One link for each root; the rest are looked at again after it is joined.
            _, first = np.unique(hi, return_index=True)
            self.parent[hi[first]] = lo[first]
            kept_i.append(i[first])
            kept_j.append(j[first])
        if not kept_i:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(kept_i), np.concatenate(kept_j)
