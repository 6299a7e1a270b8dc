"""Row-frame window functions (ROWS BETWEEN k PRECEDING ..., lag) that do not put a
whole key into one task.

``Window.partitionBy("symbol")`` sends every row of a symbol to one task; one
symbol may hold a third of all rows.  Frames that look back a fixed number of
rows only need that many rows of context, so the work is cut into chunks of a
bounded number of rows instead:

1. one light pass picks the rows whose sort keys have the least hashes, which also tells how many rows there are.
   The picked keys, in order, cut the table into chunks of about ``chunk_rows`` rows.  They
   are few (bounded by ``MOST_KEYS``), and decide nothing but the cut;
2. each row goes to the chunk its key falls in.  Rows between the ``lookback``-th picked key
   before a chunk's end and that end go to the next chunk too, as read-only context
   ("halo"): picked keys are rows themselves, so there are at least ``lookback`` of them;
3. range-partition by (keys, chunk) and evaluate the window per (keys, chunk), ordered by
   the sort key; drop the halo rows.

Nothing is written, and rows are shuffled once.
The result equals the per-key window exactly: a frame never reaches further back
than ``lookback`` rows, and a chunk holds at least that many rows before its first.

Every input takes this path, whatever its size, and the number of rows in one window
group follows a parameter, not the data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlewick.session import scratch_path

DEFAULT_CHUNK_ROWS = 1 << 14
#: Keys picked in the first pass; for many chunks, keys for each of them in a second pass, and in all.
FIRST_KEYS, KEYS_A_CHUNK, MOST_KEYS = 1024, 32, 1_000_000
_PARTITION_BITS = 33   # monotonically_increasing_id = partition << 33 | row number


def _cols(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def number_rows(df: DataFrame, order_by: Sequence[Column | str], pos_col: str = "_pos") -> DataFrame:
    """Add ``pos_col`` = 0-based position of each row in ``order_by`` order, without a single-task window.

    The sorted rows, tagged with (partition, row in partition), are written once
    as a Parquet table under the checkpoint folder: the numbering is fixed (a
    lost executor cannot renumber), lineage is cut, and the per-partition count
    reads one column.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "sequence")
    # Rows that tie on every sort key (exact copies) would all land in one range
    # partition; the input position, taken before the sort, splits them.  Copies
    # are interchangeable, so the result does not depend on it.  The position is a
    # function of the input's partitioning and row order, which is stable for a
    # table scan (the callers here).
    salted = df.withColumn("_in_pos", F.monotonically_increasing_id())
    mid = F.monotonically_increasing_id()
    tagged = salted.orderBy(*_cols(order_by), "_in_pos").select(
        *df.columns,
        F.shiftright(mid, _PARTITION_BITS).alias("_part"),
        mid.bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1)).alias("_local"),
    )
    tagged.write.parquet(path)
    stored = spark.read.parquet(path)
    # One number per partition of the sort comes back; their running sum goes out again.
    counts = sorted(tuple(r) for r in stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).collect())
    starts = accumulate((n for _, n in counts), initial=0)
    offsets = spark.createDataFrame([(p, at) for (p, _), at in zip(counts, starts)], "_part long, _offset long")
    # One row per partition of the sort: bounded by the partition count, not the data.
    numbered = stored.join(F.broadcast(offsets), "_part")
    return numbered.withColumn(pos_col, F.col("_offset") + F.col("_local")).drop("_part", "_local", "_offset")


def _picked(keyed: DataFrame, chunk_rows: int, lookback: int) -> pa.Table:
    """One row: ``e``, where chunks end, and ``t``, from where on rows are context of the next chunk, as sort keys in order."""
    hashed = keyed.select("_key.*", F.xxhash64("_key").alias("_h"))
    keys, n = hashed.orderBy("_h").limit(FIRST_KEYS).toArrow(), 0
    if len(keys) < FIRST_KEYS:
        n = len(keys)
    else:
        # All hashes up to the greatest picked one were picked: their share of the range tells how many rows there are.
        n = int(FIRST_KEYS / ((pc.max(keys["_h"]).as_py() + (1 << 63) + 1) / (1 << 64)))
        chunks = -(-n // chunk_rows)
        if chunks * KEYS_A_CHUNK > FIRST_KEYS:
            # More of them: all below a hash that so many rows should have, without a sort.
            share = min(1.0, min(chunks * KEYS_A_CHUNK, MOST_KEYS) / n)
            keys = hashed.where(F.col("_h") <= F.lit(min(int(share * (1 << 64)), (1 << 64) - 1) - (1 << 63))).toArrow()
    keys = keys.drop_columns(["_h"])
    order = pc.sort_indices(keys, [(c, "ascending") for c in keys.column_names], null_placement="at_start")
    step = max(lookback, 1, -(-len(keys) * chunk_rows // max(n, 1)))
    cuts = np.arange(step, len(keys), step)

    def row(at: np.ndarray) -> pa.Array:
        taken = keys.take(order.take(pa.array(at))).combine_chunks()
        structs = pa.StructArray.from_arrays([c.combine_chunks() for c in taken.columns], fields=list(taken.schema))
        return pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), structs)

    return pa.table({"e": row(cuts), "t": row(cuts - lookback)})


def chunked_window(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str],
    lookback: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    context: Column | None = None,
) -> DataFrame:
    """Add window columns whose frames reach at most ``lookback`` rows back.

    ``columns(w)`` receives a window spec and returns ``{name: expression over
    w}``; frames must stay within ``rowsBetween(-lookback, 0)``.  The spec is
    per (key, chunk) in the order of ``order_by``.  The output keeps the input columns
    plus the new ones, sorted by (keys, order).  Rows for which ``context`` holds are
    looked back at but not returned.
    """
    if lookback < 0:
        raise ValueError("lookback must be >= 0")
    if chunk_rows < max(lookback, 1):
        raise ValueError("chunk_rows must be at least lookback")
    out_cols = df.columns
    # The remaining columns break ties in ``order_by``: the order is then total (the
    # same run after run), and rows that tie on the given order can still be split.  Exact
    # copies are split by their input position: copies are interchangeable, so the result
    # does not depend on it.  It is stable for a table scan (the callers here).
    named = {c for c in [*keys, *order_by] if isinstance(c, str)}
    order = _cols([*keys, *order_by, *[c for c in out_cols if c not in named]])
    if context is not None:
        df = df.withColumn("_context", context)
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate([*order, F.monotonically_increasing_id()])])
    keyed = df.withColumn("_key", key)
    picked = _picked(keyed, chunk_rows, lookback)
    # One row of a few keys for each chunk, read by the tasks as a constant.
    cut = df.sparkSession.createDataFrame(picked)
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(picked["e"][0]).bit_length()))] or [F.lit(1)])

    def place(c: Column) -> Column:
        """How many ends are at or below the key (by bisection), and whether the row is context of the next chunk too."""
        chunk = F.aggregate(steps, F.lit(0), lambda n, s: F.when(F.get(c["e"], n + s - 1) <= F.col("_key"), n + s).otherwise(n))
        return F.element_at(F.transform(F.array(chunk), lambda n: F.struct(
            n.alias("n"), F.coalesce(F.get(c["t"], n) <= F.col("_key"), F.lit(False)).alias("tail"))), 1)

    # Named once, in an expression: the projections are merged and the lists of keys are never copied into a row.
    kept = [*out_cols, "_key", *(["_context"] if context is not None else [])]
    ends = cut.select(F.struct("e", "t")).scalar()
    placed = keyed.select(*kept, ends.alias("_ends")).select(
        *kept, F.element_at(F.transform(F.array("_ends"), place), 1).alias("_at"))
    if lookback:
        copies = F.when(F.col("_at.tail"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
        placed = placed.select(*kept, F.col("_at.n").alias("_n"), F.explode(copies).alias("_halo"))
        placed = placed.select(*kept, (F.col("_n") + F.col("_halo").cast("int")).alias("_chunk"), "_halo")
    else:
        placed = placed.select(*kept, F.col("_at.n").alias("_chunk"), F.lit(False).alias("_halo"))
    # Range-partitioning on (keys, chunk) satisfies the window's clustering, so the
    # window adds no exchange and its output is already in (keys, chunk, key) order.
    placed = placed.repartitionByRange(*keys, "_chunk")
    w = Window.partitionBy(*keys, "_chunk").orderBy("_key")
    new_cols = columns(w)
    result = placed.withColumns(new_cols).where(~F.col("_halo"))
    if context is not None:
        result = result.where(~F.col("_context"))
    # Already range-partitioned and sorted this way: no exchange, no extra sort.
    result = result.orderBy(*keys, "_chunk", "_key")
    return result.select(*out_cols, *new_cols.keys())
