"""The four tables at rest: Parquet folders by load and month, sorted.

Every writer uses one layout, ``load=<id>/month=<yyyymm>/``: a batch build, each
micro-batch of a backfill or live stream, and a compaction are loads.  A load counts once
it is committed to the table's manifest (``sources.loads``), which readers follow: loads
appear whole, a compaction replaces many of them in one step, and a replayed batch adds
nothing, also after it was compacted away.  ``kline_agg`` is stored as the parts of its
averages, which readers and compactions add up, so a window that is split between loads
has one average.  ``month`` (yyyymm of the layout's time column) lets a
time-range query that also filters ``month`` (see ``functions.time_range``) skip whole
months; inside each file rows are sorted by the layout's key, so Parquet row-group
min/max statistics skip most of the rest.  Tables without a time column have loads only.
"""

from __future__ import annotations

import hashlib
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.time import ts_literal, yyyymm
from candlewick.operators.windows import average, merge_parts
from candlewick.schemas import LAYOUTS, TableLayout
from candlewick.sources.catalog import create_tables, sync
from candlewick.sources.loads import Files, Loads, State, Unit

# Rows per output file: keeps files (and a lost task's rework) bounded.
MAX_RECORDS_PER_FILE = 5_000_000


def stored_schema(layout: TableLayout) -> T.StructType:
    fields = [*layout.stored.fields, T.StructField("load", T.StringType())]
    if layout.month_of:
        fields.append(T.StructField("month", T.IntegerType()))
    return T.StructType(fields)


def with_layout_columns(df: DataFrame, layout: TableLayout) -> DataFrame:
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in layout.stored.fields]
    if layout.month_of:
        cols.append(yyyymm(layout.month_of).alias("month"))
    return df.select(*cols)


def stream_load(checkpoint: str, batch_id: int) -> str:
    """Load id of a stream's micro-batch: the same for every replay, different for every checkpoint."""
    return f"{hashlib.sha1(checkpoint.rstrip('/').encode()).hexdigest()[:12]}-{batch_id}"


def write_table(df: DataFrame, path: str, layout: TableLayout, mode: str = "append",
                clustered: bool = True, load: str | None = None, replaces: list[Unit] | None = None,
                merged: bool = False, keep_replaced: bool = False, stats: bool = False) -> bool:
    """Write ``df`` in the table's layout as one load (a new one if ``load`` is None) and commit it.

    A load that was committed before is left as it is.  ``mode="append"`` adds the load
    beside the others (or in place of ``replaces``), ``"overwrite"`` puts it in place of all
    that was committed.  Files of replaced loads are deleted after the commit unless
    ``keep_replaced`` (then ``Loads.vacuum`` does it later).  False if the load is void
    because something it replaces was replaced by another.  ``stats`` keeps the least and
    greatest key of each file with the load (one more pass over two columns), from which
    ``Warehouse.lookup`` chooses files, and deals the rows by ranges of the sort key.

    ``clustered=True`` first rebalances on (month, symbol): rows of one symbol
    and month land together, AQE merges small partitions, and a partition that
    grows too big is split over several tasks.  It splits by size, so even a
    single hot key (one candle's updates, or many exact copies of one message)
    is split, which range partitioning on the sort key could not do.  Each task
    then sorts its rows by the full sort key, so every file is sorted and Parquet
    row-group min/max statistics prune by symbol and time.
    ``clustered=False`` (streaming micro-batches) only sorts within each task.
    """
    loads = Loads(df.sparkSession, path)
    if load is not None and loads.known(load):
        return True
    out = with_layout_columns(df, layout)
    keys = [*layout.partition_by, *layout.sort_by]
    if stats:
        # Files of disjoint key ranges; exact copies are split by their input position.
        out = out.repartitionByRange(*[F.col(k) for k in keys], F.monotonically_increasing_id())
    elif clustered:
        out = out.hint("rebalance", *layout.partition_by, layout.sort_by[0])
    out = out.sortWithinPartitions(*keys)
    load = load or uuid.uuid4().hex
    writer = out.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_by)
    writer.parquet(f"{path}/load={load}")
    months = loads.months_written(load) if layout.month_of else None
    if stats and len(layout.range_of) == 2:
        file_ranges(df.sparkSession, f"{path}/load={load}", layout).write.mode("overwrite").parquet(loads.stats_path(load))
    gone = "*" if mode == "overwrite" else replaces or []
    counts = loads.commit(load, months, gone, merged)
    if counts and gone and not keep_replaced:
        loads.vacuum()
    return counts


def file_ranges(spark: SparkSession, folder: str, layout: TableLayout) -> DataFrame:
    """file (path below the load's folder), rows, and least and greatest of the layout's two range columns.

    First by full path and key, of which a sorted file has few: the path is cut after that and
    not for each row, and as the least and greatest of a text are not updated in place, one
    step over all rows would sort them.
    """
    key, time = layout.range_of
    rows = spark.read.schema(layout.stored).parquet(folder).select(
        F.col("_metadata.file_path").alias("path"), F.col(key).alias("k"), F.col(time).alias("t"))
    keys = rows.groupBy("path", "k").agg(F.count(F.lit(1)).alias("rows"), F.min("t").alias("t_lo"), F.max("t").alias("t_hi"))
    name = F.element_at(F.split("path", "/load=[^/]*/"), -1).alias("file")
    return keys.groupBy(name).agg(F.sum("rows").alias("rows"), F.min("k").alias("k_lo"), F.max("k").alias("k_hi"),
                                  F.min("t_lo").alias("t_lo"), F.max("t_hi").alias("t_hi"))


def read_table(spark: SparkSession, path: str, layout: TableLayout) -> DataFrame:
    """The rows of all loads that count, as stored (``month`` included where there is one)."""
    return read_loads(spark, path, layout, Loads(spark, path).paths()).drop("load")


def read_loads(spark: SparkSession, path: str, layout: TableLayout, folders: list[str]) -> DataFrame:
    schema = stored_schema(layout)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


class Warehouse:
    """A folder holding the tables, one sub-folder each; with ``database``, in the catalogue too (``sources.catalog``)."""

    def __init__(self, spark: SparkSession, root: str, database: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def loads(self, name: str) -> Loads:
        return Loads(self.spark, self.path(name))

    def table(self, name: str) -> DataFrame:
        """The table's rows as of now.

        Parts of averages are added up, unless a single load holds one row for each window.
        """
        layout, loads = LAYOUTS[name], self.loads(name)
        state = loads.state()
        rows = read_loads(self.spark, self.path(name), layout, loads.paths(state)).drop("load")
        if layout.parts is None:
            return rows
        if len(state.live) > 1 or not set(state.live) <= state.merged:
            rows = merge_parts(rows)
        return rows.select("symbol", "window_start", average())

    def lookup(self, name: str, key: str, lo=None, hi=None) -> DataFrame:
        """The table's rows of one key (its first sort column, the symbol) with lo <= time < hi.

        Of loads with file ranges only the files that can hold such rows are read (the
        driver gets their names); of other loads the row groups' statistics decide.
        """
        layout, loads = LAYOUTS[name], self.loads(name)
        key_col, time_col = layout.range_of
        state = loads.state()
        wanted = F.col(key_col) == F.lit(key)
        may = (F.col("k_lo") <= F.lit(key)) & (F.col("k_hi") >= F.lit(key))
        if lo is not None:
            wanted, may = wanted & (F.col(time_col) >= ts_literal(lo)), may & (F.col("t_hi") >= ts_literal(lo))
        if hi is not None:
            wanted, may = wanted & (F.col(time_col) < ts_literal(hi)), may & (F.col("t_lo") < ts_literal(hi))
        ranged = [load for load in state.live if loads.files.exists(loads.stats_path(load))]
        rest = State({k: v for k, v in state.live.items() if k not in ranged}, partial=state.partial)
        folders = loads.paths(rest)
        if ranged:
            found = self.spark.read.option("basePath", f"{loads.folder}/stats").parquet(*[loads.stats_path(x) for x in ranged])
            for r in found.where(may).select("load", "file").collect():
                months, month = state.live[r.load], r.file.rsplit("/", 1)[0].removeprefix("month=")
                if months is None or int(month) in months:
                    folders.append(f"{self.path(name)}/load={r.load}/{r.file}")
        return read_loads(self.spark, self.path(name), layout, folders).drop("load").where(wanted)

    def write(self, name: str, df: DataFrame, mode: str = "append", clustered: bool = True,
              load: str | None = None, merged: bool = False) -> None:
        write_table(df, self.path(name), LAYOUTS[name], mode, clustered, load, merged=merged)
        self.register(name)

    def register(self, name: str) -> None:
        """Bring the catalogue's partitions up to date, if there is a database."""
        if self.database:
            create_tables(self.spark, self.root, self.database)
            sync(self.spark, self.root, self.database, name)

    def write_rejects(self, messages: DataFrame, load: str) -> None:
        """Messages (``value``) that did not parse, as one load."""
        messages.select("value").write.mode("overwrite").parquet(f"{self.path('rejects')}/load={load}")

    def rejects(self) -> DataFrame:
        self._files().mkdirs(self.path("rejects"))
        return self.spark.read.schema("value string, load string").parquet(self.path("rejects")).drop("load")

    def _files(self) -> Files:
        return Files(self.spark)

    def create_if_missing(self) -> None:
        """``CREATE TABLE IF NOT EXISTS`` equivalent: a folder without loads is an empty table."""
        for name in LAYOUTS:
            self.loads(name).create()
        if self.database:
            create_tables(self.spark, self.root, self.database)

    def exists(self, name: str) -> bool:
        return self._files().exists(self.path(name))

    def compact(self, name: str, months: list[int] | None = None, keep_replaced: bool = False) -> bool:
        """Rewrite the loads there are (only ``months`` of them, if given) as one clustered and sorted load.

        Micro-batches are only sorted within each task and leave many small files, and
        split windows have several parts.  The new load takes the place of the others in
        one commit; loads that arrive meanwhile are not touched, and batches among the
        replaced ones may still be replayed.  Readers that planned before the commit need
        the replaced files: give them time with ``keep_replaced`` and a later ``vacuum``.
        False if another compaction of the same loads was committed first.
        """
        layout, loads = LAYOUTS[name], self.loads(name)
        if months is not None and not layout.month_of:
            raise ValueError(f"{name} has no month partitions")
        state = loads.state()
        wanted = None if months is None else {int(m) for m in months}
        units = [(load, m) for load, m in state.units() if wanted is None or m in wanted]
        if not units:
            return True
        folders = sorted({f"{self.path(name)}/load={load}" + ("" if m is None else f"/month={m}") for load, m in units})
        current = read_loads(self.spark, self.path(name), layout, folders)
        if layout.parts is not None:
            current = merge_parts(current)
        counts = write_table(current, self.path(name), layout, "append", replaces=units,
                             merged=layout.parts is not None, keep_replaced=keep_replaced, stats=True)
        self.register(name)
        return counts

    def compact_all(self, names) -> None:
        """Compact several tables; they are independent, so their jobs are submitted together."""
        with ThreadPoolExecutor(max_workers=len(names)) as pool:
            for done in [pool.submit(self.compact, name) for name in names]:
                done.result()

    def vacuum(self, name: str, older_than_s: float = 0.0) -> None:
        """Delete the files of replaced loads (see ``Loads.vacuum``)."""
        self.loads(name).vacuum(older_than_s)
