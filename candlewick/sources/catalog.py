"""The stored tables in the session's catalogue, for SQL users: ``spark.table("market.kline_data")``.

``create_tables`` issues ``CREATE TABLE IF NOT EXISTS … PARTITIONED BY … LOCATION`` for the
tables of a warehouse; ``sync`` registers the partitions (load, month) of the loads that count
and drops those of loads that were replaced, in that order of the manifest.  A warehouse
opened with ``database=`` does both at every commit, so what SQL sees follows the manifest.
``kline_agg`` is a view that adds up the parts of its averages, stored as ``kline_agg_parts``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewick.schemas import LAYOUTS, TableLayout
from candlewick.sources.loads import Loads

#: Partitions named in one statement.
_AT_ONCE = 500


def _name(database: str, layout: TableLayout) -> str:
    return f"`{database}`.`{layout.name}{'_parts' if layout.parts else ''}`"


def create_tables(spark: SparkSession, root: str, database: str) -> None:
    """The tables of the warehouse at ``root``, created where they are missing (any number of times)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for layout in LAYOUTS.values():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layout.stored.fields)
        keys = ["`load` string", *(["`month` int"] if layout.month_of else [])]
        path = f"{root.rstrip('/')}/{layout.name}"
        Loads(spark, path).create()
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(database, layout)} ({columns}, {', '.join(keys)}) USING parquet "
                  f"PARTITIONED BY ({', '.join(k.split()[0] for k in keys)}) LOCATION '{path}'")
        if layout.parts:
            spark.sql(f"CREATE VIEW IF NOT EXISTS `{database}`.`{layout.name}` AS SELECT symbol, window_start, "
                      f"try_divide(sum(close_sum), cast(sum(close_count) as double)) AS avg_close "
                      f"FROM {_name(database, layout)} GROUP BY symbol, window_start")


def _spec(load: str, month: int | None) -> str:
    return f"PARTITION (`load`='{load}'" + ("" if month is None else f", `month`={month}") + ")"


def sync(spark: SparkSession, root: str, database: str, name: str) -> None:
    """Let the catalogue's partitions of a table be those of its loads that count."""
    layout = LAYOUTS[name]
    table = _name(database, layout)
    wanted = {_spec(load, month) for load, month in Loads(spark, f"{root.rstrip('/')}/{name}").state().units()}
    there = set()
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():       # one short name for each load and month
        parts = dict(p.split("=", 1) for p in row[0].split("/"))
        there.add(_spec(parts["load"], int(parts["month"]) if "month" in parts else None))
    for verb, specs, join in (("ADD IF NOT EXISTS", sorted(wanted - there), " "), ("DROP IF EXISTS", sorted(there - wanted), ", ")):
        for at in range(0, len(specs), _AT_ONCE):
            spark.sql(f"ALTER TABLE {table} {verb} {join.join(specs[at:at + _AT_ONCE])}")
    spark.catalog.refreshTable(table)


def catalog_table(spark: SparkSession, database: str, name: str) -> DataFrame:
    """A table by its catalogue name, without the load column."""
    return spark.table(f"`{database}`.`{name}`").drop("load")
