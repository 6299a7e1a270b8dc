"""SQL access: the stored tables as views, plus the two warehouse-dialect
functions the analyst queries use, as SQL functions (inlined by Catalyst, so
``toDateTime('2024-07-01')`` folds to a literal and is pushed to Parquet).

For statements of the user's own.  The analyst queries are DataFrame functions
(``operators.analytics``): a row-frame window in SQL puts each symbol in one task, and
a raw time range does not prune month partitions unless ``month`` is filtered too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewick.sources.warehouse import Warehouse

FUNCTIONS = {
    "toYYYYMM": "CREATE OR REPLACE TEMPORARY FUNCTION toYYYYMM(ts TIMESTAMP) RETURNS INT "
                "RETURN CAST(year(ts) * 100 + month(ts) AS INT)",
    "toDateTime": "CREATE OR REPLACE TEMPORARY FUNCTION toDateTime(s STRING) RETURNS TIMESTAMP "
                  "RETURN to_timestamp(s)",
}

TABLES = ("kline_data", "kline_events", "symbols", "kline_agg")


def register_functions(spark: SparkSession) -> None:
    for ddl in FUNCTIONS.values():
        spark.sql(ddl)


def register_tables(spark: SparkSession, warehouse: Warehouse) -> None:
    """Temp views named like the warehouse tables (``month`` included as a column)."""
    register_functions(spark)
    for name in TABLES:
        warehouse.table(name).createOrReplaceTempView(name)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan ``df.explain(mode)`` prints, as a string (the EXPLAIN of the analyst queries)."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
