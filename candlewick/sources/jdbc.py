"""Warehouse tables over JDBC (the reference's sink), as a ``foreachBatch`` writer.

Needs the warehouse's JDBC driver on the classpath; none is available here, so
only the option building is exercised by the tests.  ``batch_size`` maps the
reference's "flush every 5 rows"; Spark writes each micro-batch partition in
batches of that many rows and retries failed tasks on its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

# The reference's sink settings: flush every 5 rows, retry 3 times.
DEFAULT_BATCH_SIZE = 5


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, batch_size: int = DEFAULT_BATCH_SIZE,
                 num_partitions: int | None = None, **extra: str) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "batchsize": str(int(batch_size))}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    if num_partitions:
        opts["numPartitions"] = str(int(num_partitions))   # caps concurrent connections
    opts.update(extra)
    return opts


def write_jdbc(df: DataFrame, options: dict[str, str], mode: str = "append") -> None:
    writer = df.write.format("jdbc").mode(mode)
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.save()


def jdbc_batch_writer(options: dict[str, str], columns: list[str] | None = None
                      ) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function appending each micro-batch (columns by name, not position)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch.select(*columns) if columns else batch
        write_jdbc(out, options, "append")
    return write
