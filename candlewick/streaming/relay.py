"""Relay of raw messages to a topic: key = symbol, value unchanged.

Empty messages are dropped, and so is text that is not a JSON object (the
relay decodes every message to read its key).  Control messages carry no
symbol and get a NULL key.  The key is the message's ``s`` field, as the relay's
own documentation promises (its code looked for a field that is never sent).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def relay_records(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """(key, value) rows ready for a topic sink; narrow, no shuffle."""
    v = F.col(value_col)
    # A JSON object decodes; so does a bare `null` (it leaves the record empty).  The JSON functions stop
    # after the first value, so text behind it is found by putting the message into an array, where it must
    # be the only element, and into an object, where a stray closing bracket does not fit.
    alone = (F.json_array_length(F.concat(F.lit("["), v, F.lit("]"))) == 1) & F.json_object_keys(
        F.concat(F.lit('{"m":'), v, F.lit("}"))).isNotNull()
    ok = (v != F.lit("")) & alone & (F.json_object_keys(v).isNotNull() | (F.trim(v) == F.lit("null")))
    kept = messages.where(ok)
    return kept.select(F.get_json_object(v, "$.s").alias("key"), v.alias("value"))


def balanced(records: DataFrame, partitions: int) -> DataFrame:
    """The records in ``partitions`` parts of nearly equal bytes, in order, whatever their keys.

    Each input partition's bytes are summed first (one number a partition); a record goes
    where the bytes before it lie in the whole.  Reads the records twice, so they should be
    a table or a persisted batch.
    """
    spark = records.sparkSession
    size = F.coalesce(F.octet_length("key"), F.lit(0)) + F.coalesce(F.octet_length("value"), F.lit(0)) + F.lit(1)
    sums = dict(tuple(r) for r in records.groupBy(F.spark_partition_id()).agg(F.sum(size.cast("long"))).collect())
    total, start, before = sum(sums.values()), {}, 0
    for p in sorted(sums):
        start[p] = before
        before += sums[p]
    if not total:
        return records
    # One number a partition: bounded by their count.
    starts = spark.createDataFrame(sorted(start.items()), "_part int, _start long")
    placed = records.withColumns({"_size": size.cast("long"), "_part": F.spark_partition_id()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            n = batch.column(2).to_numpy()
            if at is None and len(n):
                at = batch.column(3)[0].as_py()
            ends = (at or 0) + np.cumsum(n)
            to = np.minimum((ends - n) * partitions // total, partitions - 1).astype(np.int32)
            at = int(ends[-1]) if len(n) else at
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(to)], names=["key", "value", "_to"])

    joined = placed.join(F.broadcast(starts), "_part").select("key", "value", "_size", "_start")
    return joined.mapInArrow(run, "key string, value string, _to int").repartitionById(partitions, "_to").drop("_to")


def topic_sink_options(bootstrap_servers: str, topic: str, checkpoint: str, **extra: str) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic, "checkpointLocation": checkpoint}
    opts.update(extra)
    return opts


def start_relay_to_topic(messages: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str,
                         partitions: int | None = None) -> StreamingQuery:
    """Needs the Kafka connector on the classpath.

    ``partitions`` hash-partitions by key before the sink (messages of one symbol
    stay in order; those without a key are spread by their text); without it the source
    partitioning is kept.
    """
    recs = relay_records(messages)
    if partitions:
        recs = recs.repartition(partitions, F.coalesce(F.col("key"), F.xxhash64("value").cast("string")))
    writer = recs.writeStream.format("kafka")
    for key, value in topic_sink_options(bootstrap_servers, topic, checkpoint).items():
        writer = writer.option(key, value)
    return writer.start()


def start_relay_to_files(messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return (relay_records(messages).writeStream.format("json").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def start_balanced_relay(messages: DataFrame, path: str, checkpoint: str, partitions: int, trigger: dict | None = None) -> StreamingQuery:
    """Relay into JSON files of nearly equal bytes, ``partitions`` for each micro-batch (named after it: a replay replaces them)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        records = relay_records(batch).persist()
        try:
            balanced(records, partitions).write.mode("overwrite").json(f"{path}/batch={batch_id}")
        finally:
            records.unpersist()

    return (messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
