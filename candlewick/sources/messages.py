"""Raw message sources: files (batch and stream) and a message topic.

A message is one ``value STRING`` column.  The topic reader is the production
source; files stand in for it in tests (no broker here).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.schemas import RAW_MESSAGE


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """One message per line of text files."""
    return spark.read.schema(RAW_MESSAGE).text(path)


def stream_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming text source; the per-trigger cap bounds each micro-batch without dropping anything."""
    reader = spark.readStream.schema(RAW_MESSAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.text(path)


def topic_options(bootstrap_servers: str, topic: str, starting_offsets: str = "latest",
                  max_offsets_per_trigger: int | None = None, min_partitions: int | None = None,
                  **extra: str) -> dict[str, str]:
    """Options of the topic source: subscribe to one topic, start at the latest offsets.

    On restart the query resumes from its checkpoint rather than from latest; the
    consumer identity is the checkpoint folder.  ``min_partitions`` splits the
    offset ranges of a topic with few partitions over more tasks, so parsing is
    not limited to one core per topic partition.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    opts.update(extra)
    return opts


def stream_topic(spark: SparkSession, bootstrap_servers: str, topic: str, **kwargs) -> DataFrame:
    """Messages from a topic as ``value STRING`` (needs the Kafka connector on the classpath)."""
    reader = spark.readStream.format("kafka")
    for key, value in topic_options(bootstrap_servers, topic, **kwargs).items():
        reader = reader.option(key, value)
    return reader.load().select(F.col("value").cast("string").alias("value"))
