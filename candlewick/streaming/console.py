"""Debug print of a stream with a label, and the compact candle's text form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def candle_text(df: DataFrame) -> Column:
    """``candle(SYMBOL close=… at=… volume=…)`` of a candle row."""
    return F.concat(
        F.lit("candle("), F.col("symbol"), F.lit(" close="), F.col("close").cast("string"),
        F.lit(" at="), F.col("close_time_ms").cast("string"), F.lit(" volume="),
        F.col("volume").cast("string"), F.lit(")"),
    )


def labelled(df: DataFrame, label: str, text: Column | None = None) -> DataFrame:
    """One ``line`` column: ``<label>> <text>`` (text defaults to all columns as JSON)."""
    body = text if text is not None else F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    return df.select(F.concat(F.lit(f"{label}> "), body).alias("line"))


def start_console(df: DataFrame, label: str, text: Column | None = None, trigger: dict | None = None,
                  checkpoint: str | None = None) -> StreamingQuery:
    writer = labelled(df, label, text).writeStream.format("console").option("truncate", "false")
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
