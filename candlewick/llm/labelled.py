"""Labelled training documents for the classifiers: a bounded sample, and their terms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm._common import crc_mod, gathered, materialise, plain

#: Labelled documents a classifier learns from at most (a documented bound).
MAX_TRAIN = 20_000


def training_rows(docs: DataFrame, labels: DataFrame, label: str, fold: int, folds: int, limit: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, y, text) of labelled documents outside the held-out fold, one row an id, written once.

    Ids whose labels disagree are left out, as are null ids and labels and ids without a
    document.  Over ``limit`` labelled documents, those whose ids have the least hash are
    taken; of an id that repeats in ``docs``, the text of least hash.
    """
    known = plain(labels, doc_id="doc_id", y=label).withColumn("doc_id", F.col("doc_id").cast("long")).where(
        "doc_id is not null and y is not null").where(crc_mod("doc_id", folds) != fold)
    agreed = known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("top")).where("y = top").drop("top")
    # A top-n by hash: each task keeps its own n, then n are left; at most ``limit`` ids are broadcast.
    there = agreed.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    some = there.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = docs.join(F.broadcast(some), "doc_id").select("doc_id", F.col("y").cast("int").alias("y"), "text")
    # A partial aggregate: each task sends one text an id.
    one = rows.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("least"))
    return materialise(gathered(one.select("doc_id", "y", "least.text"), rows=limit), "training_rows")
