"""A training corpus from ``documents``, in five stages that each read what the last one kept.

toxicity: documents graded toxic go.  simhash: one document of each near-duplicate group
stays (4-word shingles, 4 bits).  substring: passages of 20 words or more that stand in an
earlier document are cut.  decontaminate: documents with a benchmark passage go.  pack: the
rest is packed into sequences of 2048 token ids (the last stage's rows are its pieces).

Defined results, in all stages but the last: all columns of ``documents`` come out as they
came in, whatever their names; only ``substring`` changes texts, and ``n_chars`` with them.
A null text counts as empty.  Empty texts are not toxic, share one fingerprint (so one of
them stays), and have no repeats and no benchmark passage; in ``pack`` each document left
has its end id, also an empty one.  Texts of any length are read whole.  A null ``doc_id``
is an id of its own; rows with equal ids and different texts are different documents; of
rows equal in both one stays (``simhash``).  Ties are settled by id, then by the hash of the
text.  An empty table gives empty tables.  Without labels nothing is toxic; without a
benchmark nothing is contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewick.llm import decontamination, packing, simhash_dedup, substring_dedup, toxicity
from candlewick.llm._common import materialise
from candlewick.llm.queries import ready


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.remove_toxic(docs, ready(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return simhash_dedup.keep_one(docs, shingle=4, distance=4)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return substring_dedup.drop_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.remove_contaminated(docs, ready(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("simhash", remove_near_duplicates),
    ("substring", remove_repeated_passages),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: No SQL: the first stage is a fitted model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, f"stage_{name}")
    return docs
