"""Connected components of a graph of links, as rounds of joins and aggregates.

Alternating star contraction: each round, every vertex's larger neighbours are linked
to its smallest neighbour (large star), then its smaller neighbours are (small star),
until the links form stars around each component's smallest vertex.  Links are pairs of
longs; nothing is gathered by vertex but a minimum, so a vertex with a third of all
links costs a skewed join, which adaptive execution splits, and never one large group.
Rounds grow with the logarithm of the component's width.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm._common import discard, gathered, materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v), u > v.  Relink by the minimum of each vertex's neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = both.join(least, "u")
    if large:
        linked = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                               F.col("m").alias("v"))
    return linked.where("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", most: int | None = None) -> DataFrame:
    """(vertex, component): every vertex that has a link, with the smallest vertex reachable.

    Self links and nulls are ignored; a table without links gives an empty table.  ``most``:
    how many links there are at most, if that is known.
    """
    spark = edges.sparkSession
    e = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e = materialise(e if most is None else gathered(e, most), "links")
    while True:
        # Stars around the smallest vertices: no vertex hangs below two, and none that has one below it has one above.
        bad = e.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u").unionByName(
            e.select(F.col("v").alias("u")).distinct().join(e.select("u").distinct(), "u"))
        if bad.isEmpty():
            break
        after = materialise(gathered(_star(_star(e, large=True), large=False), 2 * e.count()), "links")
        discard(spark, e)
        e = after
    return e.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct())
