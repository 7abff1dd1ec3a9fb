"""Connected components of a graph of links, by large-star and small-star steps on DataFrames (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import new_path, remove, written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step on edges (a, b) with a > b. Minima are summed up before the shuffle; the join's rows are two longs, and
    a hub's rows are split by AQE."""
    out = edges.union(edges.select("b", "a").toDF("a", "b")) if large else edges
    low = out.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    near = out.join(low, "a")
    if large:
        near = near.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        near = near.select(F.explode(F.array(F.struct("b", "low"), F.struct(F.col("a").alias("b"), "low"))).alias("e")).select(F.col("e.b").alias("a"), F.col("e.low").alias("b"))
    return near.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each end of links (a, b), whose component is the smallest node that it reaches.

    Nulls and self-links are ignored, repeated links count once, an empty table gives an empty table. The number of
    steps grows with the logarithm of the longest path; no step brings rows to the driver."""
    spark = links.sparkSession
    path = new_path(spark, "edges")
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), path)
    print_of = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    seen = print_of(edges)
    while seen[0]:
        before, path = path, new_path(spark, "edges")
        edges = written(_stars(_stars(edges, True), False), path)
        remove(spark, before)
        if (now := print_of(edges)) == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
