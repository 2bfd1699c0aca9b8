"""Connected components of a graph whose links are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickseries.session import materialize


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root) for every node that has a link to another one; the root is the smallest node it reaches.

    Alternates the large and the small star: each node ties its larger neighbours, then its smaller ones, to the
    smallest of them. Links become stars in a number of rounds that grows with the logarithm of the longest path.
    Each round is written to the shared working folder, which cuts the lineage. Null ends and self links are ignored.
    """
    spark = links.sparkSession
    edges = materialize(_clean(links.select(F.col(left).alias("u"), F.col(right).alias("v"))), "links")
    before = _state(edges)
    while before[0]:
        edges = materialize(_small_star(_large_star(edges)), "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    if not before[0]:
        kind = links.schema[left].dataType
        return spark.createDataFrame([], f"node {kind.simpleString()}, root {kind.simpleString()}")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select(F.col("root"), F.col("root"))).distinct()


def _clean(edges: DataFrame) -> DataFrame:
    """Each link once, the larger end first."""
    big, small = F.greatest("u", "v"), F.least("u", "v")
    kept = edges.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    return kept.select(big.alias("u"), small.alias("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select("v", "u"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _clean(both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _clean(tied.union(low.select("u", F.col("m").alias("v"))))
