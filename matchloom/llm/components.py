"""Connected components of a link table by alternating large-star and small-star rounds.

Each round only takes minima per node and joins them back, so a node with very many links is pre-aggregated and
its rows are spread by adaptive skew joins; no neighbourhood is gathered. Rounds grow with the logarithm of the
longest chain, and end as soon as the links are stars. Every round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from matchloom.llm.common import discard, scratch
from matchloom.operators.storage import shuffles_dropped


def _neighbour_minimum(links: DataFrame, mirrored: bool) -> DataFrame:
    """Connect neighbours to the smallest node next to (mirrored: and larger than) each node."""
    edges = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if mirrored else links
    lowest = edges.groupBy("u").agg(F.min("v").alias("low"))
    if mirrored:
        return (edges.filter(F.col("v") > F.col("u")).join(lowest, "u")
                .select(F.col("v").alias("u"), F.least("low", "u").alias("v")))
    return (edges.join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
            .unionByName(lowest.select("u", F.col("low").alias("v"))).filter("u != v"))


def _settled(links: DataFrame) -> bool:
    """Whether the links are stars: every node points at one root, and no root points anywhere."""
    ends = links.select("u", "v", F.lit(False).alias("root")).unionByName(links.select(F.col("v").alias("u"), F.lit(None).alias("v"), F.lit(True).alias("root")))
    odd = (ends.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.max("root").alias("root"))
           .filter("low != high OR (root AND low IS NOT NULL)"))
    return odd.isEmpty()


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, root) for every node in ``links`` (a, b); ``root`` is the smallest node of its component. Loops and repeats
    may occur. ``known`` (node, root) stands for links that an earlier call has resolved."""
    spark = links.sparkSession
    if known is not None:
        links = links.select("a", "b").unionByName(known.select(F.col("node").alias("a"), F.col("root").alias("b")))
    now = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    path = None
    while True:
        last, path = path, scratch(spark, "components")
        with shuffles_dropped(spark):
            now.write.parquet(path)
        now = spark.read.schema(now.schema).parquet(path)
        if last:
            discard(spark, last)
        if _settled(now):
            break
        now = _neighbour_minimum(_neighbour_minimum(now, mirrored=True), mirrored=False).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
