"""Bounds for exact top-k search from block maxima.

Texts that begin alike stand in one block of BLOCK_TEXTS. A term's postings fall into its blocks, and a block has the term's
largest weight in it. The weights of a query's terms, times these maxima, bound the score of every text of the block, so
whole blocks are compared with the query's floor (a score that k texts reach) before any of their texts is joined.

A query's terms are taken in bands: band 0 holds the terms without which no text reaches the floor, then come those
that can add most. After each band, blocks go for which what they have and what later bands can add stay below the floor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK_TEXTS = 8
SORTED_BY = 128            # characters of a text that decide its place among the blocks; any order gives the same ranking
SECOND_BAND = 8            # terms in the band after the first
BANDS = 3
MARGIN = 1e-7              # far above rounding noise of score sums, far below any score gap that matters


def text_blocks(texts: DataFrame) -> DataFrame:
    """(text_id, block). Blocks are runs of the sorted texts; none crosses a task."""
    start = F.substring("norm", 1, SORTED_BY)
    ordered = texts.select("text_id", start.alias("start")).repartitionByRange("start", "text_id").sortWithinPartitions("start", "text_id")
    return ordered.select("text_id", F.expr(f"monotonically_increasing_id() div {BLOCK_TEXTS}").alias("block"))


def block_peaks(postings: DataFrame, places: DataFrame) -> DataFrame:
    """(block, term, wd): the largest weight of a term in a block."""
    return postings.join(places, "text_id").groupBy("block", "term").agg(F.max("wd").alias("wd"))


def in_bands(vectors: DataFrame, floors: DataFrame, tops: DataFrame) -> DataFrame:
    """(qid, term, wq, cosine, band, floor, after, length): ``after`` bounds what the terms of all later bands add to a text's
    score, and ``length`` is that of their part of the query, under the cosine.

    A set of terms adds at most the sum of their largest weights (``tops``: term, top); under the cosine texts have unit length, so
    it adds no more than the length of its part of the query either.
    """
    weighed = (vectors.join(floors, "qid", "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)))
               .join(tops, "term").withColumn("most", F.col("wq") * F.col("top")))

    def reach(over):
        sums, length = F.sum("most").over(over), F.sqrt(F.sum(F.col("wq") * F.col("wq")).over(over))
        return F.when(F.col("cosine"), F.least(sums, length)).otherwise(sums)

    frequent_first = Window.partitionBy("qid").orderBy(F.desc("text_df"), "term").rowsBetween(Window.unboundedPreceding, 0)
    split = weighed.withColumn("needed", reach(frequent_first) >= F.col("floor") - MARGIN)
    place = F.row_number().over(Window.partitionBy("qid", "needed").orderBy(F.desc("most"), "term"))
    banded = split.withColumn("place", place).withColumn("band", F.when(F.col("needed"), 0).when(F.col("place") <= SECOND_BAND, 1).otherwise(2))
    later = Window.partitionBy("qid").orderBy(F.desc("band")).rangeBetween(Window.unboundedPreceding, -1)
    length = F.when(F.col("cosine"), F.sqrt(F.sum(F.col("wq") * F.col("wq")).over(later)))
    return banded.withColumn("after", F.coalesce(reach(later), F.lit(0.0))).withColumn("length", F.coalesce(length, F.lit(0.0))).select(
        "qid", "term", "wq", "cosine", "band", "floor", "after", "length")


def limits(asked: DataFrame) -> DataFrame:
    """(qid, cosine, floor, after0, after1, length0): what may still come after each band but the last."""
    after = [F.coalesce(F.max(F.when(F.col("band") == b, F.col("after"))), F.lit(0.0)).alias(f"after{b}") for b in range(BANDS - 1)]
    length = F.coalesce(F.max(F.when(F.col("band") == 0, F.col("length"))), F.lit(0.0)).alias("length0")
    return asked.groupBy("qid", "cosine").agg(F.max("floor").alias("floor"), *after, length)


def reaches(bound: Column, after: Column | float) -> Column:
    return bound + after >= F.col("floor") - MARGIN


def tightened(blocks: DataFrame, asked: DataFrame, peaks: DataFrame) -> DataFrame:
    """Blocks (qid, block, bound and limits) that still reach their floor when all bands are counted."""
    for band in range(1, BANDS):
        more = (blocks.select("qid", "block").join(asked.filter(F.col("band") == band).select("qid", "term", "wq"), "qid")
                .join(peaks, ["block", "term"]).groupBy("qid", "block").agg(F.sum(F.col("wq") * F.col("wd")).alias("more")))
        bound = F.col("bound") + F.coalesce("more", F.lit(0.0))
        after = F.col(f"after{band}") if band < BANDS - 1 else F.lit(0.0)
        blocks = blocks.join(more, ["qid", "block"], "left").withColumn("bound", bound).drop("more").filter(reaches(F.col("bound"), after))
    return blocks


def first_blocks(blocks: DataFrame, n: int) -> DataFrame:
    """The ``n`` blocks of highest bound of each query."""
    order = Window.partitionBy("qid").orderBy(F.desc("bound"), "block")
    return blocks.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n).select("qid", "block")
