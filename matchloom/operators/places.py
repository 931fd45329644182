"""Rank and select over places: the first free places of each query, without a list or an order of its taken ones.

Places are numbers from 0 on, in ranges of a fixed size. Per query, the taken places are counted by range. A range
with fewer taken places than its size has free ones; adding up over the ranges that hold taken places gives the number of free
places before each, and what lies between such ranges is free altogether. So the range in which the j-th free place lies, or the
untouched stretch that holds it, follows from the counts, and only the places of that one range are looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

RANGE_PLACES = 4096


def free_places(taken: DataFrame, queries: DataFrame, k: int, size: int = RANGE_PLACES, places: int | None = None) -> DataFrame:
    """(qid, place) of the first ``k`` free places of every row of ``queries`` (qid). ``taken``: qid, place, without repeats;
    ``places``: how many places there are (fewer free ones are returned where fewer exist)."""
    ranged = taken.withColumn("at", F.floor(F.col("place") / size))
    counts = ranged.groupBy("qid", "at").agg(F.count(F.lit(1)).alias("n"))
    # only ranges before the k-th free place matter: whole ranges are skipped by their number alone
    order = Window.partitionBy("qid").orderBy("at")
    before = F.col("at") * size - F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = counts.withColumn("free_before", before).filter(F.col("free_before") < k)
    # free places inside ranges that hold taken ones
    touched = ranges.filter(F.col("n") < size).select("qid", "at", "free_before", (F.col("at") * size).alias("start"))
    inside = taken_ranks(ranged.join(touched.select("qid", "at"), ["qid", "at"], "left_semi"), size)
    wanted = touched.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(min(k, size) - 1)))).filter(F.col("free_before") + F.col("j") < k)
    # the j-th free place of a range is j plus the taken ones that have at most j free places before them in the range
    steps = wanted.join(inside, ["qid", "at"], "left").groupBy("qid", "at", "start", "j").agg(
        F.coalesce(F.sum(F.when(F.col("free") <= F.col("j"), F.col("taken"))), F.lit(0)).alias("skipped"))
    in_ranges = steps.withColumn("offset", F.col("j") + F.col("skipped")).filter(F.col("offset") < size).select("qid", (F.col("start") + F.col("offset")).alias("place"))
    # free places in ranges without taken ones: the first k places that no taken range covers
    n = -(-k // size)
    gaps = ranges.select("qid", F.col("at").alias("from"), F.coalesce(F.lead("at").over(order), F.col("at") + n + 1).alias("until")).select(
        "qid", F.explode(F.when(F.col("until") - F.col("from") > 1, F.sequence(F.col("from") + 1, F.least(F.col("until") - 1, F.col("from") + n)))).alias("at"))
    first = counts.groupBy("qid").agg(F.min("at").alias("first"))
    head = queries.select("qid").join(first, "qid", "left").select("qid", F.explode(F.when(
        F.coalesce("first", F.lit(n)) > 0, F.sequence(F.lit(0).cast("long"), F.least(F.coalesce("first", F.lit(n)), F.lit(n)).cast("long") - 1))).alias("at"))
    whole = gaps.unionByName(head).select("qid", F.explode(F.transform(F.sequence(F.lit(0), F.lit(min(k, size) - 1)), lambda i: F.col("at") * size + i)).alias("place"))
    every = in_ranges.unionByName(whole)
    if places is not None:
        every = every.filter(F.col("place") < places)
    nth = Window.partitionBy("qid").orderBy("place")
    return every.withColumn("nth", F.row_number().over(nth)).filter(F.col("nth") <= k).select("qid", F.col("place").cast("long").alias("place"))


def taken_ranks(ranged: DataFrame, size: int) -> DataFrame:
    """(qid, at, free, taken): in each range, how many taken places have ``free`` free ones before them."""
    order = Window.partitionBy("qid", "at").orderBy("place")
    return (ranged.withColumn("free", F.col("place") - F.col("at") * size - F.row_number().over(order) + 1)
            .groupBy("qid", "at", "free").agg(F.count(F.lit(1)).alias("taken")))
