"""Ranked lists: top k per query with a defined tie order, and padding for queries that match nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

TIE_DIGITS = 9


def top_k(scored: DataFrame, k: int, query: str = "query_id", item: str = "doc_id") -> DataFrame:
    """(query, rank, item, score): score rounded to nine digits descending, then item ascending.

    The filter on row_number lets each task keep k rows per query before the shuffle.
    """
    order = Window.partitionBy(query).orderBy(F.desc("score"), F.asc(item))
    return (scored.withColumn("score", F.round("score", TIE_DIGITS))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select(query, "rank", item, "score"))


def pad_zero(queries: DataFrame, positive: DataFrame, doc_ids: DataFrame, k: int, query: str = "query_id") -> DataFrame:
    """Always answer: fill short lists with the lowest other document ids at score 0, then rank again.

    ``positive`` holds the k best rows of positive score. A short list has at most k - 1 of them and no score is
    negative, so its zeros lie among the 2k lowest ids of the catalog.
    """
    pool = doc_ids.orderBy("doc_id").limit(2 * k).agg(F.array_sort(F.collect_list("doc_id")).alias("pool"))
    counted = positive.groupBy(query).agg(F.count(F.lit(1)).alias("have"))
    short = (queries.select(query).join(counted, query, "left")
             .filter(F.coalesce("have", F.lit(0)) < k).select(query))
    zeros = (short.select(query, F.explode(pool.scalar()).alias("doc_id"))
             .join(positive.select(query, "doc_id"), [query, "doc_id"], "left_anti")
             .select(query, "doc_id", F.lit(0.0).alias("score")))
    return top_k(positive.select(query, "doc_id", "score").unionByName(zeros), k, query)
