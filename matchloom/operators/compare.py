"""Systems compared query by query: segments, overlap of errors, errors one system repairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from matchloom.functions import text as T

SHORT_TOKENS, LONG_TOKENS = 4, 10


def segments(text: Column) -> Column:
    """All segments of a query text; ``common`` when none applies."""
    tokens = T.token_count(text)
    found = F.array_compact(F.array(
        F.when(T.is_upper(text), "upper"),
        F.when(T.matches(text, T.SEGMENT_PACK), "packaging"),
        F.when(T.matches(text, T.SEGMENT_MEASURE), "measure"),
        F.when(tokens <= SHORT_TOKENS, "short"),
        F.when(tokens >= LONG_TOKENS, "long")))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("common")))


def segment_scores(ranks: DataFrame, queries: DataFrame, systems: list[str]) -> DataFrame:
    """P@1 of every system per segment, with the segment's number of queries. ``ranks``: system, query_id, rank."""
    labelled = queries.select("query_id", F.explode(segments(F.col("text"))).alias("segment"))
    right = (F.col("rank") == 1).cast("double")
    per_query = ranks.groupBy("query_id").agg(
        *[F.max(F.when(F.col("system") == s, right)).alias(s) for s in systems])
    return labelled.join(per_query, "query_id").groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"), *[F.round(F.avg(s), 3).alias(s) for s in systems])


def error_counts(ranks: DataFrame) -> DataFrame:
    return ranks.groupBy("system").agg(F.count_if(F.col("rank") != 1).alias("errors"),
                                       F.count(F.lit(1)).alias("queries"))


def errors_per_query(ranks: DataFrame) -> DataFrame:
    wrong = F.col("rank") != 1
    return ranks.groupBy("query_id").agg(
        F.count_if(wrong).alias("wrong"), F.count(F.lit(1)).alias("systems"),
        F.max(F.when(wrong, F.col("system"))).alias("wrong_system"))


def error_overlap(ranks: DataFrame) -> DataFrame:
    """Queries wrong in at least one and in all systems, and P@1 of always choosing the best system."""
    return errors_per_query(ranks).agg(
        F.count(F.lit(1)).alias("queries"), F.count_if(F.col("wrong") >= 1).alias("wrong_in_one"),
        F.count_if(F.col("wrong") == F.col("systems")).alias("wrong_in_all"),
        F.round(F.avg((F.col("wrong") < F.col("systems")).cast("double")), 6).alias("best_of_all"))


def exclusive_errors(ranks: DataFrame) -> DataFrame:
    """Queries that exactly one system gets wrong."""
    return errors_per_query(ranks).filter("wrong = 1").select("query_id", F.col("wrong_system").alias("system"))


def repaired(ranks: DataFrame, tops: DataFrame, weak: str, strong: str) -> DataFrame:
    """Errors of one system that another gets right, with the first system's wrong choice."""
    fixed = ranks.filter((F.col("system") == strong) & (F.col("rank") == 1)).select("query_id", "gold_id")
    wrong = ranks.filter((F.col("system") == weak) & (F.col("rank") != 1)).select("query_id")
    picked = tops.filter((F.col("system") == weak) & (F.col("rank") == 1)).select(
        "query_id", F.col("doc_id").alias("wrong_id"))
    return fixed.join(wrong, "query_id", "left_semi").join(picked, "query_id", "left")


def error_list(ranks: DataFrame) -> DataFrame:
    return ranks.filter(F.col("rank") != 1).select("system", "split", "query_id", "gold_id", "rank")


def distributor_hits(ranks: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """First right answers among upper-case texts in the distributors' style."""
    style = T.is_upper(F.col("text")) & F.col("text").rlike("(?U)" + T.DISTRIBUTOR_STYLE)
    return (ranks.filter("rank = 1").join(queries.filter(style).select("query_id", "text"), "query_id")
            .select("query_id", "text", "gold_id").orderBy("query_id").limit(k))
