"""Metrics of ranked lists against known answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from matchloom.operators.joins import fits_broadcast, lookup

DEPTH = 5


def gold_ranks(gold: DataFrame, ranked: DataFrame, *keep: str) -> DataFrame:
    """Rank of the right answer, 0 outside the list. Starts from the gold table: no query gets lost."""
    hits = ranked.select("query_id", F.col("doc_id").alias("gold_id"), "rank")
    return (gold.select("query_id", "gold_id", *keep).join(hits, ["query_id", "gold_id"], "left")
            .withColumn("rank", F.coalesce("rank", F.lit(0))))


def gold_ranks_of_texts(gold: DataFrame, asked: DataFrame, best: DataFrame, *keep: str) -> DataFrame:
    """``gold_ranks`` of ``asked.join(best, "qid")``, without a row for every query and rank: a query carries its right answer to the
    ranking of its text, and only hits come back."""
    pairs = gold.select("query_id", "gold_id").distinct()
    hits = (lookup_ranking(asked.join(pairs, "query_id"), best.select("qid", F.col("doc_id").alias("gold_id"), "rank"))
            .select("query_id", F.col("gold_id").alias("doc_id"), "rank"))
    return gold_ranks(gold, hits, *keep)


def lookup_ranking(asked: DataFrame, best: DataFrame) -> DataFrame:
    """A ranking has one row per text and answer; it is broadcast when its measured size allows."""
    return asked.join(F.broadcast(best) if fits_broadcast(best) else best, ["qid", "gold_id"])


def precision_at_1(rank: Column) -> Column:
    return F.avg((rank == 1).cast("double"))


def reciprocal_rank(rank: Column) -> Column:
    return F.avg(F.when(rank.between(1, DEPTH), 1 / rank).otherwise(0.0))


def recall_at_5(rank: Column) -> Column:
    return F.avg(rank.between(1, DEPTH).cast("double"))


def metrics(ranks: DataFrame, *by: str) -> DataFrame:
    """n, p_at_1, mrr_at_5, r_at_5 per group; without groups an empty input is an error."""
    rank = F.col("rank")
    out = ranks.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.round(precision_at_1(rank), 6).alias("p_at_1"),
        F.round(reciprocal_rank(rank), 6).alias("mrr_at_5"), F.round(recall_at_5(rank), 6).alias("r_at_5"))
    if by:
        return out
    return out.withColumn("n", F.when(F.col("n") > 0, F.col("n")).otherwise(
        F.raise_error(F.lit("no labelled queries to evaluate")).cast("long")))


def wide_predictions(ranks: DataFrame, ranked: DataFrame, catalog: DataFrame, queries: DataFrame) -> DataFrame:
    """One row per query: text, gold id and name, rank, then id, name and score of the predictions."""
    names = catalog.select("doc_id", "name")
    named = lookup(ranked, names, "doc_id")
    cols = []
    for r in range(1, DEPTH + 1):
        at = F.col("rank") == r
        cols += [F.max(F.when(at, F.col("doc_id"))).alias(f"pred{r}_id"),
                 F.max(F.when(at, F.col("name"))).alias(f"pred{r}_name"),
                 F.max(F.when(at, F.round("score", 4))).alias(f"pred{r}_score")]
    spread = named.groupBy("query_id").agg(*cols)
    gold_names = names.select(F.col("doc_id").alias("gold_id"), F.col("name").alias("gold_name"))
    return (lookup(ranks.withColumnRenamed("rank", "gold_rank"), gold_names, "gold_id", "left")
            .join(queries.select("query_id", F.col("text").alias("query")), "query_id")
            .join(spread, "query_id", "left"))


def leaderboard(ranks: DataFrame) -> DataFrame:
    """Metrics per configuration (family, config), best first."""
    return metrics(ranks, "family", "config").orderBy(F.desc("p_at_1"), "config")


def best_configs(board: DataFrame) -> DataFrame:
    """Best configuration of every family: highest P@1, then configuration name."""
    order = Window.partitionBy("family").orderBy(F.desc("p_at_1"), "config")
    return board.withColumn("place", F.row_number().over(order)).filter("place = 1").drop("place")
