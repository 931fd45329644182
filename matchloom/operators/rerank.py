"""Reranking by an outside service as plain tables: requests go out, answers come in.

Nothing here calls the service. Requests render from candidates; answers parse with per-item isolation,
fall back to the candidate order, and complete to five.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

CANDIDATES, KEEP, BATCH = 10, 5, 32

# ---------------------------------------------------------------- fixed values: request and answer formats
ORDER_LINE = 'Pedido: "%s"\nCandidatos:\n'
BATCH_ORDER_LINE = 'Pedido %d: "%s"\nCandidatos:\n'
CANDIDATE_LINE = "%d. %s (marca: %s)"
ANSWER_SCHEMA = "ranking array<string>"
BATCH_ANSWER_SCHEMA = "resultados array<struct<pedido: string, ranking: array<string>>>"
LEDGER_SCHEMA = "qi bigint, ranking array<int>, seq bigint"
BATCH_LEDGER_SCHEMA = "lote bigint, rankings map<string, array<int>>, seq bigint"
# ---------------------------------------------------------------- end of fixed values


def number_candidates(ranked: DataFrame) -> DataFrame:
    return ranked.select("query_id", F.col("rank").alias("cand_no"), "doc_id", "score")


def candidate_block(candidates: DataFrame, catalog: DataFrame, indent: str = "") -> DataFrame:
    """query_id and its numbered candidate lines; a list holds ten entries at most."""
    named = candidates.join(catalog.select("doc_id", "name", "brand"), "doc_id")
    line = F.format_string(indent + CANDIDATE_LINE, "cand_no", "name", "brand")
    listed = F.array_sort(F.collect_list(F.struct("cand_no", line.alias("line"))))
    return named.groupBy("query_id").agg(F.array_join(F.transform(listed, lambda x: x["line"]), "\n").alias("lines"))


def requests(queries: DataFrame, candidates: DataFrame, catalog: DataFrame, examples: str = "") -> DataFrame:
    """One request per query; ``examples`` is the few-shot block, put in front when given."""
    lead = F.lit(examples + "\n\n" if examples else "")
    return (queries.select("query_id", "text").join(candidate_block(candidates, catalog), "query_id")
            .select("query_id", F.concat(lead, F.format_string(ORDER_LINE, "text"), F.col("lines")).alias("request")))


def batch_no(query_no: Column, size: int = BATCH) -> Column:
    """Consecutive blocks; ``query_no`` is the dense number given at ingest."""
    return F.floor(query_no / size)


def pending(queries: DataFrame, ledger: DataFrame) -> DataFrame:
    return queries.join(ledger.select("query_id"), "query_id", "left_anti")


def batch_requests(queries: DataFrame, ledger: DataFrame, candidates: DataFrame, catalog: DataFrame,
                   instructions: str, closing: str = "", examples: str = "") -> DataFrame:
    """One request per batch, over unanswered queries only. A batch gathers 32 queries at most."""
    open_ones = pending(queries, ledger).select("query_id", "text")
    blocks = open_ones.join(candidate_block(candidates, catalog, "  "), "query_id").select(
        batch_no(F.col("query_id")).alias("batch"), "query_id",
        F.concat(F.format_string(BATCH_ORDER_LINE, "query_id", "text"), F.col("lines")).alias("block"))
    gathered = blocks.groupBy("batch").agg(
        F.array_sort(F.collect_list(F.struct("query_id", "block"))).alias("b"))
    body = F.array_join(F.transform("b", lambda x: x["block"]), "\n\n")
    head = instructions + ("\n\n" + examples if examples else "") + "\n\n"
    return gathered.select("batch", F.size("b").cast("long").alias("queries"),
                           F.concat(F.lit(head), body, F.lit("\n\n" + closing if closing else "")).alias("request"))


def clean_ranking(items: Column) -> Column:
    """Whole numbers 1 to 10, first occurrence, first five; anything else in the list is dropped alone."""
    numbers = F.transform(items, lambda x: x.try_cast("int"))
    return F.slice(F.array_distinct(F.filter(numbers, lambda n: n.between(1, CANDIDATES))), 1, KEEP)


def parse_answers(answers: DataFrame, text: str = "answer") -> DataFrame:
    """query_id, ranking from strict JSON answers; an unreadable answer gives an empty ranking."""
    parsed = F.from_json(F.col(text), ANSWER_SCHEMA)["ranking"]
    return answers.select("query_id", F.coalesce(clean_ranking(parsed), F.array().cast("array<int>")).alias("ranking"))


def parse_batch_answers(answers: DataFrame, text: str = "answer") -> DataFrame:
    """batch, query_id, ranking from free text: the JSON from the first brace to the last.

    Only queries of the answer's own batch count, and only usable rankings; of several for one query the last counts.
    """
    body = F.from_json(F.regexp_extract(F.col(text), r"(?s)\{.*\}", 0), BATCH_ANSWER_SCHEMA)["resultados"]
    return (answers.select("batch", F.posexplode(body).alias("at", "item"))
            .select("batch", "at", F.expr("try_cast(item.pedido AS bigint)").alias("query_id"),
                    clean_ranking(F.col("item.ranking")).alias("ranking"))
            .filter((batch_no(F.col("query_id")) == F.col("batch")) & (F.size("ranking") > 0))
            .groupBy("batch", "query_id").agg(F.max_by("ranking", "at").alias("ranking")))


def with_fallback(queries: DataFrame, parsed: DataFrame) -> DataFrame:
    """Every query gets a ranking; without a usable one the candidate order stands, and is flagged."""
    usable = F.size(F.coalesce("ranking", F.array().cast("array<int>"))) > 0
    order = F.array(*[F.lit(n) for n in range(1, KEEP + 1)])
    return (queries.select("query_id").join(parsed.select("query_id", "ranking"), "query_id", "left")
            .select("query_id", F.when(usable, F.col("ranking")).otherwise(order).alias("ranking"),
                    (~usable).alias("fallback")))


def rerank(rankings: DataFrame, candidates: DataFrame) -> DataFrame:
    """query_id, rank, doc_id: answered candidates first, then the others in candidate order, five in all."""
    order = F.array_distinct(F.concat("ranking", F.sequence(F.lit(1), F.lit(CANDIDATES))))
    wanted = rankings.select("query_id", F.posexplode(order).alias("pos", "cand_no"))
    place = Window.partitionBy("query_id").orderBy("pos")
    return (wanted.join(candidates.select("query_id", "cand_no", "doc_id"), ["query_id", "cand_no"])
            .withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= KEEP)
            .select("query_id", "rank", "doc_id"))


def latest_answers(ledger: DataFrame) -> DataFrame:
    """query_id, ranking of the newest entry per query. ``ledger``: query_id, seq (any sortable order), ranking."""
    return ledger.groupBy("query_id").agg(F.max_by("ranking", "seq").alias("ranking"))


def flatten_batches(ledger: DataFrame) -> DataFrame:
    """Batch ledger rows (``rankings``: map of query to ranking) to one row per query."""
    return ledger.select("*", F.explode("rankings").alias("q", "ranking")).select(
        *[c for c in ledger.columns if c != "rankings"], F.col("q").cast("bigint").alias("query_id"), "ranking")
