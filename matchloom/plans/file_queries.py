"""Registered queries: the file layer, as round trips of the driver's rows through the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from matchloom.operators import evaluate as E, rerank as RR
from matchloom.plans import eval_queries as Q, roles as R, shared, sql as S
from matchloom.session import shared_dir
from matchloom.sources import ledger, records

C = F.col


def _home(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def csv_catalog(spark, sf):
    """Catalog written as headed CSV and read again, all columns strings."""
    path = _home(spark, "catalog")
    records.write_table(R.products(spark, sf).select(
        F.lpad(C("doc_id").cast("string"), 14, "0").alias("product_id"), C("name").alias("product_name"), C("brand").alias("brand_name")), path)
    return records.read_catalog(spark, path)


def split_queries(spark, sf):
    """One query file per split; each is read by its name and numbered densely."""
    home, out = _home(spark, "queries"), None
    for split in ("val", "test"):
        path = records.split_path(home, split)
        rows = R.orders(spark, sf).filter(C("split") == split)
        records.write_table(rows.select("text", C("gold_id").cast("string").alias("matched_id")), path)
        read = records.read_queries(spark, path, split)
        out = read if out is None else out.unionByName(read)
    return out.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.min("query_id").alias("first_no"), F.max("query_id").alias("last_no"),
        F.countDistinct("query_id").alias("numbers"), F.sum(F.length("text")).alias("chars"), F.countDistinct("gold_id").alias("golds"))


def prediction_files(spark, sf):
    """Wide predictions of two systems as files, read into one table."""
    home, paths = _home(spark, "predictions"), {}
    for system in ("tfidf_word", "bm25"):
        tops = shared.order_ranking(spark, sf, *shared.SYSTEMS[system])
        paths[system] = f"{home}/{system}"
        ranks = E.gold_ranks(Q._gold(spark, sf), tops)
        records.write_table(E.wide_predictions(ranks, tops, R.products(spark, sf), R.orders(spark, sf)), paths[system])
    return records.read_predictions(spark, paths, "gold_rank").select(
        "system", C("query_id").cast("long").alias("query_id"), "query", C("rank"), C("pred1_id").cast("long").alias("pred1_id"),
        C("pred1_name"))


def ranking_files(spark, sf):
    """Long ranking by split as Parquet; writing a split again replaces that split only."""
    path = _home(spark, "ranking")
    tops = shared.order_ranking(spark, sf, *shared.SYSTEMS["bm25"]).join(Q._gold(spark, sf).select("query_id", C("split").alias("own")), "query_id")
    for split in ("val", "test", "val"):
        records.write_ranking(tops.filter(C("own") == split).drop("own"), path, split)
    return spark.read.parquet(path).select("split", "query_id", "rank", "doc_id")


def metric_files(spark, sf):
    path = _home(spark, "metrics")
    records.write_table(Q._grid(spark, sf).filter("split = 'val'").drop("split"), path)
    read = records.read_csv(spark, path)
    return read.select("family", "config", C("n").cast("long").alias("n"), *[C(c).cast("double").alias(c) for c in ("p_at_1", "mrr_at_5", "r_at_5")])


def ledger_runs(spark, sf):
    """Answers appended run by run: the last run that answers a query counts, and in a run the last answer."""
    path, said = _home(spark, "ledger"), Q._ledger(spark, sf)
    for run in (0, 1, 2):
        ledger.append_answers(said.filter(C("seq") % 3 == run), path, run)
    return ledger.answered(spark, path).select("query_id", F.array_join("ranking", ",").alias("ranking"))


def batch_ledger(spark, sf):
    """Whole batches per line; a second run answers the even batches again."""
    path = _home(spark, "batches")
    asked = R.orders(spark, sf).select("query_id", RR.batch_no(C("query_id")).alias("batch"))
    for run in (0, 1):
        rows = asked.filter(F.lit(run == 0) | (C("batch") % 2 == 0))
        ledger.append_batches(rows.groupBy("batch").agg(F.map_from_entries(F.collect_list(F.struct(
            C("query_id").cast("string"), F.array((C("query_id") % 10 + 1).cast("int"), F.lit(run)))))
            .alias("rankings")), path, run)
    return ledger.read_batch_ledger(spark, path).select("query_id", F.array_join("ranking", ",").alias("ranking"))


def raw_answers(spark, sf):
    path = _home(spark, "raw")
    ledger.write_raw_answers(Q._batch_answers(spark, sf), path)
    return RR.parse_batch_answers(ledger.read_raw_answers(spark, path)).select(
        "batch", "query_id", F.array_join("ranking", ",").alias("ranking"))


def _wide_sql(system):
    return f"""SELECT '{system}' AS system, o.query_id, o.text AS query, g.rank, t.doc_id AS pred1_id, p.name AS pred1_name
 FROM ({S.ORDERS}) o JOIN ({Q._ranks_sql(shared.SYSTEMS[system])}) g USING (query_id)
 JOIN {Q._tops_sql(shared.SYSTEMS[system])} t ON t.query_id = o.query_id AND t.rank = 1 JOIN ({S.PRODUCTS}) p ON p.doc_id = t.doc_id"""


QUERIES: dict = {
    "csv_catalog": (csv_catalog, f"SELECT lpad(doc_id::VARCHAR, 14, '0') AS doc_id, name, brand FROM ({S.PRODUCTS})"),
    "split_queries": (split_queries, f"""SELECT split, count(*) AS n, 0::BIGINT AS first_no, count(*) - 1 AS last_no, count(*) AS numbers,
 sum(length(text))::BIGINT AS chars, count(DISTINCT gold_id) AS golds FROM ({S.ORDERS}) GROUP BY split"""),
    "prediction_files": (prediction_files, _wide_sql("tfidf_word") + " UNION ALL " + _wide_sql("bm25")),
    "ranking_files": (ranking_files, f"SELECT split, t.query_id, rank, doc_id FROM {Q._tops_sql(shared.SYSTEMS['bm25'])} t JOIN ({S.ORDERS}) USING (query_id)"),
    "metric_files": (metric_files, Q.QUERIES["leaderboard"][1]),
    "ledger_runs": (ledger_runs, f"""SELECT query_id, arg_max(ranking, (seq % 3) * 1000000 + seq) AS ranking FROM ({Q._LEDGER}) GROUP BY query_id"""),
    "batch_ledger": (batch_ledger, f"""SELECT query_id, (query_id % 10 + 1) || ',' || CASE WHEN (query_id // 32) % 2 = 0 THEN 1 ELSE 0 END AS ranking
 FROM ({S.ORDERS})"""),
    "raw_answers": (raw_answers, Q.QUERIES["parse_free_text"][1]),
}
