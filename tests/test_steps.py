"""Queries run only the steps that their rows need."""

import pytest
from pyspark.sql import functions as F

from matchloom.operators.nomatch import keyword_join
from matchloom.plans import eval_queries as Q, shared


class Asked(Exception):
    pass


@pytest.fixture
def searched(spark, monkeypatch):
    """The searches that a query asks for; each returns one row."""
    seen = set()

    def ranking(session, sf, *how):
        seen.add(how)
        return spark.createDataFrame([(1, 1, 1, 0.5)], "query_id long, rank int, doc_id long, score double")

    monkeypatch.setattr(shared, "order_ranking", ranking)
    monkeypatch.setattr(Q.R, "orders", lambda session, sf: spark.createDataFrame(
        [(1, "A", 1, "val")], "query_id long, text string, gold_id long, split string"))
    return seen


def test_repaired_errors_searches_two_systems(spark, searched):
    assert Q.repaired_errors(spark, "").collect() == []
    assert searched == {shared.SYSTEMS["tfidf_char"], shared.SYSTEMS["bm25"]}


def test_distributor_hits_searches_one_system(spark, searched):
    Q.distributor_hits(spark, "").collect()
    assert searched == {shared.SYSTEMS["tfidf_char"]}


def test_threshold_needs_labelled_orders_only(spark, searched, monkeypatch):
    def unmatched(*_):
        raise Asked

    monkeypatch.setattr(Q, "_unmatched_ranking", unmatched)
    assert [r.score_limit for r in Q.score_threshold(spark, "").collect()] == [0.5]
    with pytest.raises(Asked):
        Q.score_distribution(spark, "")


def test_keyword_join_cuts_names_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(name):
        read.add(1)
        return name

    rows = [(i, f"Red Rod {i} of steel") for i in range(50)]
    catalog = spark.createDataFrame(rows, "doc_id long, name string").withColumn("name", counted.asNondeterministic()("name"))
    keys = spark.createDataFrame([("rod 1", "rods"), ("steel", "metal"), ("d", "short"), ("lead", "metal")], "key string, title string")
    found = {(r.doc_id, r.key) for r in keyword_join(catalog, keys).collect()}
    assert found == {(i, k) for i, name in rows for k in ("rod 1", "steel", "d") if k in name.lower()}
    assert read.value <= 2 * len(rows)                     # once for its runs, once to be confirmed


def test_ranks_of_all_systems_need_no_row_per_order_and_rank(spark, monkeypatch, tmp_path):
    parts = [(key, f"red bolt {key % 7}", "Brand#1", "SMALL", key % 7, 1.0) for key in [*range(30), 3, 4]]       # two keys repeat
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    full = {name: sorted(shared.gold_ranks(Q._gold(spark, str(tmp_path)), shared.order_ranking(spark, str(tmp_path), *how), "split").collect())
            for name, how in shared.SYSTEMS.items()}
    shared.forget()

    def refused(*_):
        raise AssertionError("all rankings of all orders")

    monkeypatch.setattr(shared, "order_ranking", refused)
    got = shared.system_ranks(spark, str(tmp_path)).collect()
    for name, rows in full.items():
        assert sorted((r.query_id, r.gold_id, r.split, r["rank"]) for r in got if r.system == name) == [(r.query_id, r.gold_id, r.split, r["rank"]) for r in rows]
    shared.forget()
