"""Search by slices against the other plans."""

import random

import pytest
from pyspark.sql import functions as F

from matchloom.operators import slices
from matchloom.operators.grid import Configuration, GridIndex
from matchloom.operators.sparse import SparseIndex

WORDS = ["red", "bolt", "ring", "small", "steel", "gear", "7", "11", "14g", "nut"]


def frames(spark, n=400, asked=150):
    rng = random.Random(4)
    text = lambda: " ".join(rng.sample(WORDS, rng.randint(1, 5)))
    docs = [(i, text()) for i in range(n)] + [(n, ""), (n + 1, "")]
    queries = [(i, text() + rng.choice(["", " unknown", " other words"])) for i in range(asked)] + [(asked, ""), (asked + 1, "unknown")]
    return spark.createDataFrame(docs, "doc_id long, norm string"), spark.createDataFrame(queries, "query_id long, norm string")


def rows(df, *keys):
    return [tuple(r) for r in df.orderBy(*keys, "query_id", "rank").collect()]


@pytest.mark.parametrize("analyzer, weighting", [("word", "bm25"), ("word12", "tfidf"), ("char35", "tfidf")])
@pytest.mark.parametrize("pad", [False, True])
def test_slices_rank_as_the_other_plans(spark, monkeypatch, analyzer, weighting, pad):
    d, q = frames(spark)
    index = SparseIndex.fit(d, analyzer, weighting)
    want = rows(index.search(q, 5, pad=pad, plan="direct"))
    monkeypatch.setattr(slices, "SLICE_TEXTS", 60)             # several slices and parts
    monkeypatch.setattr(slices, "PART_QUERIES", 20)
    got = rows(index.search(q, 5, pad=pad, plan="slices"))
    assert any("search-slices" in p for p in index.files)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=2e-9)
    index.release()


def test_queries_of_the_same_known_terms_are_searched_once(spark):
    d, q = frames(spark)
    index = SparseIndex.fit(d, "word", "bm25")
    again = q.union(spark.createDataFrame([(900, "bolt unknown red"), (901, "red bolt"), (902, "bolt red red"), (903, None)], q.schema))
    distinct = again.select(F.col("query_id").alias("text_id"), "norm", F.lit(1).alias("copies"), F.lit(0).alias("words")).filter("norm is not null")
    alike, vectors = index._asked_once(index.query_vectors(distinct), distinct.select(F.col("text_id").alias("qid")))
    own = {r.own: r.qid for r in alike.collect()}
    assert own[900] == own[901] != own[902] and own[150] == own[151]
    assert len(own) == 155 and {r.qid for r in vectors.select("qid").distinct().collect()} <= set(own.values())
    index.release()


def test_grid_by_slices_equals_grid_by_bounds(spark, monkeypatch):
    d, q = frames(spark)
    other = d.withColumn("norm", F.concat_ws(" ", "norm", F.lit("gear")))
    grid = GridIndex.fit_all({"a": d, "b": other}, [Configuration("one", "a", "word", "tfidf"), Configuration("two", "b", "char35", "tfidf")])
    want = rows(grid.search(q, 5, pad=True, plan="pruned"), "config")
    monkeypatch.setattr(slices, "SLICE_TEXTS", 60)
    got = rows(grid.search(q, 5, pad=True), "config")
    assert any("search-slices" in p for p in grid.files)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert [r[4] for r in got] == pytest.approx([r[4] for r in want], abs=2e-9)
    grid.release()


def test_too_many_terms_leave_it_to_the_bounds(spark, monkeypatch):
    d, q = frames(spark)
    index = SparseIndex.fit(d, "word", "bm25")
    monkeypatch.setattr(slices, "SHUFFLED", 100)
    index.search(q, 5, plan="slices").collect()
    assert not any("search-slices" in p for p in index.files) and any("search-pairs" in p for p in index.files)
    index.release()
