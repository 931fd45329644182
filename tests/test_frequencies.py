"""Document frequencies, weights of large vocabularies, and short plans of the steps between."""

import pytest
from pyspark.sql import functions as F

from matchloom.operators import corpus, sparse
from matchloom.operators.grid import Configuration, GridIndex
from matchloom.operators.sparse import SparseIndex
from matchloom.plans import shared

TEXTS = ["red bolt 7", "red bolt 7", "red red ring", "a", "", "bolt red", "ring ring ring ring", "steel gear nut", "a", "red"]


def frame(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, norm string")


@pytest.mark.parametrize("analyzer", ["word", "word12", "char35"])
@pytest.mark.parametrize("held", [3, 1 << 19])
def test_frequencies_are_those_of_the_counted_terms(spark, monkeypatch, analyzer, held):
    monkeypatch.setattr(corpus, "HELD_TERMS", held)
    texts = corpus.by_text(corpus.distinct_texts(frame(spark), "doc_id"))
    want = corpus.term_counts(texts, analyzer).groupBy("term").agg(F.sum("copies"), F.count(F.lit(1)))
    assert sorted(map(tuple, corpus.document_frequencies(texts, analyzer).collect())) == sorted(map(tuple, want.collect()))


def test_the_vocabulary_needs_no_postings(spark):
    index = SparseIndex.fit(frame(spark), "char35", "tfidf")
    assert "Generate" not in index.kept[2]._jdf.queryExecution().analyzed().toString()
    index.release()


@pytest.mark.parametrize("rows", [0, 1, 3, 1000])
def test_weights_of_a_vocabulary_that_is_partly_broadcast(spark, monkeypatch, rows):
    whole = SparseIndex.fit(frame(spark), "word", "tfidf")
    want = {(r.text_id, r.term): round(r.weight, 9) for r in whole.weights().collect()}
    whole.release()
    monkeypatch.setattr(sparse, "BROADCAST_ROWS", rows)
    index = SparseIndex.fit(frame(spark), "word", "tfidf")
    index.vocabulary_rows = 10_000
    got = [(r.text_id, r.term, round(r.weight, 9)) for r in index.weights().collect()]
    assert {(a, b): w for a, b, w in got} == want and len(got) == len(want)
    sizes = sorted((r.text_df for r in index.vocabulary.collect()), reverse=True)
    from_ = index._frequent_from()
    assert sum(n >= from_ for n in sizes) <= rows and (from_ == 1 or sum(n >= from_ // 2 for n in sizes) > rows)
    index.release()


def test_steps_of_a_grid_hold_no_plans_of_earlier_ones(spark):
    docs = frame(spark)
    grid = GridIndex.fit_all({"name": docs}, [Configuration("c", "name", "char35", "tfidf"), Configuration("w", "name", "word", "tfidf")])
    ranked = grid.search(docs.select(F.col("doc_id").alias("query_id"), "norm"), 3, pad=True)
    assert ranked.count() == 2 * 3 * len(TEXTS)
    for step in (grid.vocabulary, grid.counts, grid.postings_by_text()):
        assert "InMemoryRelation" not in step._jdf.queryExecution().optimizedPlan().toString()
    grid.release()


def test_articles_are_normalised_once(spark, tmp_path):
    spark.createDataFrame([(i, t, "web") for i, t in enumerate(TEXTS)], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    index = shared.article_index(spark, str(tmp_path), "word", "tfidf")
    assert "regexp_replace" not in index.copies_of(5)._jdf.queryExecution().analyzed().toString()
    assert shared.article_index(spark, str(tmp_path), "word", "bm25").docs is index.docs
    shared.forget()
