"""An index written by one session and opened by another."""

import pytest

from matchloom.operators import stored_index
from matchloom.operators.sparse import SparseIndex
from test_search import fixture, frames


@pytest.mark.parametrize("analyzer, weighting", [("word", "bm25"), ("char35", "tfidf")])
def test_reopened_index_ranks_like_a_fresh_one(spark, tmp_path, analyzer, weighting):
    docs, queries = fixture()
    d, q = frames(spark, docs, queries)
    fresh = SparseIndex.fit(d, analyzer, weighting)
    stored_index.save(fresh, f"file:{tmp_path}/index", 5)
    later = spark.newSession()                             # knows no table of the first session but the files
    opened = stored_index.open_index(later, f"file:{tmp_path}/index")
    asked = later.createDataFrame(list(queries.items()), "query_id long, norm string")
    for plan in ("direct", "pruned"):
        want = sorted(map(tuple, fresh.search(q, 5, pad=True, plan=plan).collect()))
        got = sorted(map(tuple, opened.search(asked, 5, pad=True, plan=plan).collect()))
        assert [r[:3] for r in got] == [r[:3] for r in want]
        assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=2e-9)
    fresh.release()
    opened.release()


def test_postings_are_joined_without_an_exchange(spark, tmp_path):
    docs, queries = fixture()
    d, _ = frames(spark, docs, queries)
    stored_index.save(SparseIndex.fit(d, "word", "tfidf"), f"file:{tmp_path}/index", 4)
    opened = stored_index.open_index(spark, f"file:{tmp_path}/index")
    plan = opened.weights()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(text_id" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
    sums = opened.weights().groupBy("text_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in sums
    with pytest.raises(Exception):
        stored_index.save(SparseIndex.fit(d, "word", "tfidf"), f"file:{tmp_path}/index", 4)
