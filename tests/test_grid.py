"""All configurations in one index against an index for each."""

import pytest
from pyspark.sql import functions as F

from matchloom.operators.grid import Configuration, GridIndex, grid_ranks
from matchloom.operators.sparse import SparseIndex
from test_search import catalog, fixture, frames

GRID = [Configuration(f"{weighting} {analyzer} {variant}", variant, analyzer, weighting)
        for variant in ("short", "long") for analyzer, weighting in (("word", "tfidf"), ("word12", "tfidf"), ("char35", "tfidf"), ("word", "bm25"))]


def test_grid_equals_single_indexes(spark):
    docs, queries = fixture()
    docs = {i: t + " extra thing" * (i % 3) for i, t in docs.items()} | {200 + i: t for i, t in catalog(60)[0].items()}
    d, q = frames(spark, docs, queries)
    variants = {"short": d, "long": d.withColumn("norm", F.concat_ws(" ", F.nullif("norm", F.lit("")), F.concat(F.lit("brand"), F.col("doc_id") % 4)))}
    index = GridIndex.fit_all(variants, GRID)
    got = {}
    for r in index.search(q, 5, pad=True).collect():
        got.setdefault(r.config, {})[r.query_id, r["rank"]] = (r.doc_id, r.score)
    assert set(got) == {c.name for c in GRID}
    for c in GRID:
        own = SparseIndex.fit(variants[c.variant], c.analyzer, c.weighting)
        want = {(r.query_id, r["rank"]): (r.doc_id, r.score) for r in own.search(q, 5, pad=True, plan="direct").collect()}
        own.release()
        assert {k: v[0] for k, v in got[c.name].items()} == {k: v[0] for k, v in want.items()}, c
        assert [got[c.name][k][1] for k in sorted(want)] == pytest.approx([want[k][1] for k in sorted(want)], abs=2e-9)
    index.release()
    assert not index.files and not index.kept and not index.shared


def test_every_configuration_counts_every_gold_row(spark):
    docs = catalog(80)[0]
    queries = {i: docs[i] for i in range(20)}              # as written in the catalog
    d, q = frames(spark, docs, queries)
    index = GridIndex.fit_all({"short": d, "long": d}, GRID)
    gold = spark.createDataFrame([(i, i) for i in queries], "query_id long, gold_id long")
    ranks = grid_ranks(index, gold, index.search(q, 3))
    assert ranks.groupBy("config").count().filter(F.col("count") == len(queries)).count() == len(GRID)
    assert ranks.filter("rank > 0").count() > 0
    index.release()


def test_one_tokenisation_per_analyzer(spark):
    docs, queries = catalog(40)
    d, _ = frames(spark, docs, queries)
    index = GridIndex.fit_all({"short": d, "long": d}, GRID)
    assert {tuple(r) for r in index.counts.select("variant", "analyzer").distinct().collect()} == {(v, a) for v in ("short", "long") for a in ("word", "word12", "char35")}
    plan = index.counts._jdf.queryExecution().optimizedPlan().toString()
    assert index.vocabulary.select("config").distinct().count() == len(GRID) and "Python" not in plan
    index.release()


def test_negative_floors_are_refused(spark):
    docs = spark.createDataFrame([(i, "p q") for i in range(20)] + [(i, "z") for i in range(20, 30)], "doc_id long, norm string")
    with pytest.raises(ValueError):
        GridIndex.fit_all({"short": docs}, [Configuration("x", "short", "word", "bm25")])
