"""Similarity self-join and record groups against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from brute import scores
from matchloom.operators import similar, streamed
from matchloom.operators.sparse import SparseIndex


def records(seed=2, n=120):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(90)]
    texts = {}
    for i in range(n):
        if i and rnd.random() < .5:                        # a near copy of an earlier one
            t = texts[rnd.randrange(i)].split()
            for _ in range(rnd.choice([0, 1, 1, 2])):
                if t:
                    t[rnd.randrange(len(t))] = rnd.choice(words)
        else:
            t = rnd.choices(words, k=rnd.randint(3, 14))
        texts[i] = " ".join(t)
    return texts | {n: "", n + 1: "", n + 2: "single", n + 3: "single"}


def all_pairs(texts, analyzer, threshold):
    first = {}
    for i in sorted(texts):
        first.setdefault(texts[i], i)
    table = scores(texts, {i: t for t, i in first.items()}, analyzer, "tfidf")
    return {(a, b): round(table[a][b], 9) for a in table for b in first.values() if a < b and round(table[a][b], 9) >= threshold}


@pytest.mark.parametrize("analyzer, threshold", [("word", 0.8), ("word", 0.5), ("char35", 0.9), ("word12", 0.7)])
def test_join_equals_all_pairs(spark, analyzer, threshold):
    texts = records()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, norm string").repartition(5)
    index = SparseIndex.fit(docs, analyzer, "tfidf")
    got = {(r.a, r.b): r.score for r in similar.similar_texts(index, threshold).collect()}
    want = all_pairs(texts, analyzer, threshold)
    assert set(got) == set(want) and len(want) > 5
    assert [got[p] for p in sorted(want)] == pytest.approx([want[p] for p in sorted(want)], abs=2e-9)
    index.release()


def test_groups_and_copies(spark):
    texts = records()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, norm string")
    pairs = all_pairs(texts, "word", 0.8)
    first = {i: min(j for j in texts if texts[j] == texts[i]) for i in texts}
    links = {i: sum(first[i] in p for p in pairs) for i in texts}
    root = dict(first)
    for a, b in pairs:
        low, high = sorted((root[a], root[b]))
        root = {i: low if r == high else r for i, r in root.items()}
    got = {r.doc_id: (r.group_id, r.similar) for r in similar.record_groups(docs, 0.8).collect()}
    assert got == {i: (root[i], links[i]) for i in texts}
    assert similar.record_groups(docs.limit(0), 0.8).count() == 0


def test_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    links = spark.createDataFrame(chain + star + [(5000, 4999), (5000, 4999)], "a long, b long")
    got = {r.node: r.root for r in similar.groups(links).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)} | {4999: 4999, 5000: 4999}


def test_filters_leave_few_candidates_and_no_nested_loop(spark):
    texts = records(7, 400)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, norm string")
    index = SparseIndex.fit(docs, "word", "tfidf")
    pairs = similar.candidates(index, 0.8)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan
    distinct = len(set(texts.values()))
    assert pairs.count() < 0.1 * distinct * distinct / 2     # of 90 words only
    index.release()


def test_bm25_has_no_similarity(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, norm string")
    with pytest.raises(ValueError):
        similar.similar_texts(SparseIndex.fit(docs, "word", "bm25"), 0.8)


@pytest.mark.parametrize("rows", [1 << 20, 40])
def test_rounds_and_small_tables_find_the_same_pairs(spark, monkeypatch, rows):
    texts = records(5, 200)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, norm string")
    monkeypatch.setattr(streamed, "TABLE_ROWS", rows)
    monkeypatch.setattr(similar, "ROUND_PAIRS", 9_000)
    monkeypatch.setattr(similar, "ROUND_SCORED", 200)
    index = SparseIndex.fit(docs, "word", "tfidf")
    got = {(r.a, r.b): r.score for r in similar.similar_texts(index, 0.7).collect()}
    want = all_pairs(texts, "word", 0.7)
    assert set(got) == set(want) and len(want) > 5
    assert [got[p] for p in sorted(want)] == pytest.approx([want[p] for p in sorted(want)], abs=2e-9)
    assert not index.shared                                # no postings are held
    index.release()
