import random

import pytest
from pyspark.sql import functions as F

from brute import grams, scores, top
from matchloom.operators import corpus
from matchloom.operators.sparse import SparseIndex


def fixture():
    rnd = random.Random(5)
    words = ["agua", "sal", "a", "cerveja", "lata", "zero", "350ml", "2l", "limao", "gas", "coca", "cola", "pet", "x"]
    docs = {i: " ".join(rnd.choices(words, k=rnd.randint(1, 7))) for i in range(60)}
    docs |= {i: "agua gas 2l" for i in range(60, 95)}             # a third of all rows are copies
    docs |= {95: "", 96: "rare thing", 97: "x x x", 98: "sal"}
    queries = {i: " ".join(rnd.choices(words + ["unseen"], k=rnd.randint(1, 6))) for i in range(20)}
    queries |= {i: "agua gas 2l" for i in range(20, 30)} | {30: "", 31: "unseen only", 32: "rare rare thing"}
    return docs, queries


def frames(spark, docs, queries, parts=3):
    d = spark.createDataFrame(list(docs.items()), "doc_id long, norm string").repartition(parts)
    q = spark.createDataFrame(list(queries.items()), "query_id long, norm string").repartition(parts)
    return d, q


@pytest.mark.parametrize("analyzer, weighting, plan", [
    ("word", "tfidf", "direct"), ("word12", "tfidf", "pruned"), ("char35", "tfidf", "direct"),
    ("char35", "tfidf", "pruned"), ("word", "bm25", "direct"), ("word", "bm25", "pruned")])
def test_equals_brute_force(spark, analyzer, weighting, plan):
    docs, queries = fixture()
    d, q = frames(spark, docs, queries)
    index = SparseIndex.fit(d, analyzer, weighting)
    got = {}
    for r in index.search(q, 5, pad=True, plan=plan).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.doc_id, r.score))
    want = top(scores(docs, queries, analyzer, weighting), 5)
    assert set(got) == set(queries)
    for q_id in queries:
        assert [x for x, _ in got[q_id]] == [x for x, _ in want[q_id]], queries[q_id]
        assert [s for _, s in got[q_id]] == pytest.approx([s for _, s in want[q_id]], abs=2e-9)
    index.release()


def test_partitioning_does_not_matter(spark):
    docs, queries = fixture()
    rows = []
    for parts in (1, 7):
        index = SparseIndex.fit(frames(spark, docs, queries, parts)[0], "char35", "tfidf")
        out = index.search(frames(spark, docs, queries, parts)[1], 5, pad=True)
        rows.append(sorted(map(tuple, out.collect())))
        index.release()
    assert rows[0] == rows[1]


def test_grams(spark):
    texts = spark.createDataFrame([(1, 1, 2, "a sal"), (2, 1, 1, "sal")], "text_id long, copies int, words int, norm string")
    got = corpus.term_counts(corpus.by_text(texts), "char35").collect()
    assert sorted(r.term for r in got if r.text_id == 2) == sorted([" sa", "sal", "al ", " sal", "sal ", " sal "])
    assert sorted(r.term for r in got if r.text_id == 1) == sorted([" a ", *grams("sal", "char35")])


def test_idf_values(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a c"), (3, "d")], "doc_id long, norm string")
    idf = {r.term: r.idf for r in SparseIndex.fit(docs, "word", "tfidf").vocabulary.collect()}
    assert idf["b"] == pytest.approx(1.693147, abs=1e-6) and idf["a"] == pytest.approx(1.287682, abs=1e-6)
    bm = {r.term: r.idf for r in SparseIndex.fit(docs, "word", "bm25").vocabulary.collect()}
    assert bm["b"] == pytest.approx(0.510826, abs=1e-6)
    assert bm["a"] == pytest.approx(0.25 * (3 * 0.510826 - 0.510826) / 4, abs=1e-6)


def test_direct_plan_stays_in_the_jvm_and_shuffles_k_rows_only(spark):
    docs, queries = fixture()
    d, q = frames(spark, docs, queries)
    index = SparseIndex.fit(d, "char35", "tfidf")
    ranked = index.search(q, 5, plan="direct")
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and "WindowGroupLimit" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    vectors = next(x for x in index.kept if "wq" in x.columns)
    pairs = index._direct(vectors)._jdf.queryExecution().executedPlan().toString()
    before_cache = pairs.split("InMemoryTableScan")[0]
    assert "Exchange hashpartitioning" not in before_cache


def test_salted_join_equals_plain_join(spark):
    from matchloom.operators.joins import hot_keys, salted_join
    left = spark.range(3000).select(F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = hot_keys(left.groupBy("k").count(), "k", "count", 3000, floor=100)
    assert hot.count() >= 1
    got = salted_join(left, right, "k", "row", hot)
    assert sorted(map(tuple, got.select("row", "k", "v").collect())) == sorted(
        map(tuple, left.join(right, "k").select("row", "k", "v").collect()))


@pytest.mark.parametrize("pad", [True, False])
@pytest.mark.parametrize("plan", ["direct", "pruned"])
def test_negative_floor_keeps_all_rows(spark, plan, pad):
    docs = {i: "p q" for i in range(20)} | {i: "z" for i in range(20, 30)}
    queries = {1: "p", 2: "z", 3: "p z", 4: "other"}
    d, q = frames(spark, docs, queries)
    index = SparseIndex.fit(d, "word", "bm25")
    assert index.negative
    got = {}
    for r in index.search(q, 5, pad=pad, plan=plan).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.doc_id, r.score))
    table = scores(docs, queries, "word", "bm25")
    if not pad:
        table = {n: {i: s for i, s in row.items() if set(queries[n].split()) & set(docs[i].split())} for n, row in table.items() if n != 4}
    want = top(table, 5)
    assert {n: [i for i, _ in rows] for n, rows in got.items()} == {n: [i for i, _ in rows] for n, rows in want.items()}
    if pad:
        assert got[1] == [(i, 0.0) for i in range(20, 25)]
    index.release()


def test_search_state_does_not_grow(spark):
    docs, queries = fixture()
    d, q = frames(spark, docs, queries)
    index = SparseIndex.fit(d, "word", "bm25")
    index.copies_of(5)
    held = len(index.kept)
    for _ in range(3):
        mark = len(index.kept)
        ranked = index.search(q, 5, pad=True)
        plan = ranked._jdf.queryExecution().optimizedPlan().toString()
        ranked.collect()
        index.release(mark)
    assert len(index.kept) == held and len(index.copies) == 1 and plan.count("InMemoryRelation") >= 2
    index.release()


def test_salted_join_splits_both_sides(spark):
    from matchloom.operators.joins import fits_broadcast, hot_keys, salted_join
    left = spark.range(2000).select(F.col("id").alias("row"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 40).alias("k"))
    right = spark.range(600).select(F.col("id").alias("q"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("k"))
    hot = hot_keys(left.groupBy("k").count(), "k", "count", 2000, floor=100, other=right)
    assert {(r.k, r.salts, r.across) for r in hot.collect()} == {(0, 10, 3)}
    got = salted_join(left, right, "k", "row", hot, "q")
    assert sorted(map(tuple, got.select("row", "k", "q").collect())) == sorted(map(tuple, left.join(right, "k").select("row", "k", "q").collect()))
    wide = spark.range(200).select(F.array_repeat(F.lit("x" * 1000), 1000).alias("a"))
    assert fits_broadcast(spark.range(10)) and not fits_broadcast(wide)


def catalog(n, seed=3):
    rnd = random.Random(seed)
    names = [f"{a} {b}" for a in ("steel", "brass", "nylon", "oak") for b in ("bolt", "nut", "hinge", "plate", "rod")]
    docs = {i: f"{rnd.choice(names)} {rnd.randint(1, 40)}g brand{rnd.randint(1, 15)}" for i in range(n)}
    queries = {i: f"{rnd.choice(names)} {rnd.randint(1, 40)}g" + rnd.choice(["", f" brand{rnd.randint(1, 15)}", " sortido"]) for i in range(n // 4)}
    return docs, queries


@pytest.mark.parametrize("analyzer, weighting", [("word", "bm25"), ("word", "tfidf"), ("char35", "tfidf")])
def test_block_maxima_leave_few_pairs_and_the_same_ranking(spark, analyzer, weighting):
    docs, queries = catalog(1200)
    d, q = frames(spark, docs, queries)
    index = SparseIndex.fit(d, analyzer, weighting)
    counts, write = {}, index._written

    def counting(df, label):
        out = write(df, label)
        counts[label] = out.count()
        return out

    index._written = counting
    pruned = sorted(map(tuple, index.search(q, 5, pad=True, plan="pruned").collect()))
    direct = sorted(map(tuple, index.search(q, 5, pad=True, plan="direct").collect()))
    assert [r[:3] for r in pruned] == [r[:3] for r in direct]
    assert [r[3] for r in pruned] == pytest.approx([r[3] for r in direct], abs=2e-9)
    assert counts["search-texts"] <= counts["search-pairs"] < 0.25 * len(set(docs.values())) * len(set(queries.values()))
    index.release()


def test_a_block_bounds_all_its_texts(spark):
    docs, queries = catalog(300)
    d, q = frames(spark, docs, queries)
    index = SparseIndex.fit(d, "word", "bm25")
    vectors = index.query_vectors(corpus.by_text(corpus.distinct_texts(q, "query_id"))).persist()
    sums = lambda table, unit: vectors.select("qid", "term", "wq").join(table, "term").groupBy("qid", unit).agg(F.sum(F.col("wq") * F.col("wd")).alias(unit + "_sum"))
    scored = sums(index.postings_by_text(), "text_id").join(index.blocks(), "text_id")
    held = scored.join(sums(index.peaks(), "block"), ["qid", "block"])
    assert held.count() == scored.count() and held.filter("text_id_sum > block_sum + 1e-9").isEmpty()
    sizes = index.blocks().groupBy("block").count().agg(F.max("count"), F.sum("count")).first()
    assert sizes[0] == 8 and sizes[1] == len(set(docs.values()))
    index.release()


def test_pruned_search_deletes_its_tables(spark):
    from pathlib import Path
    docs, queries = catalog(100)
    d, q = frames(spark, docs, queries)
    index = SparseIndex.fit(d, "word", "bm25")
    index.search(q, 5, plan="pruned").collect()
    paths = [Path(p.removeprefix("file:")) for p in index.files]
    assert paths and all(p.exists() for p in paths)
    index.release()
    assert not index.files and not any(p.exists() for p in paths)


@pytest.mark.parametrize("size", [1, 4, 64])
def test_free_places_by_rank_and_select(spark, size):
    from matchloom.operators.places import free_places
    rnd = random.Random(size)
    n, taken = 300, {q: set() for q in range(12)}
    for q in taken:
        taken[q] |= set(range(rnd.choice([0, 0, 7, 64, 128, 290]))) | set(rnd.sample(range(n), rnd.choice([0, 3, 40, 200])))
    taken[12] = set(range(n))
    taken[13] = set(range(64, 192))
    rows = spark.createDataFrame([(q, p) for q, own in taken.items() for p in own], "qid long, place long")
    asked = spark.createDataFrame([(q,) for q in taken], "qid long")
    for k in (1, 5, 100):
        got = {}
        for r in free_places(rows, asked, k, size, n).collect():
            got.setdefault(r.qid, set()).add(r.place)
        assert got == {q: set([p for p in range(n) if p not in own][:k]) for q, own in taken.items() if len(own) < n}


def test_padding_under_a_negative_floor_looks_at_no_list_of_places(spark):
    docs = {i: "p q" for i in range(200)} | {i: "z" for i in range(200, 260)}
    d, q = frames(spark, docs, {1: "p", 2: "z", 3: "p z", 4: "other"})
    index = SparseIndex.fit(d, "word", "bm25")
    index.range_places = 16
    got = {}
    for r in index.search(q, 5, pad=True).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.doc_id)
    assert got[1] == list(range(200, 205)) and got[4] == list(range(5))
    plan = index._unscored(spark.createDataFrame([(0,)], "qid long"), spark.createDataFrame([], "qid long, score double"),
                           spark.createDataFrame([(0, 0, -1.0)], "qid long, text_id long, score double"), 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
    index.release()


@pytest.mark.parametrize("analyzer, weighting", [("word", "tfidf"), ("word12", "tfidf"), ("char35", "tfidf"), ("word", "bm25")])
def test_streamed_search_of_long_texts_holds_no_postings(spark, monkeypatch, analyzer, weighting):
    from matchloom.operators import sparse, streamed
    rnd = random.Random(8)
    monkeypatch.setattr(sparse, "LONG_TERMS", 8)
    words = [f"w{int(rnd.paretovariate(.5)) % 300}" for _ in range(2000)]
    docs = {i: " ".join(rnd.choices(words, k=rnd.randint(60, 140))) for i in range(150)}
    docs |= {150 + i: docs[i] for i in range(30)} | {200: "", 201: "alone"}
    d, q = frames(spark, docs, {i: " ".join(rnd.choices(words, k=rnd.randint(1, 9))) for i in range(12)})
    index = SparseIndex.fit(d, analyzer, weighting)
    want = sorted(map(tuple, index.search(q, 5, pad=True, plan="direct").collect()))
    index.release()
    for rows in (1 << 20, 20):                             # a whole table, and one that ends at frequent terms
        monkeypatch.setattr(streamed, "TABLE_ROWS", rows)
        index = SparseIndex.fit(d, analyzer, weighting)
        monkeypatch.setattr(index, "_direct", lambda *_: pytest.fail("postings are joined"))
        monkeypatch.setattr(index, "_many", lambda *_: pytest.fail("postings are joined"))
        got = sorted(map(tuple, index.search(q, 5, pad=True).collect()))
        assert [r[:3] for r in got] == [r[:3] for r in want] and [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=2e-9)
        index.release()
