"""Dense search by cells against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchloom.operators import dense


def vectors(seed, n, clusters=6, spread=0.25, dim=12):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(clusters, dim))
    v = middle[rng.integers(0, clusters, n)] / np.linalg.norm(middle, axis=1).mean() + spread * rng.normal(size=(n, dim)) / np.sqrt(dim)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def table(spark, name, v):
    return spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], f"{name} long, vector array<double>").repartition(4)


def plainly(queries, docs, k):
    scores = np.round(queries @ docs.T, 9)
    order = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    return {q: [(int(d), scores[q, d]) for d in row] for q, row in enumerate(order)}


def collected(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.doc_id, r.score))
    return out


@pytest.mark.parametrize("k, block_bytes", [(1, 1 << 20), (5, 1 << 20), (5, 2000), (700, 1 << 20)])
def test_cells_equal_all_products(spark, k, block_bytes):
    docs = np.concatenate([vectors(1, 600), np.zeros((2, 12)), vectors(1, 40)[:20]])          # zero vectors and copies among them
    queries = np.concatenate([vectors(1, 25), vectors(9, 5), np.zeros((1, 12))])
    got = collected(dense.dense_top_k(table(spark, "query_id", queries), table(spark, "doc_id", docs), k, block_bytes, plan="cells"))
    want = plainly(queries, docs, k)
    assert {q: [d for d, _ in rows] for q, rows in got.items()} == {q: [d for d, _ in rows] for q, rows in want.items()}
    assert all(abs(a - b) < 2e-9 for q in want for (_, a), (_, b) in zip(got[q], want[q]))


def test_most_cells_are_skipped(spark):
    docs, queries = vectors(3, 3000), vectors(3, 60)
    d, q = table(spark, "doc_id", docs), table(spark, "query_id", queries)
    cells = dense.Cells(d, 3000, 3000 * 12 * 8)
    n = int((cells.rows > 0).sum())
    first = cells.visits(q.withColumn("floor", F.lit(None).cast("double")), 5)
    floors = {i: float(rows[-1][1]) for i, rows in plainly(queries, docs, 5).items()}
    known = spark.createDataFrame(list(floors.items()), "query_id long, floor double")
    visited = first.count() + cells.visits(q.join(known, "query_id"), 5).count()
    assert n > 15 and 60 <= first.count() and visited < 0.6 * 60 * n
    assert int(cells.rows.sum()) == 3000
    cells.release()


def test_one_hot_cell_is_cut_into_parts(spark):
    docs = np.concatenate([np.repeat(vectors(5, 1), 800, axis=0), vectors(6, 200)])
    d = table(spark, "doc_id", docs)
    cells = dense.Cells(d, 1000, 1000 * 12 * 8, block_bytes=8000)
    assert cells.parts.max() >= 9
    got = collected(cells.search(table(spark, "query_id", docs[:3]), 4))
    assert {q: [d for d, _ in rows] for q, rows in got.items()} == {q: [0, 1, 2, 3] for q in range(3)}
    cells.release()


def test_empty_sides(spark):
    d, q = table(spark, "doc_id", vectors(1, 9)), table(spark, "query_id", vectors(2, 3))
    for plan in ("whole", "cells"):
        assert dense.dense_top_k(q, d.limit(0), plan=plan).count() == 0
        assert dense.dense_top_k(q.limit(0), d, plan=plan).count() == 0


def test_k_best_keeps_lower_columns_and_puts_nan_last():
    scores = np.array([[1.0, 3.0, 3.0, 3.0, 2.0], [np.nan, 1.0, np.nan, np.nan, 1.0], [0.0] * 5])
    for k in (1, 2, 3, 5, 9):
        row, column = dense.k_best(scores, k)
        want = np.argsort(-scores, axis=1, kind="stable")[:, :k]
        assert row.tolist() == np.repeat(range(3), want.shape[1]).tolist() and column.tolist() == want.ravel().tolist()


@pytest.mark.parametrize("plan", ["whole", "cells"])
def test_scores_and_visits_are_held_in_small_pieces(spark, monkeypatch, plan):
    docs, queries = vectors(1, 700), vectors(9, 90)
    d, q = table(spark, "doc_id", docs), table(spark, "query_id", queries).coalesce(1)
    whole = collected(dense.dense_top_k(q, d, 5, plan=plan))
    monkeypatch.setattr(dense, "SCORES", 1500)
    monkeypatch.setattr(dense, "PACKED_BYTES", 4000)
    monkeypatch.setattr(dense, "VISIT_ROWS", 20)
    assert collected(dense.dense_top_k(q, d, 5, plan=plan)) == whole
    cells = dense.Cells(d, 700, 700 * 12 * 8)
    made = {}

    class Asked:
        schema = q.schema

        def select(self, *_):
            return self

        def mapInPandas(self, work, _):
            made["work"] = work

    cells.visits(Asked(), 5)
    held = [len(piece) for piece in made["work"](iter([q.toPandas().assign(floor=-2.0)]))]
    assert sum(held) > 90 and max(held) <= 20
    cells.release()


def test_repeated_ids_stay_repeated_in_every_plan(spark, monkeypatch):
    monkeypatch.setattr(dense, "PACKED_BYTES", 4000)
    docs, queries = table(spark, "doc_id", vectors(1, 400)), table(spark, "query_id", vectors(9, 6))
    twice, asked = docs.union(docs.filter("doc_id % 3 = 0")), queries.union(queries.filter("query_id = 1"))
    rows = [[(r.query_id, r["rank"], r.doc_id) for r in dense.dense_top_k(asked, twice, 5, plan=plan).orderBy("query_id", "rank").collect()] for plan in ("whole", "cells")]
    assert rows[0] == rows[1] and len(rows[0]) > len({(q, d) for q, _, d in rows[0]})


def test_every_vector_is_asked(spark, tmp_path):
    """No vector is left out as a query, in the registered queries and in their SQL."""
    import duckdb

    from matchloom.plans.match_queries import QUERIES
    rows = [(i, x.tolist(), i % 3) for i, x in enumerate(vectors(2, 130, dim=64))]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    plain = duckdb.connect()
    plain.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    for name in ("dense_top5", "dense_cells_top5", "dense_grid"):
        run, sql = QUERIES[name]
        got = sorted(map(tuple, run(spark, str(tmp_path)).collect()))
        assert [tuple(r) for r in got] == sorted(plain.sql(sql).fetchall())
        assert all(r[2] == 130 for r in got) if name == "dense_grid" else len(got) == 130 * 5


@pytest.mark.parametrize("k", [1, 5, 40])
def test_tiles_give_the_same_best(monkeypatch, k):
    docs = np.concatenate([vectors(1, 300), np.repeat(vectors(4, 1), 60, axis=0), vectors(1, 300)])
    monkeypatch.setattr(dense, "SCORES", 400)
    got = {}
    for at, row, column, score in dense.best_of(docs[:90], docs, k):
        for r, c, s in zip(row, column, score):
            got.setdefault(at + r, []).append((int(c), s))
    assert {q: [d for d, _ in rows] for q, rows in got.items()} == {q: [d for d, _ in rows] for q, rows in plainly(docs[:90], docs, k).items()}


def test_cells_in_rounds_visit_all_blocks(spark, monkeypatch):
    docs = vectors(1, 700)
    d, q = table(spark, "doc_id", docs), table(spark, "query_id", docs)
    monkeypatch.setattr(dense, "PACKED_BYTES", 8000)
    whole = collected(dense.dense_top_k(q, d, 5, plan="whole"))
    monkeypatch.setattr(dense, "VISITED_BYTES", 200_000)       # three blocks a round
    assert collected(dense.dense_top_k(q, d, 5, plan="cells")) == whole
