import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchloom.operators import compare, dense, evaluate, nomatch, rerank
from matchloom.sources import ledger, records


def test_metrics_of_known_ranks(spark):
    ranks = [1] * 246 + [2, 2, 3, 4]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(ranks)], "query_id long, rank int")
    m = evaluate.metrics(df).first()
    assert (m.n, m.p_at_1, m.mrr_at_5, m.r_at_5) == (250, 0.984, 0.990333, 1.0)
    with pytest.raises(Exception):
        evaluate.metrics(df.filter("false")).collect()


def test_missing_ranking_counts_as_miss(spark):
    gold = spark.createDataFrame([(1, 10), (2, 20)], "query_id long, gold_id long")
    ranked = spark.createDataFrame([(1, 1, 10, 0.5)], "query_id long, rank int, doc_id long, score double")
    assert evaluate.metrics(evaluate.gold_ranks(gold, ranked)).first().p_at_1 == 0.5


def test_clean_and_complete(spark):
    answers = spark.createDataFrame([(1, '{"ranking": [2, 11, 2, "3", 0, 7]}'), (2, "sorry"), (3, '{"ranking": []}'),
                                     (4, '{"ranking": [null, 4, "x", 4]}')], "query_id long, answer string")
    parsed = rerank.parse_answers(answers)
    got = {r.query_id: r.ranking for r in parsed.collect()}
    assert got == {1: [2, 3, 7], 2: [], 3: [], 4: [4]}
    queries = spark.createDataFrame([(i,) for i in range(1, 6)], "query_id long")
    done = rerank.with_fallback(queries, parsed)
    assert {r.query_id for r in done.filter("fallback").collect()} == {2, 3, 5}
    cands = queries.select("query_id", F.explode(F.sequence(F.lit(1), F.lit(10))).alias("cand_no")).withColumn(
        "doc_id", F.col("cand_no") * 100)
    top = {}
    for r in rerank.rerank(done, cands).orderBy("query_id", "rank").collect():
        top.setdefault(r.query_id, []).append(r.doc_id // 100)
    assert top == {1: [2, 3, 7, 1, 4], 2: [1, 2, 3, 4, 5], 3: [1, 2, 3, 4, 5], 4: [4, 1, 2, 3, 5], 5: [1, 2, 3, 4, 5]}


def test_free_text_answers_keep_to_their_batch(spark):
    body = {"resultados": [{"pedido": 0, "ranking": [3, 3, 1]}, {"pedido": 40, "ranking": [1]},
                           {"pedido": "x", "ranking": [1]}, {"pedido": 5, "ranking": ["7", 99]}]}
    text = "Sure:\n```json\n" + json.dumps(body, indent=1) + "\n```"
    df = spark.createDataFrame([(0, text), (1, "no json")], "batch long, answer string")
    assert {r.query_id: r.ranking for r in rerank.parse_batch_answers(df).collect()} == {0: [3, 1], 5: [7]}


def test_batch_requests_skip_answered(spark):
    queries = spark.createDataFrame([(i, f"order {i}") for i in range(40)], "query_id long, text string")
    ledger_df = spark.createDataFrame([(0,), (33,)], "query_id long")
    cands = spark.createDataFrame([(i, 1, 7, 1.0) for i in range(40)], "query_id long, cand_no int, doc_id long, score double")
    catalog = spark.createDataFrame([(7, "Sal", "Lebre")], "doc_id long, name string, brand string")
    out = {r.batch: r for r in rerank.batch_requests(queries, ledger_df, cands, catalog, "Rank.", "JSON.").collect()}
    assert {b: r.queries for b, r in out.items()} == {0: 31, 1: 7}
    assert out[0].request.startswith('Rank.\n\nPedido 1: "order 1"\nCandidatos:\n  1. Sal (marca: Lebre)\n\nPedido 2:')
    assert out[0].request.endswith("JSON.")


def test_ledger_round_trip(spark, tmp_path):
    path = str(tmp_path / "ledger")
    schema = "query_id long, ranking array<int>"
    ledger.append_answers(spark.createDataFrame([(1, [1, 2]), (2, [3])], schema), path, 0)
    ledger.append_answers(spark.createDataFrame([(2, [5, 4])], schema), path, 1)
    assert {r.query_id: r.ranking for r in ledger.answered(spark, path).collect()} == {1: [1, 2], 2: [5, 4]}
    (tmp_path / "b.jsonl").write_text('{"lote": 0, "rankings": {"0": [1, 2], "31": [4]}}\n')
    assert {r.query_id: r.ranking for r in ledger.read_batch_ledger(spark, str(tmp_path / "b.jsonl")).collect()} == {
        0: [1, 2], 31: [4]}
    raw = spark.createDataFrame([(0, 'a "b"\nc')], "batch long, answer string")
    ledger.write_raw_answers(raw, str(tmp_path / "raw"))
    assert ledger.read_raw_answers(spark, str(tmp_path / "raw")).first().answer == 'a "b"\nc'


def test_csv_reading(spark, tmp_path):
    (tmp_path / "queries_val.csv").write_text('text,matched_id\n"Água 1,5 litro",00000078938816\nSal,2\n', encoding="utf-8")
    rows = records.read_queries(spark, records.split_path(str(tmp_path), "val"), "val").orderBy("query_id").collect()
    assert [(r.query_id, r.text, r.gold_id, r.split) for r in rows] == [
        (0, "Água 1,5 litro", "00000078938816", "val"), (1, "Sal", "2", "val")]
    (tmp_path / "p.csv").write_text("query,pos\nsal,2\n", encoding="utf-8-sig")
    got = records.read_predictions(spark, {"a": str(tmp_path / "p.csv")}, "pos")
    assert got.columns[0] == "query" and got.first()["rank"] == 2
    many = spark.createDataFrame([(f"t{i:03d}", "1") for i in range(500)], records.QUERIES).repartition(6)
    many.write.option("header", True).csv(str(tmp_path / "many"))
    numbers = [r.query_id for r in records.read_queries(spark, str(tmp_path / "many")).collect()]
    assert sorted(numbers) == list(range(500))
    with pytest.raises(ValueError):
        records.split_path("x", "dev")


def test_quantiles(spark):
    df = spark.createDataFrame([("a", v) for v in (1.0, 2.0, 4.0, 9.0)] + [("b", 0.5)] * 3, "g string, v double")
    got = {r.g: (r.p5, r.mid) for r in nomatch.quantiles(df, "g", "v", {"p5": 0.05, "mid": 0.5}).collect()}
    assert got["a"] == pytest.approx((1.15, 3.0)) and got["b"] == pytest.approx((0.5, 0.5))
    values = np.round(np.random.default_rng(1).random(2000), 9)
    big = spark.createDataFrame([("x", float(v)) for v in values], "g string, v double")
    r = nomatch.quantiles(big, "g", "v", {"p5": 0.05, "mid": 0.5}).first()
    assert (r.p5, r.mid) == pytest.approx((np.percentile(values, 5), np.median(values)))


def test_segments_and_overlap(spark):
    texts = spark.createDataFrame([(1, "COCA COLA 1L C/6"), (2, "um produto qualquer sem mais nada")], "query_id long, text string")
    got = {r.query_id: set(r.s) for r in texts.select("query_id", compare.segments(F.col("text")).alias("s")).collect()}
    assert got == {1: {"upper", "packaging", "measure", "short"}, 2: {"common"}}
    ranks = spark.createDataFrame([("a", 1, 1), ("b", 1, 2), ("a", 2, 0), ("b", 2, 3), ("a", 3, 1), ("b", 3, 1)],
                                  "system string, query_id long, rank int")
    o = compare.error_overlap(ranks).first()
    assert (o.queries, o.wrong_in_one, o.wrong_in_all, o.best_of_all) == (3, 2, 1, 0.666667)
    assert [tuple(r) for r in compare.exclusive_errors(ranks).collect()] == [(1, "b")]


def test_dense_blocks_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(70, 8))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    m[40] = m[12]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    q = spark.createDataFrame(rows[:30], "query_id long, vector array<double>")
    d = spark.createDataFrame(rows, "doc_id long, vector array<double>")
    got = {}
    for r in dense.dense_top_k(q, d, 4, block_bytes=1000).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.doc_id)
    s = np.round(m[:30] @ m.T, 9)
    assert got == {i: sorted(range(70), key=lambda j: (-s[i, j], j))[:4] for i in range(30)}


def test_abstention(spark):
    answers = spark.createDataFrame([("a", "control", [2]), ("b", "control", []), ("c", "no match", [1])],
                                    "query_id string, grp string, ranking array<int>")
    cands = spark.createDataFrame([("a", 2, 9), ("b", 1, 8), ("c", 1, 7)], "query_id string, cand_no int, doc_id long")
    gold = spark.createDataFrame([("a", 9), ("b", 8)], "query_id string, gold_id long")
    rows = {r.grp: r for r in nomatch.abstention_summary(nomatch.abstentions(answers, cands, gold)).collect()}
    assert (rows["control"].n, rows["control"].abstained, rows["control"].hits) == (2, 1, 1)
    assert (rows["no match"].abstained, rows["no match"].hits) == (0, 0)


def test_last_answer_counts_in_a_batch_and_in_a_run(spark, tmp_path):
    from matchloom.operators import rerank as RR
    from matchloom.sources import ledger
    text = 'so: {"resultados": [{"pedido": 3, "ranking": [3, 1]}, {"pedido": 4, "ranking": [1]}, {"pedido": 3, "ranking": [2]}]}'
    parsed = RR.parse_batch_answers(spark.createDataFrame([(0, text)], "batch long, answer string"))
    assert {(r.query_id, tuple(r.ranking)) for r in parsed.collect()} == {(3, (2,)), (4, (1,))}
    candidates = spark.createDataFrame([(3, n, 100 * n) for n in range(1, 11)], "query_id long, cand_no int, doc_id long")
    done = RR.with_fallback(spark.createDataFrame([(3,)], "query_id long"), parsed)
    assert [r.doc_id for r in RR.rerank(done, candidates).orderBy("rank").collect()] == [200, 100, 300, 400, 500]

    answers = spark.createDataFrame([(1, [1], 0), (1, [2], 1), (2, [3], 0)], "query_id long, ranking array<int>, seq long")
    ledger.append_answers(answers.repartition(3), str(tmp_path / "l"), 0)
    ledger.append_answers(answers.filter("query_id = 2").withColumn("ranking", answers.ranking), str(tmp_path / "l"), 1)
    assert {(r.query_id, r.ranking[0]) for r in ledger.answered(spark, str(tmp_path / "l")).collect()} == {(1, 2), (2, 3)}
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "run=0").mkdir()
    (tmp_path / "b" / "run=0" / "x.json").write_text('{"lote": 0, "rankings": {"1": [1], "2": [2]}}\n{"lote": 0, "rankings": {"1": [9]}}\n')
    assert {(r.query_id, r.ranking[0]) for r in ledger.read_batch_ledger(spark, str(tmp_path / "b")).collect()} == {(1, 9), (2, 2)}


def test_stream_in_several_batches_and_replay(spark, tmp_path):
    from matchloom.operators.sparse import SparseIndex
    from matchloom.streaming.incremental import match_stream
    docs = spark.createDataFrame([(i, f"thing {i} blue") for i in range(20)], "doc_id long, norm string")
    index = SparseIndex.fit(docs, "word", "bm25")
    for i in range(3):
        spark.createDataFrame([(i, f"thing {i}"), (10 + i, "blue 7")], "query_id long, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = lambda: (spark.readStream.schema("query_id long, text string").option("maxFilesPerTrigger", 1)
                      .parquet(str(tmp_path / "in")))
    index.copies_of(5)
    held = len(index.kept)
    match_stream(stream(), index, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    first = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    assert len({r[-1] for r in first}) == 3 and len(first) == 6 * 5 and len(index.kept) == held
    last = max((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    last.unlink()                                          # as if the run had died before the last commit
    last.with_name(f".{last.name}.crc").unlink()
    match_stream(stream(), index, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == first
    index.release()


def test_stream_answers_repeated_queries_once_across_batches_and_restarts(spark, tmp_path):
    from matchloom.operators.sparse import SparseIndex
    from matchloom.streaming.incremental import match_stream
    docs = spark.createDataFrame([(i, f"thing {i} blue") for i in range(20)], "doc_id long, norm string")
    index = SparseIndex.fit(docs, "word", "bm25")
    schema = "query_id long, text string"
    arrive = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run = lambda: match_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), index,
                               str(tmp_path / "out"), str(tmp_path / "state"), answered=str(tmp_path / "earlier")).awaitTermination()
    spark.createDataFrame([(100,)], "query_id long").write.parquet(str(tmp_path / "earlier"))
    arrive([(1, "thing 1"), (2, "thing 2"), (1, "thing 1"), (100, "thing 3")])
    arrive([(2, "thing 2"), (3, "thing 3")])
    run()
    arrive([(1, "thing 1"), (3, "thing 3"), (4, "thing 4")])   # after a restart
    run()
    arrive([(4, "thing 4")])
    run()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.query_id, r["rank"]) for r in rows) == [(q, n) for q in (1, 2, 3, 4) for n in range(1, 6)]
    index.release()


def test_token_counts_of_repeated_and_null_ids(spark):
    from matchloom.plans.profile_queries import _token_counts

    rows = spark.createDataFrame([(1, "Red red rod 1/2"), (2, "red rod"), (2, "Rod big"), (None, "a 1"), (None, "a b"), (3, "--"), (4, None)],
                                 "doc_id long, name string")
    counts = _token_counts(rows)
    got = {(r.doc_id, r.grammar): (r.tokens, r.distinct_tokens) for r in counts.collect()}
    assert got == {(1, "alnum"): (4, 3), (1, "letters"): (3, 2), (1, "lower"): (3, 2),
                   **{(2, g): (4, 3) for g in ("alnum", "letters", "lower")},
                   (None, "alnum"): (4, 3), (None, "letters"): (3, 2), (None, "lower"): (3, 2)}
    plan = _token_counts(rows.filter("doc_id = 1"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1                # tokens leave their row only for ids that stand in several rows
