"""Order of answers across files, and the compacted table."""

import json
import random

import pytest

from matchloom.operators import nomatch
from matchloom.sources import ledger


def write_files(path, run, files):
    home = path / f"run={run}"
    home.mkdir(parents=True, exist_ok=True)
    for name, rows in files.items():
        (home / name).write_text("".join(json.dumps({"qi": q, "ranking": r}) + "\n" for q, r in rows))


def rankings(df):
    return {r.query_id: list(r.ranking) for r in df.collect()}


FILES = {f"part-{n:02d}.json": [(q, [n, q % 3 + 1]) for q in range(30) if (q + n) % 2] + [(n, [9, n])] * (n % 2) for n in range(6)}


@pytest.mark.parametrize("order", ["names", "manifest"])
def test_files_of_a_run_have_one_order(spark, tmp_path, order):
    names = sorted(FILES)
    if order == "manifest":
        random.Random(1).shuffle(names)
    write_files(tmp_path, 0, FILES)
    if order == "manifest":
        ledger.order_files(spark, f"file:{tmp_path}", 0, names)
    want = {q: r for name in names for q, r in FILES[name]}
    try:
        for size in ("128m", "64b", "200b"):               # files read whole, together, and in pieces
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b" if size == "128m" else "4m")
            assert rankings(ledger.answered(spark, f"file:{tmp_path}")) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_later_runs_merge_into_the_compacted_table(spark, tmp_path):
    path, table = f"file:{tmp_path}/ledger", f"file:{tmp_path}/newest"
    for run in range(4):
        write_files(tmp_path / "ledger", run, {"b.json": [(q, [run, 1]) for q in range(run, 20, run + 1)], "a.json": [(q, [run, 2]) for q in range(0, 20, 4)]})
        want = rankings(ledger.answered(spark, path))
        assert rankings(ledger.answered(spark, path, table)) == want
        if run in (1, 2):
            ledger.compact(spark, path, table, run)
            done = ledger.compacted(spark, table)
            assert done[1] == run and rankings(ledger.answered(spark, path, table)) == want
    plan = ledger.answered(spark, path, table)._jdf.queryExecution().executedPlan().toString()
    assert "(run" in plan.split("PartitionFilters")[1][:80]


def test_keywords_from_a_table(spark):
    names = ["Red Anvil 12", "ANVIL", "covered", "x", None, "", "aaa", "a%b_c", "Ünder anvils"]
    catalog = spark.createDataFrame(list(enumerate(names)), "doc_id long, name string")
    words = ["anvil", "red", "a", "aa", "b_c", "ünder", "nothing here", "", None, "red", "12"]
    keys = spark.createDataFrame([(k, "t") for k in words], "key string, title string")
    out = nomatch.keyword_join(catalog, keys)
    got = sorted((r.doc_id, r.key) for r in out.collect())
    assert got == sorted((i, k) for i, n in enumerate(names) if n for k in {w for w in words if w} if k in n.lower())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert nomatch.keyword_join(catalog, keys.limit(0)).count() == 0
