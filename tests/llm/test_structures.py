"""Packing, conversation repair and the Merkle manifest against brute force."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from matchloom.llm import conversations, merkle, packing
from tests.llm import brute
from tests.llm.test_operators import corpus, plain, prose

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ 11
@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(packing.vocabulary_file())


def check_packing(model, docs, rows, capacity=2048):
    """Every document is there once, whole and in order; sequences have no gaps and no overlaps."""
    lengths, by_doc, sequences = 0, {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == {d for d, _ in docs}
    for key, text in docs:
        ids = model.encode(text or "", add_special_tokens=False).ids + [0]
        lengths += len(ids)
        own, at = sorted(by_doc[key], key=lambda r: r.piece), 0
        for n, r in enumerate(own):
            assert (r.piece, r.start) == (n, at) and (n == 0 or r.length == capacity) and r.length <= capacity
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids) and (len(own) == 1 or len(ids) > capacity)
    for placed in sequences.values():
        ends = list(itertools.accumulate(size for _, size in sorted(placed)))
        assert [o for o, _ in sorted(placed)] == [0, *ends[:-1]] and ends[-1] <= capacity
    return len(sequences), -(-lengths // capacity)


def test_packing_query(spark, model):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    used, least = check_packing(model, docs, packing.op11_best_fit_packing(spark, SF).collect())
    assert used <= 1.04 * least


def test_packing_odd_input(spark, model):
    texts = plain(corpus()) + [(100, "<|endoftext|> a <|b"), (101, "日本語   words\n\n\n  end "), (102, "x" * 50_000), (103, " " * 9000), (104, "it's we'll ''s\t\t\r\n")]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("key", F.lit("x")).withColumn("part", F.lit(1)).withColumn("length", F.lit(0))
    for capacity in (2048, 7, 1):
        used, least = check_packing(model, texts, packing.pack_documents(df, capacity=capacity, group_items=5).collect(), capacity)
        assert used >= least
    assert packing.pack_documents(df.limit(0)).count() == 0


def test_packing_repeated_and_null_keys(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, "c"), (3, "d e f"), (4, None)], "doc_id long, text string")
    rows = packing.pack_documents(df).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.length) for r in rows) == [(False, 3, 2), (False, 3, 4), (False, 4, 1), (True, None, 3), (True, None, 3)]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 5


def test_packing_again_gives_the_same_places(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    one, two = (sorted(map(tuple, packing.pack_documents(df).collect())) for _ in range(2))
    assert one == two


def test_open_bins_take_the_best_fit_and_close_the_fullest():
    rng, bins, plainly, made = random.Random(4), packing.OpenBins(100, 5), [], 0
    for _ in range(3000):
        size = rng.randint(1, 100)
        fits = sorted((free, seq) for seq, free in plainly if free >= size)
        sequence, offset = bins.place(size)
        if fits:
            free = fits[0][0]
            assert (sequence, free) in plainly and offset == 100 - free
            plainly.remove((sequence, free))
        else:
            if len(plainly) == 5:
                fullest = min(f for _, f in plainly)
                left = [s for s, f in plainly if f == fullest]
                plainly.remove((left[-1], fullest))
            assert (sequence, offset) == (made, 0)
            made, free = made + 1, 100
        if free > size:
            plainly.append((sequence, free - size))
        assert bins.count == len(plainly) <= 5


# ------------------------------------------------------------------ 12
def damaged_plainly(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1])):
        held = out.setdefault(conv, [])
        shown = [" " if v is None else str(v) for v in (conv, turn)]
        kind = zlib.crc32(":".join(shown).encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        held += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def conversations_of(rows):
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_conversation_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = {c: brute.repaired(r) for c, r in damaged_plainly(rows).items()}
    assert conversations_of(conversations.op12_conversation_repair(spark, SF).collect()) == expected


@pytest.mark.parametrize("piece_rows,fan_bits", [(2048, 5), (3, 1), (1, 2)])
def test_long_and_odd_conversations(spark, piece_rows, fan_bits):
    rng = random.Random(piece_rows)
    says = ["yes.", "no", "", " \t\n", "why?", "é!", "so\n", "more. "]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(says) + (str(t) + "." if rng.random() < .5 else ""))
            for c in (1, 2, 3, 4, None) for t in rng.sample(range(400), 150 if c == 1 else 12)]
    rows += [(9, None, "user", "a."), (8, 5, None, None), (7, -3, "assistant", "hello."), (7, 10 ** 12, "user", prose(3, 9000) + ".")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("cost", F.lit("x")).withColumn("seq", F.lit(1))
    out = conversations.repair_conversations(conversations.damaged(df), piece_rows, fan_bits).withColumnRenamed("conv", "conv_id")
    assert conversations_of(out.collect()) == {c: brute.repaired(r) for c, r in damaged_plainly(rows).items()}


def test_conversation_repeats_and_lost_rows(spark):
    rows = [(1, 0, "user", "a.", 0, False), (1, 0, "user", "a.", 0, False), (1, 0, "user", "a.", 1, False), (1, 1, "assistant", "b.", 0, False),
            (2, None, None, None, 0, True), (3, None, "user", "x.", 0, False), (3, None, "assistant", "y.", 0, False)]
    df = spark.createDataFrame(rows, "conv long, turn long, role string, text string, copy int, dropped boolean")
    out = {r.conv: tuple(r)[1:8] for r in conversations.repair_conversations(df).collect()}
    assert out[1] == (0, 0, 2, 0, 2, 4, "KDDK")
    assert out[2] == (0, 0, 0, 0, 0, 0, "")
    assert out[3] == (0, 0, 0, 0, 0, 2, "RR")             # rows of one turn stand by role: assistant, user
    empty = conversations.repair_conversations(df.limit(0))
    assert empty.count() == 0 and "repaired_sha256" in empty.columns


@pytest.mark.parametrize("seed", range(4))
def test_cells_are_the_same_for_every_split(seed):
    rng = random.Random(seed)
    kinds = [rng.choice("xsuaoSUAO") for _ in range(12)]
    cells = [conversations.row_cell(k) for k in kinds]
    whole = conversations.span_cell(cells)
    for at in range(1, 12):
        assert conversations.combined(conversations.span_cell(cells[:at]), conversations.span_cell(cells[at:])) == whole
    fault = {"x": "blank"} | {k: "truncated" for k in "SUAO"}
    assert conversations.verdict(whole) == brute.cheapest_edits([(k.lower(), fault.get(k, "")) for k in kinds])


# ------------------------------------------------------------------ 13
def manifest_rows(rows):
    out = []
    for doc, source, lang, chars, text in rows:
        hit = doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0 and text is not None
        own = brute.leaf((doc, source, lang, chars, text))
        out.append((doc, source, own, brute.leaf((doc, source, lang, chars, text.replace("\n", ""))) if hit else own))
    return out


def query_rows(spark, rows, block_levels):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df = df.withColumn("hash", F.lit("x")).withColumn("at", F.lit(1)).withColumn("changed", F.lit("x"))
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    body = F.when(hit, F.translate("text", "\n", "")).otherwise(F.col("text"))
    changed = merkle.leaf([body if f == "text" else F.col(f) for f in merkle.FIELDS])
    return sorted((tuple(r) for r in merkle.manifest(df, changed=changed, block_levels=block_levels).collect()), key=str)


def test_merkle_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = merkle.op13_merkle_manifest(spark, SF).collect()
    assert sorted(map(tuple, got), key=str) == brute.manifest(manifest_rows(rows))
    assert any(r.verified for r in got) and not all(r.verified for r in got)


@pytest.mark.parametrize("block_levels", [1, 2, 6])
def test_merkle_odd_input(spark, block_levels):
    rng = random.Random(block_levels)
    rows = [(i, rng.choice(["hot", "hot", "hot", "é", "", None, "z", f"s{i}"]), rng.choice(["en", None]), i, rng.choice([None, "", "a\nb", prose(i, 5)])) for i in range(70)]
    rows += [(500, "alone", None, None, "x\ny"), (None, "hot", "en", 1, "n\nn"), (None, None, None, None, None), (7, "hot", "en", 1, "again"), (7, "hot", "en", 1, "again"),
             (501, "long", "en", 5, "word\n" * 40_000)]
    assert query_rows(spark, rows, block_levels) == brute.manifest(manifest_rows(rows))


def test_merkle_one_row_and_no_row(spark):
    one = [(4, "a", "en", 1, "t\nt")]
    assert query_rows(spark, one, 6) == brute.manifest(manifest_rows(one))
    df = spark.createDataFrame(one, "doc_id long, source string, lang string, n_chars long, text string")
    assert merkle.manifest(df.limit(0)).count() == 0


def test_levels_are_exact(spark):
    sizes = [1, 2, 3, 4, 9, 10, 27, 28, 3 ** 20, 3 ** 20 + 1, 3 ** 38]
    got = spark.createDataFrame([(n,) for n in sizes], "n long").select("n", merkle.levels(F.col("n")).alias("d")).collect()
    assert {r.n: r.d for r in got} == {n: next(d for d in range(41) if 3 ** d >= n) for n in sizes}


def test_versions_share_all_untouched_nodes():
    nodes = [brute.node(str(i)) for i in range(11)]
    block = merkle.Block(nodes, 3)
    before = [list(level) for level in block.levels]
    for at in range(11):
        changed = nodes[:at] + [brute.node("new")] + nodes[at + 1:]
        assert block.version(at, brute.node("new")) == merkle.Block(changed, 3).ancestor
    assert block.levels == before


@pytest.mark.parametrize("name", ["op12_conversation_repair", "op13_merkle_manifest"])
def test_twins_agree(spark, name):
    import duckdb

    from matchloom.llm.queries import QUERIES
    run, sql = QUERIES[name]
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(map(tuple, run(spark, SF).select(*names).collect())) == sorted(cursor.fetchall())
