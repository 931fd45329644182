"""Hostile and odd input of the older operators and of the whole pipeline."""

import hashlib
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from matchloom.llm import neardup, secret_scan, tokens
from tests.llm import brute
from tests.llm.test_operators import as_dict, edited, prose

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ 2
def plain_base(text):
    """Base spans by one loop per kind over the text."""
    out, letter = [], "[A-Za-z0-9+/_.=-]"
    word = "|".join("".join(f"[{c}{c.upper()}]" for c in w) for w in ("password", "passwd", "secret", "token"))
    api = "[aA][pP][iI]_?[kK][eE][yY]"
    at = 0
    while m := re.compile(f"(?:{word}|{api})[\"']? *[:=] *[\"']?({letter}+)").search(text, at):
        out += [(m.start(), 0, m.end(), "assign")] if m.end() - m.start(1) >= 8 else []
        at = m.end()
    for rank, kind, start, more, least in ((1, "access", "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16), (2, "hex", "", "0123456789abcdef", 32)):
        at = 0
        while at < len(text):
            end = at + len(start)
            if not text.startswith(start, at):
                at += 1
                continue
            while end < len(text) and text[end] in more:
                end += 1
            if end > at + len(start):
                out += [(at, rank, end, kind)] if end - at >= least else []
                at = end
            else:
                at += 1
    return sorted(out)


def test_base_spans_of_whole_table(spark):
    larger = "/root/testdata/sf0.01"                       # the smallest table holds no secret
    docs = spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in secret_scan.op2_secret_scan(spark, larger).collect()}
    found = 0
    for doc in docs:
        spans = plain_base(doc.text or "")
        found += len(spans)
        row, whole = got[doc.doc_id], ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        assert row.base_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(s[3] == k for s in spans) for k in ("assign", "access", "hex")]
        assert set(whole.split(",")) <= set(row.spans.split(","))
    assert found


@pytest.mark.parametrize("text,n", [
    ('s = "aB3dE5gH7jK9mN"\n' + "s = s + s\n" * 1000 + "password = s", 1),
    ('a = "aB3dE5gH7jK9mN"\nb = "Zx81kQp4mN7r"\n' + "a = max(a, b)\nb = min(a, b)\n" * 1000 + "token_secret = a", 2),
    ('s = "aB3dE5"\n' + "".join(f's = s + "x{i}Y"\n' for i in range(5000)) + "password = s", 5001),
    ("".join(f'password{i} = f(password{i - 1}, "aB3dE5gH{i}")\n' for i in range(5000)), 5001),
    ("x = " + "[" * 3000 + '"aB3dE5gH7jK9mN"' + "]" * 3000 + "\npassword = x", 1), ("password = (" * 3000, 0), ("'\"`" * 3000, 0),
])
def test_constants_take_linear_time(text, n):
    began = time.process_time()
    assert len(secret_scan.named_spans(text)) == n
    assert time.process_time() - began < 5


# ------------------------------------------------------------------ 3
@pytest.mark.parametrize("letters", [3, 8, 30, 500])
def test_words_with_equal_hashes_get_their_own_ids(monkeypatch, letters):
    """Equal hashes are forced: a word is only what its bytes say."""
    one, two = (("ab" * letters)[:letters] + end for end in "xy")
    encoder = tokens.Encoder(tokens.vocabulary_file())
    expected = [encoder.packed(ids) for ids in encoder.whole([one.encode(), two.encode()])]
    assert expected[0] != expected[1]
    monkeypatch.setattr(tokens, "word_hashes", lambda data, at, size: np.zeros(len(at), np.uint64))
    assert encoder.encode([one.encode(), two.encode()]) == expected          # in one batch
    assert [encoder.encode([w.encode()])[0] for w in (one, two, one)] == [*expected, expected[0]]


def thue_morse(n):
    bits = [0]
    while len(bits) < n:
        bits += [1 - b for b in bits]
    return bytes(97 + b for b in bits), bytes(98 - b for b in bits)


def test_words_that_polynomial_hashes_confuse():
    one, two = thue_morse(2048)
    encoder = tokens.Encoder(tokens.vocabulary_file())
    expected = [encoder.packed(ids) for ids in encoder.whole([one, two])]
    assert expected[0] != expected[1] and encoder.encode([one, two]) == expected
    assert [encoder.encode([w])[0] for w in (one, two, one)] == [*expected, expected[0]]


def test_long_keys_reach_no_path(spark):
    keys = ["k" * 500, "é" * 300, "a/b", "", None]
    df = spark.createDataFrame([(k, "some words") for k in keys], "doc_id string, text string")
    rows = corpus_pipeline.token_shards(spark, df, SF).collect()
    assert sorted((r.doc_id is not None, r.doc_id) for r in rows) == sorted((k is not None, k) for k in keys)


# ------------------------------------------------------------------ pipeline
def test_near_duplicates_drop_loses_no_text(spark):
    a, b = prose(1, 60), prose(2, 60)
    near = a + " end"
    rows = [(1, a), (5, a), (5, b), (None, b + " and a good deal more of it " + prose(3, 60)), (7, near), (7, near), (9, prose(4, 20)), (9, prose(4, 20)), (9, None), (9, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("copies", F.lit(1))
    out = neardup.drop_near_duplicates(df)
    assert out.columns == df.columns
    kept = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert kept == sorted([rows[0], rows[2], rows[3], rows[6], rows[8], rows[9]], key=str)


def test_one_row_stays_where_equal_keys_have_similar_texts(spark):
    a = prose(1, 200)
    df = spark.createDataFrame([(1, a), (1, a + " end"), (1, a + " fin"), (None, a + " last")], "doc_id long, text string")
    assert neardup.drop_near_duplicates(df).count() == 1


def as_tables(spark, path, rows):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_run_on_an_empty_table(spark, tmp_path):
    out = corpus_pipeline.run(spark, as_tables(spark, tmp_path, []))
    assert out.count() == 0 and out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_run_on_odd_rows(spark, tmp_path):
    good = [prose(s, 300) for s in range(6)]
    rows = [(1, good[0], "en", "a", 1), (5, good[0], "en", "a", 1), (5, good[1], "en", "a", 1), (None, good[2], None, None, None), (None, None, "en", "b", 0),
            (8, "", "en", "b", 0), (8, good[3], "en", "b", 9), (8, good[3], "en", "b", 9), (10, good[4], "en", None, 3), (11, edited(good[4], 3, 0.01), "en", "b", 3)]
    out = corpus_pipeline.run(spark, as_tables(spark, tmp_path, rows)).collect()
    kept = {None, 1, 5, 8, 10}                             # 5 by its second text; 11 repeats 10; the rest is too short
    assert {r.doc_id for r in out} <= kept
    ordered = sorted(out, key=lambda r: r.start)
    assert [r.start for r in ordered] == [sum(x.n_tokens for x in ordered[:i]) for i in range(len(ordered))]


def test_source_mix_writes_each_document_as_often_as_it_is_drawn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = corpus_pipeline.source_mix(spark, docs, SF)
    sizes = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    copies = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert max(copies.values()) <= 3
    taken, whole = {}, {}
    for doc, size in sizes.items():
        taken[source[doc]] = taken.get(source[doc], 0) + size * copies.get(doc, 0)
        whole[source[doc]] = whole.get(source[doc], 0) + size
    longest = {s: max(n for d, n in sizes.items() if source[d] == s) for s in whole}
    for name, target in brute.targets(whole).items():
        assert abs(taken[name] - target) <= longest[name]


# ------------------------------------------------------------------ 4
def test_archives_give_back_every_key_and_url(spark):
    from matchloom.llm import warc
    from matchloom.llm.common import scratch
    big = "<p>" + prose(3, 400)
    keys = ["a b", "a%20b", "u\n2", "u%0A2", "é ☃", "", None, "z", "z", "%"]
    urls = ["http://x/a b", "http://x/a%20b", "u\n2", None, "", "http://é/%", "u%0A2", "http://x/\x85 ", " ", "\x7f"]
    rows = [(k, u, big if i % 2 else f"<p>{i}") for i, (k, u) in enumerate(zip(keys, urls))]
    df = spark.createDataFrame(rows, "page_id string, url string, html string")
    path = scratch(spark, "warc")
    warc.write_archives(df, path)
    out = warc.read_records(warc.read_index(spark, path)).collect()
    assert sorted([(r.key, r.url) for r in out], key=str) == sorted(zip(keys, urls), key=str)
    shared = {(r.key, r.record_type, r.refers_to) for r in out if r.payload_bytes >= warc.MIN_SHARED}
    best = max(k for k, _, h in rows if h == big and k is not None)
    assert shared == {(k, *(("response", None) if k == best else ("revisit", best))) for k, _, h in rows if h == big}


def test_archives_of_no_page(spark):
    from matchloom.llm import warc
    from matchloom.llm.common import scratch
    path = scratch(spark, "warc")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_index(spark, path).count() == 0 and warc.read_records(warc.read_index(spark, path)).count() == 0


def test_pages_that_repeat_the_largest_key_are_all_responses(spark):
    from matchloom.llm import warc
    from matchloom.llm.common import scratch
    big, path = "x" * 1200, scratch(spark, "warc")
    warc.write_archives(spark.createDataFrame([(1, "a", big), (7, "b", big), (7, "c", big), (None, "d", big)], "page_id long, url string, html string"), path)
    out = {(r.url, r.record_type, r.refers_to) for r in warc.read_records(warc.read_index(spark, path)).collect()}
    assert out == {("a", "revisit", "7"), ("b", "response", None), ("c", "response", None), ("d", "revisit", "7")}


def test_ranges_are_read_by_as_many_tasks_as_their_bytes_ask_for(spark, monkeypatch):
    from matchloom.llm import warc
    from matchloom.llm.common import scratch
    path = scratch(spark, "warc")
    warc.write_archives(spark.read.parquet(f"{SF}/pages.parquet"), path)
    monkeypatch.setattr(warc, "RANGE_BYTES", 20_000)
    records = warc.read_records(warc.read_index(spark, path))
    size = warc.read_index(spark, path).agg(F.sum("length")).first()[0]
    assert records.rdd.getNumPartitions() == -(-size // 20_000) > 1
    assert records.count() == spark.read.parquet(f"{SF}/pages.parquet").count()


# ------------------------------------------------------------------ 10
def test_rows_without_words_are_drawn_as_often_as_their_source_at_most(spark):
    from matchloom.llm import mixing
    rows = [(i, "a" if i < 20 else "b", " " if i % 5 == 0 else prose(i, 30 if i < 20 else 400)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    mixed, targets = mixing.mix(df)
    assert {r.source: r.target / r["size"] for r in targets.collect()}["a"] == 3          # capped
    assert max(r.n for r in mixed.select(F.size("draws").alias("n")).collect()) == 3
    assert max(r["count"] for r in mixing.mixed_rows(df).groupBy("doc_id").count().collect()) == 3


def test_shards_are_a_parameter_and_follow_the_words(spark, monkeypatch):
    from matchloom.llm import mixing
    df = spark.read.parquet(f"{SF}/documents.parquet")
    shards = lambda mixed: mixed.select(F.explode("draws").alias("d")).select("d.shard").distinct().count()
    taken = lambda mixed: sorted((r.row.doc_id, r.n) for r in mixed.select("row", F.size("draws").alias("n")).collect())
    few, usual = mixing.mix(df, levels=2)[0], mixing.mix(df)[0]
    assert shards(few) == 4 and shards(usual) == 64 and taken(few) == taken(usual)
    monkeypatch.setattr(mixing, "SHARD_WORDS", 400)
    assert shards(mixing.mix(df)[0]) > 100


# ------------------------------------------------------------------ 9
def test_bands_reject_repetitive_texts_that_pass_the_base_rules(spark):
    """Made from documents that are labelled good: a sentence spun with every third word new, two fifths of repeated words, and symbols on every word."""
    from matchloom.llm import quality
    rng = __import__("random").Random(1)
    larger = "/root/testdata/sf0.01"
    good = spark.read.parquet(f"{larger}/labels.parquet").filter("quality = 1").select("doc_id")
    texts = [r.text for r in spark.read.parquet(f"{larger}/documents.parquet").join(good, "doc_id").orderBy("doc_id").collect() if 3000 < len(r.text) < 30_000][:40]
    rows, kinds = [], {"good": [], "spun": [], "repeated": [], "strewn": []}
    for text in texts:
        words = text.split()
        n, part = len(words), int(len(words) * 0.42)
        made = {"good": text, "spun": " ".join(rng.choice(words) if i % 3 == 0 else words[i % 9] for i in range(n)),
                "repeated": " ".join(words[:n - part] + (words[:12] * n)[:part]), "strewn": " ".join(w + rng.choice(["***", "%%%", "&&&", "$$$"]) for w in words)}
        for kind, body in made.items():
            kinds[kind].append(len(rows))
            rows.append((len(rows), body))
    got = {r.doc_id: r for r in quality.annotate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    share = {kind: sum(not got[i].kept for i in ids if not got[i].base_failed) / max(1, sum(not got[i].base_failed for i in ids)) for kind, ids in kinds.items()}
    assert share["good"] == 0 and share["spun"] == 1 and share["repeated"] > 0.95 and share["strewn"] > 0.2
    assert all(sum(not got[i].base_failed for i in ids) > 5 for ids in kinds.values())


def test_verdicts_agree_with_labels(spark):
    from matchloom.llm import quality
    larger = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    got = [r for r in quality.op9_quality_rules(spark, larger).collect() if r.doc_id in labels and not r.base_failed]
    good, poor = ([r for r in got if labels[r.doc_id] == q] for q in (1, 0))
    assert good and all(r.kept for r in good)
    assert any(not r.kept for r in poor)
