"""The ten operators and the pipeline on small cases, against brute force, SQL or a round trip."""

import base64
import hashlib
import random
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from matchloom.llm import (
    components, decontaminate, lines, mixing, mphash, neardup, quality, secret_scan, suffix_dedup, tokens, urlfilter, warc)
from matchloom.llm.common import scratch
from tests.llm import brute

SF = "/root/testdata/sf0.001"
WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliett kilo lima mike november oscar papa quebec romeo sierra tango".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(n))


def edited(text, seed, share):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("qrstuvwxyz", k=6)) if rng.random() < share else w for w in text.split(" "))


def corpus():
    base = prose(1, 120)
    texts = [base, base, base.upper(), None, "", "   \n\t", prose(2, 90), edited(base, 3, 0.03), edited(base, 4, 0.05), edited(base, 5, 0.15),
             prose(6, 30) + " " + " ".join(base.split()[20:70]) + "\n" + prose(7, 30), "one", "ONE", "one two", prose(8, 4000), "é" * 70 + " \U0001f600",
             " ".join(["same"] * 200), prose(9, 60) + "\n" + prose(10, 40), prose(11, 10) + "\n" + prose(10, 40) + "\n" + prose(12, 20)]
    return [(i, t, ["b", None, "a", "c"][i % 4]) for i, t in enumerate(texts)]


CLASHES = ["kept", "node", "doc", "words", "body", "block", "size", "key", "row", "measured", "gone", "bad"]


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with columns named as the operators name theirs inside."""
    df = spark.createDataFrame(corpus(), "doc_id long, text string, source string")
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def as_dict(df, key="doc_id"):
    return {r[key]: tuple(v for k, v in r.asDict().items() if k != key) for r in df.collect()}


def plain(rows):
    return [(i, t) for i, t, _ in rows]


# ------------------------------------------------------------------ 1
def test_suffix_dedup(docs, empty):
    out = suffix_dedup.RepeatedStrings(docs).remove().drop("kept")
    assert as_dict(out, "key") == brute.repeated_strings(plain(corpus()))
    assert suffix_dedup.RepeatedStrings(empty).remove().count() == 0


def test_suffix_dedup_oversized_groups(docs):
    split = suffix_dedup.RepeatedStrings(docs, group_bytes=0).remove().drop("kept")
    assert as_dict(split, "key") == brute.repeated_strings(plain(corpus()))


def test_suffix_dedup_null_key_and_repeats(spark):
    text = prose(3, 40)
    df = spark.createDataFrame([(None, text), (5, text), (5, text), (7, text + " more of it")], "doc_id long, text string")
    rows = sorted((r.key is None, r.key, r.n_removed) for r in suffix_dedup.RepeatedStrings(df).remove().collect())
    assert rows == [(False, 5, 0), (False, 5, 0), (False, 7, len(text)), (True, None, len(text))]


def test_suffix_dedup_one_passage_in_many_segments(spark):
    rng = random.Random(12)
    passage = "".join(rng.choices("abcdefgh ", k=140))
    rows = [(i, prose(100 + i, rng.randint(1, 9)) + passage[rng.randint(0, 20):140 - rng.randint(0, 20)] + prose(500 + i, 6)) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for group_bytes in (2000, 0):
        work = suffix_dedup.RepeatedStrings(df, group_bytes=group_bytes)
        assert as_dict(work.remove().drop("kept"), "key") == brute.repeated_strings(rows)
        work.release()


def test_suffix_dedup_long_and_periodic_texts(spark):
    long = prose(1, 30_000)
    rows = [(1, long), (2, "x " + long[5000:150_000]), (3, "ab" * 3000), (4, "q" + "ab" * 1500 + "z"), (5, "a" * 5000), (6, "a" * 70 + "b"), (7, long[-60:] + "ab" * 40)]
    assert len(long) > suffix_dedup.PIECE_BYTES
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for group_bytes in (suffix_dedup.GROUP_BYTES, 0):
        assert as_dict(suffix_dedup.RepeatedStrings(df, group_bytes=group_bytes).remove().drop("kept"), "key") == brute.repeated_strings(rows)


def test_suffix_dedup_many_documents_without_a_key(spark):
    texts = [prose(s, 30) for s in range(20)]
    df = spark.createDataFrame([(None, t) for t in texts + texts[:5]] + [(3, texts[7] + " and more")], "doc_id long, text string")
    work = suffix_dedup.RepeatedStrings(df)
    rows = {(r.key, r.n_bytes, r.n_removed) for r in work.remove().collect()}
    assert {r for r in rows if r[2]} == {(None, len(texts[7]), len(texts[7]))} and len(rows) > 15
    names, paths = [n for n, _ in work.tables], work.paths + [p for _, p in work.tables]
    assert names and paths
    work.release()
    assert not [p for p in paths if Path(p.removeprefix("file:")).exists()] and not any(spark.catalog.tableExists(n) for n in names)


@pytest.mark.parametrize("seed", range(6))
def test_merged_transforms_find_repeated_windows(seed):
    rng = random.Random(seed)
    strings = [bytes(rng.choices(b"ab" if seed % 2 else b"abcdefgh", k=rng.randint(50, 300))) for _ in range(9)]
    strings += [strings[0][:120] + b"zz" + strings[1][-60:], strings[2], b"a" * 200, b"a" * 90]
    orders = np.array([rng.randint(0, 6) for _ in strings])
    for shards in (1, 3, 20):
        got = suffix_dedup.repeated_windows(strings, orders, shards)
        assert [g.tolist() for g in got] == [x.tolist() for x in suffix_dedup._repeated_plainly(strings, orders)]


def test_merge_orders_suffixes_and_counts_common_prefixes():
    strings = [b"banana", b"bandana", b"ananas"]
    data = np.frombuffer(b"\x00".join(strings) + b"\x00", np.uint8)
    ends = np.cumsum([len(s) + 1 for s in strings]) - 1
    shards = [suffix_dedup.ShardBwt(data[a:b + 1], np.array([b - a])) for a, b in zip([0, *(ends[:-1] + 1)], ends)]
    rows, common = suffix_dedup.merge_shards(shards, 6)
    place = np.concatenate([s.rows + o for s, o in zip(shards, [0, *(ends[:-1] + 1)])])[rows]
    cut = [(bytes(data[p:]) + b"\x00")[:6].split(b"\x00")[0] for p in place]
    assert cut == sorted(cut)
    shared = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    for before, own, n in zip(cut, cut[1:], common[1:]):
        assert n >= shared(before, own)


# ------------------------------------------------------------------ 2
SECRETS = [
    ('x = "aB3dE5gH7jK9mN"\nother = x\ndb_password = other\n', ["aB3dE5gH7jK9mN"]),
    ('config["dbPassword"] = "hunter2hunter2!"', ["hunter2hunter2!"]),
    ("<secretKey>Zk39fj20dKs9</secretKey>", ["Zk39fj20dKs9"]),
    ("run --auth-token abcDEF123456 now", ["abcDEF123456"]),
    ('a = "abcd1234"\nb = "EFGH5678"\nsecret_key = a + b', ["abcd1234", "EFGH5678"]),
    ("password_length = 12345678", []), ('public_key = "abcDEF123456xyz"', []), ('db_password = "${DB_PASSWORD}"', []),
    ('password = decode("Zx81kQp4mN7r")', ["Zx81kQp4mN7r"]), ('password = new String("Zx81kQp4mN7r")', ["Zx81kQp4mN7r"]),
    ('tokens = 1\ntoken = ["aB3dE5gH7jK9",\n  "cD4eF6gH8iJ0"]\nother = "zY9xW8vU7tS6"', ["aB3dE5gH7jK9", "cD4eF6gH8iJ0"]),
    ('x = ["aB3dE5gH7jK9", "changeme"]\nsecret = f(x)', ["aB3dE5gH7jK9"]), ('token = ("aB3dE5gH7jK9"', ["aB3dE5gH7jK9"]),
    ("the token is: nothing more to say. key points are: first things", []), ("", []),
]


@pytest.mark.parametrize("text,found", SECRETS)
def test_named_secrets(text, found):
    assert [text[a:b] for a, b in secret_scan.named_spans(text)] == found


@pytest.mark.parametrize("name", [n for n, weight in secret_scan.NAME_PARTS.items() if weight >= 2] + ["stripe_api", "ENCRYPTION", "access_api"])
def test_scan_sees_every_sensitive_name(name):
    text = f'{name} = "Zx81.kQp4!mN7rT2vW"'
    assert secret_scan.named_spans(text) == [(len(name) + 4, len(text) - 1)]
    counts = secret_scan.scan(text)
    assert counts[5] == 1 or counts[0] == 1                # found by its name, or inside a base span already


def test_base_secrets(spark, empty):
    text = "é API_key: 'abcd1234' AKIA1234567890ABCD AKIAshort " + "0f" * 20 + " token=short \u017fecret=abcdefgh9"
    expected = [(2, 21, "assign"), (23, 41, "access"), (52, 92, "hex")]
    spans = [s for s in secret_scan.base_spans(text)]
    assert [(text[a:b], k) for a, b, k in spans] == [("API_key: 'abcd1234", "assign"), ("AKIA1234567890ABCD", "access"), ("0f" * 20, "hex")]
    df = spark.createDataFrame([(1, text), (1, text), (2, None), (3, "")], "doc_id long, text string")
    rows = secret_scan.find_secrets(df).orderBy("doc_id").collect()
    whole = ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans))
    assert len(expected) == len(spans) and rows[0].base_sha256 == hashlib.sha256(whole.encode()).hexdigest() and rows[0] == rows[1]
    assert (rows[2].n_assign, rows[2].spans, rows[2].base_sha256) == (0, "", hashlib.sha256(b"").hexdigest())
    assert secret_scan.find_secrets(empty).count() == 0


# ------------------------------------------------------------------ 3
def test_token_shards(spark, docs, empty):
    model = Tokenizer.from_file(tokens.vocabulary_file())
    out = as_dict(tokens.encode_documents(docs, scratch(spark, "t")))
    start = 0
    for i, text in plain(corpus()):
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        assert out[i] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert tokens.encode_documents(empty, scratch(spark, "t")).count() == 0


def test_token_shards_keyed_access(spark):
    df = spark.createDataFrame([(4, prose(1, 50)), (2, "zwei"), (4, prose(1, 50)), (None, "none"), (9, None)], "doc_id long, text string")
    path = scratch(spark, "t")
    tokens.write_shards(df.coalesce(1), path, shard_bytes=64)
    model = Tokenizer.from_file(tokens.vocabulary_file())
    files = [r.path for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    assert len(files) > 1
    found = {}
    for file in files:
        shard = tokens.open_shard(file)
        for key in (("4", 0), ("4", 1), ("2", 0), (None, 0), ("9", 0), ("5", 0)):
            first, count = shard.find([tokens.entry_key(*key)])[0]
            if first >= 0:
                found[key] = shard.ids_at(first, count).tolist()
    assert found == {(str(k) if k else None, n): [*model.encode(t, add_special_tokens=False).ids, 1] for k, n, t in
                     ((4, 0, prose(1, 50)), (4, 1, prose(1, 50)), (2, 0, "zwei"), (None, 0, "none"), (9, 0, ""))}


def test_encoder_equals_whole_texts():
    texts = ["Σας ΟΔΟΣ. don't can't's 'tis İstanbul, İ. e\u0301t\u0301. ÀÉ!!", "<|endoftext|> a<|startoftext|>b. <|ENDOFTEXT|>,", "x\x1cy\x85z\u00a0w\u3000q", "",
             "１２３ 4½ ②x. a.b,c; (foo). «bar». ﬁn. ǅ Ǆ. 가 क़.", "a" * 300 + " " + "B" * 70 + "."]
    encoder = tokens.Encoder(tokens.vocabulary_file())
    for _ in range(2):
        got = encoder.encode([t.encode() for t in texts])
        assert got == [encoder.packed(encoder.model.encode(t, add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_minimal_perfect_hash(n):
    hashes = mphash.key_hashes([str(i).encode() for i in range(n)])
    mph = mphash.MinimalPerfectHash.build(hashes)
    assert sorted(mph.slots(hashes)) == list(range(n))
    assert (mphash.MinimalPerfectHash.from_bytes(mph.to_bytes()).slots(hashes) == mph.slots(hashes)).all()


# ------------------------------------------------------------------ 4
def pages(spark):
    body = prose(5, 300)
    rows = [(1, "http://a", body), (2, None, body), (9, "http://b\r\nX: y", body), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", "é" * 600)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))


def test_warc_round_trip(spark):
    path, table_ = scratch(spark, "w"), pages(spark)
    warc.write_archives(table_, path, archive_bytes=200)
    index = warc.read_index(spark, path)
    read = {r.key: r for r in warc.read_records(index).collect()}
    for r in table_.collect():
        raw = (r.html or "").encode()
        got = read[str(r.page_id)]
        revisit = r.page_id in (1, 2)
        assert (got.record_type, got.refers_to, got.payload_bytes) == (("revisit", "9") if revisit else ("response", None)) + (len(raw),)
        assert got.payload_digest == hashlib.sha1(raw).hexdigest() and (got.payload is None if revisit else bytes(got.payload) == raw)
    some = warc.read_records(index.filter("key IN ('4', '7')")).collect()
    assert sorted(r.key for r in some) == ["4", "7"]


def test_warc_coalesces_ranges(spark):
    rows = [("f", i * 100, 100) for i in range(10)] + [("f", 5000, 50), ("g", 0, 10)]
    index = spark.createDataFrame(rows, "file string, offset long, length long")
    got = sorted((r.file, r.start, r.size, len(r.records)) for r in warc.ranges(index, range_bytes=1 << 20, gap_bytes=10).collect())
    assert got == [("f", 0, 1000, 10), ("f", 5000, 50, 1), ("g", 0, 10, 1)]


# ------------------------------------------------------------------ 5
URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x", "http://example.com/en/", "http://a.b.example.com/fr/?q=/en/", "http://notexample.net/es/a",
        "http://x.net/es", "http://net/fr/#a", "ftp://u@h.com:80/a", "http://example.com", "http://example.com/en/", "x://y://z.com/", "http://m.www.example.com/en/a/b/c"]


def test_url_filter_equals_sql(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("host", F.lit("clash"))
    rules = spark.createDataFrame(urlfilter.RULES, "verdict string, host string, path string")
    got = urlfilter.judge(df, rules).select("row.page_id", F.col("host"), "path", "rule", "verdict").toPandas().sort_values("page_id")
    pages = df.select("page_id", "url").toPandas()  # noqa: F841
    want = duckdb.sql(urlfilter.SQL).df().sort_values("page_id")
    assert got.astype(object).where(got.notna(), None).values.tolist() == want.astype(object).where(want.notna(), None).values.tolist()
    assert urlfilter.judge(df, rules.limit(0)).filter("verdict = 'allow' AND rule IS NULL").count() == len(URLS)
    assert urlfilter.judge(df.limit(0), rules).count() == 0


def test_url_rule_inside_a_segment(spark):
    rules = spark.createDataFrame([("block", "com", "/ab"), ("allow", "COM", "/abc/d")], "verdict string, host string, path string")
    urls = spark.createDataFrame([(1, "h://x.com/abd"), (2, "h://x.com/abc/de"), (3, "h://x.com/a")], "page_id long, url string")
    assert as_dict(urlfilter.judge(urls, rules).select("row.page_id", "verdict"), "page_id") == {1: ("block",), 2: ("allow",), 3: ("allow",)}


# ------------------------------------------------------------------ 6
def test_line_dedup(docs, empty):
    got = as_dict(lines.LineDuplicates(docs).cleaned().select("key", "kept"), "key")
    assert {k: v[0] for k, v in got.items()} == brute.kept_lines(plain(corpus()))
    assert lines.LineDuplicates(empty).cleaned().count() == 0


def test_line_dedup_finds_every_link_at_the_threshold(spark):
    rng = random.Random(5)
    letters = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    bases = [letters(104) for _ in range(4000)]
    rows = [(i, base + "\n" + base[:93] + letters(11)) for i, base in enumerate(bases)]     # 89 shingles in 111
    out = lines.LineDuplicates(spark.createDataFrame(rows, "doc_id long, text string")).cleaned()
    assert [r.key for r in out.filter("n_dropped <> 1").collect()] == []


def test_line_buckets_hand_on_every_pair_of_few_and_every_node_of_many():
    sizes = {-9: 1, -2: 2, 0: 40, 3: 3, 4: lines.FEW, 7: lines.FEW + 1, 8: 1}
    rows = [(bucket, 100 + n) for bucket, size in sizes.items() for n in range(size)]
    few = {(b, 100 + y, 100 + x, False) for b, size in sizes.items() if size <= lines.FEW for y in range(size) for x in range(y)}
    many = {(b, 100 + y, 100, True) for b, size in sizes.items() if size > lines.FEW for y in range(1, size)}
    for width in (1, 4, 7, 1000):                          # whatever batches the rows arrive in
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i:i + width])], ["bucket", "node"])
                   for i in range(0, len(rows), width)]
        out = [tuple(r.values()) for b in lines._bucket_pairs(iter(batches)) for r in b.to_pylist()]
        assert len(out) == len(set(out)) and set(out) == few | many
    assert list(lines._bucket_pairs(iter([]))) == []


def test_line_signature_takes_at_most_160_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array([b"x"]), pa.array([1]), pa.array(["a line of text"])], ["digest", "doc", "body"])
    [out] = lines._line_sketch(iter([batch]))
    assert len(out.column("minima")[0].as_py()) <= 160


# ------------------------------------------------------------------ 7
def test_decontamination(spark, docs, empty):
    base = corpus()[0][1].split()
    items = [(1, " ".join(base[30:50])), (2, None), (3, ""), (4, "one"), (10, "One, two!"), (5, " ".join(base[5:12])), (6, "..."), (7, " ".join(base[30:50]))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("window", F.lit(1))
    got = decontaminate.measure(docs, bench)
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    out = as_dict(got.select("doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join(names, ","), 256), "contaminated"))
    expected = brute.contamination(plain(corpus()), items)
    assert out == expected
    clean = decontaminate.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {i for i, v in expected.items() if not v[-1]}
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == docs.count()
    assert decontaminate.measure(empty, bench).count() == 0


# ------------------------------------------------------------------ 8
@pytest.mark.parametrize("span", [2, 5])
def test_near_duplicates(docs, span):
    assert as_dict(neardup.near_duplicates(docs, span)) == brute.near_duplicates(plain(corpus()), span)


def test_near_duplicates_large_cloud_in_blocks(spark, monkeypatch):
    base = prose(1, 80)
    rows = [(i, edited(base, i, (i % 12) / 100)) for i in range(150)] + [(200 + i, prose(i, 80)) for i in range(20)]
    monkeypatch.setattr(neardup, "CELL_BYTES", 20_000)
    monkeypatch.setattr(neardup, "CELL_NODES", 16)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_dict(neardup.near_duplicates(df, 2)) == brute.near_duplicates(rows, 2)


def test_near_duplicates_drop(spark, docs, empty):
    kept = neardup.drop_near_duplicates(docs, 2)
    want = {i for i, v in brute.near_duplicates(plain(corpus()), 2).items() if v[2]}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == want
    assert neardup.near_duplicates(empty).count() == 0


def test_posterior_limits_keep_threshold_pairs():
    limits = neardup.least_matches(0.8)
    assert [n for n, _ in limits] == [32, 64, 96, 128] and all(need < 0.8 * n for n, need in limits)
    rng = np.random.default_rng(0)
    left = rng.integers(0, 1 << 32, (2000, neardup.MINIMA), dtype=np.uint32)
    right = np.where(rng.random(left.shape) < 0.8, left, left + np.uint32(1))
    assert len(neardup.surviving(left, right, limits)) == 2000
    far = np.where(rng.random(left.shape) < 0.3, left, left + np.uint32(1))
    assert len(neardup.surviving(left, far, limits)) == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)] + [(5, 5)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert got == brute.groups(nodes, [e for e in edges if e[0] != e[1]])
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------ 9
def test_quality(docs, empty):
    got = as_dict(quality.annotate(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
    assert got == {i: brute.quality(t) for i, t in plain(corpus())}
    kept = quality.filter_quality(docs)
    assert kept.columns == docs.columns and 0 in {r.doc_id for r in kept.collect()}
    assert quality.annotate(empty).count() == 0


def test_quality_bands():
    pack = zstandard.ZstdCompressor(level=3)
    rng = random.Random(1)
    noise = " ".join("".join(chr(33 + rng.randrange(94)) for _ in range(40)) for _ in range(200)).encode()
    loop = (" ".join(WORDS) + "\n").encode() * 400
    half = prose(1, 3000).encode() + b"\n" + " ".join(f"{w}{i % 7}" for i in range(6000) for w in WORDS[i % 3:i % 3 + 1]).encode()
    assert [quality.judge(t, pack)[6] for t in (noise, loop, half, prose(2, 400).encode(), b"")] == [False, False, False, True, False]


def encoded(seed, n):
    blob = base64.b64encode(random.Random(seed).randbytes(n)).decode()
    return "\n".join(blob[i:i + 76] for i in range(0, len(blob), 76)).encode()[:n]


def test_quality_rejects_base64_and_keys():
    pack = zstandard.ZstdCompressor(level=3)
    rng = random.Random(1)
    keys = " ".join("".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=12)) for _ in range(600)).encode()
    half = prose(1, 8000).encode()[:50_000] + b"\n" + encoded(2, 50_000)
    texts = [encoded(1, 5000), encoded(1, 8000), keys[:1000], keys[:1900], keys[:4096], keys, half]
    assert [quality.judge(t, pack)[6] for t in texts] == [False] * len(texts)
    assert quality.judge(half[:50_000], pack)[6]


def test_quality_judges_the_last_chunk():
    pack = zstandard.ZstdCompressor(level=3)
    rng = random.Random(1)
    noise = " ".join("".join(chr(33 + rng.randrange(94)) for _ in range(40)) for _ in range(100)).encode()[:4000]
    clean = prose(1, 3000).encode()
    got = [quality.judge(t, pack) for t in (clean[:4096] + noise, clean[:4096] + b"again and " * 400, clean[:8096], clean[:4196])]
    assert [r[6] for r in got] == [False, False, True, True] and [r[10] for r in got] == [4000, 4000, 0, 0]


# ------------------------------------------------------------------ 10
def test_mixing(spark, docs, empty):
    rows = [(i, prose(i, 5 + i % 60), ["x", "y", "z", None, "w"][min(i % 9, 4)]) for i in range(800)] + [(1000, None, "zero"), (1, prose(1, 6), "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed, _ = mixing.mix(df)
    out = mixed.select("row.doc_id", "row.source", "size", "source_size", "target", F.size("draws").alias("n"), "draws").collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = brute.targets(sizes)
    taken = {}
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 and r.n <= 3
        taken[r.source] = taken.get(r.source, 0) + r.size * r.n
    assert len(out) == len(rows) and all(abs(taken[s] - want[s]) <= 0.02 * want[s] + 60 for s in want)
    again = mixing.mix(df)[0].select("row.doc_id", "draws")
    assert sorted(map(str, again.collect())) == sorted(map(str, mixed.select("row.doc_id", "draws").collect()))
    assert mixing.mix(empty)[0].count() == 0
    assert mixing.mixed_rows(docs).columns == docs.columns


def test_splitting_tree_keeps_quotas_and_balances_shards(spark):
    quotas = {"a": 500, "b": 130, None: 10}
    leaves = mixing.split_quotas(spark.createDataFrame(list(quotas.items()), "source string, quota long"), levels=3).collect()
    for s, q in quotas.items():
        assert sum(r.quota for r in leaves if r.source == s) == q
    per_shard = [sum(r.quota for r in leaves if r.shard == n) for n in range(8)]
    assert max(per_shard) - min(per_shard) <= 1


# ------------------------------------------------------------------ pipeline
def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        docs = stage(spark, docs, SF).persist()
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "quality rules":
            pack = zstandard.ZstdCompressor(level=3)
            assert ids == {i for i, t in before if quality.judge(t.encode(), pack)[6]}
        elif name == "near-duplicates":
            assert ids == {i for i, v in brute.near_duplicates(before, 5).items() if v[2]}
        elif name == "decontamination":
            assert ids == {i for i, v in brute.contamination(before, bench).items() if not v[-1]}
        elif name == "token shards":
            assert docs.count() == len(before) and docs.columns[0] == "doc_id"
        if name != "token shards":
            assert docs.columns == names
