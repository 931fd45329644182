"""Benchmark decontamination by winnowing.

Every window of 13 words keeps the smallest hash of its 6-word grams. Two texts that share 13 words in a row
share that fingerprint, so joining fingerprints of documents and benchmark items misses no shared window. Windows
whose fingerprint is found are then compared word for word, and hits are extended to all the words they cover.
An item of fewer than 13 words is one window of its own length, fingerprinted the same way.

Only DataFrame operations. The documents' texts are shuffled once, to meet the few fingerprints found in them.

Defined results: null or blank text has no words, no hits and is clean. Rows that repeat both key and text give
one verdict; the filter keeps or drops all of them. An empty benchmark leaves every document clean.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from matchloom.llm.common import broadcast_if_small, fold_ascii, fresh, let, split_words, table

SPAN, GRAM = 13, 6
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHARE = 20                 # contaminated from one word in SHARE


def item_words(text: Column) -> Column:
    return split_words(fold_ascii(text), SEPARATORS)


def starts(words: Column, span: Column | int) -> Column:
    """1-based positions at which ``span`` words begin; none in a shorter text."""
    last = F.size(words) - span + 1
    return F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def winnow(words: Column, span: int) -> Column:
    """The fingerprint of every window of ``span`` words: the smallest hash of its grams, one per start."""
    gram = min(GRAM, span)

    def lowest(w: Column) -> Column:
        grams = F.transform(starts(w, gram), lambda i: F.xxhash64(F.slice(w, i, gram)))
        return let(grams, lambda g: F.transform(starts(w, span), lambda i: F.array_min(F.slice(g, i, span - gram + 1))))

    return let(words, lowest)


def item_windows(items: DataFrame, key: str, text: str) -> DataFrame:
    """(span, window, items): each distinct window of the benchmark and the sorted keys of its items."""
    words = items.select(F.col(key).alias("item"), item_words(F.col(text)).alias("words")).filter(F.size("words") > 0)
    spans = words.withColumn("span", F.least(F.lit(SPAN), F.size("words")))
    return (spans.withColumn("at", F.explode(starts(F.col("words"), F.col("span"))))
            .select("span", F.array_join(F.slice("words", F.col("at"), F.col("span")), " ").alias("window"), "item")
            .groupBy("span", "window").agg(F.collect_set("item").alias("items")))


def measure(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
            item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, text_hash, n_words, n_hit, items, contaminated) per distinct document row."""
    windows = item_windows(items, item_key, item_text)
    lengths = sorted(r.span for r in windows.select("span").distinct().collect()) or [SPAN]      # at most SPAN values
    split = windows.withColumn("words", F.split("window", " "))
    prints = None
    for span in lengths:
        own = split.filter(F.col("span") == span).select("span", winnow(F.col("words"), span)[0].alias("print")).distinct()
        prints = own if prints is None else prints.unionByName(own)
    prints = broadcast_if_small(prints)
    windows = broadcast_if_small(windows)

    keyed = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("body"))

    def shown_prints(words: Column) -> Column:
        return F.flatten(F.array(*[F.transform(F.array_distinct(winnow(words, span)), _tagged(span)) for span in lengths]))

    shown = (keyed.select("key", "text_hash", F.explode(let(item_words(F.col("body")), shown_prints)).alias("seen"))
             .select("key", "text_hash", "seen.span", "seen.print"))
    found = (shown.join(prints, ["span", "print"]).groupBy("key", "text_hash")
             .agg(F.collect_set(F.struct("span", "print")).alias("found"))
             .select(F.col("key").alias("of"), F.col("text_hash").alias("of_hash"), "found"))

    met = (keyed.join(found, F.col("key").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash")), "left"))

    def spots(words: Column) -> Column:
        at = F.flatten(F.array(*[_spots(words, F.col("found"), span) for span in lengths]))
        return F.struct(F.size(words).cast("long").alias("n_words"), F.when(F.col("found").isNotNull(), at).alias("spots"))

    tried = (met.select("key", "text_hash", let(item_words(F.col("body")), spots).alias("read"))
             .select("key", "text_hash", "read.n_words", F.explode_outer("read.spots").alias("spot")))
    hits = tried.select("key", "text_hash", "n_words", "spot.*").join(windows, ["span", "window"], "left")
    covered = F.aggregate(
        F.array_sort("hits"), F.struct(F.lit(1).alias("next"), F.lit(0).alias("words")),
        lambda seen, h: F.struct(F.greatest(seen["next"], h["at"] + h["span"]).alias("next"),
                                 (seen["words"] + F.greatest(F.lit(0), h["at"] + h["span"] - F.greatest(seen["next"], h["at"]))).alias("words")),
        lambda seen: seen["words"]).cast("long")
    return (hits.groupBy("key", "text_hash", "n_words")
            .agg(F.collect_set(F.when(F.col("items").isNotNull(), F.struct("at", "span"))).alias("hits"),
                 F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
            .select(F.col("key").alias(key), "text_hash", "n_words", covered.alias("n_hit"), "items")
            .withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))))


def _tagged(span: int):
    return lambda p: F.struct(F.lit(span).alias("span"), p.alias("print"))


def _spots(words: Column, found: Column, span: int) -> Column:
    """Windows of a document whose fingerprint was found, with their words."""
    wanted = F.transform(F.filter(found, lambda f: f["span"] == span), lambda f: f["print"])
    prints = F.transform(winnow(words, span), lambda p, i: F.struct((i + 1).alias("at"), p.alias("print")))
    seen = let(wanted, lambda known: F.filter(prints, lambda s: F.array_contains(known, s["print"])))
    return F.transform(seen, lambda s: F.struct(
        F.lit(span).alias("span"), s["at"].alias("at"), F.array_join(F.slice(words, s["at"], span), " ").alias("window")))


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows that are clean, with their columns as they were."""
    bad, bad_hash = fresh(docs, "bad", "bad_hash")
    dirty = (measure(docs, items, key, text).filter("contaminated")
             .select(F.col(key).alias(bad), F.col("text_hash").alias(bad_hash)))
    return docs.join(dirty, F.col(key).eqNullSafe(F.col(bad)) & (F.xxhash64(F.col(text)) == F.col(bad_hash)), "left_anti")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = measure(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), "contaminated")


_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least({SPAN}, len(w)) AS m FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS k
        FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM b)),
spans AS (SELECT DISTINCT m FROM win),
dw AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS k
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, spans WHERE len(w) >= m)),
hits AS (SELECT doc_id, i, m, item_id FROM dw JOIN win USING (m, k)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, i, m FROM hits)) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

QUERIES = {"op7_decontaminate": (op7_decontaminate, SQL)}
