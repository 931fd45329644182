"""Registered queries: text functions and profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from matchloom.functions import text as T
from matchloom.operators import profile as P
from matchloom.operators.joins import fits_broadcast
from matchloom.plans import roles as R, sql as S

C = F.col


def normalize_products(spark, sf):
    return R.orders(spark, sf).select("query_id", T.normalise(C("text")).alias("norm"))


def normalize_articles(spark, sf):
    return R.articles(spark, sf).select("doc_id", T.normalise(C("name")).alias("norm"))


def fold_text(spark, sf):
    return R.articles(spark, sf).select("doc_id", T.fold_accents(C("name")).alias("folded"))


def build_document(spark, sf):
    return R.catalog_texts(R.products(spark, sf), True)


def text_predicates(spark, sf):
    return R.articles(spark, sf).select(
        "doc_id", T.has_accent(C("name")).alias("accent"), T.is_upper(C("name")).alias("upper"),
        F.char_length("name").cast("long").alias("chars"), T.token_count(C("name")).cast("long").alias("tokens"),
        T.first_word(C("name")).alias("first_word"))


GRAMMARS = (("alnum", T.TOKENS_ALNUM), ("letters", T.TOKENS_LETTERS), ("lower", T.TOKENS_LOWER))


def token_grammars(spark, sf):
    return _token_counts(R.articles(spark, sf))


def _token_counts(articles):
    """Tokens of a row are counted where it is read, and only numbers are shuffled. The tokens of an id that stands in several rows
    are counted again, one by one, as the same token may stand in more than one of them."""
    lists = F.array(*[F.struct(F.lit(label).alias("grammar"), T.tokens(C("name"), g).alias("found")) for label, g in GRAMMARS])
    rows = articles.select("doc_id", F.inline(lists))
    single = (rows.select("doc_id", "grammar", F.size("found").alias("tokens"), F.size(F.array_distinct("found")).alias("distinct_tokens"))
              .groupBy("doc_id", "grammar").agg(F.count(F.lit(1)).alias("rows"), F.sum("tokens").alias("tokens"),
                                                F.max("distinct_tokens").cast("long").alias("distinct_tokens"))
              .filter("rows = 1 AND tokens > 0").drop("rows"))
    ids = articles.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select(C("doc_id").alias("again"))
    ids = F.broadcast(ids) if fits_broadcast(ids) else ids
    again = (rows.join(ids, C("doc_id").eqNullSafe(C("again")), "left_semi").select("doc_id", "grammar", F.explode("found").alias("token"))
             .groupBy("doc_id", "grammar").agg(F.count(F.lit(1)).alias("tokens"), F.countDistinct("token").alias("distinct_tokens")))
    return single.unionByName(again)


def base_names(spark, sf):
    return R.products(spark, sf).select("doc_id", T.base_name(C("name")).alias("base"))


def prefixed_texts(spark, sf):
    kinds = F.explode(F.array(F.lit("raw"), F.lit("normalised"))).alias("kind")
    asked = R.orders(spark, sf).select("query_id", "text", kinds)
    return asked.select("query_id", "kind", T.with_prefix(T.text_kind(C("text"), C("kind")), "query: ").alias("text"))


def null_profile(spark, sf):
    return (P.null_profile(R.products(spark, sf), "products")
            .unionByName(P.null_profile(R.orders(spark, sf), "orders"))
            .unionByName(P.null_profile(R.table(spark, sf, "labels"), "labels")))


def distinct_dups(spark, sf):
    return P.distinct_counts(R.articles(spark, sf), "name").withColumn("column_name", F.lit("article")).unionByName(
        P.distinct_counts(R.products(spark, sf), "name").withColumn("column_name", F.lit("product"))).unionByName(
        P.distinct_counts(R.requests_seen(spark, sf), "text").withColumn("column_name", F.lit("request")))


def duplicate_groups(spark, sf):
    return P.shared_values(R.products(spark, sf), "name", "doc_id")


def duplicate_groups_first(spark, sf):
    return P.shared_values(R.products(spark, sf), "name", "doc_id", 5)


def frequent_texts(spark, sf):
    return P.top_values(R.articles(spark, sf), "name", 5)


def brand_counts(spark, sf):
    return P.top_values(R.products(spark, sf), "brand", 20)


def category_top(spark, sf):
    return P.category_counts(R.articles(spark, sf), "name", 25)


def set_overlap(spark, sf):
    names = R.table(spark, sf, "benchmark").select("text")
    return P.overlap_count(R.table(spark, sf, "documents").select("text"), names, "text").withColumn(
        "pair", F.lit("article and passage")).unionByName(
        P.overlap_count(R.orders(spark, sf).select(F.lower("text").alias("text")),
                        R.products(spark, sf).select(F.lower("name").alias("text")), "text")
        .withColumn("pair", F.lit("order and product")))


def reference_check(spark, sf):
    return P.reference_check(R.table(spark, sf, "labels"), "doc_id", R.articles(spark, sf), "doc_id").withColumn(
        "refs", F.lit("labels")).unionByName(
        P.reference_check(R.articles(spark, sf), "doc_id", R.table(spark, sf, "labels"), "doc_id").withColumn(
            "refs", F.lit("articles")))


def missing_references(spark, sf):
    return P.missing_references(R.articles(spark, sf).select("doc_id", "brand"), "doc_id",
                                R.table(spark, sf, "labels"), "doc_id")


def length_stats(spark, sf):
    return (P.length_stats(R.articles(spark, sf), "name", "articles")
            .unionByName(P.length_stats(R.orders(spark, sf), "text", "orders"))
            .unionByName(P.length_stats(R.requests_seen(spark, sf), "text", "requests")))


def token_histogram(spark, sf):
    return P.token_histogram(R.requests_seen(spark, sf), "text")


def case_and_accents(spark, sf):
    return P.case_and_accents(R.articles(spark, sf), "name", "articles").unionByName(
        P.case_and_accents(R.requests_seen(spark, sf), "text", "requests"))


def pattern_shares(spark, sf):
    both = R.orders(spark, sf).select("text").unionByName(R.articles(spark, sf).select(C("name").alias("text")))
    return P.pattern_shares(both, "text")


def token_freq(spark, sf):
    return P.top_tokens(R.articles(spark, sf), "name", 30).withColumn("side", F.lit("catalog")).unionByName(
        P.top_tokens(R.requests_seen(spark, sf), "text", 30).withColumn("side", F.lit("requests")))


def short_texts(spark, sf):
    docs = R.articles(spark, sf)
    return P.share_of(docs, T.token_count(C("name")) <= 2)


def short_examples(spark, sf):
    return P.short_texts(R.articles(spark, sf), "name").orderBy("doc_id").limit(10).select("doc_id", "name")


def variant_groups(spark, sf):
    return P.variant_groups(R.products(spark, sf), "name", "doc_id", 8)


def variant_totals(spark, sf):
    return P.variant_totals(R.products(spark, sf), "name")


def vocabulary_coverage(spark, sf):
    words = P.vocabulary(R.articles(spark, sf), ["name"], T.TOKENS_ALNUM)
    return P.coverage(R.requests_seen(spark, sf), "query_id", "text", words).select("query_id", "coverage")


def low_coverage(spark, sf):
    words = P.vocabulary(R.products(spark, sf), ["name"], T.TOKENS_ALNUM)
    covered = P.coverage(R.requests_seen(spark, sf), "query_id", "text", words)
    return P.share_of(covered, C("coverage") <= P.LOW_COVERAGE)


def low_coverage_examples(spark, sf):
    words = P.vocabulary(R.products(spark, sf), ["name"], T.TOKENS_ALNUM)
    covered = P.coverage(R.requests_seen(spark, sf), "query_id", "text", words)
    return covered.filter(C("coverage") <= P.LOW_COVERAGE).orderBy("query_id").limit(12)


def seeded_sample(spark, sf):
    return P.seeded_sample(R.requests_seen(spark, sf), "query_id", "42", 15)


_ALNUM, _LETTERS, _LOWER = T.TOKENS_ALNUM, T.TOKENS_LETTERS, T.TOKENS_LOWER
_SPREAD = "round(avg(CASE WHEN {} THEN 1.0 ELSE 0.0 END), 6)"


def _nulls(table: str, src: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS rows, {len(cols)}::BIGINT AS columns, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM ({src})" for c in cols)


def _lengths(label: str, src: str, c: str) -> str:
    cols = []
    for name, e in (("chars", f"length({c})"), ("tokens", S.token_count(c))):
        cols.append(f"round(avg({e}), 6) AS {name}_mean, median({e})::DOUBLE AS {name}_median, "
                    f"min({e})::BIGINT AS {name}_min, max({e})::BIGINT AS {name}_max")
    return f"SELECT '{label}' AS label, {', '.join(cols)} FROM ({src})"


def _coverage(catalog: str) -> str:
    return f"""WITH v AS (SELECT DISTINCT unnest(regexp_extract_all(lower(name), '{_ALNUM}')) AS token FROM ({catalog})),
 u AS (SELECT query_id, text, unnest(regexp_extract_all(lower(text), '{_LETTERS}')) AS token FROM ({S.REQUESTS_SEEN})),
 k AS (SELECT query_id, avg(CASE WHEN v.token IS NULL THEN 0.0 ELSE 1.0 END) AS share FROM u LEFT JOIN v USING (token)
  WHERE length(u.token) > 2 GROUP BY query_id),
 c AS (SELECT q.query_id, q.text, round(coalesce(share, 1.0), 6) AS coverage
  FROM ({S.REQUESTS_SEEN}) q LEFT JOIN k USING (query_id)) """


def _shared(limit: str) -> str:
    return (f"WITH p AS ({S.PRODUCTS}), g AS (SELECT name, count(*) AS group_size FROM p GROUP BY name "
            f"HAVING count(*) > 1 {limit}) SELECT p.name, p.doc_id, g.group_size FROM p JOIN g USING (name)")


def _tops(src: str, e: str, out: str, k: int) -> str:
    return (f"SELECT {out}, count(*) AS n FROM (SELECT {e} AS {out} FROM ({src})) WHERE {out} IS NOT NULL "
            f"GROUP BY {out} ORDER BY n DESC, {out} LIMIT {k}")


def _distinct(label: str, src: str, c: str) -> str:
    return (f"SELECT count(*) AS rows, count(DISTINCT {c}) AS distinct_values, "
            f"count(*) - count(DISTINCT {c}) AS duplicates, '{label}' AS column_name FROM ({src})")


_GRAMMARS = " UNION ALL ".join(
    f"SELECT doc_id, '{label}' AS grammar, unnest(regexp_extract_all(lower(text), '{g}')) AS token FROM documents"
    for label, g in (("alnum", _ALNUM), ("letters", _LETTERS), ("lower", _LOWER)))

QUERIES: dict = {
    "normalize_text_orders": (normalize_products, S.ORDER_TEXTS),
    "normalize_text_articles": (normalize_articles, S.ARTICLE_TEXTS),
    "fold_accents": (fold_text, f"SELECT doc_id, {S.fold('text')} AS folded FROM documents"),
    "build_document": (build_document, S.PRODUCT_BRAND_TEXTS),
    "text_predicates": (text_predicates, f"""SELECT doc_id, text <> {S.fold('text')} AS accent, upper(text) = text AS upper,
 length(text) AS chars, {S.token_count('text')} AS tokens,
 lower(nullif(regexp_extract(text, '\\S+'), '')) AS first_word FROM documents"""),
    "token_grammars": (token_grammars, f"""SELECT doc_id, grammar, count(*) AS tokens,
 count(DISTINCT token) AS distinct_tokens FROM ({_GRAMMARS}) GROUP BY ALL"""),
    "base_names": (base_names, f"SELECT doc_id, {S.base_name('name')} AS base FROM ({S.PRODUCTS})"),
    "prefixed_texts": (prefixed_texts, f"""SELECT query_id, 'raw' AS kind, 'query: ' || text AS text FROM ({S.ORDERS})
 UNION ALL SELECT query_id, 'normalised', 'query: ' || {S.norm('text')} FROM ({S.ORDERS})"""),
    "null_profile": (null_profile, " UNION ALL ".join([
        _nulls("products", S.PRODUCTS, ["doc_id", "name", "brand"]),
        _nulls("orders", S.ORDERS, ["query_id", "text", "gold_id", "split"]),
        _nulls("labels", "SELECT * FROM labels", ["doc_id", "quality", "toxic"])])),
    "distinct_dups": (distinct_dups, " UNION ALL ".join([
        _distinct("article", S.ARTICLES, "name"), _distinct("product", S.PRODUCTS, "name"),
        _distinct("request", S.REQUESTS_SEEN, "text")])),
    "duplicate_groups": (duplicate_groups, _shared("")),
    "duplicate_groups_first": (duplicate_groups_first, _shared("ORDER BY name LIMIT 5")),
    "frequent_texts": (frequent_texts, _tops(S.ARTICLES, "name", "name", 5)),
    "brand_counts": (brand_counts, _tops(S.PRODUCTS, "brand", "brand", 20)),
    "category_top": (category_top, f"""WITH c AS (SELECT lower(nullif(regexp_extract(text, '\\S+'), '')) AS category
 FROM documents) SELECT category, count(*) AS n, (SELECT count(DISTINCT category) FROM c) AS categories FROM c
 WHERE category IS NOT NULL GROUP BY category ORDER BY n DESC, category LIMIT 25"""),
    "set_overlap": (set_overlap, f"""SELECT count(*) AS shared, 'article and passage' AS pair FROM
 (SELECT text FROM documents INTERSECT SELECT text FROM benchmark) UNION ALL SELECT count(*), 'order and product' FROM
 (SELECT lower(text) FROM ({S.ORDERS}) INTERSECT SELECT lower(name) FROM ({S.PRODUCTS}))"""),
    "reference_check": (reference_check, """SELECT count(*) AS rows, count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM documents)) AS present,
 count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS missing, 'labels' AS refs FROM labels
 UNION ALL SELECT count(*), count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels)),
 count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM labels)), 'articles' FROM documents"""),
    "missing_references": (missing_references, """SELECT doc_id, source AS brand FROM documents
 WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""),
    "length_stats": (length_stats, " UNION ALL ".join([
        _lengths("articles", S.ARTICLES, "name"), _lengths("orders", S.ORDERS, "text"),
        _lengths("requests", S.REQUESTS_SEEN, "text")])),
    "token_histogram": (token_histogram, f"""SELECT least(t, 23)::BIGINT AS bin, count(*) AS n FROM
 (SELECT {S.token_count('text')} AS t FROM ({S.REQUESTS_SEEN})) WHERE t <= 24 GROUP BY bin"""),
    "case_and_accents": (case_and_accents, " UNION ALL ".join(
        f"SELECT '{label}' AS label, {_SPREAD.format(f'upper({c}) = {c}')} AS upper_share, "
        f"{_SPREAD.format(f'{c} <> {S.fold(c)}')} AS accent_share FROM ({src})"
        for label, c, src in (("articles", "name", S.ARTICLES), ("requests", "text", S.REQUESTS_SEEN)))),
    "pattern_shares": (pattern_shares, " UNION ALL ".join(
        f"SELECT '{name}' AS pattern, " + _SPREAD.format(f"regexp_matches(text, '{S.rx(p)}', 'i')")
        + f" AS share FROM (SELECT text FROM ({S.ORDERS}) UNION ALL SELECT text FROM documents)"
        for name, p in T.ORDER_PATTERNS.items())),
    "token_freq": (token_freq, " UNION ALL ".join(
        f"SELECT * FROM (SELECT token, count(*) AS n, '{side}' AS side FROM (SELECT "
        f"unnest(regexp_extract_all(lower({c}), '{_ALNUM}')) AS token FROM ({src})) GROUP BY token "
        f"ORDER BY n DESC, token LIMIT 30)"
        for side, c, src in (("catalog", "name", S.ARTICLES), ("requests", "text", S.REQUESTS_SEEN)))),
    "short_texts": (short_texts, f"""SELECT count(*) AS rows, count(*) FILTER (WHERE {S.token_count('text')} <= 2) AS hits,
 {_SPREAD.format(S.token_count('text') + ' <= 2')} AS share FROM documents"""),
    "short_examples": (short_examples, f"""SELECT doc_id, text AS name FROM documents
 WHERE {S.token_count('text')} <= 2 ORDER BY doc_id LIMIT 10"""),
    "variant_groups": (variant_groups, f"""WITH p AS (SELECT {S.base_name('name')} AS base, name, doc_id FROM ({S.PRODUCTS})),
 g AS (SELECT base, count(*) AS n FROM p GROUP BY base HAVING count(*) > 1 ORDER BY n DESC, base LIMIT 8),
 x AS (SELECT base, name, doc_id, row_number() OVER (PARTITION BY base ORDER BY doc_id) AS pos FROM p)
 SELECT g.base, g.n, string_agg(x.name, ' | ' ORDER BY pos) AS examples FROM g JOIN x ON g.base = x.base AND pos <= 3
 GROUP BY g.base, g.n"""),
    "variant_totals": (variant_totals, f"""SELECT count(*) FILTER (WHERE n > 1) AS bases_with_variants,
 coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT AS records_involved FROM
 (SELECT {S.base_name('name')} AS base, count(*) AS n FROM ({S.PRODUCTS}) GROUP BY base)"""),
    "vocabulary_coverage": (vocabulary_coverage, _coverage(S.ARTICLES) + "SELECT query_id, coverage FROM c"),
    "low_coverage": (low_coverage, _coverage(S.PRODUCTS) + f"""SELECT count(*) AS rows,
 count(*) FILTER (WHERE coverage <= 0.34) AS hits, {_SPREAD.format('coverage <= 0.34')} AS share FROM c"""),
    "low_coverage_examples": (low_coverage_examples, _coverage(S.PRODUCTS) + """SELECT query_id, text, coverage FROM c
 WHERE coverage <= 0.34 ORDER BY query_id LIMIT 12"""),
    "seeded_sample": (seeded_sample, f"""SELECT query_id, text FROM ({S.REQUESTS_SEEN})
 ORDER BY md5(query_id || ':42'), query_id LIMIT 15"""),
}
