"""URL filters by hashed host-suffix and path-prefix expressions.

A rule names a host and a path. It fits its host and all subdomains, if the url's path starts with the rule's;
the longest fitting rule wins. Each distinct (host, path) is expanded into host suffixes x path prefixes (up to a
slash, only to the depths that rules have). Expressions meet rules on four bytes of their SHA-256; the whole
digest and the rest of the rule's path are then confirmed.

Only DataFrame operations. Urls are first reduced to distinct (host, path) pairs, so a hot url is expanded once.

Defined results: a null url, or one without ``://``, has an empty host and path and fits no rule. Rows that repeat
keep their number. No rules: every url gets the default verdict. Of two rules with equal text, block wins.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from matchloom.llm.common import broadcast_if_small, fold_ascii, let, table

DEFAULT = "allow"
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path). The host is what follows the first ``://``, lower-cased; the path ends before ``?`` or ``#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(fold_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def stem(path: Column) -> Column:
    """A path up to its last slash: a prefix every url path has that starts with the whole of it."""
    return F.regexp_extract(path, r"^(?s)(.*/)?", 0)


def depth(path: Column) -> Column:
    return F.size(F.split(path, "/")) - 1


def suffixes(host: Column, labels: Column) -> Column:
    """The host and its parent domains, of at most ``labels`` labels."""
    return let(F.split(host, r"\."), lambda parts: F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), labels)),
        lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), ".")))


def prefixes(path: Column, slashes: Column) -> Column:
    """The empty path and every part of the path that ends in one of its first ``slashes`` slashes."""
    return let(F.split(path, "/"), lambda parts: F.transform(
        F.sequence(F.lit(0), F.least(F.size(parts) - 1, slashes)),
        lambda n: F.concat(F.array_join(F.slice(parts, 1, n), "/"), F.when(n > 0, "/").otherwise(""))))


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\x00"), path), 256)


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """``rules``: verdict, host, path. Returns the rows of ``urls`` in a struct ``row`` with host, path, rule, verdict."""
    host, path = url_parts(F.col(url))
    rows = urls.select(F.struct(*urls.columns).alias("row"), host.alias("host"), path.alias("path"))
    known = rules.select("verdict", fold_ascii(F.col("host")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path")).filter("rule_host IS NOT NULL")
    reach = known.agg(F.coalesce(F.max(F.size(F.split("rule_host", r"\."))), F.lit(0)).alias("labels"),
                      F.coalesce(F.max(depth(stem(F.col("rule_path")))), F.lit(0)).alias("slashes")).first()
    known = known.withColumn("digest", digest(F.col("rule_host"), stem(F.col("rule_path"))))
    known = broadcast_if_small(known.withColumn("short", F.substring("digest", 1, 8)))

    distinct = rows.select("host", "path").distinct()
    hosts = distinct.filter("host != ''").select("host", "path", F.explode(suffixes(F.col("host"), F.lit(reach.labels))).alias("suffix"))
    spelt = hosts.select("host", "path", F.explode(F.transform(
        prefixes(F.col("path"), F.lit(reach.slashes)), lambda p: digest(F.col("suffix"), p))).alias("whole"))
    fits = (spelt.withColumn("short", F.substring("whole", 1, 8)).join(known, "short")
            .filter((F.col("whole") == F.col("digest")) & F.startswith("path", "rule_path")))
    best = (fits.groupBy("host", "path").agg(F.max(F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("size"), F.length("rule_host").alias("host_size"), "verdict", "rule_host", "rule_path")).alias("best"))
        .select(F.col("host").alias("of_host"), F.col("path").alias("of_path"), F.concat("best.rule_host", "best.rule_path").alias("rule"), "best.verdict"))
    return (rows.join(best, (F.col("host") == F.col("of_host")) & (F.col("path") == F.col("of_path")), "left")
            .select("row", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return (judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
            .select("row.page_id", "host", "path", "rule", "verdict"))


_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
SQL = f"""
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
                 regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(verdict, rule_host, rule_path) AS (VALUES {_RULES}),
fits AS (SELECT p.page_id, p.host, p.path, rule_host || rule_path AS rule, verdict,
                row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS n
         FROM parts p LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, '{DEFAULT}') AS verdict FROM fits WHERE n = 1
"""

QUERIES = {"op5_url_filter": (op5_url_filter, SQL)}
