"""Queries that no catalog record matches: unknown terms, score threshold, abstentions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from matchloom.functions import text as T
from matchloom.operators.joins import fits_broadcast, hot_keys, lookup, salted_join
from matchloom.operators.storage import written

TERM_LETTERS, MIN_TOKENS, SAMPLE = 5, 3, 25
BIN = 10_000


def unknown_terms(queries: DataFrame, words: DataFrame, id_col: str = "query_id") -> DataFrame:
    """(query_id, terms): letter tokens of five letters or more outside the vocabulary, in text order.

    Only terms the queries use enter the join, so the vocabulary side is cut down before it moves.
    """
    seen = (queries.select(id_col, F.posexplode(T.tokens(F.col("text"), T.TOKENS_LOWER)).alias("pos", "token"))
            .filter(F.char_length("token") >= TERM_LETTERS))
    known = words.join(seen.select("token").distinct(), "token", "left_semi").withColumn("known", F.lit(True))
    unknown = lookup(seen, known, "token", "left").filter(F.col("known").isNull())
    return unknown.groupBy(id_col).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]).alias("terms"))


def no_match_candidates(queries: DataFrame, words: DataFrame) -> DataFrame:
    """Distinct texts (under their lowest id) of three tokens or more with a term the catalog lacks."""
    distinct = queries.groupBy("text").agg(F.min("query_id").alias("query_id"))
    long_enough = distinct.filter(F.size(T.tokens(F.col("text"), T.TOKENS_LOWER)) >= MIN_TOKENS)
    return long_enough.join(unknown_terms(long_enough, words), "query_id").select("query_id", "text", "terms")


def quantiles(df: DataFrame, by: str, value: str, shares: dict[str, float]) -> DataFrame:
    """Exact quantiles with linear interpolation, without gathering a group in one task.

    Values carry nine digits. Equal ones are counted first; counts per bin of width 1/10000 then locate the
    two order statistics, and only the values of those bins (at most 100,000 distinct) are looked at.
    """
    counted = df.groupBy(by, F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    counted = counted.withColumn("bin", F.floor(F.col("v") * BIN))
    below = Window.partitionBy(by).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = counted.groupBy(by, "bin").agg(F.sum("n").alias("size")).withColumn(
        "start", F.coalesce(F.sum("size").over(below), F.lit(0))).withColumn(
        "total", F.sum("size").over(Window.partitionBy(by)))
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(p)).alias("p"))
                                 for name, p in shares.items()])).alias("q")
    places = bins.select(by, "bin", "size", "start", "total", wanted).withColumn(
        "at", F.col("q.p") * (F.col("total") - 1))
    places = places.select(by, "bin", "size", "start", F.col("q.name").alias("name"), "at",
                           F.explode(F.array(F.floor("at"), F.ceil("at"))).alias("place"))
    places = places.filter((F.col("place") >= F.col("start")) & (F.col("place") < F.col("start") + F.col("size")))
    inside = Window.partitionBy(by, "bin").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    values = (counted.join(places.select(by, "bin").distinct(), [by, "bin"], "left_semi")
              .withColumn("upto", F.sum("n").over(inside)))
    hits = values.join(places, [by, "bin"]).filter(
        (F.col("place") >= F.col("start") + F.col("upto") - F.col("n"))
        & (F.col("place") < F.col("start") + F.col("upto")))
    ends = hits.groupBy(by, "name", "at").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    each = ends.withColumn("x", F.col("lo") + (F.col("at") - F.floor("at")) * (F.col("hi") - F.col("lo")))
    return each.groupBy(by).agg(*[F.max(F.when(F.col("name") == s, F.col("x"))).alias(s) for s in shares])


def score_distribution(tops: DataFrame) -> DataFrame:
    """Median, 5th percentile, least and greatest first score per group. ``tops``: grp, score."""
    spread = quantiles(tops, "grp", "score", {"median": 0.5, "p5": 0.05})
    ends = tops.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"),
                                   F.max("score").alias("greatest"))
    return ends.join(spread, "grp")


def threshold(labelled: DataFrame, share: float = 0.05) -> DataFrame:
    """One row: the score below which a query counts as having no match."""
    return quantiles(labelled.withColumn("all", F.lit(1)), "all", "score", {"score_limit": share}).select("score_limit")


def flag_below(tops: DataFrame, limit: DataFrame) -> DataFrame:
    return tops.withColumn("score_limit", limit.scalar()).withColumn("no_match", F.col("score") < F.col("score_limit"))


def detection_rates(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("no_match").alias("flagged"),
        F.round(F.avg(F.col("no_match").cast("double")), 6).alias("flagged_share"))


def abstentions(answers: DataFrame, candidates: DataFrame, gold: DataFrame) -> DataFrame:
    """Per query: did the service abstain (empty ranking), and which document came first otherwise.

    ``answers``: query_id, grp, ranking, as given by the service: no fallback here.
    """
    first = answers.withColumn("cand_no", F.get("ranking", F.lit(0)))
    chosen = first.join(candidates.select("query_id", "cand_no", "doc_id"), ["query_id", "cand_no"], "left")
    return (chosen.join(gold.select("query_id", "gold_id"), "query_id", "left")
            .select("query_id", "grp", (F.size("ranking") == 0).alias("abstained"), "doc_id",
                    F.coalesce(F.col("doc_id") == F.col("gold_id"), F.lit(False)).alias("hit")))


def abstention_summary(per_query: DataFrame) -> DataFrame:
    return per_query.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("abstained").alias("abstained"),
        F.round(F.avg(F.col("abstained").cast("double")), 6).alias("abstained_share"),
        F.count_if("hit").alias("hits"), F.count_if(~F.col("abstained")).alias("answered"))


def combined_flags(flagged: DataFrame, abstained: DataFrame) -> DataFrame:
    """(query_id, grp, low_score, abstained, no_match): both signs of a query without a match in one row. A query that only one
    side knows counts by that side; it has no match if the score is low and the service, where it was asked, abstained."""
    low = flagged.select("query_id", "grp", F.col("no_match").alias("low_score"))
    said = abstained.select("query_id", F.col("grp").alias("asked_grp"), "abstained")
    return (low.join(said, "query_id", "full").select(
        "query_id", F.coalesce("grp", "asked_grp").alias("grp"), "low_score", "abstained",
        (F.coalesce("low_score", F.lit(True)) & F.coalesce("abstained", F.lit(True))).alias("no_match")))


def keyword_rows(catalog: DataFrame, keys: list[tuple[str, str]]) -> DataFrame:
    """Catalog rows whose lower-case name holds a key; one pass for all keys."""
    found = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), F.lit(title).alias("title")) for k, title in keys]),
                     lambda x: T.contains_key(F.col("name"), x["key"]))
    return catalog.select("doc_id", "name", F.inline(found))


ANCHOR = 3                 # characters of a key that its rows are found by


def keyword_join(catalog: DataFrame, keys: DataFrame) -> DataFrame:
    """(doc_id, name, key, title): catalog rows whose lower-case name holds a key of the table ``keys`` (key, title).

    Every key is looked up by its rarest run of ANCHOR characters (a shorter key by itself): rows and keys meet on equal runs, and
    ``contains`` confirms them. Only runs of some key leave the names, as a written table, so the index of names is never built.
    """
    def runs(text, n):
        return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)))        # one pass, overlaps included

    known = keys.filter("key IS NOT NULL AND key <> ''").distinct()
    parts = known.select("key", "title", F.explode(F.when(F.length("key") < ANCHOR, F.array("key")).otherwise(runs(F.col("key"), ANCHOR))).alias("run"))
    lower = catalog.select("doc_id", "name", F.lower("name").alias("lower"))
    lengths = [r.n for r in parts.select(F.length("run").alias("n")).distinct().collect()]                 # at most ANCHOR of them
    every = F.flatten(F.array(*[runs(F.col("lower"), n) for n in sorted(lengths)])) if lengths else F.array().cast("array<string>")
    wanted = parts.select("run").distinct()
    found = lower.select("doc_id", F.explode(every).alias("run")).join(F.broadcast(wanted) if fits_broadcast(wanted) else wanted, "run")
    found, _ = written(found, "keyword-runs")              # names are cut into runs once, whatever reads them
    counts = found.groupBy("run").agg(F.count(F.lit(1)).alias("rows"))
    rare = parts.join(counts, "run").groupBy("key", "title").agg(F.min_by("run", F.struct("rows", "run")).alias("run"))
    hot = hot_keys(counts, "run", "rows", counts.agg(F.sum("rows")).first()[0] or 0)
    met = salted_join(found, rare, "run", "doc_id", hot)
    return (met.join(lower, "doc_id").filter(F.contains("lower", F.col("key"))).select("doc_id", "name", "key", "title"))


def unsure(ranked: DataFrame, gap: float) -> DataFrame:
    """Queries whose first two scores lie close together: worth sending to the reranker."""
    pair = ranked.filter("rank <= 2").groupBy("query_id").agg(
        F.max(F.when(F.col("rank") == 1, F.col("score"))).alias("first"),
        F.max(F.when(F.col("rank") == 2, F.col("score"))).alias("second"))
    return pair.filter(F.col("first") - F.coalesce("second", F.lit(0.0)) < gap)
