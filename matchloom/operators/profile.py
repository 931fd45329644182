"""Data profiling: each section of a report is one lazy DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from matchloom.functions import text as T
from matchloom.operators.joins import lookup

HISTOGRAM_TOP = 24
MIN_LETTERS = 3
LOW_COVERAGE = 0.34


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """One row per column: rows, columns and nulls, all from one pass."""
    cols = df.columns
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return (counted.unpivot(["rows"], cols, "column_name", "nulls")
            .select(F.lit(table).alias("table_name"), "column_name", "rows",
                    F.lit(len(cols)).cast("long").alias("columns"), "nulls"))


def distinct_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows, distinct values and duplicates. Values are pre-aggregated, so a frequent one costs nothing."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(col).alias("distinct_values"))
            .withColumn("duplicates", F.col("rows") - F.col("distinct_values")))


def shared_values(df: DataFrame, col: str, id_col: str, groups: int | None = None) -> DataFrame:
    """Every row whose value occurs on several rows, in long form; optionally the first groups by value."""
    repeated = df.groupBy(col).agg(F.count(F.lit(1)).alias("group_size")).filter("group_size > 1")
    if groups is not None:
        repeated = repeated.orderBy(col).limit(groups)
    return lookup(df.select(col, id_col), repeated, col).select(col, id_col, "group_size")


def top_values(df: DataFrame, col: str, k: int) -> DataFrame:
    """Most frequent values; equal counts by value. Nulls are not values."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc(col)).limit(k))


def overlap_count(left: DataFrame, right: DataFrame, col: str) -> DataFrame:
    return left.select(col).intersect(right.select(col)).agg(F.count(F.lit(1)).alias("shared"))


def category_counts(df: DataFrame, col: str, k: int) -> DataFrame:
    """First word as a category: the most frequent ones, each with the number of categories."""
    counts = (df.select(T.first_word(F.col(col)).alias("category")).filter(F.col("category").isNotNull())
              .groupBy("category").agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.count(F.lit(1)).alias("c"))
    return (counts.orderBy(F.desc("n"), F.asc("category")).limit(k)
            .withColumn("categories", total.scalar()))


def reference_check(refs: DataFrame, ref: str, catalog: DataFrame, id_col: str) -> DataFrame:
    ids = catalog.select(F.col(id_col).alias(ref), F.lit(True).alias("found")).distinct()
    return (refs.select(ref).join(ids, ref, "left")
            .agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("found")).alias("present"),
                 F.count_if(F.col("found").isNull()).alias("missing")))


def missing_references(refs: DataFrame, ref: str, catalog: DataFrame, id_col: str) -> DataFrame:
    return refs.join(catalog.select(F.col(id_col).alias(ref)), ref, "left_anti")


def length_stats(df: DataFrame, col: str, label: str) -> DataFrame:
    """Mean, median, least and greatest length in characters and in tokens.

    The exact median keeps one counter per distinct length, which text size bounds, not row count.
    """
    sized = df.select(F.char_length(col).alias("chars"), T.token_count(F.col(col)).alias("tokens"))
    out = [F.lit(label).alias("label")]
    for c in ("chars", "tokens"):
        out += [F.round(F.avg(c), 6).alias(f"{c}_mean"), F.median(c).cast("double").alias(f"{c}_median"),
                F.min(c).cast("long").alias(f"{c}_min"), F.max(c).cast("long").alias(f"{c}_max")]
    return sized.agg(*out[1:]).select(out[0], "*")


def token_histogram(df: DataFrame, col: str) -> DataFrame:
    """Unit bins from 0; the last one is closed and holds 23 and 24. Longer texts lie outside."""
    return (df.select(T.token_count(F.col(col)).alias("t")).filter(F.col("t") <= HISTOGRAM_TOP)
            .groupBy(F.least("t", F.lit(HISTOGRAM_TOP - 1)).cast("long").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")))


def case_and_accents(df: DataFrame, col: str, label: str) -> DataFrame:
    c = F.col(col)
    return df.agg(F.round(F.avg(T.is_upper(c).cast("double")), 6).alias("upper_share"),
                  F.round(F.avg(T.has_accent(c).cast("double")), 6).alias("accent_share")).select(
        F.lit(label).alias("label"), "*")


def pattern_shares(df: DataFrame, col: str) -> DataFrame:
    """Share of texts per named order pattern; one pass, then one row per pattern."""
    shares = df.agg(*[F.round(F.avg(T.matches(F.col(col), rx).cast("double")), 6).alias(name)
                      for name, rx in T.ORDER_PATTERNS.items()])
    return shares.unpivot([], list(T.ORDER_PATTERNS), "pattern", "share")


def top_tokens(df: DataFrame, col: str, k: int, grammar: str = T.TOKENS_ALNUM) -> DataFrame:
    return top_values(df.select(F.explode(T.tokens(F.col(col), grammar)).alias("token")), "token", k)


def short_texts(df: DataFrame, col: str, most: int = 2) -> DataFrame:
    return df.filter(T.token_count(F.col(col)) <= most)


def share_of(df: DataFrame, flag: Column) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(flag).alias("hits"),
                  F.round(F.avg(flag.cast("double")), 6).alias("share"))


def variant_groups(df: DataFrame, name: str, id_col: str, k: int, examples: int = 3) -> DataFrame:
    """Largest groups of names that differ in measures only, with their first names by id.

    The examples come from a row limit per group, applied before the shuffle; no group is gathered whole.
    """
    named = df.select(T.base_name(F.col(name)).alias("base"), F.col(name).alias("name"), F.col(id_col).alias("id"))
    sizes = named.groupBy("base").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.filter("n > 1").orderBy(F.desc("n"), F.asc("base")).limit(k)
    first = Window.partitionBy("base").orderBy("id")
    shown = (named.join(F.broadcast(largest), "base").withColumn("at", F.row_number().over(first))
             .filter(F.col("at") <= examples))
    return shown.groupBy("base", "n").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "name"))), lambda x: x["name"]), " | ")
        .alias("examples"))


def variant_totals(df: DataFrame, name: str) -> DataFrame:
    sizes = df.groupBy(T.base_name(F.col(name)).alias("base")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.count_if(F.col("n") > 1).alias("bases_with_variants"),
                     F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("records_involved"))


def vocabulary(df: DataFrame, cols: list[str], grammar: str) -> DataFrame:
    """Distinct tokens of several columns (union of their vocabularies)."""
    parts = [df.select(F.explode(T.tokens(F.col(c), grammar)).alias("token")).distinct() for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def coverage(queries: DataFrame, id_col: str, text: str, words: DataFrame) -> DataFrame:
    """Share of a text's letter tokens (three letters or more) that the vocabulary knows; 1 without any.

    Tokens are counted per text first, and only the vocabulary that the texts use takes part in the join.
    """
    used = (queries.select(id_col, F.explode(T.tokens(F.col(text), T.TOKENS_LETTERS)).alias("token"))
            .filter(F.char_length("token") >= MIN_LETTERS)
            .groupBy(id_col, "token").agg(F.count(F.lit(1)).alias("n")))
    known = words.join(used.select("token").distinct(), "token", "left_semi").withColumn("known", F.lit(1))
    shares = (lookup(used, known, "token", "left").groupBy(id_col)
              .agg((F.sum(F.col("n") * F.coalesce("known", F.lit(0))) / F.sum("n")).alias("share")))
    return (queries.select(id_col, text).join(shares, id_col, "left")
            .select(id_col, text, F.round(F.coalesce("share", F.lit(1.0)), 6).alias("coverage")))


def seeded_sample(df: DataFrame, key: str, seed: str, n: int) -> DataFrame:
    """n rows without replacement, equal on any partitioning: the lowest hashes of key and seed."""
    drawn = F.md5(F.concat(F.col(key).cast("string"), F.lit(":" + seed)))
    return df.withColumn("_draw", drawn).orderBy("_draw", key).limit(n).drop("_draw")
