"""Exact similarity self-join of records, and the groups that it links.

Records are unit TF-IDF vectors of distinct texts. With terms in one fixed order, the rarest first, ``reach`` at a term is the
length of the part of the vector from this term on. Where the first common term of two texts is w, their cosine is
at most reach_a(w) * reach_b(w). So only postings with a reach of the threshold or more (the text's prefix: its rarest terms)
are joined, on the term, and a row counts only if the product of both reaches attains the threshold.

* length filter: a text of n terms and largest weight m cannot have more than n_min * m_a * m_b in common with another;
* position filter: the product of the reaches where the two meet;
* of the pairs that are left, what their joined terms leave open is bounded by Cauchy-Schwarz before they are
  completed with all their terms.

Equal texts are one record here. Terms that many prefixes share are salted on both sides.

Where no two texts have the same id, prefixes are made where a text is read (``streamed``), and prefixes carry all their terms: whatever two
texts have in common besides lies behind the end of the shorter prefix. It is bounded level by level (a level is a range of
frequencies), by the product of the lengths that the two have there. Prefixes meet in rounds, so that the pairs of one round only lie on disk.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from matchloom.operators.blockmax import MARGIN
from matchloom.operators.joins import fits_broadcast, hot_keys, salted_join
from matchloom.operators.sparse import SparseIndex
from matchloom.operators.storage import discard, written
from matchloom.operators.streamed import LEVELS, prefix_rows, shared_weights
from matchloom.operators.topk import TIE_DIGITS

FLOAT_MARGIN = 1e-6        # far above the rounding noise of sums of products of floats
ROUND_PAIRS = 1 << 26      # meetings of two prefixes, per term, in one round
ROUND_SCORED = 1 << 17     # pairs scored in one round


def prefixes(index: SparseIndex, threshold: float) -> DataFrame:
    """(text_id, term, wd, reach, size, most) of the postings that must be looked at to find all partners of a text."""
    order = Window.partitionBy("text_id").orderBy(F.desc("text_df"), F.desc("term")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("text_id")
    placed = index.postings_by_text().join(index.vocabulary.select("term", "text_df"), "term")
    return (placed.withColumn("reach", F.sqrt(F.sum(F.col("wd") * F.col("wd")).over(order)))
            .withColumn("size", F.count(F.lit(1)).over(whole)).withColumn("most", F.max("wd").over(whole))
            .filter(F.col("reach") >= threshold - MARGIN).select("text_id", "term", "wd", "reach", "size", "most"))


def candidates(index: SparseIndex, threshold: float) -> DataFrame:
    """(a, b), a < b: pairs that the filters leave."""
    if index.told_apart:
        return bounded(index, threshold)
    rows = index._written(prefixes(index, threshold), "similar-prefixes")
    counts = rows.groupBy("term").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    total = counts.agg(F.sum("texts")).first()[0] or 0
    left, right = (rows.select("term", *[F.col(c).alias(f"{c}_{x}") for c in ("text_id", "wd", "reach", "size", "most")]) for x in "ab")
    hot = hot_keys(counts, "term", "texts", total, other=rows)
    met = salted_join(left, right, "term", "text_id_a", hot, "text_id_b").filter(
        (F.col("text_id_a") < F.col("text_id_b")) & (F.col("reach_a") * F.col("reach_b") >= threshold - MARGIN)
        & (F.least("size_a", "size_b") * F.col("most_a") * F.col("most_b") >= threshold - MARGIN))
    open_ = lambda x: F.sqrt(F.greatest(1 - F.sum(F.col(f"wd_{x}") * F.col(f"wd_{x}")), F.lit(0.0)))
    most = met.groupBy(F.col("text_id_a").alias("a"), F.col("text_id_b").alias("b")).agg(
        (F.sum(F.col("wd_a") * F.col("wd_b")) + open_("a") * open_("b")).alias("most"))
    return most.filter(F.col("most") >= threshold - MARGIN).select("a", "b")


def bounded(index: SparseIndex, threshold: float) -> DataFrame:
    """(a, b), a < b: pairs whose common prefix terms, and what can be behind them level by level, reach ``threshold``."""
    spark = index.docs.sparkSession
    whole, path = written(prefix_rows(index, threshold), "similar-prefixes")
    # equal hashes of different terms only raise a bound
    rows = whole.filter("term IS NOT NULL").select(F.xxhash64("term").alias("term"), "text_id", F.col("wd").cast("float").alias("wd"))
    facts = whole.filter("term IS NULL").select("text_id", "size", "most", "last", "levels", "rest")
    facts = F.broadcast(facts) if fits_broadcast(facts) else facts
    counts = rows.groupBy("term").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").persist()
    total = counts.agg(F.sum("texts").alias("rows"), F.sum(F.expr("texts * (texts - 1) / 2")).alias("pairs")).first()
    rounds = max(1, math.ceil((total["pairs"] or 0) / ROUND_PAIRS))
    hot = hot_keys(counts, "term", "texts", total["rows"] or 0, other=rows)
    left, right = (rows.select("term", *[F.col(c).alias(f"{c}_{x}") for c in ("text_id", "wd")]) for x in "ab")
    own = lambda x: facts.select(F.col("text_id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("size", "most", "last")],
                                 *[F.col(c)[i].alias(f"{c}_{x}{i}") for c in ("levels", "rest") for i in range(LEVELS)])
    least = threshold - FLOAT_MARGIN

    def behind(x: str, y: str) -> Column:
        """What the texts can have in common behind the prefix of ``x``, where it ends first."""
        both = reduce(Column.__add__, [F.col(f"rest_{x}{i}") * F.col(f"levels_{y}{i}") for i in range(LEVELS)])
        return F.when(F.col(f"last_{x}") <= F.col(f"last_{y}"), both).otherwise(0.0)

    parts = []
    for number in range(rounds):
        some = left.filter(F.pmod(F.xxhash64("text_id_a"), F.lit(rounds)) == number)
        met = salted_join(some, right, "term", "text_id_a", hot, "text_id_b").filter("text_id_a < text_id_b")
        sums = met.groupBy(F.col("text_id_a").alias("a"), F.col("text_id_b").alias("b")).agg(F.sum(F.col("wd_a") * F.col("wd_b")).alias("common"))
        pairs = sums.join(own("a"), "a").join(own("b"), "b").filter(F.least("size_a", "size_b") * F.col("most_a") * F.col("most_b") >= least)
        parts.append(index._written(pairs.filter(F.col("common") + F.greatest(behind("a", "b"), behind("b", "a")) >= least).select("a", "b"), "similar-bounded"))
    counts.unpersist()
    discard(spark, path)
    return reduce(DataFrame.unionByName, parts)


def scored_pairs(index: SparseIndex, pairs: DataFrame) -> DataFrame:
    """(a, b, score), exactly, with nine digits; in rounds, since a pair takes two texts with it."""
    ends = pairs.select(F.col("a").alias("text_id")).union(pairs.select("b")).distinct()
    vectors, path = written(shared_weights(index, index.kept[0].join(ends, "text_id", "left_semi")), "similar-vectors")
    one, other = (vectors.select(F.col("text_id").alias(x), F.col("terms").alias(f"terms_{x}"), F.col("weights").alias(f"weights_{x}")) for x in "ab")
    rounds, kind = max(1, math.ceil(pairs.count() / ROUND_SCORED)), pairs.schema["a"].dataType.simpleString()

    def dots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [batch.column(c).to_pylist() for c in ("terms_a", "weights_a", "terms_b", "weights_b")]
            out = []
            for terms_a, weights_a, terms_b, weights_b in zip(*sides):
                held = dict(zip(terms_a, weights_a))
                out.append(sum(held[t] * w for t, w in zip(terms_b, weights_b) if t in held))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], names=["a", "b", "score"])

    parts = []
    for number in range(rounds):
        some = pairs.filter(F.pmod(F.xxhash64("a", "b"), F.lit(rounds)) == number)
        parts.append(index._written(some.join(one, "a").join(other, "b").mapInArrow(dots, f"a {kind}, b {kind}, score double"), "similar-scored"))
    discard(index.docs.sparkSession, path)
    return reduce(DataFrame.unionByName, parts).withColumn("score", F.round("score", TIE_DIGITS))


def similar_texts(index: SparseIndex, threshold: float) -> DataFrame:
    """(a, b, score) of all pairs of different texts with a cosine of ``threshold`` or more; a text goes by its lowest
    document. ``index`` has TF-IDF weights."""
    if index.norms is None:
        raise ValueError("similar texts need unit vectors")
    pairs = index._written(candidates(index, threshold), "similar-candidates")
    if index.told_apart:
        return scored_pairs(index, pairs).filter(F.col("score") >= threshold)
    postings = index.postings_by_text()
    one = pairs.join(postings.select(F.col("text_id").alias("a"), "term", F.col("wd").alias("wa")), "a")
    both = one.join(postings.select(F.col("text_id").alias("b"), "term", F.col("wd").alias("wb")), ["b", "term"])
    return (both.groupBy("a", "b").agg(F.round(F.sum(F.col("wa") * F.col("wb")), TIE_DIGITS).alias("score"))
            .filter(F.col("score") >= threshold))


def groups(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes of ``links`` (a, b); root is the smallest node that links lead to.

    Every node takes the smallest root among its own and its neighbours', and then its root's root, so the distance to the
    smallest node halves at least where roots form chains. A round joins and aggregates; no neighbourhood is gathered.
    """
    spark, paths = links.sparkSession, []

    def keep(df: DataFrame) -> DataFrame:
        table, path = written(df, "groups")
        paths.append(path)
        return table

    edges = keep(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    roots = keep(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")))
    while True:
        near = edges.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = roots.join(near, "node").select("node", F.col("root").alias("before"), F.least("root", "near").alias("root"))
        onward = lower.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
        now = keep(lower.join(onward, "root", "left").select("node", "before", F.coalesce("beyond", "root").alias("root")))
        roots = now.select("node", "root")
        if now.filter("before <> root").isEmpty():
            for path in paths[:-1]:
                discard(spark, path)
            return roots
        if len(paths) > 3:                                     # the edges, the last and this round are still read
            discard(spark, paths.pop(1))


def record_groups(docs: DataFrame, threshold: float, analyzer: str = "word", index: SparseIndex | None = None) -> DataFrame:
    """(doc_id, group_id, similar) of every record of ``docs`` (doc_id, norm): the smallest record that copies and links lead to,
    and the number of other texts that the record's text is similar to. Empty texts are similar to nothing but copies."""
    own = index or SparseIndex.fit(docs, analyzer, "tfidf")
    links = own._written(similar_texts(own, threshold), "similar-texts")
    roots = groups(links)
    counts = links.select(F.col("a").alias("text_id")).unionByName(links.select(F.col("b").alias("text_id"))).groupBy("text_id").agg(F.count(F.lit(1)).alias("similar"))
    keyed = docs.select("doc_id", F.sha2("norm", 256).alias("text_key"))
    texts = keyed.groupBy("text_key").agg(F.min("doc_id").alias("text_id"))
    labels = (texts.join(roots.withColumnRenamed("node", "text_id"), "text_id", "left").join(counts, "text_id", "left")
              .select("text_key", F.coalesce("root", "text_id").alias("group_id"), F.coalesce("similar", F.lit(0)).alias("similar")))
    return keyed.join(labels, "text_key").select("doc_id", "group_id", "similar")
