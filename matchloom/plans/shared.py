"""Indexes and rankings that several queries of one session use; built once, dropped by ``forget``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from matchloom.operators.evaluate import gold_ranks, gold_ranks_of_texts
from matchloom.operators.sparse import SparseIndex
from matchloom.operators.storage import discard, written
from matchloom.plans import roles as R

# system name: analyzer, weighting, brand appended
SYSTEMS = {
    "tfidf_char": ("char35", "tfidf", False),
    "tfidf_word": ("word", "tfidf", False),
    "bm25": ("word", "bm25", True),
}
GRID = {
    f"{label} {'name+brand' if brand else 'name'}": (family, analyzer, weighting, brand)
    for brand in (False, True)
    for label, family, analyzer, weighting in (
        ("tfidf word 1", "tfidf", "word", "tfidf"), ("tfidf word 1-2", "tfidf", "word12", "tfidf"),
        ("tfidf char 3-5", "tfidf", "char35", "tfidf"), ("bm25", "bm25", "word", "bm25"))
}

_held: dict = {}


def _once(spark: SparkSession, key: tuple, build):
    key = (spark.sparkContext.applicationId, *key)
    if key not in _held:
        _held[key] = build()
    return _held[key]


def forget() -> None:
    for thing in _held.values():
        if isinstance(thing, SparseIndex):
            thing.release()
        elif isinstance(thing, DataFrame):
            thing.unpersist()
        elif isinstance(thing, tuple):
            discard(thing[0].sparkSession, thing[1])
    _held.clear()


def product_index(spark: SparkSession, sf: str, analyzer: str, weighting: str, brand: bool) -> SparseIndex:
    return _once(spark, (sf, "products", analyzer, weighting, brand), lambda: SparseIndex.fit(
        product_texts(spark, sf, brand), analyzer, weighting))


def article_index(spark: SparkSession, sf: str, analyzer: str, weighting: str) -> SparseIndex:
    return _once(spark, (sf, "articles", analyzer, weighting), lambda: SparseIndex.fit(
        article_texts(spark, sf), analyzer, weighting))


def article_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Long texts, normalised once for all indexes and their copies."""
    return _once(spark, (sf, "article texts"), lambda: written(R.catalog_texts(R.articles(spark, sf), False), "article-texts"))[0]


def product_texts(spark: SparkSession, sf: str, brand: bool) -> DataFrame:
    """Short texts, normalised once for the index, its copies and its padding."""
    return _once(spark, (sf, "product texts", brand), lambda: R.catalog_texts(R.products(spark, sf), brand).persist())


def order_texts(spark: SparkSession, sf: str) -> DataFrame:
    return _once(spark, (sf, "order texts"), lambda: R.normalised(R.orders(spark, sf), "text", "query_id").persist())


def passage_texts(spark: SparkSession, sf: str) -> DataFrame:
    return R.normalised(R.passages(spark, sf), "text", "query_id")


def order_ranking(spark: SparkSession, sf: str, analyzer: str, weighting: str, brand: bool, k: int = 5) -> DataFrame:
    """Ranked products of every order, always k of them."""
    return _once(spark, (sf, "ranking", analyzer, weighting, brand, k), lambda: product_index(
        spark, sf, analyzer, weighting, brand).search(order_texts(spark, sf), k, pad=True).persist())


def order_gold_ranks(spark: SparkSession, sf: str, analyzer: str, weighting: str, brand: bool) -> DataFrame:
    """Rank of the right product of every order, from the ranking of each different text; where all rankings are held already, from those."""
    gold = R.orders(spark, sf).select("query_id", "gold_id", "split")
    if (spark.sparkContext.applicationId, sf, "ranking", analyzer, weighting, brand, 5) in _held:
        return gold_ranks(gold, order_ranking(spark, sf, analyzer, weighting, brand), "split")

    def build():
        index = product_index(spark, sf, analyzer, weighting, brand)
        asked, best = index.search_texts(order_texts(spark, sf), 5, pad=True)
        return gold_ranks_of_texts(gold, asked, index._keep(best), "split").persist()

    return _once(spark, (sf, "gold ranks", analyzer, weighting, brand), build)


def system_tops(spark: SparkSession, sf: str, *names: str) -> DataFrame:
    """system, query_id, rank, doc_id, score of the named systems; of all, by default. No other system is indexed or searched."""
    return reduce(DataFrame.unionByName, [order_ranking(spark, sf, *SYSTEMS[name]).withColumn("system", F.lit(name)) for name in names or SYSTEMS])


def system_ranks(spark: SparkSession, sf: str, *names: str) -> DataFrame:
    """system, split, query_id, gold_id, rank of the right product, of the named systems or of all."""
    if not names:
        return reduce(DataFrame.unionByName, [order_gold_ranks(spark, sf, *how).withColumn("system", F.lit(name)) for name, how in SYSTEMS.items()])
    gold = R.orders(spark, sf).select("query_id", "gold_id", "split")
    return reduce(DataFrame.unionByName, [gold_ranks(gold, order_ranking(spark, sf, *SYSTEMS[name]), "split").withColumn("system", F.lit(name))
                                          for name in names])
