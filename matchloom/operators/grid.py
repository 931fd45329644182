"""Many search configurations in one plan.

A configuration names a catalog variant, an analyzer and a weighting. One index holds them all: texts of a variant are
tokenised once per analyzer, frequencies are counted once per (variant, analyzer), and from there on a text is
(configuration, text) and a term is written with its configuration before it. Search, bounds and rankings then treat all configurations at once; none
waits for another, and the number of jobs does not grow with the grid.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from matchloom.operators import corpus
from matchloom.operators.joins import fits_broadcast
from matchloom.operators.sparse import SparseIndex, bm25_raw_idf, bm25_weight, replaced_idf, smooth_idf
from matchloom.operators.topk import pad_zero, top_k

MARK = "\x01"              # between configuration and term; normalised texts have no control characters


@dataclass(frozen=True)
class Configuration:
    name: str
    variant: str
    analyzer: str
    weighting: str


@dataclass
class GridIndex(SparseIndex):
    configurations: list[Configuration] = field(default_factory=list)
    own_texts: DataFrame | None = None         # variant, text_id, norm, copies, words

    @classmethod
    def fit_all(cls, variants: dict[str, DataFrame], configurations: list[Configuration]) -> "GridIndex":
        """``variants``: name -> (doc_id, norm) of one catalog written in several ways."""
        parts = [corpus.distinct_texts(docs, "doc_id").withColumn("variant", F.lit(name)) for name, docs in variants.items()]
        texts = parts[0]
        for part in parts[1:]:
            texts = texts.unionByName(part)
        texts = corpus.by_text(texts).persist()
        docs = next(iter(variants.values()))
        index = cls("grid", "grid", docs, texts, texts, 0, 0.0, 0, 0, 0, 0, kept=[texts], configurations=configurations, own_texts=texts)
        index.variants = variants
        index._count()
        return index

    def known(self) -> DataFrame:
        """(config, variant, analyzer, cosine): one row per configuration."""
        return F.broadcast(self.docs.sparkSession.createDataFrame(
            [(c.name, c.variant, c.analyzer, c.weighting == "tfidf") for c in self.configurations], "config string, variant string, analyzer string, cosine boolean"))

    def names(self) -> Column:
        return F.array(*[F.lit(c.name) for c in self.configurations])

    def analyzed(self, texts: DataFrame, keys: list[str]) -> DataFrame:
        """Terms of ``texts`` under every analyzer in use, each text tokenised once per analyzer."""
        out = None
        for analyzer in sorted({c.analyzer for c in self.configurations}):
            part = corpus.term_counts(texts, analyzer, keys).withColumn("analyzer", F.lit(analyzer))
            out = part if out is None else out.unionByName(part)
        return out

    def _count(self) -> None:
        counts = self._written(self.analyzed(self.own_texts, ["variant"]).select("variant", "analyzer", "text_id", "copies", "words", "term", "tf"), "grid-counts")
        sizes = self.own_texts.groupBy("variant").agg(F.sum("copies").cast("double").alias("n"), (F.sum(F.col("copies") * F.col("words")) / F.sum("copies")).alias("mean_words"))
        frequent = self._written(counts.groupBy("variant", "analyzer", "term").agg(F.sum("copies").alias("df"), F.count(F.lit(1)).alias("text_df")).join(F.broadcast(sizes), "variant"), "grid-frequencies")
        raw = bm25_raw_idf(F.col("n"), F.col("df"))
        means = frequent.groupBy("variant", "analyzer").agg(F.avg(raw).alias("mean_raw"))
        idf = F.when(F.col("cosine"), smooth_idf(F.col("n"), F.col("df"))).otherwise(replaced_idf(raw, F.col("mean_raw")))
        self.vocabulary = self._written(frequent.join(F.broadcast(means), ["variant", "analyzer"]).join(self.known(), ["variant", "analyzer"]).select(
            "config", "variant", "analyzer", "cosine", "term", idf.alias("idf"), "text_df", "mean_words"), "grid-vocabulary")
        self.counts = counts
        self.negative = not self.vocabulary.filter("idf < 0").isEmpty()
        if self.negative:
            raise ValueError("a BM25 floor below zero knows no bounds: search that configuration with its own index")

    def _shared(self, name: str, build) -> DataFrame:
        """Written, so that the plans of later steps do not hold those of all configurations before them."""
        if name not in self.shared:
            self.shared[name] = self._written(build(), f"grid-{name}")
        return self.shared[name]

    def postings_by_text(self) -> DataFrame:
        """(text_id, term, wd) of all configurations: text_id is (config, text), the term carries its configuration."""
        def build() -> DataFrame:
            terms = self.vocabulary.select("variant", "analyzer", "term", "config", "cosine", "idf", "mean_words")
            weighed = self.counts.join(F.broadcast(terms) if fits_broadcast(terms) else terms, ["variant", "analyzer", "term"])
            own = Window.partitionBy("config", "text_id")
            raw = F.when(F.col("cosine"), F.col("tf") * F.col("idf")).otherwise(bm25_weight(F.col("tf"), F.col("idf"), F.col("words"), F.col("mean_words")))
            placed = weighed.withColumn("raw", raw).withColumn("length", F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(own)))
            return placed.select(keyed("text_id").alias("text_id"), marked().alias("term"), F.when(F.col("cosine"), F.col("raw") / F.col("length")).otherwise(F.col("raw")).alias("wd"))

        return self._shared("postings", build)

    def texts_in_order(self) -> DataFrame:
        return self.own_texts.join(self.known(), "variant").select(keyed("text_id").alias("text_id"), F.concat("config", F.lit(MARK), "norm").alias("norm"))

    def query_vectors(self, texts: DataFrame) -> DataFrame:
        """(qid, term, tf, wq, text_df, cosine); qid is (config, text)."""
        counted = self.analyzed(texts, []).join(self.known().select("config", "analyzer"), "analyzer")
        known = self.vocabulary.select("config", "term", "idf", "text_df", "cosine")
        joined = counted.join(F.broadcast(known) if fits_broadcast(known) else known, ["config", "term"])
        raw = F.col("tf") * F.col("idf")
        length = F.sqrt(F.sum(raw * raw).over(Window.partitionBy("config", "text_id")))
        return joined.select(keyed("text_id").alias("qid"), marked().alias("term"), "tf", F.when(F.col("cosine"), raw / length).otherwise(F.col("tf").cast("double")).alias("wq"), "text_df", "cosine")

    @staticmethod
    def _scope(key: str) -> Column:
        return F.col(key)["config"]

    def search(self, queries: DataFrame, k: int = 5, pad: bool = False, plan: str = "auto") -> DataFrame:
        """(config, query_id, rank, doc_id, score) under every configuration."""
        distinct = self._keep(corpus.by_text(corpus.distinct_texts(queries, "query_id")))
        each = self._written(distinct.withColumn("config", F.explode(self.names())).select("config", "norm", keyed("text_id").alias("own")), "search-each")
        alike, vectors = self._asked_once(self._written(self.query_vectors(distinct), "search-vectors"), each.select(F.col("own").alias("qid")))
        best_texts = top_k(self._many(vectors, k, plan), k, "qid", "text_id")
        best = top_k(best_texts.join(self._copies(k), "text_id"), k, "qid")
        asked = each.join(alike, "own").select("config", "norm", "qid")
        if pad:
            best = pad_zero(alike.filter("own = qid").select("qid"), self._written(best, "search-best").filter(F.col("score") > 0), self.docs.select("doc_id"), k, "qid")
        return queries.join(asked, "norm").join(best, "qid").select("config", "query_id", "rank", "doc_id", "score")

    def _copies(self, k: int) -> DataFrame:
        """(text_id, doc_id): the k lowest documents of every text of every configuration."""
        def build() -> DataFrame:
            out = None
            for name, docs in self.variants.items():
                part = corpus.first_copies(docs, "doc_id", k).withColumn("variant", F.lit(name))
                out = part if out is None else out.unionByName(part)
            return out.join(self.known().select("variant", "config"), "variant").select(keyed("text_id").alias("text_id"), "doc_id")

        return self._shared(f"copies-{k}", build)


def grid_ranks(index: GridIndex, gold: DataFrame, ranked: DataFrame, *keep: str) -> DataFrame:
    """Rank of the right answer under every configuration, 0 outside the list. ``gold``: query_id, gold_id."""
    hits = ranked.select("config", "query_id", F.col("doc_id").alias("gold_id"), "rank")
    asked = gold.select(F.explode(index.names()).alias("config"), "query_id", "gold_id", *keep)
    return asked.join(hits, ["config", "query_id", "gold_id"], "left").withColumn("rank", F.coalesce("rank", F.lit(0)))


def keyed(key: str) -> Column:
    return F.struct("config", F.col(key).alias("id"))


def marked() -> Column:
    return F.concat("config", F.lit(MARK), "term")
