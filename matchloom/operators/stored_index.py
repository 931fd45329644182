"""An index that outlives its session: bucketed tables that later sessions open and join without an exchange.

``save`` writes texts, postings and vector lengths bucketed and sorted by text, beside the vocabulary, the documents and one row of
facts. ``open_index`` declares the buckets again, so that every join and sum by text reads them in place: postings
are neither tokenised nor shuffled again, however many sessions search them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from matchloom.operators.sparse import SparseIndex
from matchloom.session import partitions

BUCKETED = ("texts", "counts", "norms")
FACTS = ("weighting", "analyzer", "n_docs", "mean_words", "vocabulary_rows", "vocabulary_bytes", "postings", "n_texts", "negative")


def _table(part: str) -> str:
    return f"matchloom_{part}_{uuid.uuid4().hex}"


def save(index: SparseIndex, path: str, buckets: int | None = None) -> None:
    """Write ``index`` below ``path``, which must not exist yet. The facts come last: without them the index cannot be opened."""
    spark = index.docs.sparkSession
    n = buckets or partitions(spark)
    parts = {"texts": index.kept[0], "counts": index.counts} | ({"norms": index.norms} if index.norms is not None else {})
    for part, df in parts.items():
        name = _table(part)
        (df.repartition(n, "text_id").write.bucketBy(n, "text_id").sortBy("text_id").option("path", f"{path}/{part}").saveAsTable(name))
        spark.sql(f"DROP TABLE {name}")                     # the files stay: the table lies at a path of its own
    index.vocabulary.write.parquet(f"{path}/vocabulary")
    index.docs.write.parquet(f"{path}/docs")
    values = [F.lit(getattr(index, f)).alias(f) for f in FACTS]
    spark.range(1).select(*values, F.lit(n).alias("buckets")).coalesce(1).write.parquet(f"{path}/facts")


def _opened(spark: SparkSession, path: str, part: str, buckets: int) -> DataFrame:
    name = _table(part)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{path}/{part}").schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (text_id) SORTED BY (text_id) INTO {buckets} BUCKETS LOCATION '{path}/{part}'")
    return spark.table(name)


def open_index(spark: SparkSession, path: str) -> SparseIndex:
    facts = spark.read.parquet(f"{path}/facts").first().asDict()
    opened = {part: _opened(spark, path, part, facts["buckets"]) for part in BUCKETED if part != "norms" or facts["weighting"] == "tfidf"}
    return SparseIndex(docs=spark.read.parquet(f"{path}/docs"), counts=opened["counts"], vocabulary=spark.read.parquet(f"{path}/vocabulary"),
                       norms=opened.get("norms"), kept=[opened["texts"]], **{f: facts[f] for f in FACTS})
