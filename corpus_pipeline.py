"""Training-data pipeline over ``documents``: quality rules, near-duplicates, decontamination, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet into the shared
folder and rereads it as the next stage's docs. Stages keep the columns of documents, whatever they are, but
for the last, which returns one row per written document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchloom.llm.common import scratch, stored, table
from matchloom.llm.decontaminate import drop_contaminated
from matchloom.llm.mixing import mixed_rows
from matchloom.llm.neardup import drop_near_duplicates
from matchloom.llm.quality import filter_quality
from matchloom.llm.tokens import encode_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return filter_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, similarity 0.8 or more."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without enough benchmark passages to count as contaminated."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, shuffled within its shards."""
    return mixed_rows(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mix in binary shards; the rows read back from them."""
    return encode_documents(docs, scratch(spark, "tokens"))


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source mix", source_mix),
    ("token shards", token_shards),
]

#: Compression ratios, signatures and tokenizers have no SQL; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
