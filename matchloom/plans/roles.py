"""The driver's tables in the roles of a matching job. Every role keeps all rows and whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from matchloom.functions import text as T
from matchloom.operators.joins import spread


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def products(spark: SparkSession, sf: str) -> DataFrame:
    """Catalog of short records: doc_id, name, brand."""
    return spread(table(spark, sf, "part").select(
        F.col("p_partkey").alias("doc_id"),
        F.concat_ws(" ", "p_name", F.col("p_size").cast("string"), F.lit("GR")).alias("name"),
        F.col("p_brand").alias("brand")), "doc_id")


def orders(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled order texts in six writing styles, one per part: query_id, text, gold_id, split."""
    return spread(as_orders(table(spark, sf, "part")), "query_id")


def as_orders(parts: DataFrame) -> DataFrame:
    name, size, brand = F.col("p_name"), F.col("p_size").cast("string"), F.col("p_brand")
    text = (F.when(F.col("p_type") == "ECONOMY", F.concat(F.upper(F.concat_ws(" ", name, size)), F.lit(" GR C/12 UNID")))
            .when(F.col("p_type") == "SMALL", F.concat(name, F.lit(" "), size, F.lit("g")))
            .when(F.col("p_type") == "MEDIUM", F.concat(F.upper(name), F.lit(" CX 12X"), size, F.lit(" GR")))
            .when(F.col("p_type") == "LARGE", F.concat_ws(" ", name, brand, size, F.lit("gramas")))
            .when(F.col("p_type") == "PROMO", F.concat(F.lit("fardo de "), name, F.lit(" da "), brand,
                                                       F.lit(" com "), size, F.lit(" gr cada und")))
            .otherwise(F.concat(name, F.lit(" marca "), brand, F.lit(" sortido"))))
    return parts.select(
        F.col("p_partkey").alias("query_id"), text.alias("text"), F.col("p_partkey").alias("gold_id"),
        F.when(F.col("p_size") <= 25, "val").otherwise("test").alias("split"))


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """Catalog of long records: doc_id, name (the whole text), brand (its source)."""
    return spread(table(spark, sf, "documents").select(
        "doc_id", F.col("text").alias("name"), F.col("source").alias("brand")), "doc_id")


def passages(spark: SparkSession, sf: str) -> DataFrame:
    """Queries against the articles: query_id, text."""
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def requests_seen(spark: SparkSession, sf: str) -> DataFrame:
    """Unlabelled texts: the orders and all user turns, as query_id (string) and text."""
    said = table(spark, sf, "conversations").filter(F.col("role") == "user").select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
        .alias("query_id"), "text")
    asked = orders(spark, sf).select(F.concat(F.lit("o"), F.col("query_id").cast("string")).alias("query_id"), "text")
    return asked.unionByName(said)


def normalised(df: DataFrame, text: str, id_col: str) -> DataFrame:
    return df.select(id_col, T.normalise(F.col(text)).alias("norm"))


def catalog_texts(df: DataFrame, use_brand: bool) -> DataFrame:
    return T.with_document(df, "name", "brand", use_brand).select("doc_id", "norm")
