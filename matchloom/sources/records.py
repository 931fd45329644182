"""Reading and writing the files of a matching job. Every input column is a string: ids keep leading zeros."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from matchloom.operators.storage import shuffles_dropped

CATALOG = T.StructType([T.StructField(c, T.StringType()) for c in ("product_id", "product_name", "brand_name")])
QUERIES = T.StructType([T.StructField(c, T.StringType()) for c in ("text", "matched_id")])


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """Headed CSV, quoted commas kept; without a schema the header names the columns, a byte-order mark aside."""
    reader = spark.read.option("header", True).option("escape", '"').option("encoding", "UTF-8")
    if schema is not None:
        return reader.schema(schema).csv(path)
    df = reader.csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def number_rows(scan: DataFrame, out: str = "query_id") -> DataFrame:
    """Dense numbers from 0 in scan order, for data straight from a file scan.

    Only the row counts per split (one row each) are put in sequence; the rows themselves do not move.
    Number once at ingest and store the result: later runs must not number again.
    """
    tagged = scan.withColumn("_id", F.monotonically_increasing_id())
    tagged = tagged.withColumn("_split", F.shiftrightunsigned("_id", 33)).withColumn(
        "_at", F.col("_id").bitwiseAND((1 << 33) - 1))
    counts = tagged.groupBy("_split").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_split", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (tagged.join(F.broadcast(starts), "_split").withColumn(out, F.col("_start") + F.col("_at"))
            .select(out, *scan.columns))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, CATALOG).select(
        F.col("product_id").alias("doc_id"), F.col("product_name").alias("name"), F.col("brand_name").alias("brand"))


def read_queries(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """query_id, text, gold_id and, when given, the split the file stands for."""
    df = number_rows(read_csv(spark, path, QUERIES)).withColumnRenamed("matched_id", "gold_id")
    return df if split is None else df.withColumn("split", F.lit(split))


def split_path(folder: str, split: str) -> str:
    if split not in ("val", "test"):
        raise ValueError(f"unknown split: {split}")
    return f"{folder}/queries_{split}.csv"


def read_predictions(spark: SparkSession, paths: dict[str, str], rank: str) -> DataFrame:
    """Prediction files of several systems in one table: system, its rows, integer rank."""
    out = None
    for system, path in paths.items():
        df = read_csv(spark, path).withColumn("system", F.lit(system)).withColumn("rank", F.col(rank).cast("int"))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def write_ranking(ranked: DataFrame, path: str, split: str) -> None:
    """Long ranking as Parquet, one folder per split."""
    ranked.withColumn("split", F.lit(split)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("split").parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    """Wide predictions, metrics, segments: headed CSV files, written by all tasks."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
