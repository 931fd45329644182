"""Joins that stay balanced: broadcast behind a size check, salting for keys that hold too many rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from matchloom.session import partitions

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 128 << 20
HOT_KEYS = 10_000
HOT_ROWS = 1_000_000


def hot_keys(counts: DataFrame, key: str, rows: str, total: int, floor: int = HOT_ROWS,
             other: DataFrame | None = None) -> DataFrame:
    """Keys with so many rows that one task should not hold them, and how many salts each gets.

    A hot key holds more than ``total / HOT_KEYS`` rows, so there are fewer than ``HOT_KEYS`` of them and
    the result may be broadcast whatever the data. ``counts`` has one row per key. ``other`` is the side it will be
    joined with: where that is large for a hot key too, its rows get salts (``across``) as well.
    """
    limit = max(floor, total // HOT_KEYS)
    hot = counts.filter(F.col(rows) > limit).select(F.col(key), F.ceil(F.col(rows) / limit).cast("int").alias("salts"))
    if other is None:
        return hot.withColumn("across", F.lit(1))
    sizes = other.join(F.broadcast(hot.select(key)), key).groupBy(key).agg(F.ceil(F.count(F.lit(1)) / limit).cast("int").alias("across"))
    return hot.join(sizes, key, "left").withColumn("across", F.coalesce("across", F.lit(1)))


def salted_join(left: DataFrame, right: DataFrame, key: str, spread_by: str, hot: DataFrame, across_by: str | None = None) -> DataFrame:
    """Inner join of a large ``left`` with ``right`` on ``key``; rows of hot keys go to several tasks.

    A hot key becomes a grid of salts x across cells. A left row picks its line by hashing ``spread_by`` and is repeated
    once per column; a right row picks its column by hashing ``across_by`` and is repeated once per line. Other keys
    are one cell, so nothing else is repeated.
    """
    hot = F.broadcast(hot)
    lines, columns = F.coalesce("salts", F.lit(1)), F.coalesce("across", F.lit(1))
    pick = lambda by, n: F.pmod(F.xxhash64(by), n).cast("int") if by else F.lit(0)
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    cut = left.join(hot, key, "left").withColumn("salt", pick(spread_by, lines)).withColumn("column", every(columns))
    copied = right.join(hot, key, "left").withColumn("column", pick(across_by, columns)).withColumn("salt", every(lines))
    return (cut.drop("salts", "across").join(copied.drop("salts", "across"), [key, "salt", "column"]).drop("salt", "column"))


def lookup(left: DataFrame, table: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join with a table whose key is unique; it is broadcast when its measured size allows.

    Beyond that size the shuffle join takes over, where adaptive execution splits skewed left partitions.
    """
    if fits_broadcast(table):
        table = F.broadcast(table)
    return left.join(table, key, how)


def _width(c: Column, kind: T.DataType) -> Column:
    """Bytes of a value, nested ones included."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.aggregate(c, F.lit(16).cast("long"), lambda total, x: total + _width(x, kind.elementType).cast("long")), F.lit(16).cast("long"))
    if isinstance(kind, T.MapType):
        return _width(F.map_entries(c), T.ArrayType(T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])))
    if isinstance(kind, T.StructType):
        return sum((_width(c[f.name], f.dataType) for f in kind), F.lit(16))
    return F.lit(16)


def fits_broadcast(table: DataFrame) -> bool:
    """Measure rows and bytes in one distributed pass."""
    width = sum((_width(F.col(f.name), f.dataType) for f in table.schema), F.lit(16))
    size = table.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return size["rows"] <= BROADCAST_ROWS and size["bytes"] <= BROADCAST_BYTES


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a scan with fewer splits than cores (small or unsplittable files) enough parallel tasks."""
    spark = df.sparkSession
    wanted = min(partitions(spark), spark.sparkContext.defaultParallelism)
    if df.rdd.getNumPartitions() >= wanted:
        return df
    return df.repartition(wanted, *keys)
