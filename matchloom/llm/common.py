"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import string
import sys
import types
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from matchloom.operators.joins import fits_broadcast
from matchloom.operators.storage import shuffles_dropped
from matchloom.session import shared_dir

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row; a lambda that names a column expression would compute it
    again for every element."""
    return F.transform(F.array(value), body)[0]


def split_words(text: Column, separators: str = SPACE) -> Column:
    """Non-empty pieces between separators; null and blank texts give an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), separators), lambda w: w != "")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write to the shared folder and read back, so that a lost executor replays no earlier stage."""
    path = scratch(df.sparkSession, label)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_cache() -> dict:
    """Objects that a Python worker keeps between its tasks (Spark reuses workers); never needed for right results."""
    return sys.modules.setdefault("_matchloom_worker_cache", types.ModuleType("_matchloom_worker_cache")).__dict__


def give_back() -> None:
    """Hand freed memory back to the system at the end of a task: the worker lives on, beside others on its machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)         # glibc has it
    if trim:
        trim(0)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table of this run's own that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


class Tables:
    """Written tables of one run, each deleted as soon as its last reader has written its own."""

    def __init__(self, spark: SparkSession):
        self.spark, self.held = spark, {}

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch(self.spark, label)
        with shuffles_dropped(self.spark):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.held[id(out)] = out, path
        return out

    def discard(self, *tables: DataFrame) -> None:
        for one in tables:
            discard(self.spark, self.held.pop(id(one))[1])


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished steps now; it acts when the driver has collected them."""
    spark.sparkContext._jvm.System.gc()


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """A broadcast hint behind a count of rows and bytes, texts and lists included; beyond the bound the join shuffles."""
    return F.broadcast(df) if fits_broadcast(df) else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that clash with none in ``df`` (case is ignored, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def crc32_sql(text: str) -> str:
    """DuckDB expression for the unsigned CRC-32 of an ASCII text; the polynomial is the usual one, reflected."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)), "
            f"lambda h, b: list_reduce(list_prepend(xor(h, b), range(8)), lambda c, i: {step})), 4294967295)")
