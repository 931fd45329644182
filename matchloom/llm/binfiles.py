"""Raw binary files through Spark's own writer.

A row holds the bytes of a whole file (or of one record). The text writer puts them into any store that Spark
can write, with its commit protocol: a task that is lost or repeated leaves no half file behind. The writer ends
every row with ``end``, which the formats here use as their end mark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_files(df: DataFrame, path: str, content: str, folders: list[str], end: str) -> None:
    """One file per combination of ``folders`` values and task, holding ``content`` and ``end`` per row in row order."""
    (df.select(F.col(content).cast("string").alias("value"), *folders)
     .write.partitionBy(*folders).option("lineSep", end).option("compression", "none").text(path))


def read_files(spark, path: str) -> DataFrame:
    """path, length, content and the folder columns; ``content`` is read only if it is used."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(path)
