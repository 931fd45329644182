"""Answer ledgers: JSON lines, appended run by run; the newest answer of a query counts.

The place of a line is its run, its number in the run where it has one, its file and its place in that file. Files of a run
stand in the order of a manifest, and of their names where no manifest lists them; so the newest answer is the same however
the files are listed, split or read. ``compact`` folds finished runs into a table of newest answers with their places; later reads
take that table and the runs after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from matchloom.operators.rerank import BATCH_LEDGER_SCHEMA, LEDGER_SCHEMA, flatten_batches, latest_answers


def append_answers(answers: DataFrame, path: str, run: int) -> None:
    """``answers``: query_id, ranking, and seq where a run may answer a query twice. A rerun of the same run number
    replaces that run's folder only."""
    seq = F.col("seq") if "seq" in answers.columns else F.lit(0)
    answers.select(F.col("query_id").alias("qi"), "ranking", seq.cast("bigint").alias("seq")).write.mode("overwrite").json(f"{path}/run={run}")


def order_files(spark: SparkSession, path: str, run: int, names: list[str]) -> None:
    """Manifest of a run: its files, oldest first. It lies beside the runs, where no reader of answers looks."""
    rows = [(name, number) for number, name in enumerate(names)]
    spark.createDataFrame(rows, "name string, number bigint").coalesce(1).write.mode("overwrite").json(f"{path}/_manifest/run={run}")


def _manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """run, name, number of every listed file, if the ledger has manifests."""
    home = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_manifest")
    if not home.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(home):
        return None
    return spark.read.schema("name string, number bigint, run bigint").json(f"{path}/_manifest")


def _lines(spark: SparkSession, path: str, schema: str, after: int | None = None) -> DataFrame:
    """Lines with ``order``, their place among all answers. A line's number counts within one split of one file only, where
    it follows the file; splits follow each other by where they begin."""
    lines = spark.read.schema(schema + ", run bigint").json(path)
    lines = lines if after is None else lines.filter(F.col("run") > after)
    placed = lines.withColumn("name", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)).withColumn(
        "block", F.col("_metadata.file_block_start")).withColumn("line", F.monotonically_increasing_id())
    listed = _manifest(spark, path)
    if listed is None:
        placed = placed.withColumn("number", F.lit(-1).cast("bigint"))
    else:
        # files of one ledger folder, one row each; adaptive execution broadcasts them while they are few
        known = listed.select(F.col("run").alias("_run"), F.col("name").alias("_name"), "number")
        placed = placed.join(known, F.col("run").eqNullSafe(F.col("_run")) & (F.col("name") == F.col("_name")), "left").withColumn("number", F.coalesce("number", F.lit(-1)))
    return placed.withColumn("order", F.struct(F.coalesce("run", F.lit(-1)).alias("run"), F.coalesce("seq", F.lit(-1)).alias("seq"), "number", "name", "block", "line"))


def read_ledger(spark: SparkSession, path: str, after: int | None = None) -> DataFrame:
    """query_id, seq, ranking of all runs (those after ``after``); ``seq`` orders the answers, later lines last."""
    return _lines(spark, path, LEDGER_SCHEMA, after).select(F.col("qi").alias("query_id"), F.col("order").alias("seq"), "ranking")


def newest(ledger: DataFrame) -> DataFrame:
    """query_id, seq, ranking of the newest line of every query."""
    return ledger.groupBy("query_id").agg(F.max(F.struct("seq", "ranking")).alias("last")).select("query_id", "last.*")


def compact(spark: SparkSession, path: str, table: str, run: int) -> None:
    """Newest answers of all runs up to ``run`` as a table version below ``table``. It starts from the version before it, so each
    run is read once. A version is final: its runs must not be written again."""
    done = compacted(spark, table)
    rows = read_ledger(spark, path, done[1] if done else None).filter(F.col("seq.run") <= run)
    merged = newest(rows.unionByName(done[0]) if done else rows)
    merged.repartition("query_id").write.mode("overwrite").parquet(f"{table}/upto={run}")


def compacted(spark: SparkSession, table: str) -> tuple[DataFrame, int] | None:
    """The latest version (query_id, seq, ranking) and its last run; None before the first."""
    home = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
    files = home.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(home):
        return None
    names = [f.getPath() for f in files.listStatus(home)]
    runs = [int(n.getName().split("=")[1]) for n in names if n.getName().startswith("upto=") and files.exists(n.suffix("/_SUCCESS"))]
    return (spark.read.parquet(f"{table}/upto={max(runs)}"), max(runs)) if runs else None


def answered(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """query_id, ranking: the newest answer of every query, from the compacted table and the runs after it if there is one."""
    done = compacted(spark, table) if table else None
    if done is None:
        return latest_answers(read_ledger(spark, path))
    return newest(read_ledger(spark, path, done[1]).unionByName(done[0])).select("query_id", "ranking")


def append_batches(batches: DataFrame, path: str, run: int) -> None:
    """``batches``: batch, rankings (map of query to ranking)."""
    batches.select(F.col("batch").alias("lote"), "rankings").write.mode("overwrite").json(f"{path}/run={run}")


def read_batch_ledger(spark: SparkSession, path: str) -> DataFrame:
    """query_id, ranking from lines that hold the rankings of a whole batch; the last line that names a query counts."""
    return latest_answers(flatten_batches(_lines(spark, path, BATCH_LEDGER_SCHEMA)).select("query_id", F.col("order").alias("seq"), "ranking"))


def read_raw_answers(spark: SparkSession, path: str) -> DataFrame:
    """batch, answer: the service's free text per batch."""
    return spark.read.schema("lote bigint, resposta string").json(path).select(
        F.col("lote").alias("batch"), F.col("resposta").alias("answer"))


def write_raw_answers(answers: DataFrame, path: str) -> None:
    answers.select(F.col("batch").alias("lote"), F.col("answer").alias("resposta")).write.mode("overwrite").json(path)
