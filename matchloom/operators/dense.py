"""Exact cosine top k over dense vectors, computed block by block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from matchloom.operators.storage import discard, written
from matchloom.operators.topk import TIE_DIGITS, top_k

BLOCK_BYTES = 32 << 20     # vectors of one document block
GROUP_BYTES = 64 << 20     # vectors of one group of queries
VISITED_BYTES = 2 << 30    # vectors of the visits that are shuffled at once
SCORES = 1 << 20           # scores or angles that a task holds at once
STEP = 10.0 ** -TIE_DIGITS      # scores that far apart differ when rounded
VISIT_ROWS = 1 << 13       # visits, each with its vector, that a task holds at once
TASK_ROWS = 256            # fewer documents are not worth a block of their own
PACKED_BYTES = 4 << 20     # vectors of cells that share a block
CENTRES, CELL_ROWS = 1024, 128
ANGLE_MARGIN = 1e-6        # far above the rounding noise of an angle


def unit_vectors(df: DataFrame, vector: str) -> DataFrame:
    """Scale to length one; a zero vector stays as it is."""
    v = F.col(vector).cast("array<double>")
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return df.withColumn(vector, F.when(length == 0, v).otherwise(F.transform(v, lambda x: x / length)))


def dense_top_k(queries: DataFrame, docs: DataFrame, k: int = 5, block_bytes: int = BLOCK_BYTES, plan: str = "auto") -> DataFrame:
    """``queries``: query_id, vector; ``docs``: doc_id, vector; both of unit length.

    Documents are cut into blocks and queries into groups, and each task holds one block and lets one group stream past it, so every pair
    is scored, in bounded memory (``plan``: "whole", which "auto" takes, since queries may be as many as documents). "cells" cuts
    the documents into cells of neighbouring vectors, and a query goes only to cells that can hold one of its k best.
    """
    spark = docs.sparkSession
    size = docs.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("vector")), F.lit(0)).alias("values")).first()
    if plan == "cells":
        return Cells(docs, size["rows"], size["values"] * 8, block_bytes).search(queries, k)
    asking = queries.agg(F.coalesce(F.sum(F.size("vector")), F.lit(0)).alias("values")).first()["values"] * 8
    cores = spark.sparkContext.defaultParallelism
    blocks = max(1, -(-size["values"] * 8 // block_bytes))
    groups = max(1, -(-asking // GROUP_BYTES), -(-cores // blocks))
    if size["rows"] < TASK_ROWS * cores:                       # too few documents to be met by many tasks
        groups = max(1, -(-asking // GROUP_BYTES))
    places = F.array(*[F.lit(x) for x in one_each(spark, blocks * groups)])
    own, group = (F.pmod(F.xxhash64(key), F.lit(n)).cast("int") for key, n in (("doc_id", blocks), ("query_id", groups)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    placed = docs.select(own.alias("own"), every(groups).alias("group"), "doc_id", "vector")
    asked = queries.select(every(blocks).alias("own"), group.alias("group"), "query_id", "vector")
    place = F.get(places, F.col("own") * groups + F.col("group")).alias("block")
    return top_k(met(asked.select(place, "query_id", "vector"), placed.select(place, "doc_id", "vector"), k, blocks * groups), k)


def one_each(spark: SparkSession, n: int) -> list[int]:
    """``n`` numbers that hash partitioning deals to ``n`` different tasks."""
    number, found = F.col("id").cast("int"), {}
    for first in range(0, 64 * n, 32 * n):
        for r in spark.range(first, first + 32 * n, 1, 1).select(number.alias("id"), F.pmod(F.hash(number), F.lit(n)).alias("task")).collect():
            found.setdefault(r["task"], r["id"])
    used = set(found.values())
    spare = (x for x in range(64 * n) if x not in used)
    return [found[task] if task in found else next(spare) for task in range(n)]


def matrix_of(column: pa.Array) -> np.ndarray:
    if column.null_count:
        raise ValueError("a vector is null")
    rows = np.diff(column.offsets.to_numpy())
    if len(rows) and (rows != rows[0]).any():
        raise ValueError("vectors differ in length")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), rows[0] if len(rows) else 0)


def met(asked: DataFrame, placed: DataFrame, k: int, tasks: int | None = None) -> DataFrame:
    """(query_id, doc_id, score): the k best of each block for each query that goes there. ``asked``: block, query_id, vector;
    ``placed``: block, doc_id, vector. A block's documents come before its queries, which stream past them in batches."""
    query_type, doc_type = asked.schema["query_id"].dataType.simpleString(), placed.schema["doc_id"].dataType.simpleString()
    rows = placed.select("block", F.lit(False).alias("asked"), F.lit(None).cast(query_type).alias("query_id"), "doc_id", "vector").unionByName(
        asked.select("block", F.lit(True).alias("asked"), "query_id", F.lit(None).cast(doc_type).alias("doc_id"), "vector"))
    dealt = rows.repartition(tasks, "block") if tasks else rows.repartition("block")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, parts, matrix, names = None, [], [], None, None
        for batch in batches:
            own, asks = batch.column("block").to_numpy(zero_copy_only=False), batch.column("asked").to_numpy(zero_copy_only=False)
            ends = np.flatnonzero((own[1:] != own[:-1]) | (asks[1:] != asks[:-1])) + 1
            for start, end in zip([0, *ends], [*ends, len(own)]):
                if end == start:
                    continue
                if own[start] != block:
                    block, ids, parts, matrix = own[start], [], [], None
                vectors = matrix_of(batch.column("vector").slice(start, end - start))
                if not asks[start]:
                    ids.append(batch.column("doc_id").slice(start, end - start))
                    parts.append(vectors)
                    continue
                if matrix is None and not parts:
                    continue
                if matrix is None:
                    matrix, names = np.concatenate(parts), pa.concat_arrays(ids)
                    ids, parts = [], []
                asking = batch.column("query_id").slice(start, end - start)
                for at, row, column, score in best_of(vectors, matrix, k):
                    yield pa.RecordBatch.from_arrays([asking.take(pa.array(at + row)), names.take(pa.array(column)), pa.array(score)],
                                                     names=["query_id", "doc_id", "score"])

    return dealt.sortWithinPartitions("block", "asked", "doc_id").mapInArrow(best, f"query_id {query_type}, doc_id {doc_type}, score double")


def best_of(vectors: np.ndarray, matrix: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first, row, column, score) for pieces of ``vectors`` from row ``first`` on: the k best columns of every row. Scores are made tile by
    tile, at most SCORES at once; of a tile, only those that reach the k-th best so far are looked at again."""
    high = max(1, int(SCORES ** 0.5) // 2)
    wide = max(k, SCORES // high)
    for at in range(0, len(vectors), high):
        asking = vectors[at:at + high]
        row = column = np.zeros(0, int)
        score, floor = np.zeros(0), None
        for first in range(0, len(matrix), wide):
            tile = asking @ matrix[first:first + wide].T
            if floor is None:
                near, place = k_best(np.round(tile, TIE_DIGITS), k)
            else:
                near, place = np.nonzero(~(tile < floor[:, None]))             # NaN is kept until it proves to be last
            found = np.round(tile[near, place], TIE_DIGITS)
            row, column, score = np.concatenate([row, near]), np.concatenate([column, place + first]), np.concatenate([score, found])
            order = np.lexsort((column, -score, row))
            row, column, score = row[order], column[order], score[order]
            starts = np.searchsorted(row, row)
            kept = np.arange(len(row)) - starts < k
            row, column, score = row[kept], column[kept], score[kept]
            held = np.bincount(row, minlength=len(asking))
            floor = np.full(len(asking), -np.inf)
            last = np.cumsum(held) - 1
            floor[held >= k] = score[last[held >= k]] - STEP
        yield at, row, column, score


def k_best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``k`` highest scores of every row; of equal scores, those in the lower columns."""
    least = -scores
    if k < scores.shape[1]:
        row, column = np.nonzero(~(least > np.partition(least, k - 1, axis=1)[:, k - 1, None]))      # NaN comes last, as in a sort
    else:
        row, column = (at.ravel() for at in np.indices(scores.shape))
    order = np.lexsort((column, least[row, column], row))
    row, column = row[order], column[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[kept], column[kept]


class Cells:
    """A catalog in cells of neighbouring vectors, each with its centre and radius.

    Centres are a bounded sample of the catalog (at most CENTRES vectors, those of smallest id hash); every vector belongs to its
    nearest centre. No vector of a cell is nearer to a query than the angle to the centre less the radius. A query first meets the cells
    of highest bound that hold k vectors; with the k-th score found there, it meets those others whose bound reaches it. The rest
    is skipped, and skipping loses nothing. Small neighbouring cells are visited together, as one block; a cell above the block size is
    cut into parts, so no task holds more.
    """

    def __init__(self, docs: DataFrame, rows: int, size: int, block_bytes: int = BLOCK_BYTES, centres: int = CENTRES):
        self.spark, self.tables = docs.sparkSession, []
        wanted = max(1, min(centres, rows // CELL_ROWS))
        sample = docs.orderBy(F.xxhash64("doc_id"), "doc_id").limit(wanted).select("vector").collect()
        self.centres = np.array([r["vector"] for r in sample], float)
        kind, centre = docs.schema["doc_id"].dataType.simpleString(), self.centres
        step = max(1, SCORES // max(1, len(centre)))

        def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for at in range(0, len(batch), step):
                    part = batch.iloc[at:at + step]
                    near = np.stack(part["vector"]) @ centre.T
                    yield part.assign(cell=near.argmax(axis=1).astype(np.int32), near=near.max(axis=1))

        self.placed = self.keep(docs.select("doc_id", F.col("vector").cast("array<double>").alias("vector")).mapInPandas(
            assign, f"doc_id {kind}, vector array<double>, cell int, near double"), "dense-cells")
        found = {r.cell: r for r in self.placed.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.min("near").alias("near")).collect()}  # one per centre
        self.rows = np.array([found[c].rows if c in found else 0 for c in range(len(sample))], int)
        self.radius = np.array([np.arccos(np.clip(found[c].near, -1, 1)) if c in found else 0.0 for c in range(len(sample))])
        width = -(-size // max(rows, 1))
        self.blocks, self.parts = self.packed(self.rows * width, block_bytes)

    def packed(self, sizes: np.ndarray, block_bytes: int) -> tuple[np.ndarray, np.ndarray]:
        """The block of every cell, and the parts of every block: small neighbouring cells share one, a large cell is cut."""
        limit, number, held = min(PACKED_BYTES, block_bytes), -1, 0
        if not len(sizes):
            return np.zeros(0, int), np.ones(1, int)
        near = (self.centres @ self.centres[:int(sizes.sum() // limit) + 1].T).argmax(axis=1)
        blocks, parts = np.zeros(len(sizes), int), []
        for cell in np.argsort(near, kind="stable"):
            if number < 0 or held + sizes[cell] > limit:
                number, held = number + 1, 0
                parts.append(1)
            held += sizes[cell]
            blocks[cell], parts[number] = number, max(parts[number], int(-(-sizes[cell] // block_bytes)))
        return blocks, np.array(parts)

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        table, path = written(df, label)
        self.tables.append(path)
        return table

    def release(self) -> None:
        while self.tables:
            discard(self.spark, self.tables.pop())

    def visits(self, queries: DataFrame, k: int, among: tuple[int, int] | None = None) -> DataFrame:
        """(query_id, block, vector): the blocks of the cells to visit. ``queries``: query_id, vector, and floor: null for the
        first visits, else the score to reach, of which the blocks of the first visits are left out. ``among``: first block and the one after the last."""
        centres, rows, radius, blocks = self.centres, self.rows, self.radius, self.blocks
        low, high = among or (0, len(self.parts))

        def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            step = max(1, VISIT_ROWS // len(centres))
            for batch in batches:
                for start in range(0, len(batch), step):
                    part = batch.iloc[start:start + step]
                    vectors = np.stack(part["vector"])
                    angle = np.arccos(np.clip(vectors @ centres.T, -1, 1))
                    bound = np.where(rows > 0, np.cos(np.maximum(angle - radius, 0)), -2.0)
                    order = np.argsort(-bound, axis=1, kind="stable")
                    before = np.cumsum(rows[order], axis=1) - rows[order]      # vectors in the cells of higher bound
                    first = (before < k) & (rows[order] > 0)
                    floor = part["floor"].to_numpy(float)
                    later = (rows[order] > 0) & (np.take_along_axis(bound, order, axis=1) >= floor[:, None] - ANGLE_MARGIN)
                    begins = np.isnan(floor)
                    pairs = [np.unique(at * len(blocks) + blocks[order[at, cell]]) for at, cell in (np.nonzero(first), np.nonzero(later & ~begins[:, None]))]
                    firsts = pairs[0][begins[pairs[0] // len(blocks)]]
                    at, block = np.divmod(np.sort(np.concatenate([firsts, np.setdiff1d(pairs[1], pairs[0], assume_unique=True)])), len(blocks))
                    inside = (block >= low) & (block < high)
                    at, block = at[inside], block[inside]
                    if len(at):
                        yield pd.DataFrame({"query_id": part["query_id"].to_numpy()[at], "block": block.astype(np.int32), "vector": list(vectors[at])})

        kind = queries.schema["query_id"].dataType.simpleString()
        return queries.select("query_id", F.col("vector").cast("array<double>").alias("vector"), "floor").mapInPandas(
            choose, f"query_id {kind}, block int, vector array<double>")

    def scored(self, visits: DataFrame, k: int) -> DataFrame:
        parts, blocks = (F.array(*[F.lit(int(n)) for n in numbers]) for numbers in (self.parts, self.blocks))
        own = F.pmod(F.xxhash64("doc_id"), F.get(parts, F.col("block"))).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.get(parts, F.col("block")) - 1))
        number = F.concat_ws("-", "block", "part")
        return met(visits.withColumn("part", every).select(number.alias("block"), "query_id", "vector"),
                   self.placed.withColumn("block", F.get(blocks, F.col("cell"))).withColumn("part", own).select(number.alias("block"), "doc_id", "vector"), k)

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        if not len(self.centres):                              # an empty catalog
            return top_k(self.placed.select(F.lit(None).cast(queries.schema["query_id"].dataType).alias("query_id"), "doc_id", F.lit(0.0).alias("score")), k)
        size = queries.agg(F.coalesce(F.sum(F.size("vector")), F.lit(0)).alias("values")).first()["values"] * 8
        best = self.keep(top_k(self.scored(self.visits(queries.withColumn("floor", F.lit(None).cast("double")), k), k), k), "dense-best")
        step = max(1, VISITED_BYTES // max(1, size))
        for first in range(0, len(self.parts), step):          # floors rise from round to round, and only a round's visits lie on disk
            floors = best.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(-2.0).alias("floor"))
            again = self.visits(queries.join(floors, "query_id"), k, (first, first + step))
            best = self.keep(top_k(best.drop("rank").unionByName(self.scored(again, k)), k), "dense-best")
            discard(self.spark, self.tables.pop(-2))
        return best
