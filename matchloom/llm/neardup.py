"""MinHash near-duplicates with sequential Bayesian verification.

1. A document's set holds the hashes of its distinct word shingles; a signature keeps their minimum under 128
   hash functions. Equal texts share one node, so copies are never compared.
2. Bands of four minima put similar nodes into common buckets: two sets of similarity 0.8 miss each other with
   probability 5e-8.
3. A pair's signatures are compared 32 minima at a time. After each batch the posterior of its similarity (uniform
   prior, so a beta distribution) tells the chance that it reaches the threshold; below MISS the pair is dropped.
   In each bucket all nodes are compared with its smallest one, and what survives joins nodes into clouds; buckets
   that still meet several clouds then try every pair across them. No likely pair is left between two clouds.
4. Inside a cloud, likely pairs are verified on their whole sets, in cells whose bytes are bounded. A small cloud is
   one cell. A large one is cut into blocks: each block is done with itself and with a few pivots, and only nodes
   that are not yet in the cloud's major component go on to meet the other blocks.
   A task hands on links that join something new, so no step writes more rows than it reads.

Defined results: null, blank and empty texts have no set and stand alone. Rows that repeat a text share its
component. The smallest key of a component names it; a null key is never the smallest unless there is no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import groupby
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from matchloom.llm.common import Tables, fold_ascii, fresh, give_back, let, release_shuffles, split_words, stored, table
from matchloom.llm.components import components

MINIMA, ROWS, BATCH = 128, 4, 32
PERCENT = 80
MISS = 1e-6                # accepted chance, per batch, to drop a pair that reaches the threshold
CELL_NODES = 1024          # signatures on one side of a cell
CELL_BYTES = 8 << 20       # signatures and sets of a block
PIVOTS = 8
SEED = 8


def shingle_set(words: Column, span: int) -> Column:
    """Hashes of the distinct runs of ``span`` words; a shorter text is one run, a text without words has none."""
    def runs(w: Column) -> Column:
        last = F.greatest(F.size(w) - span + 1, F.lit(1))
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(
            F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(w, i, span)))))

    return let(words, runs)


def hash_functions(minima: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 32, (2, minima), dtype=np.uint32) | np.uint32(1)


def signatures(values: np.ndarray, starts: np.ndarray, minima: int = MINIMA) -> np.ndarray:
    """Minima of each run of ``values`` (64-bit hashes) from ``starts`` on; no run may be empty."""
    a, b = hash_functions(minima)
    out = np.empty((len(starts), minima), np.uint32)
    ends = np.append(starts[1:], len(values))
    first = 0
    while first < len(starts):                             # pieces that fit the processor's cache
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + 65_536, "right")))
        piece = values[starts[first]:ends[last - 1]]
        high, low = (piece >> np.uint64(32)).astype(np.uint32), piece.astype(np.uint32)
        at = starts[first:last] - starts[first]
        for k in range(minima):
            out[first:last, k] = np.minimum.reduceat(high * a[k] + low * b[k], at)
        first = last
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = batch.column("shingles")
        offsets = np.asarray(sets.offsets, dtype=np.int64)
        sizes = np.diff(offsets)
        values = np.asarray(sets.values).view(np.uint64)[offsets[0]:offsets[-1]]
        found = np.full(len(sizes), None, dtype=object)
        filled = np.flatnonzero(sizes)
        if len(filled):
            found[filled] = [row.tobytes() for row in signatures(values, (offsets - offsets[0])[:-1][filled])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("node"), pa.array(sizes), pa.array(found, pa.binary())],
            ["doc", "node", "n_shingles", "minima"])
    give_back()


def least_matches(threshold: float, miss: float = MISS, minima: int = MINIMA) -> list[tuple[int, int]]:
    """(minima compared, matches needed to go on). With a uniform prior, m matches in n give similarity a
    Beta(m + 1, n - m + 1) posterior; its part above t is the chance of at most m successes in n + 1 draws of t."""
    out = []
    for n in [*range(BATCH, minima, BATCH), minima]:
        below, need = 0.0, 0
        while True:
            below += comb(n + 1, need) * threshold ** need * (1 - threshold) ** (n + 1 - need)
            if below >= miss:
                break
            need += 1
        out.append((n, need))
    return out


def surviving(left: np.ndarray, right: np.ndarray, limits: list[tuple[int, int]]) -> np.ndarray:
    """Positions of the row pairs whose posterior stays above the miss probability through all batches."""
    alive, matches, done = np.arange(len(left)), np.zeros(len(left), np.int64), 0
    for n, need in limits:
        matches = matches + (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
        keep = matches >= need
        alive, matches, done = alive[keep], matches[keep], n
    return alive


def _minima(column: list[bytes], code: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), code).reshape(len(column), -1)


def _likely(limits: list[tuple[int, int]], code: str):
    def likely(left: pd.Series, right: pd.Series) -> pd.Series:
        out = np.zeros(len(left), bool)
        if len(left):
            out[surviving(_minima(left.tolist(), code), _minima(right.tolist(), code), limits)] = True
        return pd.Series(out)

    return F.pandas_udf(likely, "boolean")


class Cell:
    """Nodes of one task's unit of work, with their group so far; ``left`` nodes are held against all ``right`` ones."""

    def __init__(self, rows: list[dict], code: str):
        self.nodes = [r["node"] for r in rows]
        self.right = np.array([r["right"] for r in rows])
        self.minima = _minima([r["minima"] for r in rows], code)
        self.group = np.unique([r["root"] for r in rows], return_inverse=True)[1]
        self.sets = [r["shingles"] for r in rows] if "shingles" in rows[0] else None

    def links(self, limits: list[tuple[int, int]], percent: int) -> Iterator[tuple[bytes, bytes]]:
        """Links that join groups: likely pairs, or pairs that reach ``percent`` where the sets are given."""
        if self.sets is not None:
            sizes = np.array([len(x) for x in self.sets])
            tokens = np.unique(np.concatenate(self.sets), return_inverse=True)[1]
            starts = np.cumsum(sizes) - sizes
            mark = np.zeros(tokens.max() + 1, np.int32)
        rights = np.flatnonzero(self.right)
        for x in np.flatnonzero(~self.right) if len(rights) < len(self.nodes) else rights:
            others = rights[self.group[rights] != self.group[x]]
            if not len(others):
                continue
            others = others[surviving(np.broadcast_to(self.minima[x], (len(others), self.minima.shape[1])), self.minima[others], limits)]
            if self.sets is not None and len(others):
                own = tokens[starts[x]:starts[x] + sizes[x]]
                mark[own] = 1
                if 4 * len(others) > len(self.nodes):
                    common = np.add.reduceat(mark[tokens], starts)[others]
                else:
                    common = np.array([mark[tokens[starts[y]:starts[y] + sizes[y]]].sum() for y in others])
                mark[own] = 0
                others = others[100 * common >= percent * (sizes[x] + sizes[others] - common)]
            for y in others:
                if self.group[y] != self.group[x]:
                    self.group[self.group == self.group[y]] = self.group[x]
                    yield self.nodes[x], self.nodes[y]


def _whole_sets(column: pa.Array) -> Iterator[np.ndarray]:
    offsets, values = np.asarray(column.offsets), np.asarray(column.values)
    for first, last in zip(offsets, offsets[1:]):
        yield values[first:last].copy()


def _cell_links(keys: list[str], limits: list[tuple[int, int]], percent: int, code: str, sets_of):
    """Links found in each cell; a partition holds whole cells, sorted by ``keys``."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            names = [n for n in batch.schema.names if n != "shingles"]
            sets = sets_of(batch.column("shingles")) if "shingles" in batch.schema.names else None
            for row in zip(*(batch.column(n).to_pylist() for n in names)):
                row = dict(zip(names, row))
                if sets is not None:
                    row["shingles"] = next(sets)
                yield row

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, cell in groupby(rows(batches), key=lambda r: [r[k] for k in keys]):
            found = list(Cell(list(cell), code).links(limits, percent))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(side) for side in zip(*found)], ["a", "b"])
        give_back()

    return links


class NearDuplicates:
    """Links between nodes (distinct texts) whose sets overlap by at least ``percent`` of their union."""

    band_rows, minima, code = ROWS, MINIMA, "<u4"         # minima to a band, minima in all, and how one is stored
    node_type, sets_of = "binary", staticmethod(_whole_sets)   # what names a node, and how the column of shingles() is read
    slices = 1                                             # parts in which the bands are shuffled

    def __init__(self, docs: DataFrame, span: int = 5, percent: int = PERCENT, text: str = "text", key: str = "doc_id"):
        self.spark, self.span, self.percent = docs.sparkSession, span, percent
        self.tables = Tables(self.spark)
        self.limits = least_matches(percent / 100, minima=self.minima)
        self.minima_bytes = self.minima * np.dtype(self.code).itemsize
        body = F.coalesce(F.col(text), F.lit(""))
        self.texts = docs.select(F.col(key).alias("doc"), F.unhex(F.md5(body)).alias("node"), body.alias("body"))
        self.key_type = docs.schema[key].dataType.simpleString()

    def shingles(self) -> Column:
        return shingle_set(split_words(fold_ascii(F.col("body"))), self.span)

    def sketched(self, schema: str) -> DataFrame:
        return self.texts.select("doc", "node", self.shingles().alias("shingles")).mapInArrow(_sketch, schema)

    def sketch(self) -> tuple[DataFrame, DataFrame]:
        """(one row per document with its set size, one row per node with its signature)."""
        rows = stored(self.sketched(f"doc {self.key_type}, node binary, n_shingles long, minima binary"), "sketch")
        nodes = (rows.filter("n_shingles > 0").groupBy("node")
                 .agg(F.min("doc").alias("doc"), F.first("minima").alias("minima"), F.first("n_shingles").alias("n_shingles")))
        return rows, stored(nodes, "nodes")

    def members(self, nodes: DataFrame) -> list[DataFrame]:
        """(bucket, node, low, more) of all buckets with several nodes, in slices; ``more``: with three and more."""
        width = np.dtype(self.code).itemsize * self.band_rows
        bands, parts = self.minima // self.band_rows, []
        for first in range(0, bands, bands // self.slices):
            numbers = F.sequence(F.lit(first), F.lit(min(first + bands // self.slices, bands) - 1))
            members = nodes.select(F.explode(F.transform(numbers, lambda band: F.xxhash64(
                band, F.substring("minima", band * width + 1, F.lit(width))))).alias("bucket"), "node")
            shared = self.tables.stored(members.groupBy("bucket").agg(F.min("node").alias("low"), F.count(F.lit(1)).alias("members"))
                                        .filter("members > 1").select("bucket", "low", (F.col("members") > 2).alias("more")), "buckets")
            parts.append(self.tables.stored(members.join(shared, "bucket"), "members"))
            self.tables.discard(shared)
            self.settle()
        return parts

    def likely(self, stars: DataFrame, nodes: DataFrame) -> DataFrame:
        """The pairs (a, b) whose signatures survive."""
        left = nodes.select(F.col("node").alias("a"), F.col("minima").alias("left"))
        right = nodes.select(F.col("node").alias("b"), F.col("minima").alias("right"))
        return self.tables.stored(stars.join(right, "b").join(left, "a").filter(_likely(self.limits, self.code)("left", "right")).select("a", "b"), "likely")

    def settle(self) -> None:
        """Between large steps, where bands come in slices to spare disk."""
        if self.slices > 1:
            release_shuffles(self.spark)

    def in_cells(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        """Links (a, b) found in the cells named by ``keys``."""
        sets = ["shingles"] if "shingles" in rows.columns else []
        return (rows.select(*keys, "right", "node", "root", "minima", *sets).repartition(*keys).sortWithinPartitions(*keys)
                .mapInArrow(_cell_links(keys, self.limits, self.percent, self.code, self.sets_of), f"a {self.node_type}, b {self.node_type}"))

    def clouds(self, nodes: DataFrame) -> DataFrame:
        """(node, root): groups such that every likely pair of a bucket lies inside one."""
        parts = self.members(nodes)
        members = reduce(DataFrame.unionByName, parts)
        stars = members.filter("node != low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()
        likely = self.likely(stars, nodes)
        roots = components(likely)
        more = self.tables.stored(self.crossing(members, roots, nodes), "crossing")
        self.tables.discard(likely, *parts)
        self.settle()
        return roots if more.isEmpty() else components(more, roots)

    def crossing(self, members: DataFrame, roots: DataFrame, nodes: DataFrame) -> DataFrame:
        """Likely pairs across clouds in buckets of three or more nodes; the smallest node is done already."""
        others = (members.filter("more AND node != low").select("bucket", "node").join(roots, "node", "left")
                  .withColumn("root", F.coalesce("root", "node")))
        counts = others.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
        several = (counts.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("major"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("roots"))
                   .filter("roots > 1")
                   .select("bucket", F.col("major.root").alias("major"), F.ceil(F.col("all") / CELL_NODES).cast("int").alias("columns"),
                           F.ceil((F.col("all") - F.col("major.n")) / CELL_NODES).cast("int").alias("lines")))
        return self.in_cells(self.minor_by_all(others.join(several, "bucket"), "bucket").join(nodes.select("node", "minima"), "node"), ["bucket", "i", "j"])

    def minor_by_all(self, placed: DataFrame, unit: str) -> DataFrame:
        """Cells (unit, i, j): block i of the nodes outside the unit's major root against block j of all its nodes."""
        block = lambda blocks: F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int")
        every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
        kept = [c for c in ("minima", "shingles") if c in placed.columns]
        lefts = placed.filter("root != major").select(unit, block("lines").alias("i"), every("columns").alias("j"), F.lit(False).alias("right"), "node", "root", *kept)
        rights = placed.select(unit, every("lines").alias("i"), block("columns").alias("j"), F.lit(True).alias("right"), "node", "root", *kept)
        return lefts.unionByName(rights)

    def with_bodies(self, placed: DataFrame) -> DataFrame:
        """Nodes with the text of their first document."""
        texts = self.texts.select(F.col("node").alias("of"), F.col("doc").alias("of_doc"), "body")
        return placed.join(texts, (F.col("node") == F.col("of")) & F.col("doc").eqNullSafe(F.col("of_doc")))

    def roots(self, nodes: DataFrame) -> DataFrame:
        """(node, root) of all nodes that the threshold connects with others, by verified links."""
        clouds = self.clouds(nodes).withColumnRenamed("root", "cloud")
        inside = nodes.join(clouds, "node")
        sizes = clouds.join(nodes.select("node", "n_shingles"), "node").groupBy("cloud").agg(
            F.ceil(F.sum(F.col("n_shingles") * 8 + self.minima_bytes) / CELL_BYTES).cast("int").alias("blocks"))
        placed = inside.join(sizes, "cloud").select("node", "doc", "minima", "cloud", "blocks")
        sets = (self.with_bodies(placed)
                .dropDuplicates(["node"]).select("node", "minima", "cloud", "blocks", self.shingles().alias("shingles")))
        sets = self.tables.stored(sets, "sets")
        self.settle()
        block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        blocks = sets.select("cloud", block.alias("i"), F.lit(True).alias("right"), "node", F.col("node").alias("root"), "minima", "shingles")
        large = sets.filter("blocks > 1")
        if large.isEmpty():
            links = stored(self.in_cells(blocks, ["cloud", "i"]), "links")
            self.tables.discard(sets)
            return components(links)
        first = stored(self.in_cells(blocks.unionByName(self.pivots(large)), ["cloud", "i"]), "links")
        roots = components(first)
        known = (large.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
        counts = known.groupBy("cloud", "root").agg(F.count(F.lit(1)).alias("n"))
        several = (counts.groupBy("cloud").agg(F.max(F.struct("n", "root")).alias("major"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("roots"))
                   .filter("roots > 1").select("cloud", F.col("major.root").alias("major"), (F.col("major.n") / F.col("all")).alias("share")))
        open_ = (known.join(several, "cloud").withColumn("columns", F.col("blocks"))
                 .withColumn("lines", F.greatest(F.lit(1), F.ceil(F.col("blocks") * (1 - F.col("share")))).cast("int")))
        links = stored(self.in_cells(self.minor_by_all(open_, "cloud"), ["cloud", "i", "j"]), "links")
        self.tables.discard(sets)
        return components(links, roots)

    def pivots(self, large: DataFrame) -> DataFrame:
        """The first PIVOTS nodes of each cut cloud, for each of its other blocks."""
        order = Window.partitionBy("cloud").orderBy("node")
        chosen = (large.select("cloud", "node").withColumn("n", F.row_number().over(order)).filter(F.col("n") <= PIVOTS).select("node"))
        own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        return (large.join(chosen, "node", "left_semi").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter(F.col("i") != own)
                .select("cloud", "i", F.lit(True).alias("right"), "node", F.col("node").alias("root"), "minima", "shingles"))

    def resolve(self) -> DataFrame:
        """(doc, node, n_shingles, root, component) per input row; root is the smallest node of the component."""
        rows, nodes = self.sketch()
        roots = self.roots(nodes)
        named = roots.join(nodes.select("node", "doc"), "node")
        lows = named.groupBy("root").agg(F.min("doc").alias("component"))
        labels = named.join(lows, "root").select("node", "root", "component")
        alone = nodes.join(labels, "node", "left_anti").select("node", F.col("node").alias("root"), F.col("doc").alias("component"))
        of_node = labels.unionByName(alone)
        return (rows.select("doc", "node", "n_shingles").join(of_node, "node", "left")
                .withColumn("component", F.when(F.col("n_shingles") == 0, F.col("doc")).otherwise(F.col("component"))))


def near_duplicates(docs: DataFrame, span: int = 5, percent: int = PERCENT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id, kept) per input row."""
    return (NearDuplicates(docs, span, percent, text, key).resolve()
            .select(F.col("doc").alias(key), "n_shingles", F.col("component").alias("component_id"),
                    F.col("doc").eqNullSafe(F.col("component")).alias("kept")))


def drop_near_duplicates(docs: DataFrame, span: int = 5, percent: int = PERCENT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each component, with its columns as they were: that of the smallest key (null last), and among rows of
    one key that of the smallest text digest. Rows that repeat key and text count as one. Texts without words all stay."""
    [key_of, node_of] = fresh(docs, "key_of", "node_of")
    rows = stored(NearDuplicates(docs, span, percent, text, key).resolve().filter("n_shingles > 0").groupBy("root", "doc", "node").agg(
        F.count(F.lit(1)).alias("copies")), "near-duplicates")
    best = rows.groupBy("root").agg(F.min(F.struct(F.col("doc").isNull().alias("unnamed"), "doc", "node")).alias("best"))
    placed = rows.join(best, "root").withColumn("stays", F.col("doc").eqNullSafe(F.col("best.doc")) & (F.col("node") == F.col("best.node")))
    gone = placed.filter("not stays").select(F.col("doc").alias(key_of), F.col("node").alias(node_of))
    repeated = placed.filter("stays and copies > 1").select(F.col("doc").alias(key_of), F.col("node").alias(node_of))
    same = F.col(key).eqNullSafe(F.col(key_of)) & (F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))) == F.col(node_of))
    kept = docs.join(gone, same, "left_anti")
    if repeated.isEmpty():
        return kept
    copies = kept.join(repeated, same)
    return kept.join(repeated, same, "left_anti").unionByName(copies.dropDuplicates([key_of, node_of]).drop(key_of, node_of))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), span=2)


QUERIES = {"op8_near_duplicates": (op8_near_duplicates, None)}
