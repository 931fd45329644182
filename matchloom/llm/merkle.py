"""Merkle manifest of a table: a persistent path-copying tree over row digests.

A leaf is the digest of a row's fields. Per group (source) the leaves stand in key order; every three consecutive nodes
have one parent until one node remains, the group's subroot. The subroots, in group order, form a tree of the same kind:
its last node is the manifest's root.

The tree is built and read in blocks: 3^BLOCK_LEVELS consecutive nodes, aligned at multiples of that number, and the
levels between them and their one common ancestor. A block is one row of bounded size and is handled whole by one task,
whatever its group's size; the ancestors of a level's blocks are the nodes of the next level's blocks.

* Upwards, ``climb`` reduces blocks to their ancestors, level by level, until each group has one node.
* Downwards, ``Blocks.paths`` gives each block the siblings between its ancestor and the root.
* A changed leaf creates a *version* of its block: only the nodes between the leaf and the block's ancestor are copied,
  each from the copied child and the two siblings that the version shares with the untouched tree. The copied ancestor
  continues as a version in the block above, and so to the root. ``Block.version`` does one block; nothing is rebuilt, and
  a leaf that did not change is checked by the same path.

Digests are the lower-case hex of SHA-256, and inputs are concatenated as that text.

Defined results: null fields count as ``-``. A group without a name comes first. Null keys stand before all others in their
group and are never tampered with; rows that repeat a key stand in the order of their leaves, equal rows next to each
other. A lone leaf is its group's subroot, a lone subroot the root; the proof of a lone leaf is the digest of nothing. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from matchloom.llm.common import crc32_sql, stored, table

FANOUT, BLOCK_LEVELS = 3, 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PLACE_BITS = 33            # monotonically_increasing_id: task number above, row number in the task below


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def levels(nodes: Column) -> Column:
    """Levels between ``nodes`` nodes and their one ancestor: the least d with FANOUT^d >= nodes, in whole numbers."""
    powers = [FANOUT ** d for d in range(40)]
    return F.size(F.filter(F.array(*[F.lit(p) for p in powers]), lambda p: p < nodes))


class Block:
    """Consecutive nodes and the levels above them; level 0 holds the nodes themselves."""

    def __init__(self, nodes: list[str], height: int):
        self.levels = [nodes]
        for _ in range(height):
            below = self.levels[-1]
            self.levels.append([digest(*below[i:i + FANOUT]) for i in range(0, len(below), FANOUT)])

    @property
    def ancestor(self) -> str:
        return self.levels[-1][0]

    def siblings(self, at: int) -> list[tuple[str, str]]:
        """(left, right) siblings of node ``at`` and of its ancestors below the top, as joined digests."""
        out = []
        for level in self.levels[:-1]:
            start = at - at % FANOUT
            out.append(("".join(level[start:at]), "".join(level[at + 1:start + FANOUT])))
            at //= FANOUT
        return out

    def version(self, at: int, node: str) -> str:
        """Ancestor in the version where ``node`` stands at ``at``: copies of the path, everything else shared."""
        return folded(node, self.siblings(at))


def folded(node: str, path: list[tuple[str, str]]) -> str:
    for left, right in path:
        node = digest(left, node, right)
    return node


def numbered(nodes: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``nodes`` with ``at``, their place in their group from 0, and ``total``, the group's size.

    Rows are sorted by range, so that a large group lies in several tasks; places come from one count per group and task.
    ``salt`` parts equal rows among tasks.
    """
    keys = [F.col(group).asc_nulls_first(), *order, F.col("salt")]
    spread = nodes.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stored(spread.withColumn("salt", F.monotonically_increasing_id()), "merkle-order")
    placed = placed.withColumn("task", F.shiftright("salt", PLACE_BITS)).withColumn("row", F.col("salt").bitwiseAND((1 << PLACE_BITS) - 1)).drop("salt")
    counted = placed.groupBy(group, "task").agg(F.count("*").alias("rows"), F.min("row").alias("first"))
    before = Window.partitionBy(group).orderBy("task")
    spans = counted.select(
        F.col(group).alias("_group"), F.col("task").alias("_task"),
        (F.sum("rows").over(before) - F.col("rows") - F.col("first")).alias("shift"), F.sum("rows").over(Window.partitionBy(group)).alias("total"))
    joined = placed.join(spans, F.col(group).eqNullSafe(F.col("_group")) & (F.col("task") == F.col("_task")))
    return joined.select(*[c for c in placed.columns if c not in ("task", "row")], (F.col("row") + F.col("shift")).alias("at"), "total")


def blocks_of(nodes: DataFrame, group: str, block_levels: int) -> DataFrame:
    """One row per block: group, block, height (levels up to its ancestor), above (levels from there to the group's last
    node), and its nodes in order. ``nodes`` has at, depth (levels to the group's last node), hash and more columns."""
    width = FANOUT ** block_levels
    members = F.struct("at", *[c for c in nodes.columns if c not in (group, "at", "depth")])
    return nodes.groupBy(group, F.expr(f"at div {width}").alias("block"), "depth").agg(F.sort_array(F.collect_list(members)).alias("nodes")).select(
        group, "block", F.least("depth", F.lit(block_levels)).alias("height"), F.greatest(F.col("depth") - block_levels, F.lit(0)).alias("above"), "nodes")


def climb(blocks: DataFrame, group: str) -> DataFrame:
    """The blocks' ancestors as nodes of the next level: group, at, depth, hash."""
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = [Block([n["hash"] for n in nodes.as_py()], height.as_py()).ancestor for nodes, height in zip(batch.column("nodes"), batch.column("height"))]
            yield pa.RecordBatch.from_arrays([batch.column("group"), batch.column("block"), batch.column("above"), pa.array(tops, pa.string())],
                                             names=["group", "at", "depth", "hash"])

    kind = blocks.schema[group].dataType.simpleString()
    hashes = F.transform("nodes", lambda n: F.struct(n["hash"].alias("hash"))).alias("nodes")
    return blocks.select(F.col(group).alias("group"), "block", "height", "above", hashes).mapInArrow(
        reduce, f"group {kind}, at long, depth int, hash string").withColumnRenamed("group", group)


def descend(blocks: DataFrame, paths: DataFrame | None, group: str, out: str, rows) -> DataFrame:
    """``rows(nodes, height, path)`` of every block, where path is what leads from its ancestor to the last node: arrays of
    left and right siblings, joined on (group, block). ``out`` is the schema of the rows, which ``rows`` yields as tuples."""
    if paths is None:
        joined = blocks.withColumn("lefts", F.array().cast("array<string>")).withColumn("rights", F.array().cast("array<string>"))
    else:
        up = paths.select(F.col(group).alias("_group"), F.col("at").alias("_at"), "lefts", "rights")
        joined = blocks.join(up, F.col(group).eqNullSafe(F.col("_group")) & (F.col("block") == F.col("_at"))).drop("_group", "_at")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                made = list(rows(row["nodes"], row["height"], list(zip(row["lefts"], row["rights"]))))
                columns = list(zip(*made))
                yield pa.RecordBatch.from_arrays([pa.array([row["group"]] * len(made), batch.schema.field("group").type), *[pa.array(c, t) for c, t in zip(columns, kinds)]], names=["group", *names])

    fields = [f.split(" ", 1) for f in out.split(", ")]
    names = [n for n, _ in fields]
    kinds = [{"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}[k] for _, k in fields]
    kind = blocks.schema[group].dataType.simpleString()
    return joined.withColumnRenamed(group, "group").mapInArrow(expand, f"group {kind}, {out}").withColumnRenamed("group", group)


def node_paths(nodes: list[dict], height: int, path: list[tuple[str, str]]) -> Iterator[tuple]:
    block = Block([n["hash"] for n in nodes], height)
    for i, node in enumerate(nodes):
        whole = block.siblings(i) + path
        yield node["at"], [a for a, _ in whole], [b for _, b in whole]


class Forest:
    """The trees of all groups of ``nodes`` (group, at, depth, hash and more): ``tops`` has the last node of each."""

    def __init__(self, nodes: DataFrame, group: str, block_levels: int = BLOCK_LEVELS):
        self.group, self.levels = group, []
        while True:
            blocks = stored(blocks_of(nodes, group, block_levels), "merkle-blocks")
            self.levels.append(blocks)
            nodes = stored(climb(blocks, group), "merkle-nodes")
            if nodes.filter("depth > 0").isEmpty():
                break
        self.tops = nodes.select(group, "hash")

    def paths(self, above: DataFrame | None = None) -> DataFrame | None:
        """(group, at, lefts, rights) of the ancestors of the lowest blocks; ``above`` has what lies beyond each group's
        last node, with at = 0."""
        for blocks in reversed(self.levels[1:]):
            above = stored(descend(blocks, above, self.group, "at long, lefts array<string>, rights array<string>", node_paths), "merkle-paths")
        return above

    def members(self, above: DataFrame | None, out: str, rows) -> DataFrame:
        return descend(self.levels[0], self.paths(above), self.group, out, rows)


def checked(nodes: list[dict], height: int, path: list[tuple[str, str]]) -> Iterator[tuple]:
    """Proof and folded root of every leaf of a block; a changed leaf makes a version, copied up to the root."""
    block = Block([n["hash"] for n in nodes], height)
    beyond = "".join(a + b for a, b in path)
    for i, node in enumerate(nodes):
        own = block.siblings(i)
        yield (node["key"], node["hash"], digest("".join(a + b for a, b in own), beyond),
               folded(block.version(i, node["changed"]), path))


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "source", fields: tuple[str, ...] = FIELDS, changed: Column | None = None,
             block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) per row of ``docs``.

    ``changed`` is the leaf found at verification, as a column over ``docs``; the leaf itself if not given.
    """
    own = leaf([F.col(f) for f in fields])
    leaves = stored(docs.select(F.col(group).alias("group"), F.col(key).alias("key"), own.alias("hash"), (own if changed is None else changed).alias("changed")), "merkle-leaves")
    kind = docs.schema[key].dataType.simpleString()
    if kind not in ("bigint", "string"):
        leaves = leaves.withColumn("key", F.col("key").cast("string"))
    nodes = numbered(leaves, "group", [F.col("key").cast(kind).asc_nulls_first(), F.col("hash")]).withColumn("depth", levels(F.col("total"))).drop("total")
    forest = Forest(nodes, "group", block_levels)
    subroots = numbered(forest.tops.withColumn("all", F.lit(0)).withColumnRenamed("group", "name"), "all", [F.col("name").asc_nulls_first()])
    upper = Forest(subroots.withColumn("depth", levels(F.col("total"))).drop("total"), "all", block_levels)

    def subroot_paths(nodes, height, path):
        block = Block([n["hash"] for n in nodes], height)
        for i, node in enumerate(nodes):
            whole = block.siblings(i) + path
            yield node["name"], node["hash"], folded(node["hash"], whole), [a for a, _ in whole], [b for _, b in whole]

    tops = stored(upper.members(None, "name string, subroot string, root string, lefts array<string>, rights array<string>", subroot_paths)
                  .withColumn("at", F.lit(0).cast("long")), "merkle-subroots")
    above = tops.select(F.col("name").alias("group"), "at", "lefts", "rights")
    shape = "long" if kind == "bigint" else "string"
    rows = forest.members(above, f"key {shape}, leaf string, proof_sha256 string, folded_root string", checked)
    named = tops.select(F.col("name").alias("_group"), "subroot", "root")
    return rows.join(named, F.col("group").eqNullSafe(F.col("_group"))).select(
        F.col("key").cast(kind).alias(key), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents; where 2 divides the crc32 of the decimal doc_id, line feeds were deleted from the text."""
    docs = table(spark, sf_dir, "documents")
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    body = F.when(hit, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return manifest(docs, changed=leaf([body if f == "text" else F.col(f) for f in FIELDS]))


def _field_sql(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}, '-')"


#: The same level by level: all nodes of all trees, then each changed leaf's path with the siblings beside it.
SQL = f"""WITH RECURSIVE l AS (SELECT doc_id, source, sha256(concat({", ".join(map(_field_sql, FIELDS[:4]))}, {_field_sql("text")})) AS leaf,
  CASE WHEN text IS NOT NULL AND {crc32_sql("doc_id::VARCHAR")} % 2 = 0 THEN sha256(concat({", ".join(map(_field_sql, FIELDS[:4]))}, {_field_sql("replace(text, chr(10), '')")})) END AS changed FROM documents),
leaves AS MATERIALIZED (SELECT doc_id, source, leaf, coalesce(changed, leaf) AS changed,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l),
low(source, d, i, h) AS (SELECT source, 0, i, leaf FROM leaves UNION ALL
  SELECT source, d + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER (PARTITION BY source) AS n FROM low) WHERE n > 1 GROUP BY source, d, i // 3),
lows AS MATERIALIZED (SELECT * FROM low),
subs AS MATERIALIZED (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i
  FROM (SELECT source, arg_max(h, d) AS h FROM lows GROUP BY source)),
high(d, i, h) AS (SELECT 0, i, subroot FROM subs UNION ALL
  SELECT d + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER () AS n FROM high) WHERE n > 1 GROUP BY d, i // 3),
nodes AS MATERIALIZED (SELECT 0 AS part, source, d, i, h FROM lows UNION ALL SELECT 1, NULL, d, i, h FROM high),
tops AS (SELECT part, source, max(d) AS top FROM nodes GROUP BY part, source),
sides AS MATERIALIZED (SELECT a.part, a.source, a.d, a.i, string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i) AS lefts,
  string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i) AS rights
  FROM nodes a LEFT JOIN nodes b ON b.part = a.part AND b.source IS NOT DISTINCT FROM a.source AND b.d = a.d AND b.i // 3 = a.i // 3 AND b.i <> a.i GROUP BY ALL),
path(doc_id, leaf, source, step, part, d, i, h, proof) AS (
  SELECT doc_id, leaf, source, 0, 0, 0, i, changed, '' FROM leaves
  UNION ALL
  SELECT p.doc_id, p.leaf, p.source, p.step + 1, CASE WHEN t.top = p.d THEN 1 ELSE p.part END, CASE WHEN t.top = p.d THEN 0 ELSE p.d + 1 END,
    CASE WHEN t.top = p.d THEN s.i ELSE p.i // 3 END,
    CASE WHEN t.top = p.d THEN p.h ELSE sha256(concat(coalesce(g.lefts, ''), p.h, coalesce(g.rights, ''))) END,
    CASE WHEN t.top = p.d THEN p.proof ELSE concat(p.proof, g.lefts, g.rights) END
  FROM path p JOIN tops t ON t.part = p.part AND (t.part = 1 OR t.source IS NOT DISTINCT FROM p.source)
  JOIN subs s ON s.source IS NOT DISTINCT FROM p.source
  LEFT JOIN sides g ON g.part = p.part AND (g.part = 1 OR g.source IS NOT DISTINCT FROM p.source) AND g.d = p.d AND g.i = p.i
  WHERE NOT (p.part = 1 AND t.top = p.d)),
ends AS (SELECT *, row_number() OVER (PARTITION BY doc_id, leaf, source ORDER BY step DESC) AS nth FROM path)
SELECT e.doc_id, e.leaf, s.subroot, r.h AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root, e.h = r.h AS verified
FROM ends e JOIN subs s ON s.source IS NOT DISTINCT FROM e.source, (SELECT arg_max(h, d) AS h FROM high) r WHERE nth = 1
"""

QUERIES = {"op13_merkle_manifest": (op13_merkle_manifest, SQL)}
