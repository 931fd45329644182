"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is cut into permuted blocks (documents are dealt to blocks by a hash). A source whose target is
above its size is passed several times; a pass that is needed in part draws blocks until their words fill the
target. The number of block units per source is an exact quota. The tree splits the quotas of a node between
its two halves by drawing exactly half of its units without replacement, which is the multivariate
hypergeometric distribution; its leaves are the output shards. Each shard then takes the next units of every
source's permutation, so shards are disjoint, and orders its rows by a hash.

Only DataFrame operations. Everything but the mix itself works on one row per block or per source, whatever the number of
documents; documents are shuffled once, to their shards.

Defined results: null or blank text has size 0; a null source is a source of its own, the last. Rows that repeat
a document are mixed like other rows. Empty input gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from matchloom.llm.common import NOT_SPACE, broadcast_if_small, stored, table

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCKS = 256               # blocks per source: the finest share of a source that is drawn or left
LEVELS = 6                 # 2 ** LEVELS output shards at least
SHARD_WORDS = 1 << 24
SEED = 20


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(NOT_SPACE)).cast("long")


def draw(*parts) -> Column:
    """Uniform number for the draw named by ``parts``; the seed makes reruns agree."""
    return F.xxhash64(F.lit(SEED), *parts)


def source_targets(sources: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sources``: source, size. Adds ``target``: the total shared by weight, no source above ``cap`` times its size.

    The excess of capped sources is reshared by weight until none is above. In ascending order of size per weight,
    a source is capped if its cap is below its share of what the sources before it leave.
    The windows below run over one row per source.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(named) - 1, F.lit(len(weights))) + 1))
    everything = Window.partitionBy(F.lit(0))
    by_room = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    caps = ranked.withColumn("cap", F.lit(float(cap)) * F.col("size"))
    level = ((F.sum("size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    levels = caps.withColumn("level", level).withColumn("full", F.col("cap") / F.col("weight") < F.col("level"))
    share = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    return levels.select("source", "size", F.when(F.col("full"), F.col("cap"))
                         .otherwise(F.least(F.col("cap"), share * F.col("weight"))).alias("target"))


def block_units(blocks: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, block, pass, unit): which blocks each pass takes, numbered in the order of the permutation.

    The last pass goes through the permuted blocks of a source (at most BLOCKS) and takes each that still fits; then the
    smallest one left joins if that comes nearer to the target.
    """
    per_source = blocks.groupBy("source").agg(F.array_sort(F.collect_list(F.struct(
        draw(F.lit("block"), "source", "block").alias("at"), "block", "words"))).alias("blocks"))
    state = F.struct(F.lit(0).cast("long").alias("words"), F.array().cast("array<int>").alias("taken"))

    def step(kept: Column, b: Column) -> Column:
        fits = (b["words"] > 0) & (kept["words"] + b["words"] <= F.col("rest"))            # blocks without words have had their passes
        return F.when(fits, F.struct((kept["words"] + b["words"]).alias("words"),
                                     F.concat(kept["taken"], F.array(b["block"])).alias("taken"))).otherwise(kept)

    drawn = (per_source.join(targets, per_source["source"].eqNullSafe(targets["source"])).drop(targets["source"])
             .withColumn("passes", F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0).cast("int"))
             .withColumn("rest", F.col("target") - F.col("passes") * F.col("size"))
             .withColumn("part", F.aggregate("blocks", state, step))
             .withColumn("over", F.array_min(F.transform(
                 F.filter("blocks", lambda b: (b["words"] > 0) & ~F.array_contains(F.col("part.taken"), b["block"])),
                 lambda b: F.struct(b["words"], b["block"]))))
             .withColumn("taken", F.when(F.col("over.words") - (F.col("rest") - F.col("part.words"))
                                         < F.col("rest") - F.col("part.words"),
                                         F.concat("part.taken", F.array("over.block"))).otherwise(F.col("part.taken"))))
    whole = F.flatten(F.transform(F.when(F.col("passes") > 0, F.sequence(F.lit(1), "passes")).otherwise(F.array().cast("array<int>")),
                                  lambda p: F.transform("blocks", lambda b: F.struct(b["block"], p.alias("pass")))))
    last = F.transform("taken", lambda b: F.struct(b.alias("block"), (F.col("passes") + 1).alias("pass")))
    return (drawn.select("source", F.posexplode(F.concat(whole, last)).alias("unit", "drawn"))
            .select("source", "drawn.block", "drawn.pass", "unit"))


def split_quotas(quotas: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``quotas``: source, quota. Returns (shard, source, quota), the leaves of the tree.

    At each node the units are drawn in random order, and the first half goes left.
    """
    nodes = quotas.withColumn("node", F.lit(1))
    for _ in range(levels):
        lots = nodes.filter(F.col("quota") > 0).select("node", "source", F.explode(F.sequence(F.lit(1), F.col("quota").cast("int"))).alias("lot"))
        order = Window.partitionBy("node").orderBy(draw(F.lit("lot"), "node", "source", "lot"), F.col("source").asc_nulls_last(), "lot")
        half = 2 * F.row_number().over(order) > F.count(F.lit(1)).over(Window.partitionBy("node"))
        nodes = (lots.select((2 * F.col("node") + half.cast("int")).alias("node"), "source")
                 .groupBy("node", "source").agg(F.count(F.lit(1)).alias("quota")))
    return nodes.select((F.col("node") - F.lit(1 << levels)).alias("shard"), "source", "quota")


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id",
        keep: list[str] | None = None, levels: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Plan a mix. Returns (the input with size, target and draws, the targets per source).

    The mix has 2^``levels`` shards; without a number, as many as keep a shard near SHARD_WORDS words, and 2^LEVELS at least.

    ``draws`` is an array of (shard, pass), one entry for each time the mix takes the row: none to CAP.
    The input's columns, or those named by ``keep``, come back in a struct ``row``.
    """
    names = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sized = docs.select(F.struct(*(keep or docs.columns)).alias("row"), F.col(source).cast("string").alias("source"),
                        word_count(F.col(text)).alias("words"),
                        F.pmod(draw(F.lit("doc"), F.col(key)), F.lit(BLOCKS)).cast("int").alias("block"))
    # at most BLOCKS rows per source, written once: targets, draws and shards all come from here
    blocks = stored(sized.groupBy("source", "block").agg(F.sum("words").alias("words")), "mix-blocks")
    if levels is None:
        words = blocks.agg(F.sum("words")).first()[0] or 0
        levels = max(LEVELS, (words // SHARD_WORDS).bit_length())
    targets = source_targets(blocks.groupBy("source").agg(F.sum("words").alias("size")))
    units = block_units(blocks, targets)
    leaves = split_quotas(units.groupBy("source").agg(F.count(F.lit(1)).alias("quota")), levels)
    first = F.coalesce(F.sum("quota").over(names), F.lit(0))
    dealt = (leaves.withColumn("first", first.cast("int"))
             .select(F.col("source").alias("of"), "shard",
                     F.explode(F.sequence(F.col("first"), F.col("first") + F.col("quota").cast("int") - 1)).alias("no")))
    plan = (units.join(dealt, F.col("source").eqNullSafe(F.col("of")) & (F.col("unit") == F.col("no")))
            .groupBy("source", "block").agg(F.array_sort(F.collect_list(F.struct("shard", "pass"))).alias("draws")))
    plan = (blocks.select("source", "block").alias("b")
            .join(plan.alias("p"), F.col("b.source").eqNullSafe(F.col("p.source")) & (F.col("b.block") == F.col("p.block")), "left")
            .join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
            .select(F.col("b.source").alias("of"), F.col("b.block").alias("in_block"), "size", "target", "draws"))
    mixed = (sized.join(broadcast_if_small(plan), F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("in_block")))
             .select("row", F.col("words").alias("size"), F.col("size").alias("source_size"), "target",
                     F.coalesce("draws", F.array().cast("array<struct<shard:int,pass:int>>")).alias("draws")))
    return mixed, targets


def mixed_rows(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", levels: int | None = None) -> DataFrame:
    """The mix itself: each row as often as it is drawn, shards together, in random order within a shard."""
    mixed, _ = mix(docs, text, source, key, levels=levels)
    drawn = mixed.select("row", F.explode("draws").alias("draw"))
    return (drawn.repartition("draw.shard")
            .sortWithinPartitions("draw.shard", draw(F.lit("row"), f"row.{key}", "draw.pass")).select("row.*"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, _ = mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target",
                        (F.col("size") * F.size("draws")).alias("taken"))


QUERIES = {"op10_mix_sources": (op10_mix_sources, None)}
