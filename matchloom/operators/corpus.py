"""Distinct texts with their copies, and their terms.

A text that occurs many times is scored once. Counts of copies keep document frequencies and averages
equal to those over all rows, and a group of copies of any size collapses before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from matchloom.session import partitions

WORD, WORD_PAIRS, CHAR = "word", "word12", "char35"
HELD_TERMS = 1 << 19       # terms that a task counts before it hands them on
PARTS = 4                  # parts of the terms for each shuffle partition


def distinct_texts(df: DataFrame, id_col: str, text: str = "norm") -> DataFrame:
    """One row per distinct text: its lowest id as ``text_id``, number of copies and of words."""
    return (df.groupBy(F.col(text).alias("norm"))
            .agg(F.min(id_col).alias("text_id"), F.count(F.lit(1)).alias("copies"))
            .withColumn("words", F.when(F.col("norm") == "", 0).otherwise(F.size(F.split("norm", " ")))))


def first_copies(df: DataFrame, id_col: str, k: int, text: str = "norm") -> DataFrame:
    """The ``k`` lowest ids of every text: no other copy can reach a top ``k`` with ties broken by id.

    The row limit per group is applied before the shuffle, so a large group of copies sends k rows per task.
    """
    keyed = df.select(F.sha2(F.col(text), 256).alias("text_key"), F.col(id_col).alias("doc_id"))
    order = Window.partitionBy("text_key").orderBy("doc_id")
    return (keyed.withColumn("copy", F.row_number().over(order)).filter(F.col("copy") <= k)
            .withColumn("text_id", F.min("doc_id").over(Window.partitionBy("text_key")))
            .select("text_id", "doc_id"))


def by_text(texts: DataFrame) -> DataFrame:
    """Move the compact texts once; all term counting below then needs no further shuffle."""
    return texts.repartition(partitions(texts.sparkSession), "text_id")


def term_counts(texts: DataFrame, analyzer: str, more: list[str] | None = None) -> DataFrame:
    """(text_id, copies, words, term, tf). ``texts`` comes from :func:`by_text`; ``more`` names further columns of the key."""
    keys = ["text_id", "copies", "words", *(more or [])]
    filled = texts.filter(F.col("norm") != "")
    if analyzer == CHAR:
        return char_counts(word_counts(filled, keys), keys)
    if analyzer == WORD_PAIRS:
        words = F.split("norm", " ")
        rest = F.size(words) - 1
        pairs = F.zip_with(F.slice(words, F.lit(1), rest), F.slice(words, F.lit(2), rest),
                           lambda a, b: F.concat_ws(" ", a, b))
        return (filled.select(*keys, F.explode(F.concat(words, pairs)).alias("term"))
                .groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf")))
    return word_counts(filled, keys)


def word_counts(texts: DataFrame, keys: list[str]) -> DataFrame:
    return (texts.select(*keys, F.explode(F.split("norm", " ")).alias("term"))
            .groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf")))


def char_counts(words: DataFrame, keys: list[str]) -> DataFrame:
    """Character 3- to 5-grams inside blank-padded words, from counted words."""
    return (words.select(*keys, "tf", F.explode(gram_spans("term")).alias("span"), padded("term").alias("word"))
            .select(*keys, "tf", "word", (F.floor(F.col("span") / F.length("word")) + 3).cast("int").alias("n"),
                    (F.col("span") % F.length("word") + 1).cast("int").alias("at"))
            .filter(F.col("at") <= F.length("word") - F.col("n") + 1)
            .select(*keys, "tf", F.substring("word", F.col("at"), F.col("n")).alias("term"))
            .groupBy(*keys, "term").agg(F.sum("tf").alias("tf")))


def padded(word: str):
    return F.concat(F.lit(" "), F.col(word), F.lit(" "))


def gram_spans(word: str):
    """Numbers that encode (length, position) of each gram; a short word keeps one gram, itself padded."""
    size = F.length(word) + 2
    return F.sequence(F.lit(0), size * 3 - 1)


def document_frequencies(texts: DataFrame, analyzer: str) -> DataFrame:
    """(term, df, text_df): copies and texts that hold a term. ``texts``: norm, copies.

    A task reads each text once and adds up per term what it has seen, so neither a text's terms nor pairs of text and term are
    shuffled or held; it hands its counts on whenever it holds HELD_TERMS of them: sorted and compressed, one packet for each part of the terms.
    """
    parts = PARTS * partitions(texts.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen(analyzer)
        for batch in batches:
            for norm, copies in zip(batch.column("norm"), batch.column("copies").to_pylist()):
                seen.add(norm.as_py(), copies)
                if seen.full():
                    yield seen.packets(parts)
                    seen = Seen(analyzer)
        yield seen.packets(parts)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own = None, []
        for batch in batches:
            for number, packet in zip(batch.column("part").to_pylist(), batch.column("packet")):
                if number != part:
                    yield from total(own)
                    part, own = number, []
                own.append(pa.ipc.open_stream(packet.as_buffer()).read_all())
        yield from total(own)

    packets = texts.select("norm", "copies").mapInArrow(counted, "part int, packet binary")
    return packets.repartition("part").sortWithinPartitions("part").mapInArrow(added, "term string, df long, text_df long")


def total(counts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
    if counts:
        sums = pa.concat_tables(counts).group_by("term").aggregate([("df", "sum"), ("text_df", "sum")])
        yield from sums.select(["term", "df_sum", "text_df_sum"]).rename_columns(["term", "df", "text_df"]).combine_chunks().to_batches(1 << 16)


class Seen:
    """Frequencies of the terms of some texts."""

    def __init__(self, analyzer: str) -> None:
        self.analyzer, self.numbers, self.grams = analyzer, {}, {}
        self.df, self.text_df = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)

    def number(self, term: str) -> int:
        return self.numbers.setdefault(term, len(self.numbers))

    def add(self, norm: str | None, copies: int) -> None:
        if not norm:
            return
        words = norm.split(" ")
        if self.analyzer == CHAR:
            own = np.unique(np.concatenate([self._grams(word) for word in set(words)]))
        else:
            terms = set(words)
            if self.analyzer == WORD_PAIRS:
                terms.update(map(" ".join, zip(words, words[1:])))
            own = np.fromiter(map(self.number, terms), np.int64, len(terms))
        if len(self.numbers) > len(self.df):
            self.df, self.text_df = (np.concatenate([c, np.zeros(2 * len(self.numbers) - len(c), np.int64)]) for c in (self.df, self.text_df))
        self.df[own] += copies
        self.text_df[own] += 1

    def _grams(self, word: str) -> np.ndarray:
        if word not in self.grams:
            whole = f" {word} "
            spans = {whole[at:at + n] for n in (3, 4, 5) for at in range(len(whole) - n + 1)}
            self.grams[word] = np.fromiter(map(self.number, spans), np.int64, len(spans))
        return self.grams[word]

    def full(self) -> bool:
        return len(self.numbers) + len(self.grams) >= HELD_TERMS

    def counts(self) -> pa.RecordBatch:
        n = len(self.numbers)
        return pa.RecordBatch.from_arrays([pa.array(list(self.numbers), pa.string()), pa.array(self.df[:n]), pa.array(self.text_df[:n])],
                                          names=["term", "df", "text_df"])

    def packets(self, parts: int) -> pa.RecordBatch:
        """(part, packet): the counts of the terms of one part of all terms, in order of the terms."""
        counts = self.counts()
        own = np.fromiter((crc32(t.encode("utf-8", "surrogatepass")) % parts for t in self.numbers), np.int64, len(counts))
        order = pc.sort_indices(counts.column("term")).to_numpy()
        order = order[np.argsort(own[order], kind="stable")]
        counts, own = counts.take(pa.array(order)), own[order]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, int)
        packets = []
        for start, end in zip(first, np.append(first, len(own))[1:]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, counts.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(counts.slice(start, end - start))
            packets.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(own[first].astype(np.int32)), pa.array(packets, pa.binary())], names=["part", "packet"])
