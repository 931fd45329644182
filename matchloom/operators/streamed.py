"""Weights of long texts, made where a text is read: none of their postings is held, written or shuffled, but rare ones of few texts.

Tasks get a table of the terms that many texts share. A term that lies in one text only needs no row there: as many records
hold it as the text has copies. Where the table would grow too large, it ends at terms of ``least`` records. What a text has of rarer terms
then lies between two weights, which bounds its length and its scores. Of each query only the texts whose upper bound reaches the k-th lower
bound are left, and for these (``with_rare``) the rare terms are looked up, so that every score is exact.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from matchloom.operators import corpus
from matchloom.operators.blockmax import MARGIN
from matchloom.operators.topk import top_k

if TYPE_CHECKING:
    from matchloom.operators.sparse import SparseIndex

TABLE_ROWS, TABLE_BYTES = 1 << 20, 32 << 20      # of the table that every task gets
QUERIES = 4096             # different queries that a task scores each text for
HELD_WORDS = 1 << 17       # words whose grams a task remembers
HELD_SCORES = 1 << 20      # scores that a task holds at once
LEVELS = 20                # of terms by their number of texts, the last one without an upper end
RARE = "array<struct<term:string,idf:double,text_df:bigint>>"


def least_shared(index: "SparseIndex") -> int:
    """Least power of two, 2 or more, such that the terms in so many records, and in two texts at least, fit the table."""
    level = F.floor(F.log2("df")).cast("int")
    sizes = index.vocabulary.filter("text_df > 1").groupBy(level.alias("level")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("term") + 16).alias("bytes")).collect()           # one row per power of two
    rows = held = 0
    for size in sorted(sizes, key=lambda r: -r["level"]):
        rows, held = rows + size["rows"], held + size["bytes"]
        if rows > TABLE_ROWS or held > TABLE_BYTES:
            return 2 << size["level"]
    return 2


class Table:
    """What tasks know: the terms of the queries, then those that many texts share, by rising number of texts. ``asked``: term, idf, text_df."""

    def __init__(self, index: "SparseIndex", asked: DataFrame | None = None, lengths: bool = True):
        spark, self.least = index.docs.sparkSession, least_shared(index) if lengths else 2
        columns = ["term", "idf", "text_df"]
        own = (asked if asked is not None else index.vocabulary.limit(0)).select(*columns).toArrow()
        known = set(own.column("term").to_pylist())
        shared = index.vocabulary.filter(F.col("text_df") > 1).filter(F.col("df") >= self.least) if lengths else index.vocabulary.limit(0)
        rest = shared.select(*columns).toArrow()
        rest = rest.filter(pa.array([t not in known for t in rest.column("term").to_pylist()], pa.bool_()))
        both = pa.concat_tables([own, rest])
        idf, text_df = (both.column(c).to_numpy().astype(float) for c in ("idf", "text_df"))
        self.at = {t: i for i, t in enumerate(own.column("term").to_pylist())}
        self.sent = spark.sparkContext.broadcast({
            "key": uuid.uuid4().hex, "names": both.column("term").to_pylist(), "idf": idf, "text_df": text_df, "asked": len(known),
            "least": self.least, "n": index.n_docs, "analyzer": index.analyzer, "lengths": lengths, "mean_words": index.mean_words})


_reader: dict = {}


class Reader:
    """Terms of texts as numbers: those of the table first, others as they come. One at a time is kept by a worker."""

    @staticmethod
    def of(sent) -> "Reader":
        facts = sent.value
        if facts["key"] not in _reader:
            _reader.clear()
            _reader[facts["key"]] = Reader(facts)
        return _reader[facts["key"]]

    def __init__(self, facts: dict):
        self.facts, self.analyzer, self.names, self.known = facts, facts["analyzer"], list(facts["names"]), len(facts["names"])
        self.numbers, self.grams = {t: i for i, t in enumerate(self.names)}, {}

    def number(self, term: str) -> int:
        n = self.numbers.get(term)
        if n is None:
            n = self.numbers[term] = len(self.names)
            self.names.append(term)
        return n

    def settle(self) -> None:
        if len(self.names) - self.known > corpus.HELD_TERMS or len(self.grams) > HELD_WORDS:
            for term in self.names[self.known:]:
                del self.numbers[term]
            del self.names[self.known:]
            self.grams.clear()

    def counts(self, norm: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(number, tf) of the terms of a text, each once."""
        self.settle()
        if not norm:
            return np.zeros(0, np.int64), np.zeros(0)
        words = norm.split(" ")
        terms = Counter(words)
        if self.analyzer == corpus.CHAR:
            own = [self._grams(word) for word in terms]
            spans = np.repeat(np.fromiter(terms.values(), float, len(terms)), [len(x) for x in own])
            numbers, at = np.unique(np.concatenate(own), return_inverse=True)
            return numbers, np.bincount(at, spans, len(numbers))
        if self.analyzer == corpus.WORD_PAIRS:
            terms.update(map(" ".join, zip(words, words[1:])))
        return np.fromiter(map(self.number, terms), np.int64, len(terms)), np.fromiter(terms.values(), float, len(terms))

    def _grams(self, word: str) -> np.ndarray:
        if word not in self.grams:
            whole = f" {word} "
            spans = [whole[at:at + n] for n in (3, 4, 5) for at in range(len(whole) - n + 1)]
            self.grams[word] = np.fromiter(map(self.number, spans), np.int64, len(spans))
        return self.grams[word]

    def idf(self, df: float) -> float:
        return float(np.log((1.0 + self.facts["n"]) / (1.0 + df)) + 1)

    def weighed(self, norm: str | None, copies: int, rare: list | None) -> tuple[np.ndarray, ...]:
        """(number, tf, least idf, most idf, text_df) of the terms of a text; both idf are the same where it is known."""
        numbers, tf = self.counts(norm)
        low, text_df = np.empty(len(numbers)), np.ones(len(numbers))
        inside = numbers < self.known
        low[inside], text_df[inside] = self.facts["idf"][numbers[inside]], self.facts["text_df"][numbers[inside]]
        high = low.copy()
        outside = np.flatnonzero(~inside)
        least = self.facts["least"] - 1
        low[outside], high[outside] = self.idf(max(copies, least) if rare is None else copies), self.idf(copies)
        if rare:
            found = {r["term"]: (r["idf"], r["text_df"]) for r in rare}
            for i in outside:
                if self.names[numbers[i]] in found:
                    low[i], text_df[i] = found[self.names[numbers[i]]]
                    high[i] = low[i]
        return numbers, tf, low, high, text_df


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    rare = batch.column("rare").to_pylist() if "rare" in batch.schema.names else [None] * len(batch)
    yield from zip(batch.column("norm").to_pylist(), batch.column("copies").to_pylist(), batch.column("words").to_pylist(), rare)


def with_rare(index: "SparseIndex", texts: DataFrame, table: Table) -> DataFrame:
    """``texts`` with the idf of those of their terms that the table lacks and other texts share (``rare``)."""
    texts = texts.select("text_id", "norm", "copies", "words")
    if table.least == 2:
        return texts.withColumn("rare", F.array().cast(RARE))
    kind, sent = texts.schema["text_id"].dataType.simpleString(), table.sent

    def unknown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader.of(sent)
        for batch in batches:
            at, terms = [], []
            for i, (norm, *_) in enumerate(_rows(batch)):
                own = [reader.names[n] for n in reader.counts(norm)[0] if n >= reader.known]
                at += [i] * len(own)
                terms += own
            yield pa.RecordBatch.from_arrays([batch.column("text_id").take(pa.array(at, pa.int64())), pa.array(terms, pa.string())], names=["text_id", "term"])

    rare = texts.mapInArrow(unknown, f"text_id {kind}, term string").join(
        index.vocabulary.filter("text_df > 1").filter(F.col("df") < table.least).select("term", "idf", F.col("text_df").cast("long")), "term")
    lists = rare.groupBy("text_id").agg(F.collect_list(F.struct("term", "idf", "text_df")).alias("rare"))          # of one text
    return texts.join(lists, "text_id", "left").withColumn("rare", F.coalesce("rare", F.array().cast(RARE)))


def best_streamed(index: "SparseIndex", vectors: DataFrame, k: int) -> DataFrame:
    """(qid, text_id, score): all texts that can be among the ``k`` best of a query, scored exactly."""
    asked = vectors.groupBy("term").agg(F.first("idf").alias("idf"), F.first("text_df").alias("text_df"))
    table = Table(index, asked, lengths=index.norms is not None)
    texts = index.kept[0]
    if table.least == 2:
        return _scored(index, table, vectors, texts.select("text_id", "norm", "copies", "words"), k).select("qid", "text_id", F.col("low").alias("score"))
    bounds = index._written(_scored(index, table, vectors, texts.select("text_id", "norm", "copies", "words"), k), "search-bounds")
    best = Window.partitionBy("qid").orderBy(F.desc("low"))
    floors = bounds.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") == k).select("qid", F.col("low").alias("floor"))
    left = index._written(bounds.join(floors, "qid", "left").filter(F.col("high") >= F.coalesce("floor", F.lit(0.0)) - MARGIN).select("text_id").distinct(), "search-left")
    exact = with_rare(index, texts.join(left, "text_id", "left_semi"), table)
    return _scored(index, table, vectors, exact, k).select("qid", "text_id", F.col("low").alias("score"))


def _scored(index: "SparseIndex", table: Table, vectors: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(qid, text_id, low, high): bounds of the score, of the texts of each task that can be among the ``k`` best of a query."""
    rows = vectors.select("qid", "term", "wq").toArrow()
    qids = pa.chunked_array(rows.column("qid")).combine_chunks().unique()
    place = {q: i for i, q in enumerate(qids.to_pylist())}
    term = np.array([table.at[t] for t in rows.column("term").to_pylist()], int)
    order = np.argsort(term, kind="stable")
    query = np.array([place[q] for q in rows.column("qid").to_pylist()], int)[order]
    start = np.searchsorted(term[order], np.arange(len(table.at) + 1))
    asks = index.docs.sparkSession.sparkContext.broadcast({"start": start, "query": query, "wq": rows.column("wq").to_numpy()[order], "qids": qids})
    sent, bm25 = table.sent, index.weighting == "bm25"
    kinds = vectors.schema["qid"].dataType.simpleString(), texts.schema["text_id"].dataType.simpleString()

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from matchloom.operators.sparse import B, K1

        reader, ask = Reader.of(sent), asks.value
        asked, mean, n = reader.facts["asked"], reader.facts["mean_words"], len(ask["qids"])
        start, query, wq = ask["start"], ask["query"], ask["wq"]
        if not n:
            return
        tops, found, held, step = np.zeros((k, n)), [], 0, max(1, HELD_SCORES // n)

        def kept(pieces: list) -> list:
            floor = tops.min(axis=0) - MARGIN
            out = []
            for ids, at, q, low, high in pieces:
                alive = high >= floor[q]
                out.append((ids, at[alive], q[alive], low[alive], high[alive]))
            return out

        for batch in batches:
            ids, texts = batch.column("text_id"), list(_rows(batch))
            for first in range(0, len(texts), step):
                part = texts[first:first + step]
                low, high = np.zeros((len(part), n)), np.zeros((len(part), n))
                for i, (norm, copies, words, rare) in enumerate(part):
                    if bm25:
                        numbers, tf = reader.counts(norm)
                        hit = numbers < asked
                        numbers, tf = numbers[hit], tf[hit]
                        weight = reader.facts["idf"][numbers] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * words / mean))
                        short = long = 1.0
                    else:
                        numbers, tf, less, more, _ = reader.weighed(norm, copies, rare)
                        short, long = float(np.sqrt(((tf * less) ** 2).sum())), float(np.sqrt(((tf * more) ** 2).sum()))
                        hit = numbers < asked
                        numbers, weight = numbers[hit], (tf * less)[hit]
                    if not len(numbers):
                        continue
                    sizes = start[numbers + 1] - start[numbers]
                    at = np.repeat(start[numbers] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                    dot = np.bincount(query[at], np.repeat(weight, sizes) * wq[at], n)
                    low[i], high[i] = dot / long, dot / short
                best_low = low if len(part) <= k else np.partition(low, len(part) - k, axis=0)[-k:]
                tops = np.sort(np.concatenate([tops, best_low]), axis=0)[-k:]
                at, q = np.nonzero((high > 0) & (high >= tops.min(axis=0) - MARGIN))
                found.append((ids, at + first, q, low[at, q], high[at, q]))
                held += len(at)
                if held > HELD_SCORES:
                    found = kept(found)
                    held = sum(len(x[1]) for x in found)
        for ids, at, q, low, high in kept(found):
            yield pa.RecordBatch.from_arrays([ask["qids"].take(pa.array(q)), ids.take(pa.array(at)), pa.array(low), pa.array(high)],
                                             names=["qid", "text_id", "low", "high"])

    return texts.mapInArrow(best, f"qid {kinds[0]}, text_id {kinds[1]}, low double, high double")


def prefix_rows(index: "SparseIndex", threshold: float) -> DataFrame:
    """(text_id, term, wd, size, most, last, levels, rest): the prefixes of ``similar``, of terms that several texts share.

    A level is a power of two of a term's texts, so that the order by texts is one by levels too; last: level of the last term of the
    prefix. One row of a text has no term but the length of its terms of each level (``levels``), and of those behind its prefix (``rest``).
    """
    table = Table(index)
    texts = with_rare(index, index.kept[0], table)
    kind, sent = texts.schema["text_id"].dataType.simpleString(), table.sent

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader.of(sent)
        for batch in batches:
            at, terms, numbers, levels, rests = [], [], [], [], []
            for i, (norm, copies, _, rare) in enumerate(_rows(batch)):
                own, tf, idf, _, text_df = reader.weighed(norm, copies, rare)
                if not len(own):
                    continue
                names = [reader.names[n] for n in own]
                wd = tf * idf
                wd = wd / np.sqrt((wd * wd).sum())
                order = sorted(range(len(own)), key=lambda j: (-text_df[j], names[j]))     # any order that all texts share
                level = np.minimum(np.floor(np.log2(text_df)).astype(int), LEVELS - 1)
                reach = np.sqrt(np.cumsum(wd[order] ** 2))
                most = wd.max()
                inside = reach >= threshold - MARGIN
                behind = np.array(order)[~inside]
                last = level[np.array(order)[inside]].max()                    # its most frequent term is its last
                first = len(at)
                for j in np.array(order)[inside]:
                    if text_df[j] > 1:
                        at.append(i)
                        terms.append(names[j])
                        numbers.append((wd[j], 0, 0.0, 0))
                if len(at) > first:
                    levels += [None] * (len(at) - first) + [np.sqrt(np.bincount(level, wd * wd, LEVELS))]
                    rests += [None] * (len(at) - first) + [np.sqrt(np.bincount(level[behind], wd[behind] ** 2, LEVELS))]
                    at.append(i)
                    terms.append(None)
                    numbers.append((0.0, len(own), most, last))
            values = np.array(numbers).reshape(-1, 4)
            whole = lambda c: pa.array(values[:, c].astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("text_id").take(pa.array(at, pa.int64())), pa.array(terms, pa.string()), pa.array(values[:, 0]), whole(1),
                                              pa.array(values[:, 2]), whole(3), pa.array(levels, pa.list_(pa.float64())), pa.array(rests, pa.list_(pa.float64()))],
                                             names=["text_id", "term", "wd", "size", "most", "last", "levels", "rest"])

    return texts.mapInArrow(rows, f"text_id {kind}, term string, wd double, size int, most double, last int, levels array<double>, rest array<double>")


def shared_weights(index: "SparseIndex", texts: DataFrame) -> DataFrame:
    """(text_id, terms, weights) of some texts: their unit vectors without the terms that no other text has, by term."""
    table = Table(index)
    texts = with_rare(index, texts, table)
    kind, sent = texts.schema["text_id"].dataType.simpleString(), table.sent

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader.of(sent)
        for batch in batches:
            terms, weights = [], []
            for norm, copies, _, rare in _rows(batch):
                own, tf, idf, _, text_df = reader.weighed(norm, copies, rare)
                wd = tf * idf
                wd = wd / (np.sqrt((wd * wd).sum()) or 1.0)
                pairs = sorted((reader.names[own[j]], wd[j]) for j in np.flatnonzero(text_df > 1))
                terms.append([t for t, _ in pairs])
                weights.append([w for _, w in pairs])
            yield pa.RecordBatch.from_arrays([batch.column("text_id"), pa.array(terms, pa.list_(pa.string())), pa.array(weights, pa.list_(pa.float64()))],
                                             names=["text_id", "terms", "weights"])

    return texts.mapInArrow(rows, f"text_id {kind}, terms array<string>, weights array<double>")
