"""Exact top k of many queries against texts of few terms, slice by slice.

Texts are cut into slices, queries into parts, and every pair of a slice and a part is one block. A task holds a block's
slice as postings by term and streams its queries past them: a query adds its weights to the texts of its terms and hands on its k
best. Rows that are shuffled are whole texts and queries, never pairs of them, so terms that all texts share cost additions only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from matchloom.operators.topk import TIE_DIGITS

SLICE_TEXTS, SLICE_POSTINGS = 1 << 17, 1 << 22
PART_QUERIES, LEAST_QUERIES = 8192, 256
SHUFFLED = 1 << 28         # terms of all blocks, texts' and queries': beyond, bounds are worth their joins
TEXT_TERMS = 256           # terms of a text, on the average
NOISE = 1e-8               # above what rounding to nine digits moves a score by


def as_rows(terms: DataFrame, key: str, weight: str) -> DataFrame:
    """(key, terms, weights): one row per text."""
    listed = F.collect_list(F.struct("term", F.col(weight).alias("w")))
    return terms.groupBy(key).agg(listed.alias("listed")).select(
        key, F.col("listed.term").alias("terms"), F.col("listed.w").alias("weights"))


def blocks(texts: DataFrame, asked: DataFrame, text_scope: Column, query_scope: Column, cores: int) -> tuple[int, int, int] | None:
    """Slices, parts and the number of blocks; None where too much would be shuffled. Texts and queries meet within a scope."""
    many = [df.groupBy(scope.alias("scope")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("terms")).alias("terms"))
            .agg(F.max("n"), F.max("terms"), F.sum("n"), F.sum("terms"), F.count(F.lit(1))).first() for df, scope in ((texts, text_scope), (asked, query_scope))]
    (n, postings, all_n, all_postings, scopes), (queries, _, _, query_terms, _) = [[v or 0 for v in row] for row in many]
    slices = max(1, -(-n // SLICE_TEXTS), -(-postings // SLICE_POSTINGS))
    parts = max(1, -(-queries // PART_QUERIES), min(-(-queries // LEAST_QUERIES), -(-2 * cores // (slices * max(1, scopes)))))
    if all_postings > TEXT_TERMS * all_n or all_postings * parts + query_terms * slices > SHUFFLED:
        return None
    return slices, parts, slices * parts * max(1, scopes)


def best_by_slice(texts: DataFrame, asked: DataFrame, k: int, text_scope: Column, query_scope: Column, cut: tuple[int, int, int]) -> DataFrame:
    """(qid, text_id, score): the k best texts of every slice for every query, of those that share a term with it.
    ``texts``: text_id, terms, weights; ``asked``: qid, terms, weights."""
    slices, parts, tasks = cut
    query_type, text_type = asked.schema["qid"].dataType, texts.schema["text_id"].dataType
    own = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    placed = texts.withColumn("part", every(parts)).select(
        F.concat_ws("-", text_scope, own("text_id", slices), "part").alias("block"), F.lit(False).alias("asks"),
        F.lit(None).cast(query_type).alias("qid"), "text_id", "terms", "weights")
    sent = asked.withColumn("slice", every(slices)).select(
        F.concat_ws("-", query_scope, "slice", own("qid", parts)).alias("block"), F.lit(True).alias("asks"),
        "qid", F.lit(None).cast(text_type).alias("text_id"), "terms", "weights")

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, Slice()
        for batch in batches:
            names, asks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "asks"))
            starts = np.flatnonzero((names[1:] != names[:-1]) | (asks[1:] != asks[:-1])) + 1
            for start, end in zip([0, *starts], [*starts, len(names)]):
                if start == end:
                    continue
                if names[start] != block:
                    block, held = names[start], Slice()
                run = batch.slice(start, end - start)
                if not asks[start]:
                    held.add(run)
                elif held.ids:
                    yield held.best(run, k)

    return placed.unionByName(sent).repartition(tasks, "block").sortWithinPartitions("block", "asks", "text_id").mapInArrow(
        answers, f"qid {query_type.simpleString()}, text_id {text_type.simpleString()}, score double")


class Slice:
    """Texts of one block, in ascending order of their ids, as postings by term."""

    def __init__(self) -> None:
        self.codes, self.ids, self.sizes, self.terms, self.weights, self.starts = {}, [], [], [], [], None

    def add(self, run: pa.RecordBatch) -> None:
        terms = run.column("terms")
        coded = terms.flatten().dictionary_encode()
        own = np.array([self.codes.setdefault(t, len(self.codes)) for t in coded.dictionary.to_pylist()], np.int32)
        self.ids.append(run.column("text_id"))
        self.sizes.append(np.diff(terms.offsets.to_numpy()))
        self.terms.append(own[coded.indices.to_numpy()])
        self.weights.append(run.column("weights").flatten().to_numpy())

    def by_term(self) -> None:
        sizes, terms = np.concatenate(self.sizes), np.concatenate(self.terms)
        order = np.argsort(terms, kind="stable")
        self.texts = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.weights = np.concatenate(self.weights)[order]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=len(self.codes)))])
        self.ids, self.terms = [pa.concat_arrays(self.ids)], []
        self.scores, self.met = np.zeros(len(sizes)), np.zeros(len(sizes), bool)

    def best(self, run: pa.RecordBatch, k: int) -> pa.RecordBatch:
        if self.starts is None:
            self.by_term()
        asked, found, scores = [], [], []
        for row, (terms, weights) in enumerate(zip(run.column("terms").to_pylist(), run.column("weights").to_pylist())):
            for term, weight in sorted(zip(terms, weights)):
                code = self.codes.get(term)
                if code is not None:
                    span = slice(self.starts[code], self.starts[code + 1])
                    self.scores[self.texts[span]] += weight * self.weights[span]
                    self.met[self.texts[span]] = True
            at = np.flatnonzero(self.met)
            got = self.scores[at]
            self.scores[at], self.met[at] = 0.0, False
            if len(at) > k:
                near = got >= np.partition(got, len(got) - k)[len(got) - k] - NOISE
                at, got = at[near], got[near]
            got = np.round(got, TIE_DIGITS)
            first = np.lexsort((at, -got))[:k]
            asked.append(np.full(len(first), row))
            found.append(at[first])
            scores.append(got[first])
        row, at = np.concatenate(asked), np.concatenate(found)
        return pa.RecordBatch.from_arrays([run.column("qid").take(pa.array(row)), self.ids[0].take(pa.array(at)), pa.array(np.concatenate(scores))],
                                          names=["qid", "text_id", "score"])
