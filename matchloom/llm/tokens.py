"""Token ids in binary shards with a minimal perfect hash index.

A shard is one file: header, raw little-endian ids (two bytes each if the vocabulary allows, else four), index,
keys, end mark. The index maps a key to a slot (minimal perfect hash); the slot holds the key's fingerprint and
the place of its ids, so one document is read with two short reads, whatever the shard holds. Shards follow the
order of the keys: documents are range-partitioned and sorted, and a shard ends when it holds SHARD_BYTES.

Defined results: null and empty text is the end id alone. Rows that repeat a key are further documents, told
apart by their number among equals (ties ordered by text). A null key sorts first. An empty table writes no shard.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from matchloom.llm.binfiles import read_files, write_files
from matchloom.llm.common import give_back, scratch, table, worker_cache
from matchloom.llm.mphash import MinimalPerfectHash, key_hashes

MAGIC, END_MARK = b"MLTOKEN1", "\nMLEND1\n"
HEADER = "<8sIIQQQQ"                         # magic, bytes per id, documents, ids, starts of index, of keys, of the end
SHARD_BYTES = 8 << 20
HEADER_BYTES = struct.calcsize(HEADER)
END_ID = 1
MEMO, LONG_WORD = 700_000, 64
BASE = 0xD6E8FEB86659FD93
BATCH_BYTES = 1 << 19      # texts encoded together
#: By number of bytes, up to eight.
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _kinds() -> np.ndarray:
    """Of bytes: 0 white space, 1 tail punctuation, 2 others, 3 lower-case and 4 upper-case ASCII letters."""
    kinds = np.full(256, 2, np.uint8)
    kinds[[9, 10, 11, 12, 13, 32]] = 0
    kinds[list(b".,!?;:")] = 1
    kinds[ord("a"):ord("z") + 1] = 3
    kinds[ord("A"):ord("Z") + 1] = 4
    return kinds


KINDS = _kinds()


def vocabulary_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of whole texts, batch by batch, with a bounded memo of words.

    The vocabulary drops white space before it merges, so the pieces between ASCII white space encode alone. Punctuation
    after an ASCII letter is merged apart from it, and case is dropped: a piece is a lower-case word and a tail. Equal
    words of a batch are found by a 64-bit hash and then compared byte by byte, with each other and with the word that the
    memo holds under that hash; each is encoded once. The memo has sorted hashes, the words and their packed ids.
    """

    def __init__(self, vocabulary: str):
        self.model = Tokenizer.from_file(vocabulary)
        self.merges = self.model.model
        self.width = 2 if max(max(self.model.get_vocab().values()), END_ID) < 1 << 16 else 4
        self.forget()

    def forget(self) -> None:
        #: Two tables, one for most words and one for the latest: sorted hashes, place and number of ids, place and number of bytes.
        self.tables = [self.no_words(), self.no_words()]
        self.ids, self.used = np.empty(1 << 16, f"<u{self.width}"), 0
        self.letters, self.written = np.zeros(1 << 16, np.uint8), 0

    @staticmethod
    def no_words() -> tuple[np.ndarray, ...]:
        return np.empty(0, np.uint64), *(np.empty(0, np.int32) for _ in range(4))

    def known_words(self) -> int:
        return sum(len(t[0]) for t in self.tables)

    @classmethod
    def of_worker(cls, vocabulary: str) -> "Encoder":
        cache = worker_cache()
        if vocabulary not in cache:
            cache[vocabulary] = cls(vocabulary)
        return cache[vocabulary]

    def packed(self, ids: list[int]) -> bytes:
        return np.array(ids, f"<u{self.width}").tobytes()

    def whole(self, texts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)]

    def learn(self, words: list[bytes], hashes: np.ndarray) -> None:
        """Words of ASCII letters need no normaliser or splitter, only the merges over their bytes."""
        plain = [w.isalpha() and len(w) <= LONG_WORD for w in words]                   # of bytes: ASCII letters only
        others = iter(self.whole([w for w, p in zip(words, plain) if not p]))
        lists = [[t.id for t in self.merges.tokenize(w.decode())] if p else next(others) for w, p in zip(words, plain)]
        size = np.array([len(x) for x in lists])
        at, total = self.used + np.cumsum(size) - size, int(size.sum())
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.used:self.used + total] = np.fromiter(chain.from_iterable(lists), self.ids.dtype, total)
        self.used += total
        length = np.array([len(w) for w in words])
        of, total = self.written + np.cumsum(length) - length, int(length.sum())
        while self.written + total + 7 > len(self.letters):
            self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
        self.letters[self.written:self.written + total] = np.frombuffer(b"".join(words), np.uint8)
        self.written += total
        main, latest = self.tables
        latest = self.joined(latest, (hashes, *(x.astype(np.int32) for x in (at, size, of, length))))
        self.tables = [main, latest] if 4 * len(latest[0]) < len(main[0]) + (1 << 16) else [self.joined(main, latest), self.no_words()]

    @staticmethod
    def joined(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        both = [np.concatenate(x) for x in zip(a, b)]
        order = np.argsort(both[0], kind="stable")
        return tuple(x[order] for x in both)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """(place, number) of the ids and (place, number) of the bytes known under sorted hashes; -1 ids where none is."""
        out = np.zeros((4, len(hashes)), np.int64)
        out[1] = -1
        for table_ in self.tables:
            if len(table_[0]):
                row = np.minimum(np.searchsorted(table_[0], hashes), len(table_[0]) - 1)
                known = table_[0][row] == hashes
                for column, values in zip(out, table_[1:]):
                    column[known] = values[row[known]]
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Packed ids of each text. Texts with the start of a special token, which depends on case, go to the model whole."""
        odd = [b"<|" in t for t in texts]
        out = self._encode([b"" if o else t for t, o in zip(texts, odd)])
        if out is None:                                    # two different words share a hash
            return [self.packed(x) for x in self.whole(texts)]
        special = iter(self.whole([t for t, o in zip(texts, odd) if o]))
        return [self.packed(next(special)) if o else x for x, o in zip(out, odd)]

    def _encode(self, texts: list[bytes]) -> list[bytes] | None:
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        kind = KINDS[raw]
        shown = kind != 0
        edge = np.flatnonzero(np.diff(shown, prepend=False))
        start, end = edge[::2], edge[1::2]                 # the last byte is white space
        text_at = np.cumsum([0] + [len(t) + 1 for t in texts])
        if not len(start):
            return [b""] * len(texts)
        body = np.maximum.accumulate(np.where(kind != 1, np.arange(len(raw)), 0))[end - 1] + 1
        tailed = (body < end) & (body > start) & (kind[np.maximum(body - 1, 0)] >= 3)
        middle = np.where(tailed, body, end)
        high = np.concatenate([[0], np.cumsum(raw > 127, dtype=np.int32)])
        keep = high[end] != high[start]                    # case may matter to marks that combine: such pieces stay as they are
        low = raw.copy()
        low[kind == 4] |= 32
        if keep.any():
            size = (end - start)[keep]
            where = np.repeat(start[keep] - np.cumsum(size) + size, size) + np.arange(size.sum())
            low[where] = raw[where]
        parts = 1 + tailed
        place = np.cumsum(parts) - parts
        a, b = np.empty(int(parts.sum()), np.int64), np.empty(int(parts.sum()), np.int64)
        a[place], b[place] = start, middle
        a[place[tailed] + 1], b[place[tailed] + 1] = middle[tailed], end[tailed]
        size = b - a
        low = np.concatenate([low, np.zeros(7, np.uint8)])
        hashes = word_hashes(low, a, size)
        order = np.argsort(hashes)
        ranked = hashes[order]
        fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        own, where, back = ranked[fresh], order[fresh], np.empty(len(order), np.int64)
        back[order] = np.cumsum(fresh) - 1
        of = where[back]                                   # the piece that stands for each piece
        if not same_words(low, a, size, low, a[of], size[of]):
            return None
        if self.known_words() > MEMO:
            self.forget()
        at, count, word, letters = self.find(own)
        known = count >= 0
        if not same_words(low, a[where[known]], size[where[known]], self.letters, word[known], letters[known]):
            return None
        new = np.flatnonzero(~known)
        if len(new):
            view = low.tobytes()
            self.learn([view[x:y] for x, y in zip(a[where[new]].tolist(), b[where[new]].tolist())], own[new])
            at, count, _, _ = self.find(own)
        at, count = at[back], count[back]
        until = np.cumsum(count)
        ids = self.ids[np.repeat(at - until + count, count) + np.arange(until[-1])]
        cuts = np.concatenate([[0], until])[np.searchsorted(a, text_at)]
        raw_ids, w = ids.tobytes(), self.width
        return [raw_ids[x * w:y * w] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def at_every_byte(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as numbers; no copy. The last seven places have none."""
    return np.lib.stride_tricks.as_strided(data.view(np.uint8)[:8].view("<u8"), (len(data) - 7,), (1,))


def eights(at: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(words, place, mask) of the first, second, ... eight bytes of those words that have them."""
    some, done = np.arange(len(at)), 0
    while len(some):
        yield some, at[some] + done, MASKS[np.minimum(size[some] - done, 8)]
        done += 8
        some = some[size[some] > done]


def word_hashes(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hash of each data[at:at + size]. ``data`` goes on for seven bytes after the last word."""
    view, out = at_every_byte(data), size.astype(np.uint64) * np.uint64(BASE)
    short = np.flatnonzero(size <= LONG_WORD)
    for some, place, mask in eights(at[short], size[short]):
        x = (out[short[some]] ^ (view[place] & mask)) * np.uint64(BASE)
        out[short[some]] = x ^ (x >> np.uint64(32))
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(data[at[i]:at[i] + size[i]].tobytes())
    out *= np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(29))


def same_words(x: np.ndarray, x_at: np.ndarray, x_size: np.ndarray, y: np.ndarray, y_at: np.ndarray, y_size: np.ndarray) -> bool:
    """Whether each x[x_at:x_at + x_size] equals its y[y_at:y_at + y_size], byte by byte."""
    if not np.array_equal(x_size, y_size):
        return False
    one, two = at_every_byte(x), at_every_byte(y)
    short = np.flatnonzero(x_size <= LONG_WORD)
    for some, place, mask in eights(x_at[short], x_size[short]):
        if ((one[place] ^ two[y_at[short[some]] + (place - x_at[short[some]])]) & mask).any():
            return False
    return all(np.array_equal(x[x_at[i]:x_at[i] + x_size[i]], y[y_at[i]:y_at[i] + x_size[i]]) for i in np.flatnonzero(x_size > LONG_WORD))


def entry_key(key: str | None, nth: int) -> bytes:
    """Key of the ``nth`` document of those that share ``key``."""
    return (b"-" if key is None else b"+" + key.encode()) + b"\x00" + str(nth).encode()


def pack_shard(width: int, keys: list[tuple[str | None, int]], payloads: list[bytes]) -> bytes:
    names = [entry_key(*k) for k in keys]
    hashes = key_hashes(names)
    mph = MinimalPerfectHash.build(hashes)
    counts = np.array([len(p) // width for p in payloads], "<u8")
    places = np.zeros((len(names), 2), "<u8")
    prints = np.zeros(len(names), "<u4")
    slots = mph.slots(hashes)
    places[slots, 0], places[slots, 1] = np.cumsum(counts) - counts, counts
    prints[slots] = hashes[:, 1].astype(np.uint32)
    body, table_ = b"".join(payloads), mph.to_bytes()
    index = struct.pack("<Q", len(table_)) + table_ + prints.tobytes() + places.tobytes()
    named = np.array([len(n) for n in names], "<u4").tobytes() + b"".join(names)
    at_index = HEADER_BYTES + len(body)
    return struct.pack(HEADER, MAGIC, width, len(names), int(counts.sum()), at_index, at_index + len(index),
                       at_index + len(index) + len(named)) + body + index + named


class Shard:
    """Reads one shard through ``read(start, size)``; only the parts asked for are read."""

    def __init__(self, read: Callable[[int, int], bytes]):
        self.read = read
        magic, self.width, self.documents, self.ids, self.at_index, self.at_keys, self.end = struct.unpack(HEADER, read(0, HEADER_BYTES))
        if magic != MAGIC or read(self.end, len(END_MARK)) != END_MARK.encode():
            raise ValueError("not a whole shard")
        raw = read(self.at_index, self.at_keys - self.at_index)
        size = struct.unpack_from("<Q", raw)[0]
        self.mph = MinimalPerfectHash.from_bytes(raw[8:8 + size])
        self.prints = np.frombuffer(raw, "<u4", self.documents, 8 + size)
        self.places = np.frombuffer(raw, "<u8", 2 * self.documents, 8 + size + 4 * self.documents).reshape(-1, 2)

    def keys(self) -> list[bytes]:
        raw = self.read(self.at_keys, self.end - self.at_keys)
        sizes = np.frombuffer(raw, "<u4", self.documents).astype(np.int64)
        ends = 4 * self.documents + np.cumsum(sizes)
        return [raw[e - s:e] for s, e in zip(sizes, ends)]

    def find(self, keys: list[bytes]) -> np.ndarray:
        """(first id, number of ids) per key; (-1, -1) for a key the shard does not hold."""
        out = np.full((len(keys), 2), -1, np.int64)
        if keys and self.documents:
            hashes = key_hashes(keys)
            slots = self.mph.slots(hashes)
            known = (slots >= 0) & (self.prints[slots] == hashes[:, 1].astype(np.uint32))
            out[known] = self.places[slots[known]]
        return out

    def ids_at(self, first: int, count: int) -> np.ndarray:
        return np.frombuffer(self.read(HEADER_BYTES + first * self.width, count * self.width), f"<u{self.width}")


def encoded(encoder: Encoder, texts: Iterable[bytes]) -> Iterator[bytes]:
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text)
        if size >= BATCH_BYTES:
            yield from encoder.encode(some)
            some, size = [], 0
    yield from encoder.encode(some)


def write_shards(docs: DataFrame, path: str, vocabulary: str | None = None, text: str = "text", key: str = "doc_id",
                 shard_bytes: int = SHARD_BYTES) -> None:
    """Write all documents in ascending key order; folders name each shard's place, documents and ids."""
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seq, size, keys, payloads = Encoder.of_worker(vocabulary or vocabulary_file()), 0, 0, [], []
        end = np.array([END_ID], f"<u{encoder.width}").tobytes()
        part = TaskContext.get().partitionId()
        last, nth = object(), 0

        def shard() -> pa.RecordBatch:
            ids = sum(map(len, payloads)) // encoder.width
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "docs": [len(keys)], "ids": [ids],
                                               "content": [pack_shard(encoder.width, keys, payloads)]})

        for batch in batches:
            bodies = (x.as_py() for x in batch.column("body"))
            for name, ids in zip(batch.column("key").to_pylist(), encoded(encoder, bodies)):
                nth = nth + 1 if name == last else 0
                last = name
                keys.append((name, nth))
                payloads.append(ids + end)
                size += len(payloads[-1])
                if size >= shard_bytes:
                    yield shard()
                    seq, size, keys, payloads = seq + 1, 0, [], []
        if keys:
            yield shard()
        give_back()

    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    ordered = docs.select(F.col(key).alias("order"), body.alias("body")).repartitionByRange("order", F.xxhash64("body"))
    rows = ordered.sortWithinPartitions(F.col("order").asc_nulls_first(), F.xxhash64("body")).select(F.col("order").cast("string").alias("key"), "body")
    out = rows.mapInArrow(shards, "part int, seq int, docs long, ids long, content binary")
    write_files(out, path, "content", ["part", "seq", "docs", "ids"], END_MARK)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """(key, nth, start, n_tokens, ids_crc32, ids) of every document, found through the shards' indexes.

    ``start`` counts the ids of all documents before: a sum over one row per shard, taken from folder names.
    """
    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, content in zip(batch.column("part").to_pylist(), batch.column("seq").to_pylist(), batch.column("content")):
                view = memoryview(content.as_buffer())
                shard = Shard(lambda start, size, view=view: bytes(view[start:start + size]))
                keys = shard.keys()
                found = shard.find(keys)
                if (found < 0).any() or int(found[:, 1].sum()) != shard.ids:
                    raise ValueError("the index does not cover the shard")
                name = [k.rpartition(b"\x00") for k in keys]
                ids = [shard.ids_at(int(a), int(n)).astype("<u4").tobytes() for a, n in found]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part] * len(keys), pa.int32()), "seq": pa.array([seq] * len(keys), pa.int32()),
                    "key": pa.array([None if a == b"-" else a[1:].decode() for a, _, _ in name], pa.string()),
                    "nth": pa.array([int(b) for _, _, b in name], pa.int64()), "first_id": pa.array(found[:, 0]), "n_tokens": pa.array(found[:, 1]),
                    "ids_crc32": pa.array([zlib.crc32(i) for i in ids], pa.int64())})

    files = read_files(spark, path)
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("part", "seq", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    rows = files.select("part", "seq", "content").mapInArrow(
        documents, "part int, seq int, key string, nth long, first_id long, n_tokens long, ids_crc32 long")
    return rows.join(bases, ["part", "seq"]).select("key", "nth", (F.col("base") + F.col("first_id")).alias("start"), "n_tokens", "ids_crc32")


def open_shard(uri: str) -> Shard:
    """A shard in any store that pyarrow reaches, read by byte ranges."""
    store, path = pafs.FileSystem.from_uri(uri)
    file = store.open_input_file(path)
    return Shard(lambda start, size: file.read_at(size, start))


def encode_documents(docs: DataFrame, path: str, vocabulary: str | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Write shards to ``path`` and read them back: (key, start, n_tokens, ids_crc32) per row."""
    if docs.isEmpty():
        return docs.select(F.col(key), *[F.lit(0).cast("long").alias(c) for c in ("start", "n_tokens", "ids_crc32")]).limit(0)
    write_shards(docs, path, vocabulary, text, key)
    kind = docs.schema[key].dataType
    return read_shards(docs.sparkSession, path).select(F.col("key").cast(kind).alias(key), "start", "n_tokens", "ids_crc32")


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), scratch(spark, "tokens"))


QUERIES = {"op3_token_shards": (op3_token_shards, None)}
