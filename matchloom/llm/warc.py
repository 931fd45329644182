"""WARC archives, index first.

Pages become WARC records, one gzip member each, in archives of about ARCHIVE_BYTES. Every archive comes with its
index: offset, length, url and digest per record. Reading starts from the index: the selected records are sorted
by archive and offset, neighbours with small gaps are coalesced into ranges, and each range is one read.

Of records with equal payloads of at least MIN_SHARED bytes, the one with the largest key holds the payload
(response); the others refer to it (revisit). Digests are grouped on narrow rows; the pages themselves are
shuffled once, by key.

Defined results: a null payload is empty; empty and short payloads are always responses. Rows that repeat the
largest key of a group are all responses. A null key never holds a payload for others. An empty table writes no archive.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from matchloom.llm.binfiles import read_files, write_files
from matchloom.llm.common import exists, scratch, table

MIN_SHARED = 1000
ARCHIVE_BYTES = 32 << 20
RANGE_BYTES, GAP_BYTES = 8 << 20, 64 << 10                 # a range, and about what a reading task gets; a gap that is read over
WRITTEN = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END_MARK = "\x00"                                          # zero bytes after the last gzip member are padding
URL_ENCODED = "X-Target-URI-Encoding"
INDEX_SCHEMA = "key string, offset long, length long, url string, digest string, type string"


def encoded(text: str) -> str:
    """A header value without blanks and control characters; ``unquote`` gives the text back."""
    return "".join(c if c > " " and c not in "\x7f%" else f"%{ord(c):02X}" for c in text)


def record(key: str | None, url: str | None, payload: bytes, digest: str, original: str | None) -> bytes:
    """One WARC record as a gzip member."""
    revisit = original is not None
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Date", WRITTEN), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Payload-Length", str(len(payload)))]
    if key is not None:
        head.append(("WARC-Record-ID", f"<urn:page:{encoded(key)}>"))
    if url is not None:
        plain = not re.search(r"[\x00-\x20\x7f]", url)         # a proper url stands as it is, with its own percent signs
        head.append(("WARC-Target-URI", url if plain else encoded(url)))
        if not plain:
            head.append((URL_ENCODED, "percent"))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{encoded(original)}>")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    raw = "WARC/1.1\r\n" + "".join(f"{n}: {v}\r\n" for n, v in head) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw.encode() + block + b"\r\n\r\n") + packer.flush()


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields, payload) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("broken record")
    return fields, block.partition(b"\r\n\r\n")[2]


def with_originals(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """key, url, payload, digest and, for pages that revisit another, the key it has (``original``)."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), body.alias("payload"), F.sha1(body).alias("digest"))
    slim = rows.select("key", "digest", F.octet_length("payload").alias("size")).filter(F.col("size") >= MIN_SHARED)
    shared = (slim.groupBy("digest", "size").agg(F.max("key").alias("original"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1 AND original IS NOT NULL"))
    revisits = (slim.join(shared, ["digest", "size"]).filter(~F.col("key").eqNullSafe(F.col("original")))
                .select(F.col("key").alias("of"), F.col("digest").alias("of_digest"), "original").distinct())
    return rows.join(revisits, F.col("key").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("of_digest")), "left").drop("of", "of_digest")


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Archives below ``kind=warc`` and their indexes (JSON lines) below ``kind=index``."""
    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, size, records, index = TaskContext.get().partitionId(), 0, 0, [], []

        def both() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"kind": ["warc", "index"], "archive": [f"{part:06d}-{seq:04d}"] * 2,
                                               "content": [b"".join(records), "\n".join(index).encode()]})

        for batch in batches:
            columns = [batch.column(c) for c in ("key", "url", "payload", "digest", "original")]
            for name, link, body, digest, original in zip(*columns):
                name, link, digest, original = name.as_py(), link.as_py(), digest.as_py(), original.as_py()
                records.append(record(name, link, body.as_py(), digest, original))
                index.append(json.dumps({"key": name, "offset": size, "length": len(records[-1]), "url": link, "digest": digest,
                                         "type": "response" if original is None else "revisit"}))
                size += len(records[-1])
                if size >= archive_bytes:
                    yield both()
                    seq, size, records, index = seq + 1, 0, [], []
        if records:
            yield both()

    rows = with_originals(pages, key, url, payload).select(
        F.col("key").cast("string").alias("key"), "url", "payload", "digest", F.col("original").cast("string").alias("original"))
    write_files(rows.mapInArrow(archives, "kind string, archive string, content binary"), path, "content", ["kind", "archive"], END_MARK)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """key, offset, length, url, digest, type of every record, and the archive file that holds it."""
    if not exists(spark, f"{path}/kind=index"):             # an empty table has written no archive
        return spark.createDataFrame([], "archive string, file string, " + INDEX_SCHEMA)
    lines = (spark.read.option("recursiveFileLookup", "false").text(f"{path}/kind=index")
             .select("archive", F.from_json(F.rtrim("value", F.lit(END_MARK)), INDEX_SCHEMA).alias("entry")).filter("entry IS NOT NULL"))
    files = read_files(spark, f"{path}/kind=warc").select("archive", F.col("path").alias("file"))
    return lines.join(files, "archive").select("archive", "file", "entry.*")


def ranges(selected: DataFrame, range_bytes: int = RANGE_BYTES, gap_bytes: int = GAP_BYTES) -> DataFrame:
    """(file, start, size, records) reads that cover the selected index rows. A range ends at a gap or at a cell of
    ``range_bytes``; the windows run inside one archive, whose size is bounded."""
    order = Window.partitionBy("file").orderBy("offset")
    end = F.col("offset") + F.col("length")
    breaks = ((F.col("offset") - F.coalesce(F.lag(end).over(order), F.col("offset")) > gap_bytes)
              | (F.floor(F.col("offset") / range_bytes) != F.floor(F.coalesce(F.lag("offset").over(order), F.col("offset")) / range_bytes)))
    numbered = selected.withColumn("broken", breaks.cast("int")).withColumn("range", F.sum("broken").over(order))
    return (numbered.groupBy("file", "range").agg(
        F.min("offset").alias("start"), F.max(end).alias("end"),
        F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("records"))
        .select("file", "start", (F.col("end") - F.col("start")).alias("size"), "records"))


def read_records(selected: DataFrame) -> DataFrame:
    """Read the selected index rows: key, url, payload, payload length and digest, type, key referred to."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = pafs.FileSystem.from_uri(row["file"])
                with store.open_input_file(path) as file:
                    raw = file.read_at(row["size"], row["start"])
                out = []
                for place in row["records"]:
                    at = place["offset"] - row["start"]
                    fields, payload = parse(zlib.decompress(raw[at:at + place["length"]], 31))
                    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(fields["WARC-Payload-Length"])):
                        raise ValueError("a payload does not match its digest")
                    named = lambda field: unquote(fields[field][len("<urn:page:"):-1]) if field in fields else None
                    link = fields.get("WARC-Target-URI")
                    out.append((named("WARC-Record-ID"), unquote(link) if URL_ENCODED in fields else link, payload if kind == "response" else None,
                                int(fields["WARC-Payload-Length"]), digest, kind, named("WARC-Refers-To")))
                kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 ["key", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    # a row of a range weighs nothing, so the number of tasks follows from the bytes that the rows stand for
    size = selected.agg(F.sum("length")).first()[0] or 0
    spread = ranges(selected).repartition(max(1, -(-size // RANGE_BYTES)), "file", "start")
    return spread.mapInArrow(read, "key string, url string, payload binary, payload_bytes long, payload_digest string, "
                                   "record_type string, refers_to string")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, path = table(spark, sf_dir, "pages"), scratch(spark, "warc")
    kind = pages.schema["page_id"].dataType
    write_archives(pages, path)
    return read_records(read_index(spark, path)).select(
        F.col("key").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS original FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_SHARED} AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_SHARED} AND page_id <> original THEN original END AS refers_to
FROM g
"""

QUERIES = {"op4_warc": (op4_warc, SQL)}
