"""Quality rules by compression bands.

zstandard ratios (bytes per compressed byte) of the whole document and of its fixed chunks are held against
limits for their length: above the upper limit text is repetitive, below the lower one it is incompressible
(keys, encoded blobs, noise). Short text compresses worse, so both limits rise with length. Few symbols strewn over all words
(markup, menus, noise between words) are repetitive in this sense.

Defined results: null, empty or blank text has no words, fails the base rules and is rejected. Repeated rows
are judged each for itself. Columns besides the text are never looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from matchloom.llm.common import fresh, give_back, table

LEVEL = 3
CHUNK_BYTES = 4096
CHUNK_SHARE = 0.3          # rejected if chunks outside their band hold more than this share of the bytes
#: (bytes from, lowest ratio, highest ratio). From 512 bytes on, the lower limits are above the most that random base64 in
#: lines or random keys between blanks reached in the band (1.30, 1.34, 1.37, 1.37, 1.37), and below prose. The upper ones are 0.2 above the
#: most that prose without repeated lines reached at sf0.1 (1.71, 1.97, 2.15, 2.34, 2.48), and below text of which two fifths repeat; see the README.
BANDS = [(0, 0.0, 3.0), (128, 0.9, 1.9), (512, 1.31, 2.17), (1024, 1.36, 2.35), (2048, 1.4, 2.55), (8192, 1.4, 2.7), (65536, 1.4, 3.0)]
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, REPEAT_PERCENT, REPEAT_WORDS = 50, 50, 3

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
          "kept boolean, ratio double, chunk_low double, chunk_high double, odd_bytes long")


def band(size: int, bands: list[tuple[int, float, float]] = BANDS) -> tuple[float, float]:
    return next((low, high) for start, low, high in reversed(bands) if size >= start)


def repeated_words(words: list[bytes], span: int = REPEAT_WORDS) -> int:
    """Words inside windows of ``span`` words that occur twice or more."""
    windows = list(zip(*(words[i:] for i in range(span))))
    if len(set(windows)) == len(windows):
        return 0
    counts, covered, total = Counter(windows), 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            total += i + span - max(covered, i)
            covered = i + span
    return total


def judge(raw: bytes, pack: zstandard.ZstdCompressor) -> tuple:
    words = raw.split()                                    # bytes.split() cuts at \x20 and \x09-\x0D only
    n = len(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeats = repeated_words(words)
    base_failed = n < MIN_WORDS or 100 * repeats > REPEAT_PERCENT * n
    ratio = len(raw) / len(pack.compress(raw)) if raw else 0.0
    chunks = []
    for at in range(0, len(raw), CHUNK_BYTES):             # a short tail is held against the band of its own length
        part = raw[at:at + CHUNK_BYTES]
        chunks.append((len(part), len(part) / len(pack.compress(part))))
    low, high = band(len(raw))
    full = [r for n_bytes, r in chunks if n_bytes == CHUNK_BYTES] or [r for _, r in chunks]     # a tail's ratio does not compare
    odd = sum(size for size, r in chunks if not (band(size)[0] <= r <= band(size)[1]))
    kept = not base_failed and low <= ratio <= high and odd <= CHUNK_SHARE * len(raw)
    return (n, len(b"".join(words).decode("utf-8", "replace")), len(raw) - len(raw.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeats, base_failed, kept, ratio,
            min(full, default=0.0), max(full, default=0.0), odd)


def _judged(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    pack = zstandard.ZstdCompressor(level=LEVEL)
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    for batch in texts:
        yield pd.DataFrame([judge(raw, pack) for raw in batch], columns=names)
    give_back()


def verdict(text: Column) -> Column:
    """Struct of all measures and the verdict for one text column."""
    return F.pandas_udf(_judged, SCHEMA)(F.coalesce(text, F.lit("")).cast("binary"))


def annotate(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and all measures, one row per input row."""
    return docs.select(F.col(key), verdict(F.col(text)).alias("measured")).select(key, "measured.*")


def filter_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows that pass, with their columns as they were."""
    [name] = fresh(docs, "measured")
    return docs.withColumn(name, verdict(F.col(text))).filter(F.col(f"{name}.kept")).drop(name)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate(table(spark, sf_dir, "documents"))


QUERIES = {"op9_quality_rules": (op9_quality_rules, None)}
