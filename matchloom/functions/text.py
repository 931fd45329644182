"""Text normalisation and text predicates: every function maps Column to Column and stays in the JVM."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F

# ---------------------------------------------------------------- fixed values
# Light stopwords; "com" and "sem" are absent on purpose (with gas / without gas).
STOPWORDS = ("de", "do", "da", "dos", "das", "e", "em", "no", "na", "nos", "nas",
             "o", "a", "os", "as", "ao", "aos", "um", "uma", "para", "por")

# Words that describe the order's packaging rather than the product.
PACK_WORDS = ("und", "unid", "un", "unds", "cx", "fd", "fardo", "pct", "emb")

# Case-insensitive packaging and unit patterns, by name.
ORDER_PATTERNS = {
    "case_of_n": r"\bC/\s?\d+",
    "n_by_m": r"\b\d+\s?[xX]\s?\d+",
    "unit_word": r"\b(?:UND|UNID|UN)\b",
    "box": r"\bCX\b",
    "bundle": r"\bFD\b|\bFARDO\b",
    "packet": r"\bPCT\b",
    "millilitres": r"\d+\s?[mM][lL]\b",
    "litres": r"\d+\s?[lL]\b",
    "can": r"\bLT\b|\bLATA\b",
    "grams": r"\d+\s?[gG][rR]?\b",
    "kilograms": r"\d+\s?[kK][gG]\b",
    "without": r"\bS/\w+",
    "pet_bottle": r"\bPET\b",
    "bottle": r"\bGRF\b|\bGARRAFA\b",
}

# Query segments: packaging terms, and volume or weight.
SEGMENT_PACK = r"C/\s?\d+|\b(?:UND|UNID|UN)\b|\d+\s?X\s?\d+|\bCX\b|\bFD\b|\bPCT\b"
SEGMENT_MEASURE = r"\d+\s?(?:ml|l|litros?|g|gr|kg)\b"

# Order style of distributors. Its last alternative accepts nearly any text; kept for equal results.
DISTRIBUTOR_STYLE = r"C/\s?\d|UND|UNID|^\S+(?:\s\S+)*$"

# Number with unit inside a product name.
NAME_MEASURE = r"\d+[.,]?\d*\s?(ml|l|litros?|g|gr|kg|un|unidades?)\b"

# Spellings of a unit after a number, and other marks that normalisation rewrites.
LITRES, MILLILITRES, KILOGRAMS, GRAMS = "litros?|lts?|l", "ml", "quilos?|kgs?|kg", "gramas?|grs?|gr|g"
WITHOUT_MARK, COUNT_MARK, LONE_CAN = "s/", "c/", "lt"

# Token grammars: with digits and slash, letters only, lower-case letters only.
TOKENS_ALNUM = "[A-Za-zÀ-ÿ0-9/]+"
TOKENS_LETTERS = "[A-Za-zÀ-ÿ]+"
TOKENS_LOWER = "[a-zà-ÿ]+"
# ---------------------------------------------------------------- end of fixed values

_SPACE = r"[\s\x1c-\x1f]"
_NUMBER = r"(\d+(?:\.\d+)?)"


@lru_cache(maxsize=1)
def _ascii_folds() -> tuple[dict[str, str], dict[str, str]]:
    """Compatibility decompositions reduced to ASCII: one-to-one folds and one-to-many folds."""
    single: dict[str, str] = {}
    several: dict[str, str] = {}
    for point in range(0x80, sys.maxunicode + 1):
        char = chr(point)
        if unicodedata.category(char) in ("Cs", "Cn", "Co"):
            continue
        plain = "".join(c for c in unicodedata.normalize("NFKD", char) if c < "\x80")
        if len(plain) == 1:
            single[char] = plain
        elif plain:
            several[char] = plain
    return single, several


_NON_ASCII = r"[^\x00-\x7F]"


def fold_accents(c: Column) -> Column:
    """Decompose by compatibility and keep ASCII only; plain ASCII text passes untouched.

    One-to-one folds cover nearly all text; the character-wise expansion runs only where they leave a
    character that expands to several, and only on the characters outside ASCII.
    """
    single, several = _ascii_folds()
    mapping = F.str_to_map(F.lit("\x01".join(a + "\x02" + b for a, b in several.items())), F.lit("\x01"), F.lit("\x02"))
    folded = F.translate(c, "".join(single), "".join(single.values()))
    chars = F.regexp_extract_all(folded, F.lit("(?s)."), F.lit(0))
    spread = F.array_join(
        F.transform(chars, lambda x: F.when(x <= "\x7f", x).otherwise(F.coalesce(mapping[x], F.lit("")))), "")
    expands = folded.rlike(_NON_ASCII) & (F.translate(folded, "".join(several), "") != folded)
    plain = F.when(expands, spread).otherwise(F.regexp_replace(folded, _NON_ASCII, ""))
    return F.when(c.rlike(_NON_ASCII), plain).otherwise(c)


def decimal_point(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit("."))


def spell_without(c: Column) -> Column:
    return F.regexp_replace(c, rf"\b{WITHOUT_MARK}{_SPACE}*", "sem ")


def unit_content(c: Column) -> Column:
    """``12x15`` keeps only the content of one unit."""
    return F.regexp_replace(c, rf"\b\d+{_SPACE}*x{_SPACE}*{_NUMBER}\b", "$1")


def drop_pack_words(c: Column) -> Column:
    counted = F.regexp_replace(c, rf"\b{COUNT_MARK}{_SPACE}*\d+\b", " ")
    return F.regexp_replace(counted, rf"\b(?:{'|'.join(PACK_WORDS)})\b", " ")


def litres(c: Column) -> Column:
    return F.regexp_replace(c, rf"{_NUMBER}{_SPACE}*(?:{LITRES})\b", "$1l")


def millilitres(c: Column) -> Column:
    return F.regexp_replace(c, rf"{_NUMBER}{_SPACE}*{MILLILITRES}\b", "$1ml")


def kilograms(c: Column) -> Column:
    return F.regexp_replace(c, rf"{_NUMBER}{_SPACE}*(?:{KILOGRAMS})\b", "$1kg")


def grams(c: Column) -> Column:
    return F.regexp_replace(c, rf"{_NUMBER}{_SPACE}*(?:{GRAMS})\b", "$1g")


def lone_can(c: Column) -> Column:
    return F.regexp_replace(c, rf"\b{LONE_CAN}\b", "lata")


def drop_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, r"[^a-z0-9. ]+", " ")


def loose_dots(c: Column) -> Column:
    return F.regexp_replace(c, r"\.(?=\D)|(?<=\D)\.", " ")


def drop_stopwords(c: Column) -> Column:
    """Remove stopword tokens and squeeze blanks. A regex keeps the projection inside generated code."""
    kept = F.regexp_replace(c, rf"(?<![^ ])(?:{'|'.join(STOPWORDS)})(?![^ ])", "")
    return F.trim(F.regexp_replace(kept, " +", " "))


def normalise(c: Column) -> Column:
    """All steps in their fixed order; a null text counts as empty."""
    t = fold_accents(F.lower(F.coalesce(c, F.lit(""))))
    for step in (decimal_point, spell_without, unit_content, drop_pack_words, litres, millilitres,
                 kilograms, grams, lone_can, drop_punctuation, loose_dots, drop_stopwords):
        t = step(t)
    return t


def with_document(df, name: str, brand: str, use_brand: bool, out: str = "norm"):
    """Catalog text to index: the normalised name, plus the normalised brand unless the name holds it.

    The parts go through a projection of their own, so that each is normalised once per row.
    """
    if not use_brand:
        return df.withColumn(out, normalise(F.col(name)))
    parts = df.withColumn("_name", normalise(F.col(name))).withColumn("_brand", normalise(F.col(brand)))
    return parts.withColumn(out, append_brand(F.col("_name"), F.col("_brand"))).drop("_name", "_brand")


def append_brand(name: Column, brand: Column) -> Column:
    """Both sides already normalised; the test is on substrings, not on tokens."""
    missing = (brand != "") & ~F.contains(name, brand)
    return F.when(missing, F.concat(name, F.lit(" "), brand)).otherwise(name)


def has_accent(c: Column) -> Column:
    return c != fold_accents(c)


def is_upper(c: Column) -> Column:
    return F.upper(c) == c


def matches(c: Column, pattern: str) -> Column:
    """Case-insensitive search with Unicode word boundaries, blanks and digits."""
    return c.rlike("(?iU)" + pattern)


def tokens(c: Column, grammar: str = TOKENS_ALNUM) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(grammar), F.lit(0))


def base_name(c: Column) -> Column:
    """Product name without measures and digits: equal for the variants of one product."""
    t = F.regexp_replace(F.lower(c), "(?U)" + NAME_MEASURE, " ")
    t = F.regexp_replace(t, r"(?U)\d+", " ")
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))


def first_word(c: Column) -> Column:
    return F.lower(F.nullif(F.regexp_extract(c, r"(?U)\S+", 0), F.lit("")))


def token_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"(?U)\S+"))


def contains_key(c: Column, key: Column) -> Column:
    return F.contains(F.lower(c), key)


def with_prefix(c: Column, prefix: str) -> Column:
    """Asymmetric encoders want ``query: `` and ``passage: `` in front of the two sides."""
    return F.concat(F.lit(prefix), c)


def text_kind(raw: Column, kind: Column) -> Column:
    """Raw or normalised text, chosen per row."""
    return F.when(kind == "raw", raw).otherwise(normalise(raw))


def round_score(c: Column, digits: int = 4) -> Column:
    return F.round(c, digits)
