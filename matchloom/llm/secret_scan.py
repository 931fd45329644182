"""Secret scans by assignment-aware lexing.

Base patterns find well-known forms. On top of them, a lexer reads source and configuration syntax into
(name, value) pairs: ``name = value``, ``name: value``, quoted and subscripted keys, call arguments, attributes,
``<name>value</name>``, ``--name value``. Names given to literals are constants; a value that names a constant
stands for its literals, so ``x = "..."`` with a later ``db_password = x`` points at the literal. Each literal is
scored by the target name it reaches and by its own shape; from MIN_SCORE on it is a ``named`` span.

Defined results: null and empty text has no spans. Rows are scanned each for itself. Spans count code points.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from matchloom.llm.common import table

KINDS = ("assign", "access", "hex", "named")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"                     # the maximal runs of 32 and more
ASSIGN_VALUE, ACCESS_LENGTH = 8, 16

#: Parts of a name and what they add to a literal's score.
NAME_PARTS = {
    "password": 4, "passwd": 4, "pwd": 4, "passphrase": 4, "pass": 3, "secret": 4, "token": 3, "apikey": 4, "credential": 3,
    "credentials": 3, "auth": 2, "bearer": 3, "private": 2, "signing": 2, "encryption": 2, "access": 1, "api": 2, "key": 2, "salt": 2,
    "public": -3, "length": -4, "size": -4, "count": -4, "max": -3, "min": -3, "url": -3, "uri": -3, "path": -3, "file": -2, "name": -3,
    "type": -3, "field": -3, "label": -3, "hint": -3, "policy": -3, "expiry": -3, "expires": -3, "ttl": -3, "timeout": -3, "example": -3,
}
PLACEHOLDER = r"(?i)x{4,}|\*{3,}|\.{3,}|change.?me|placeholder|example|your[_-]|dummy|redacted|todo|^(none|null|true|false|undefined)$|^[<{$%].*"
MIN_SCORE, MIN_LENGTH = 5.0, 8
#: Where no part that adds to a score occurs, no name can reach a literal; every such part is in here.
SENSITIVE = "(?i)" + "|".join(part for part, weight in NAME_PARTS.items() if weight > 0)

TOKENS = r"""
  (?P<string>"(?:\\.|[^"\\\n])*"|'(?:\\.|[^'\\\n])*'|`[^`]*`)
 |(?P<tag><(?P<tagname>[A-Za-z_][\w.:-]*)>(?P<tagvalue>[^<\n]+)</(?P=tagname)>)
 |(?P<flag>--(?P<flagname>[A-Za-z][\w-]*)[= ](?P<flagvalue>[^\s"'=-][^\s"']*))
 |(?P<comment>(?:\#|//)[^\n]*)
 |(?P<op>:=|=>|==|!=|<=|>=|[=:+,;(){}\[\]])
 |(?P<word>[A-Za-z0-9_$@%/.~^&*!?|-]+)
 |(?P<line>\n)
"""


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in re.finditer(ASSIGN, text, re.ASCII) if len(m[2]) >= ASSIGN_VALUE]
    found += [(m.start(), m.end(), "access") for m in re.finditer(ACCESS, text) if len(m[0]) >= ACCESS_LENGTH]
    found += [(m.start(), m.end(), "hex") for m in re.finditer(HEX, text)]
    return found


def name_score(name: str) -> int:
    """Sum over the parts of a camelCase, snake_case, dotted or dashed name; the last qualified part counts."""
    last = re.split(r"[./:]", name.strip("$@%"))[-1]
    parts = re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", last)
    return sum(NAME_PARTS.get(p.lower(), 0) for p in parts)


class Summary:
    """What a score needs of a text that is joined from others, without the text: any number of parts add up in the
    time of their alphabet. ``size`` stays finite where constants are doubled again and again."""

    __slots__ = ("size", "counts", "odd")
    MOST = 1e15

    def __init__(self, size: float, counts: dict[str, float], odd: bool):
        self.size, self.counts, self.odd = size, counts, odd

    @classmethod
    def of(cls, value: str) -> "Summary":
        return cls(len(value), Counter(value), bool(re.search(PLACEHOLDER, value) or re.search(r"\s", value)))

    @classmethod
    def joined(cls, parts: list["Summary"]) -> "Summary":
        size, counts = sum(p.size for p in parts), Counter()
        for p in parts:
            counts.update(p.counts)
        shrink = min(1.0, cls.MOST / size) if size else 1.0
        return cls(size * shrink, {c: n * shrink for c, n in counts.items()} if shrink < 1 else counts, any(p.odd for p in parts))

    def score(self) -> float:
        """Length, mixed characters and entropy speak for a secret; placeholders, blanks and plain words against it."""
        if self.size < MIN_LENGTH or self.odd:
            return -10.0
        entropy = -sum(n / self.size * math.log2(n / self.size) for n in self.counts.values() if n)
        every = "".join(self.counts)
        kinds = sum(bool(re.search(p, every)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
        return min(self.size, 32) / 16 + entropy / 2 + (kinds - 2)


class Value:
    """A literal (with its span), one text joined from several values, or the values that a name may stand for."""

    __slots__ = ("span", "parts", "joins", "known", "weight")

    def __init__(self, span: tuple[int, int] | None, parts: list["Value"], joins: bool, summary: Summary | None = None):
        self.span, self.parts, self.joins, self.known, self.weight = span, parts, joins, summary, None

    def summary(self) -> Summary:
        """Of all that lies below; computed once, from the bottom up and without recursion."""
        path = [self]
        while path:
            value = path[-1]
            missing = [v for v in value.parts if v.known is None]
            if value.known is None and not missing:
                value.known = Summary.joined([v.known for v in value.parts])
            if value.known is not None:
                path.pop()
            else:
                path += missing
        return self.known

    def literals(self, taken: set[int], found: set[tuple[int, int]]) -> None:
        """Add all spans below to ``found``; ``taken`` has what was added before."""
        path = [self]
        while path:
            value = path.pop()
            if id(value) not in taken:
                taken.add(id(value))
                if value.span:
                    found.add(value.span)
                path += value.parts


def closings(tokens: list[tuple]) -> dict[int, int]:
    """Position of the bracket that closes each bracket."""
    opened, out = [], {}
    for i, (kind, op, _, _) in enumerate(tokens):
        if kind == "op" and op in "([{":
            opened.append(i)
        elif kind == "op" and op in ")]}" and opened:
            out[opened.pop()] = i
    return out


def pairs(text: str) -> Iterator[tuple[str, list[list[tuple[str, int, int, bool]]]]]:
    """(name, values) of each assignment. A value is a list of parts (text, start, end, is a literal); a list or a call
    gives one value per element or argument."""
    tokens = []
    for m in re.finditer(TOKENS, text, re.X):
        kind = m.lastgroup if m.lastgroup in ("string", "op", "word", "line", "comment") else "tag" if m["tag"] else "flag"
        if kind in ("tag", "flag"):
            yield m[kind + "name"], [[(m[kind + "value"].strip(), m.start(kind + "value"), m.end(kind + "value"), True)]]
            tokens.append(("line", "", m.start(), m.end()))
        elif kind == "string":
            tokens.append((kind, m[0][1:-1], m.start() + 1, m.end() - 1))
        elif kind != "comment":
            tokens.append((kind, m[0], m.start(), m.end()))
    closes = closings(tokens)
    for i, (kind, op, _, _) in enumerate(tokens):
        if kind != "op" or op not in (":=", "=>", "=", ":") or i == 0:
            continue
        at = i - 1
        while at >= 1 and tokens[at][1] == "]" and tokens[at][0] == "op":           # config["name"] = ...
            at -= 1
        if tokens[at][0] not in ("string", "word"):
            continue
        name, values, j, joined, ends = tokens[at][1], [[]], i + 1, True, []
        while j < len(tokens):
            part, value, start, end = tokens[j]
            after = tokens[j + 1] if j + 1 < len(tokens) else ("line", "", end, end)
            if part == "word" and joined and value == "new" and after[0] == "word":
                pass
            elif part == "word" and joined and after[0] == "op" and after[1] == "(" and after[2] == end:     # called: f("...")
                pass
            elif part in ("string", "word") and joined:
                values[-1].append((value, start, end, part == "string"))
                joined = False
            elif part == "op" and value == "+" and not joined:
                joined = True
            elif part == "op" and value in "([{" and joined:                        # wrapped: f("...", "..."), ["...", "..."]
                if j in closes:
                    ends.append(closes[j])
            elif ends and j == ends[-1]:
                ends.pop()
                joined = False
            elif ends and part == "op" and value in (",", ";"):
                values.append([])
                joined = True
            elif ends and part == "op" and value in ("=", ":", ":=", "=>"):          # what came before names the element
                values[-1] = []
                inner = j + 1
                while tokens[inner][0] == "word":
                    inner += 1
                joined = inner not in closes                                        # brackets of its own are read for its own name
                j = j if joined else closes[inner]
            elif ends and part == "string":
                values.append([(value, start, end, True)])
            elif not ends:
                break
            j += 1
        values = [parts for parts in values if parts]
        if values:
            yield name, values


def named_spans(text: str) -> list[tuple[int, int]]:
    """Literals that reach a sensitive name, directly or through constants.

    A constant is a reference to its values, each literal there is once, and each value is visited with the highest weight that
    reaches it: the work grows with the text, however often constants are used in each other.
    """
    constants: dict[str, Value] = {}
    marks: list[tuple[int, Value]] = []
    for name, values in pairs(text):
        reached = []
        for parts in values:
            known = [constants.get(value.lstrip("$")) if not quoted else None for value, _, _, quoted in parts]
            own = [of or Value((start, end), [], False, Summary.of(value)) for (value, start, end, _), of in zip(parts, known)]
            reached.append(own[0] if len(own) == 1 else Value(None, own, True))
        reached = Value(None, reached, False)
        constants[name.lstrip("$").split(".")[-1] if name.startswith("$") else name] = reached
        weight = name_score(name)
        if weight >= 2:
            marks.append((weight, reached))
    found, taken = set(), set()
    for weight, reached in sorted(marks, key=lambda m: -m[0]):
        path = [reached]
        while path:
            value = path.pop()
            if value.weight is not None:                   # seen with this weight or a higher one
                continue
            value.weight = weight
            if value.span or value.joins:
                if weight + value.summary().score() >= MIN_SCORE:
                    value.literals(taken, found)
            else:
                path += value.parts
    return sorted(span for span in found if span[1] > span[0])


def scan(text: str) -> tuple:
    base = base_spans(text)
    spans = list(base)
    if re.search(SENSITIVE, text):
        spans += [(a, b, "named") for a, b in named_spans(text) if not any(s <= a and b <= e for s, e, _ in base)]
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    write = lambda some: ",".join(f"{kind}:{a}:{b}" for a, b, kind in sorted(some, key=order))
    count = Counter(kind for _, _, kind in spans)
    return (count["assign"], count["access"], count["hex"], hashlib.sha256(write(base).encode()).hexdigest(), write(spans), count["named"])


def scanned(text: Column) -> Column:
    schema = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_named long"
    names = [f.split()[0] for f in schema.split(", ")]

    def scan_all(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([scan(raw.decode("utf-8", "replace")) for raw in batch], columns=names)

    return F.pandas_udf(scan_all, schema)(F.coalesce(text, F.lit("")).cast("binary"))


def find_secrets(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Counts and spans per input row."""
    return docs.select(F.col(key), scanned(F.col(text)).alias("found")).select(key, "found.*")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


QUERIES = {"op2_secret_scan": (op2_secret_scan, None)}
