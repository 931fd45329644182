"""Repair of conversation structure by weighted CYK parsing of intervals.

The role initials of a repaired conversation form ``(s?(ua)+)?``. The grammar is in Chomsky normal form: a nonterminal
``pq`` stands for what leads the pattern from state p to state q, with the binary rules ``pq -> pr rq`` and, for each row,
the terminal rules of its edits: Keep, Rerole to user or assistant, Delete. ``CLOSURE`` has the cheapest insertions for
the empty span and is applied on both sides of every row, so that empty rows may be inserted anywhere.

A cell holds, for one span of rows, the least (cost, audit) of every nonterminal; the audit spells the edits. Every
binary rule may split a span at any place with the same result, because any state may stand there; so spans are combined
bottom-up by their length (1, 2, 4, ...), each from its two halves, and a span of n rows takes n - 1 combinations. Two audits of equal
cost over one span are never prefixes of each other (the longer one would have paid for its insertions), so the least
audit of a span is made of the least audits of its halves.

1. Faults are found by Column expressions; an earlier equal row is found by the least place per (conversation, role, text).
2. Rows are sorted by range of (conversation, place), so a long conversation lies in many tasks. A task reads its rows in order and
   parses them in pieces of at most PIECE_ROWS rows or PIECE_BYTES of text. A conversation that surely begins and ends in
   the piece is finished there.
3. The cells of the other pieces are combined, 2^FAN_BITS at a time, until one span per conversation is left.
4. These conversations are read again piece by piece, in order, beside their audit, to digest the repaired text: no more
   than one piece is held.

Defined results: a null role or text is one space. Null turns come first; rows of one turn are ordered by role and by the
digest of role and text, a repetition directly after its original. Conversations without a key are one conversation. A
conversation of which no row is left has no faults, no cost, an empty audit and the digest of the empty text. Rows repeated exactly are
duplicates of their first. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from matchloom.llm.common import crc32_sql, stored, table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: The pattern's states: 0 nothing yet, S after s, U after u, A after a; steps by initial.
STEPS = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}
STATES, ACCEPTED = "0SUA", "0A"
ROLES = {"u": "user", "a": "assistant"}
PIECE_ROWS, PIECE_BYTES = 2048, 4 << 20
FAN_BITS = 5               # 32 spans are joined at a time
BLANKS = " \t\n\x0b\f\r"

Cell = dict[str, tuple[int, str]]


def combined(left: Cell, right: Cell) -> Cell:
    """Binary rules ``pq -> pr rq``: the cell of two adjacent spans."""
    out: Cell = {}
    for pr, (cost, audit) in left.items():
        for q in STATES:
            tail = right.get(pr[1] + q)
            if tail:
                pq, total = pr[0] + q, cost + tail[0]
                best = out.get(pq)
                if best is None or total < best[0] or (total == best[0] and audit + tail[1] < best[1]):
                    out[pq] = (total, audit + tail[1])
    return out


def least(options: list[tuple[str, int, str]]) -> Cell:
    out: Cell = {}
    for pq, cost, audit in options:
        out[pq] = min(out.get(pq, (cost, audit)), (cost, audit))
    return out


def _closure() -> Cell:
    """Cheapest insertions between any two states: none, one row, or more, until nothing gets cheaper."""
    cell = least([(p + p, 0, "") for p in STATES] + [(p + q, INSERT, "I") for (p, i), q in STEPS.items() if i in ROLES])
    while (more := combined(cell, cell)) != cell:
        cell = more
    return cell


CLOSURE = _closure()


@lru_cache(maxsize=64)
def row_cell(kind: str) -> Cell:
    """Terminal rules of one row. ``kind``: x must be deleted, else the initial s, u, a or o (any other), upper-case where
    the row is truncated."""
    options = [(p + p, DELETE, "D") for p in STATES]
    if kind != "x":
        extra = TRUNCATED * kind.isupper()
        options += [(p + q, KEEP + extra, "K") for (p, i), q in STEPS.items() if i == kind.lower()]
        options += [(p + q, REROLE + extra, "R") for (p, i), q in STEPS.items() if i in ROLES]
    return combined(combined(CLOSURE, least(options)), CLOSURE)


def span_cell(cells: list[Cell]) -> Cell:
    """The cell of adjacent spans, bottom-up by span length."""
    while len(cells) > 1:
        cells = [combined(cells[i], cells[i + 1]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0] if cells else CLOSURE


@lru_cache(maxsize=1 << 14)
def short_cell(kinds: str) -> Cell:
    """Many short conversations have the same kinds of rows."""
    return span_cell([row_cell(k) for k in kinds])


def parse(kinds: str) -> Cell:
    return short_cell(kinds) if len(kinds) <= 16 else span_cell([row_cell(k) for k in kinds])


def verdict(cell: Cell) -> tuple[int, str]:
    """Least (cost, audit) of a whole conversation."""
    return min(cell["0" + q] for q in ACCEPTED if "0" + q in cell)


def kind_of(fault: str, initial: str) -> str:
    if fault in ("blank", "duplicate"):
        return "x"
    kind = initial if initial in "sua" and initial else "o"
    return kind.upper() if fault == "truncated" else kind


class Repair:
    """Follows an audit row by row; what it writes is digested, newline-joined."""

    def __init__(self):
        self.state, self.sha, self.first = "0", hashlib.sha256(), True

    def write(self, role: str, text: str) -> None:
        self.sha.update(f"{'' if self.first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.first = False

    def wanted(self) -> str:
        """The initial that the pattern asks for; insertions and new roles follow it."""
        return "a" if self.state == "U" else "u"

    def insert(self) -> None:
        self.step(ROLES[self.wanted()], "", self.wanted())

    def step(self, role: str, text: str, initial: str) -> None:
        self.write(role, text)
        self.state = STEPS[self.state, initial]

    def row(self, edit: str, role: str, text: str) -> None:
        if edit == "K":
            self.step(role, text, role[:1])
        elif edit == "R":
            self.step(ROLES[self.wanted()], text, self.wanted())

    def rows(self, audit: str, at: int, roles: list[str], texts: list[str]) -> int:
        """Apply the audit from ``at`` on to these rows, with the insertions before each; returns the place after them."""
        for role, text in zip(roles, texts):
            while audit[at] == "I":
                self.insert()
                at += 1
            self.row(audit[at], role, text)
            at += 1
        return at

    def end(self, audit: str, at: int) -> str:
        for _ in audit[at:]:
            self.insert()
        return self.sha.hexdigest()


class Piece:
    """Consecutive rows of one conversation: counts that add up across pieces, and what is needed where pieces meet."""

    def __init__(self):
        self.kinds, self.roles, self.texts, self.bytes = [], [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if self.roles and not legal(self.roles[-1], role):
            self.illegal += 1
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        self.kinds.append(kind_of(fault, role[:1]))
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(text)

    def full(self, rows: int) -> bool:
        return len(self.roles) >= rows or self.bytes >= PIECE_BYTES


def legal(before: str, after: str) -> bool:
    return before[:1] + after[:1] in ("su", "ua", "au")


COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns", "low", "high"]
SHAPE = ("part int, seq long, rows long, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, "
         "first_role string, last_role string, cell array<struct<pq: string, cost: long, audit: string>>, roles array<string>, texts array<string>, "
         "whole boolean, cost long, audit string, repaired_sha256 string")
ROW_TYPE = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()),
            "array<struct<pq: string, cost: long, audit: string>>": pa.list_(pa.struct([("pq", pa.string()), ("cost", pa.int64()), ("audit", pa.string())]))}


def _types(shape: str) -> dict[str, pa.DataType]:
    out = {}
    for one in shape.replace("struct<pq: string, cost: long, audit: string>", "CELL").split(", "):
        name, kind = one.split(" ", 1)
        out[name] = ROW_TYPE[kind.replace("CELL", "struct<pq: string, cost: long, audit: string>")]
    return out


def packed_cell(cell: Cell) -> list[dict]:
    return [{"pq": pq, "cost": cost, "audit": audit} for pq, (cost, audit) in cell.items()]


def unpacked_cell(rows: list[dict]) -> Cell:
    return {r["pq"]: (r["cost"], r["audit"]) for r in rows}


def faulted(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, turn, role, text, copy, dropped) with their fault and digest. The first fault counts."""
    shown = F.rtrim("text", F.lit(BLANKS))
    marked = rows.withColumn("blank", shown == "").withColumn("cut", ~F.right(shown, F.lit(1)).isin(".", "!", "?")).withColumn(
        "said", F.sha2(F.concat_ws("\0", F.length("role").cast("string"), "role", "text"), 256))
    place = F.struct(F.col("turn").isNotNull().alias("placed"), "turn", "copy")
    heard = marked.filter("not dropped and not blank").groupBy(F.col("conv").alias("_conv"), F.col("said").alias("_said")).agg(F.min(place).alias("earliest"))
    met = marked.join(heard, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("said") == F.col("_said")), "left")
    later = F.coalesce(F.col("earliest") < place, F.lit(False))
    return met.select("conv", "turn", "role", "text", "said", "copy", "dropped", F.when(F.col("blank"), "blank").when(later, "duplicate").when(
        F.col("cut"), "truncated").otherwise("").alias("fault"))


def parsed(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Pieces of ``faulted`` rows; those that are whole conversations come with their result and without their texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, out = TaskContext.get().partitionId(), 0, []

        def made(conv, piece: Piece, whole: bool) -> dict:
            nonlocal seq
            cell, row = parse("".join(piece.kinds)), {"conv": conv, "part": part, "seq": seq, "rows": len(piece.roles), "whole": whole}
            seq += not whole                                               # places are given to pieces that must be combined
            row |= {c: getattr(piece, c) for c in COUNTS}
            if whole:
                row["cost"], row["audit"] = verdict(cell)
                repair = Repair()
                row["repaired_sha256"] = repair.end(row["audit"], repair.rows(row["audit"], 0, piece.roles, piece.texts))
            else:
                row |= {"cell": packed_cell(cell), "roles": piece.roles, "texts": piece.texts,
                        "first_role": piece.roles[0] if piece.roles else None, "last_role": piece.roles[-1] if piece.roles else None}
            return row

        def shown() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in out], t) for n, t in types.items()], names=list(types))

        conv, piece, inside, before, held = object(), None, False, None, 0
        for batch in batches:
            types = {"conv": batch.schema.field("conv").type, **_types(SHAPE)}
            for name, turn, role, text, said, dropped, fault in zip(*[batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "said", "dropped", "fault")]):
                if piece is None or name != conv:
                    if piece is not None:
                        out.append(made(conv, piece, inside))              # the next conversation begins: this one has ended here
                        held += 0 if inside else piece.bytes
                    inside = piece is not None                             # a task's first conversation may have begun in another
                    conv, piece, before = name, Piece(), None
                elif piece.full(piece_rows):
                    out.append(made(conv, piece, False))
                    held += piece.bytes
                    inside, piece = False, Piece()
                if not dropped:
                    piece.add(turn, role, text, "duplicate" if (turn, said) == before and not fault == "blank" else fault)
                    before = (turn, said)
                if len(out) >= 4096 or held >= PIECE_BYTES:
                    yield shown()
                    out, held = [], 0
        if piece is not None:
            out.append(made(conv, piece, False))                           # it may go on in the next task
        if out:
            yield shown()

    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("said"), F.col("copy")]
    kind = rows.schema["conv"].dataType.simpleString()
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "turn", "role", "text", "said", "dropped", "fault").mapInArrow(run, f"conv {kind}, {SHAPE}")


def joined_spans(spans: list[dict]) -> dict:
    """One span from adjacent ones, in order."""
    out = {c: sum(s[c] for s in spans) for c in ("rows", "blank", "duplicate", "truncated", "illegal", "turns")}
    out |= {"low": None, "high": None, "first_role": None, "last_role": None}
    for s in spans:
        if s["rows"]:
            out["illegal"] += out["last_role"] is not None and not legal(out["last_role"], s["first_role"])
            out["first_role"] = s["first_role"] if out["first_role"] is None else out["first_role"]
            out["last_role"] = s["last_role"]
        if s["low"] is not None:
            out["turns"] -= s["low"] == out["high"]
            out["low"], out["high"] = s["low"] if out["low"] is None else out["low"], s["high"]
    out["cell"] = packed_cell(span_cell([unpacked_cell(s["cell"]) for s in spans]))
    return out


SPAN = ["rows", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first_role", "last_role", "cell"]


def merged(spans: DataFrame, fan_bits: int = FAN_BITS) -> DataFrame:
    """Adjacent spans of a conversation as one: those whose place agrees but for its lowest bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                near = batch.column("near")[i].as_py()
                row = {"conv": batch.column("conv")[i].as_py(), "place": batch.column("place")[i].as_py(), "first": near[0]["first"], **joined_spans(near)}
                yield pa.RecordBatch.from_arrays([pa.array([row[n]], t) for n, t in types(batch).items()], names=list(types(batch)))

    def types(batch: pa.RecordBatch) -> dict[str, pa.DataType]:
        shape = _types(SHAPE)
        return {"conv": batch.schema.field("conv").type, "place": pa.int64(), "first": pa.int64(), **{c: shape[c] for c in SPAN}}

    kind = spans.schema["conv"].dataType.simpleString()
    shape = ", ".join(f"{c} {_ddl(c)}" for c in SPAN)
    near = spans.groupBy("conv", F.shiftright("place", fan_bits).alias("above")).agg(F.sort_array(F.collect_list(F.struct("place", "first", *SPAN))).alias("near"))
    return near.select("conv", F.col("above").alias("place"), "near").mapInArrow(run, f"conv {kind}, place long, first long, {shape}")


def _ddl(column: str) -> str:
    return next(f.split(" ", 1)[1] for f in SHAPE.replace("struct<pq: string, cost: long, audit: string>", "CELL").split(", ") if f.startswith(column + " ")).replace(
        "CELL", "struct<pq: string, cost: long, audit: string>")


def judged(spans: DataFrame) -> DataFrame:
    """Cost and audit of whole conversations, from their cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [verdict(unpacked_cell(c.as_py())) for c in batch.column("cell")]
            shown = batch.drop_columns(["cell"])
            yield pa.RecordBatch.from_arrays([*shown.columns, pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
                                             names=[*shown.schema.names, "cost", "audit"])

    kind = spans.schema["conv"].dataType.simpleString()
    columns = ["first", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high"]
    return spans.select("conv", *columns, "cell").mapInArrow(run, f"conv {kind}, {', '.join(f'{c} long' for c in columns)}, cost long, audit string")


def digested(pieces: DataFrame, verdicts: DataFrame) -> DataFrame:
    """repaired_sha256 of conversations in several pieces. A digest runs through its text from first to last, so a conversation's
    pieces pass through one task, one at a time; only its first piece carries the audit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, repair, audit, at = None, None, "", 0

        def ended() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([conv], conv_type), pa.array([repair.end(audit, at)], pa.string())], names=["conv", "repaired_sha256"])

        for batch in batches:
            conv_type = batch.schema.field("conv").type
            for i in range(batch.num_rows):
                start = batch.column("audit")[i].as_py()
                if start is not None:
                    if repair is not None:
                        yield ended()
                    conv, repair, audit, at = batch.column("conv")[i].as_py(), Repair(), start, 0
                at = repair.rows(audit, at, batch.column("roles")[i].as_py(), batch.column("texts")[i].as_py())
        if repair is not None:
            yield ended()

    kind = pieces.schema["conv"].dataType.simpleString()
    starts = verdicts.select(F.col("conv").alias("_conv"), F.col("first").alias("_first"), "audit")
    order = ["conv", "place"]
    return pieces.select("conv", "place", "roles", "texts").join(starts, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("place") == F.col("_first")), "left").select(
        "conv", "place", "roles", "texts", "audit").repartition("conv").sortWithinPartitions(*order).mapInArrow(run, f"conv {kind}, repaired_sha256 string")


def repair_conversations(rows: DataFrame, piece_rows: int = PIECE_ROWS, fan_bits: int = FAN_BITS) -> DataFrame:
    """``rows`` (conv, turn, role, text, copy, dropped): a dropped row only tells that its conversation exists. Returns
    conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 per conversation."""
    pieces = stored(parsed(stored(faulted(rows), "conversation-rows"), piece_rows), "conversation-pieces")
    most = pieces.filter("not whole").agg(F.max("seq").alias("most")).first().most or 0
    bits = -(-most.bit_length() // fan_bits) * fan_bits                    # as few as the task with most pieces needs
    parts = pieces.filter("not whole").withColumn("place", F.shiftleft(F.col("part").cast("long"), bits) + F.col("seq"))
    spans = parts.withColumn("first", F.col("place")).select("conv", "place", "first", *SPAN)
    while not spans.groupBy("conv").count().filter("count > 1").isEmpty():
        spans = stored(merged(spans, fan_bits), "conversation-spans")
    verdicts = stored(judged(spans), "conversation-verdicts")
    digests = digested(parts, verdicts).withColumnRenamed("conv", "_conv")
    long_ones = verdicts.join(digests, F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv", "first")
    columns = ["conv", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "cost", "audit", "repaired_sha256"]
    both = pieces.filter("whole").select(*columns).unionByName(long_ones.select(*columns))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("long")).alias("gaps")
    return both.select("conv", gaps, "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage, by crc32(``conv_id:turn``) % 20: 0 drops a row, 1 empties its text, 2 removes sentence ends,
    3 repeats it, 4 makes it a user's. A dropped row stays as a mark without role and text."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
    copies = rows.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    gone = F.col("kind") == 0
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).when(~gone, F.col("text"))
    return copies.select("conv", F.when(~gone, F.col("turn")).alias("turn"), F.when(F.col("kind") == 4, "user").when(~gone, F.col("role")).alias("role"),
                         text.alias("text"), "copy", gone.alias("dropped"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(table(spark, sf_dir, "conversations"))).withColumnRenamed("conv", "conv_id")


#: The same by dynamic programming over rows and states, least (cost, audit) first.
SQL = f"""WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {crc32_sql("concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' '))")} % 20 AS kind FROM conversations),
damaged AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM c),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
  sha256(concat(length(role)::VARCHAR, chr(0), role, chr(0), text)), copy) AS n, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown FROM damaged),
faults AS MATERIALIZED (SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
  WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
steps(p, i, q) AS (VALUES ('0', 's', 'S'), ('0', 'u', 'U'), ('S', 'u', 'U'), ('U', 'a', 'A'), ('A', 'u', 'U')),
inserted(p, q, cost, audit) AS (VALUES ('0', '0', 0, ''), ('S', 'S', 0, ''), ('U', 'U', 0, ''), ('A', 'A', 0, ''), ('0', 'U', 5, 'I'),
  ('S', 'U', 5, 'I'), ('U', 'A', 5, 'I'), ('A', 'U', 5, 'I'), ('0', 'A', 10, 'II'), ('S', 'A', 10, 'II')),
edits AS (SELECT q AS p, q, 2 AS cost, 'D' AS audit, NULL AS initial, FALSE AS kept FROM (SELECT DISTINCT q FROM inserted)
  UNION ALL SELECT p, q, 0, 'K', i, TRUE FROM steps UNION ALL SELECT p, q, 1, 'R', NULL, TRUE FROM steps WHERE i <> 's'),
best(conv_id, n, q, cost, audit) AS (SELECT conv_id, 0, q, cost::BIGINT, audit FROM (SELECT DISTINCT conv_id FROM conversations), inserted WHERE p = '0'
  UNION ALL SELECT conv_id, n, q, least.cost, least.audit FROM (
    SELECT b.conv_id, b.n + 1 AS n, i.q, min({{'cost': b.cost + e.cost + CASE WHEN e.kept AND f.fault = 'truncated' THEN 5 ELSE 0 END + i.cost,
      'audit': b.audit || e.audit || i.audit}}) AS least
    FROM best b JOIN faults f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.n = b.n + 1 JOIN edits e ON e.p = b.q
      AND (e.initial IS NULL OR e.initial = left(f.role, 1)) AND NOT (e.kept AND f.fault IN ('blank', 'duplicate')) JOIN inserted i ON i.p = e.q
    GROUP BY b.conv_id, b.n, i.q)),
ended AS (SELECT conv_id, min({{'cost': cost, 'audit': audit}}) AS least FROM best WHERE q IN ('0', 'A')
  AND n = (SELECT count(*) FROM faults f WHERE f.conv_id IS NOT DISTINCT FROM best.conv_id) GROUP BY conv_id),
letters AS (SELECT conv_id, unnest(string_split(least.audit, '')) AS edit, generate_subscripts(string_split(least.audit, ''), 1) AS pos FROM ended WHERE least.audit <> ''),
numbered AS (SELECT *, count(*) FILTER (WHERE edit <> 'I') OVER w AS n, count(*) FILTER (WHERE edit <> 'D') OVER w AS no FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
kept AS (SELECT k.conv_id, pos, edit, no, role, text, max(CASE WHEN no = 1 AND edit = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY k.conv_id) AS headed
  FROM numbered k LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM k.conv_id AND f.n = k.n AND edit <> 'I' WHERE edit <> 'D'),
repaired AS (SELECT conv_id, string_agg(concat(CASE WHEN edit = 'K' THEN role WHEN (no - headed) % 2 = 1 THEN 'user' ELSE 'assistant' END, ':', coalesce(text, '')),
  chr(10) ORDER BY pos) AS whole FROM kept GROUP BY conv_id),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
  count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
  count(*) FILTER (WHERE before IS NOT NULL AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM faults) GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, least.cost AS cost, least.audit AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM ended e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM e.conv_id
"""

QUERIES = {"op12_conversation_repair": (op12_conversation_repair, SQL)}
