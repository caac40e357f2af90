"""Conversation structure repair by weighted interval parsing.

A conversation should be a system turn or none, then user and assistant in turn, the
assistant last, or nothing at all. The repair grammar is in Chomsky normal form. Its
nonterminals ``X[p, q]`` derive the spans of rows that take the conversation from state p
to state q; the rules are ``X[p, q] -> X[p, r] X[r, q]`` for all r, and for one row the edits:
keep, change the role, delete. Insertions derive empty spans; closing them under
the rules once gives the cells of the empty span, and every row has these before and after it.

A cell of a span holds the least (cost, audit) of a nonterminal, the audit being the edits'
initials. Cells are combined bottom-up by span length: spans of one row, of two, of four. In
this grammar a span's cells are the same wherever it is split, so one split of each span is
enough (the tests compare with all splits). Audits of one span and cost hold each row's edit
once, so none is the beginning of another one, and the least audits of the parts make
the least of the whole.

On Spark: rows without their texts are sorted by conversation and turn over all tasks, so
that a long conversation lies in several pieces. A task parses its pieces. A conversation in
one piece is decided there; of others only the cells of their pieces meet (two pieces a task
at most) and are combined in the same way, which tells each piece its first and last state.
Pieces then turn into repaired rows, and these fetch their texts by a join. No task
needs to hold a whole conversation, except for its audit, which is one string.

Rows go by turn, null turns first, rows of one turn by role, then by the digest of their text.
Null roles and texts are one space. A row's first fault counts: blank (no character but
ASCII white space), duplicate (role and text seen earlier), truncated (the last character
that is not white space is none of ``.!?``). Blank and duplicate rows have to go. Roles other
than system, user and assistant are told by their first letter. A null ``conv_id`` is a
conversation like others. Rows repeated exactly are duplicates of one another. Texts are read
whole. An empty table gives no rows. Further columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import freeze

# States of a conversation: nothing yet, after a system turn, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
FINAL = (START, ASSISTANT)
TO = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
ROLE = {USER: "user", ASSISTANT: "assistant"}
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

_WHITE = " \t\n\x0b\x0c\r"

Cell = tuple[int, str]
Cells = dict[tuple[int, int], Cell]


def product(left: Cells, right: Cells) -> Cells:
    """The cells of a span from those of its two parts."""
    out: Cells = {}
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            if (r, q) in right:
                more, rest = right[r, q]
                found = (cost + more, audit + rest)
                if (p, q) not in out or found < out[p, q]:
                    out[p, q] = found
    return out


def _closed_insertions() -> Cells:
    """The empty span: nothing, one insertion, and what the rules make of these until nothing changes."""
    cells: Cells = {(p, p): (0, "") for p in STATES}
    cells |= {(p, q): (INSERT, "I") for p in STATES for q in NEXT[p] if q in ROLE}
    while (more := product(cells, cells)) != cells:
        cells = more
    return cells


EMPTY = _closed_insertions()


def _row_cells(initial: str, gone: bool, truncated: bool) -> Cells:
    """One row, with insertions before and after it; ``gone``: it has to be deleted."""
    own: Cells = {(p, p): (DELETE, "D") for p in STATES}
    for p in () if gone else STATES:
        for q in NEXT[p]:
            if TO.get(initial) == q:
                own[p, q] = (TRUNCATED * truncated, "K")
            elif q in ROLE:
                own[p, q] = (RENAME + TRUNCATED * truncated, "R")
    return product(product(EMPTY, own), EMPTY)


_LEAF = {(i, g, t): _row_cells(i, g, t) for i in ("s", "u", "a", "") for g in (False, True) for t in (False, True)}


def row_cells(initial: str, gone: bool, truncated: bool) -> Cells:
    return _LEAF[initial if initial in TO else "", gone, truncated]


def chart(spans: list[Cells]) -> list[list[Cells]]:
    """Cells of spans of 1, 2, 4 ... of the given ones; the last level is the whole."""
    levels = [spans]
    while len(levels[-1]) > 1:
        last = levels[-1]
        paired = [product(last[i], last[i + 1]) for i in range(0, len(last) - 1, 2)]
        levels.append(paired + last[len(paired) * 2 :])
    return levels


class Fold:
    """The cells of a growing span; keeps those of a few spans of halving lengths only."""

    def __init__(self) -> None:
        self.parts: list[tuple[int, Cells]] = []

    def add(self, cells: Cells) -> None:
        n = 1
        while self.parts and self.parts[-1][0] == n:
            cells = product(self.parts.pop()[1], cells)
            n *= 2
        self.parts.append((n, cells))

    def whole(self) -> Cells:
        out = EMPTY
        for _, cells in reversed(self.parts):
            out = product(cells, out)
        return out


def best(cells: Cells) -> tuple[Cell, int]:
    """The cheapest repair of a whole conversation, and the state it ends in."""
    return min((cells[START, q], q) for q in FINAL if (START, q) in cells)


def states(levels: list[list[Cells]], last: int) -> list[tuple[int, int]]:
    """The first and last state of each span of the lowest level, in the cheapest repair that ends in ``last``."""
    found = [(START, last)]
    for above, below in zip(levels[:0:-1], levels[-2::-1], strict=True):
        parts = []
        for i, (p, q) in enumerate(found):
            if 2 * i + 1 == len(below):  # the odd one went up alone
                parts.append((p, q))
                continue
            left, right = below[2 * i], below[2 * i + 1]
            r = next(
                r
                for r in STATES
                if (p, r) in left
                and (r, q) in right
                and (left[p, r][0] + right[r, q][0], left[p, r][1] + right[r, q][1]) == above[i][p, q]
            )
            parts += [(p, r), (r, q)]
        found = parts
    return found


def edited(audit: str, roles: list[str], state: int) -> Iterator[tuple[int | None, str]]:
    """The rows that are left, in order: which row it was (none if inserted) and its role."""
    row = 0
    for edit in audit:
        if edit == "D":
            row += 1
        elif edit == "K":
            state = TO[roles[row][:1]]
            yield row, roles[row]
            row += 1
        else:
            state = USER if USER in NEXT[state] else ASSISTANT
            yield (None if edit == "I" else row), ROLE[state]
            row += edit == "R"


@dataclass
class Piece:
    """Consecutive rows of one conversation."""

    conv: int | None
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(("blank", "duplicate", "truncated"), 0))
    illegal: int = 0
    first_initial: str | None = None
    last_initial: str | None = None
    first_turn: int | None = None
    last_turn: int | None = None
    turns: int = 0
    span: Fold = field(default_factory=Fold)
    roles: list[str] = field(default_factory=list)
    digests: list[bytes] = field(default_factory=list)

    def add(self, row: dict) -> None:
        initial = row["role"][:1]
        if self.last_initial is None:
            self.first_initial = initial
        else:
            self.illegal += not legal(self.last_initial, initial)
        self.last_initial = initial
        if row["turn"] is not None:
            self.first_turn = row["turn"] if self.turns == 0 else self.first_turn
            self.turns += self.turns == 0 or row["turn"] != self.last_turn
            self.last_turn = row["turn"]
        fault = "blank" if row["blank"] else "duplicate" if row["again"] else "truncated" if row["cut"] else None
        if fault:
            self.counts[fault] += 1
        self.span.add(row_cells(initial, fault in ("blank", "duplicate"), fault == "truncated"))
        self.roles.append(row["role"])
        self.digests.append(row["digest"])


def legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


_HEAD = (
    "conv_id bigint, piece int, at int, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "first_initial string, last_initial string, first_turn bigint, last_turn bigint, turns bigint, "
    "cells array<struct<p:int,q:int,cost:bigint,audit:string>>, first int, last int"
)
_PIECES = f"{_HEAD}, roles array<string>, digests array<binary>"
_DECIDED = "conv_id bigint, piece int, at int, first int, last int, summary struct<gaps:bigint,blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,cost:bigint,audit:string>"
_ARROW = {
    "cells": pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])),
    "roles": pa.list_(pa.string()),
    "digests": pa.list_(pa.binary()),
}


def _batch(rows: list[dict], names: Iterable[str]) -> pa.RecordBatch:
    kinds = {"piece": pa.int32(), "at": pa.int32(), "first": pa.int32(), "last": pa.int32()} | _ARROW
    kinds |= dict.fromkeys(("first_initial", "last_initial"), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[n] for r in rows], kinds.get(n, pa.int64())) for n in names], names=list(names)
    )


_FIELDS = [f.split(" ")[0] for f in _HEAD.split(", ")] + ["roles", "digests"]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to pieces. The first and last piece of a task may go on in others; the rest is decided."""
    at, open_, done = 0, None, []

    def closed(piece: Piece, edge: bool) -> dict:
        cells = piece.span.whole()
        first, last = (None, None) if edge else (START, best(cells)[1])
        listed = [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in cells.items() if edge or (p, q) == (first, last)]
        own = {n: getattr(piece, n) for n in _FIELDS if hasattr(piece, n)}
        return own | piece.counts | {"conv_id": piece.conv, "piece": number, "at": at, "cells": listed, "first": first, "last": last}

    number = None
    for batch in batches:
        for row in batch.to_pylist():
            number = row["piece"]
            if open_ is None or row["conv_id"] != open_.conv:
                if open_ is not None:
                    done.append(closed(open_, at == 0))
                    at += 1
                open_ = Piece(row["conv_id"])
            if not row["dropped"]:
                open_.add(row)
        if len(done) > 1000:
            yield _batch(done, _FIELDS)
            done = []
    if open_ is not None:
        done.append(closed(open_, True))
    if done:
        yield _batch(done, _FIELDS)


def _combine(pieces: list[dict]) -> list[dict]:
    """The states of a conversation's pieces; the first one has the summary too."""
    pieces = sorted(pieces, key=lambda r: (r["piece"], r["at"]))
    spans = [{(c["p"], c["q"]): (c["cost"], c["audit"]) for c in r["cells"]} for r in pieces]
    levels = chart(spans)
    (cost, audit), last = best(levels[-1][0])
    total = {n: sum(r[n] for r in pieces) for n in ("blank", "duplicate", "truncated", "illegal")}
    ends = [(r["first_initial"], r["last_initial"]) for r in pieces if r["first_initial"] is not None]
    total["illegal"] += sum(not legal(a[1], b[0]) for a, b in zip(ends, ends[1:], strict=False))
    dated = [r for r in pieces if r["turns"]]
    turns = sum(r["turns"] for r in dated) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(dated, dated[1:], strict=False))
    total["gaps"] = dated[-1]["last_turn"] - dated[0]["first_turn"] + 1 - turns if dated else 0
    total |= {"cost": cost, "audit": audit}
    ways = states(levels, last)
    return [
        {"conv_id": r["conv_id"], "piece": r["piece"], "at": r["at"], "first": p, "last": q, "summary": total if i == 0 else None}
        for i, (r, (p, q)) in enumerate(zip(pieces, ways, strict=True))
    ]


_SUMMARY = pa.struct([(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string())])
_OUT = pa.schema(
    [("conv_id", pa.int64()), ("piece", pa.int32()), ("at", pa.int32()), ("first", pa.int32()), ("last", pa.int32()), ("summary", _SUMMARY)]
)


def _alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations in one piece."""
    for batch in batches:
        rows = [row for r in batch.to_pylist() for row in _combine([r])]
        yield pa.RecordBatch.from_pylist(rows, schema=_OUT)


def _together(rows: pa.Table) -> pa.Table:
    return pa.Table.from_pylist(_combine(rows.to_pylist()), schema=_OUT)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with their states to the rows that are left."""
    names = ["conv_id", "piece", "at", "place", "role", "old_role", "digest"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.binary()]
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            audit = next(c["audit"] for c in r["cells"] if (c["p"], c["q"]) == (r["first"], r["last"]))
            for place, (row, role) in enumerate(edited(audit, r["roles"], r["first"])):
                # an inserted row looks for no text, under a key that spreads
                own = ("", f"{r['piece']}:{r['at']}:{place}".encode())
                old, digest = own if row is None else (r["roles"][row], r["digests"][row])
                out.append((r["conv_id"], r["piece"], r["at"], place, role, old, digest))
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def plain_turns(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text, null roles and texts as one space."""
    space = F.lit(" ")
    return rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
    )


def _digest(text: str | Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@dataclass
class Repair:
    """``conversations`` has a row per conversation: gaps, faults, cost and audit. ``rows`` are
    what is left, ordered within a conversation by piece, at and place: conv_id, role and text."""

    conversations: DataFrame
    rows: DataFrame


def repair(turns: DataFrame) -> Repair:
    """Find the cheapest edits of each conversation and make them.

    ``turns`` has conv_id, turn, role and text, and may have ``dropped``: such rows are not
    there, but their conversations are.
    """
    if "dropped" not in turns.columns:
        turns = plain_turns(turns).withColumn("dropped", F.lit(False))
    solid = F.rtrim(F.col("text"), F.lit(_WHITE))
    light = turns.select(
        "conv_id",
        "turn",
        "role",
        _digest("text").alias("digest"),
        (solid == "").alias("blank"),
        (~F.substring(solid, -1, 1).isin(".", "!", "?")).alias("cut"),
        "dropped",
    )
    # equal rows of one turn become one with a count, so copies fold before they move
    light = light.groupBy("conv_id", "turn", "role", "digest", "blank", "cut", "dropped").agg(F.count("*").alias("copies"))
    light = freeze(light)
    order = F.struct(F.col("turn").isNotNull(), "turn")
    seen = light.where("not dropped").groupBy(*[F.col(c).alias(f"{c}_") for c in ("conv_id", "role", "digest")])
    first = seen.agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    mine = F.col("conv_id").eqNullSafe(F.col("conv_id_")) & (F.col("role") == F.col("role_")) & (F.col("digest") == F.col("digest_"))
    joined = light.join(first, mine, "left")
    joined = joined.withColumn("again", F.col("n").isNotNull() & ~order.eqNullSafe(F.col("first")))
    rows = joined.select("conv_id", "turn", "role", "digest", "blank", "cut", "dropped", "again", F.posexplode(F.sequence(F.lit(1), F.col("copies"))).alias("copy", "_"))
    rows = rows.withColumn("again", F.col("again") | (F.col("copy") > 0)).drop("_")
    keys = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest", "copy"]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("piece", F.spark_partition_id())
    pieces = freeze(rows.mapInArrow(_parse, _PIECES))

    heads = pieces.drop("roles", "digests")
    alone = heads.where("first is not null").mapInArrow(_alone, _DECIDED)
    several = heads.where("first is null").groupBy("conv_id").applyInArrow(_together, _DECIDED)
    decided = freeze(alone.unionByName(several))
    found = decided.where("summary is not null").select("conv_id", "summary.*")
    way = decided.select("piece", "at", "first", "last")
    left = pieces.drop("first", "last").join(way, ["piece", "at"])
    left = left.mapInArrow(_repaired, "conv_id bigint, piece int, at int, place int, role string, old_role string, digest binary")
    texts = turns.where("not dropped").groupBy(
        F.col("conv_id").alias("conv_"), F.col("role").alias("old_role"), _digest("text").alias("digest")
    ).agg(F.first("text").alias("text"))
    on = left.conv_id.eqNullSafe(texts.conv_) & (left.old_role == texts.old_role) & (left.digest == texts.digest)
    full = left.join(texts, on, "left").select(
        left.conv_id, "piece", "at", "place", "role", F.coalesce("text", F.lit("")).alias("text")
    )
    return Repair(found, full)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of whole conversations to one hash for each, row after row."""
    conv, running, out = None, None, []
    for batch in batches:
        for row in batch.to_pylist():
            line = f"{row['role']}:{row['text']}".encode()
            if running is None or row["conv_id"] != conv:
                if running is not None:
                    out.append((conv, running.hexdigest()))
                conv, running = row["conv_id"], hashlib.sha256(line)
            else:
                running.update(b"\n" + line)
    if running is not None:
        out.append((conv, running.hexdigest()))
    columns = [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.string())]
    yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "repaired_sha256"])


def digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines.

    The hash goes over the lines one after another, so a conversation's rows pass one task; it holds one batch.
    """
    sorted_ = rows.repartition("conv_id").sortWithinPartitions("conv_id", "piece", "at", "place")
    return sorted_.mapInArrow(_hashed, "conv_id bigint, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with planted faults, picked by a checksum of conversation and turn."""
    turns = plain_turns(rows)
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(name.cast("binary")) % 20
    turns = turns.withColumn("kind", kind)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return turns.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("dropped"), copies.alias("copy")
    ).drop("copy")


def report(rows: DataFrame) -> DataFrame:
    """Damage conversations, repair them, and say how, per conversation."""
    done = repair(damaged(rows))
    hashes = digests(done.rows).withColumnRenamed("conv_id", "conv_")
    found = done.conversations
    joined = found.join(hashes, found.conv_id.eqNullSafe(hashes.conv_), "left").drop("conv_")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select(
        *["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"],
        F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
    )
