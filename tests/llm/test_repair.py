"""Conversation repair against a chart with all splits, and against a search row by row."""

import hashlib
import random
import re
import zlib

import pytest

from tests.conftest import rows
from tidemark.llm import repair

VALID = re.compile(r"(s?(ua)+)?")
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(given):
    """(cost, audit) over (initial, gone, truncated) rows, row by row over the states."""
    step = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def inserted(best):
        for _ in range(3):
            for p, (cost, audit) in list(best.items()):
                for c, q in step[p].items():
                    if c != "s":
                        best[q] = min(best.get(q, (10**9, "")), (cost + 2, audit + "I"))
        return best

    best = inserted({0: (0, "")})
    for initial, gone, cut in given:
        new = {}
        for p, (cost, audit) in best.items():
            new[p] = min(new.get(p, (10**9, "")), (cost + 3, audit + "D"))
            for c, q in () if gone else step[p].items():
                if c == initial:
                    new[q] = min(new.get(q, (10**9, "")), (cost + cut, audit + "K"))
                elif c != "s":
                    new[q] = min(new.get(q, (10**9, "")), (cost + 2 + cut, audit + "R"))
        best = inserted(new)
    return min(best[q] for q in (0, 3) if q in best)


def all_splits(given):
    """The same from a chart in which each span tries every split."""
    n = len(given)
    chart = {(i, i + 1): repair.row_cells(*row) for i, row in enumerate(given)}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            cells = {}
            for k in range(i + 1, i + size):
                for key, found in repair.product(chart[i, k], chart[k, i + size]).items():
                    cells[key] = min(cells.get(key, found), found)
            chart[i, i + size] = cells
    return repair.best(chart[0, n])[0] if n else repair.best(repair.EMPTY)[0]


def random_rows(rng, n):
    return [(rng.choice("suuaaat"), rng.random() < 0.15, rng.random() < 0.3) for _ in range(n)]


@pytest.mark.parametrize("seed", range(30))
def test_one_split_a_span_is_enough(seed):
    rng = random.Random(seed)
    given = random_rows(rng, rng.randint(0, 9))
    fold = repair.Fold()
    for row in given:
        fold.add(repair.row_cells(*row))
    found = repair.best(fold.whole())[0]
    assert found == cheapest(given) == all_splits(given)


@pytest.mark.parametrize("seed", range(10))
def test_pieces_combine_to_the_whole(seed):
    rng = random.Random(seed)
    given = random_rows(rng, 40)
    cuts = sorted(rng.sample(range(41), 6))
    pieces = [given[a:b] for a, b in zip([0, *cuts], [*cuts, 40], strict=True)]
    spans = []
    for piece in pieces:
        fold = repair.Fold()
        for row in piece:
            fold.add(repair.row_cells(*row))
        spans.append(fold.whole())
    levels = repair.chart(spans)
    (cost, audit), last = repair.best(levels[-1][0])
    assert (cost, audit) == cheapest(given)
    ways = repair.states(levels, last)
    assert ways[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ways, ways[1:], strict=False))
    assert "".join(s[w][1] for s, w in zip(spans, ways, strict=True)) == audit


def damaged(given):
    out = []
    for conv, turn, role, text, *_ in given:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        row = (conv, turn, "user" if kind == 4 else role, text)
        out += [] if kind == 0 else [row] * (1 + (kind == 3))
    return out


def expected(given):
    found = []
    for conv in {r[0] for r in given}:
        digest = lambda t: hashlib.sha256(t.encode()).digest()
        mine = [r for r in damaged(given) if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r[3])))
        seen, faults = set(), []
        for _, _, role, text in mine:
            solid = BLANK.findall(text)
            faults.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = cheapest([(r[2][:1], f in ("b", "d"), f == "t") for r, f in zip(mine, faults, strict=True)])
        turns = [r[1] for r in mine if r[1] is not None]
        kept, at = [], 0
        for edit in audit:
            if edit != "D":
                before = kept[-1][0][:1] if kept else ""
                role = "assistant" if before == "u" else "user"
                kept.append((mine[at][2] if edit == "K" else role, "" if edit == "I" else mine[at][3]))
            at += edit != "I"
        assert VALID.fullmatch("".join(r[:1] for r, _ in kept))
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:], strict=False)]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        found.append(
            (conv, gaps, *[faults.count(f) for f in "bdt"], sum(p not in ("su", "ua", "au") for p in pairs),
             cost, audit, hashlib.sha256(text.encode()).hexdigest())
        )
    return sorted(found, key=repr)


SCHEMA = "conv_id long, turn long, role string, text string, dropped string, piece string, `at` string"


def frame(spark, given):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in given], SCHEMA)


def awkward(seed=1):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "", " \n", "é?", "What is it ? \n", "a" * 30_000, "word " * 20_000 + ".", None, "nbsp ", "x. "]
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None, "Sys"]
    given = []
    for conv in [*range(40), None]:
        for turn in range(rng.randint(1, 9)):
            given.append((conv, rng.choice((turn, turn, turn, None)), rng.choice(roles), rng.choice(texts)))
    given += given[:5]  # repeated rows
    given += [(50, t, "user", f"Same {t % 3}.") for t in range(300)]  # a long one, with copies
    given += [(51, None, "assistant", "Hm")]
    given += [(c, 0, "user", "A.") for c in range(60, 100)]  # some lose their only row
    return given


@pytest.mark.parametrize("partitions", [1, 7])
def test_awkward_conversations(spark, partitions):
    given = awkward()
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = rows(repair.report(frame(spark, given).repartition(3)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == expected(given)


def test_a_conversation_in_many_pieces(spark):
    """One conversation over many tasks, with the rows that the repair leaves."""
    rng = random.Random(4)
    given = [(1, t, rng.choice(("user", "assistant")), f"{rng.randint(0, 700)}.") for t in range(1500)]
    given += [(2, 0, "user", "Hi."), (2, 1, "assistant", "Hi!")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        done = repair.repair(frame(spark, given).select("conv_id", "turn", "role", "text"))
        assert done.rows.where("conv_id = 1").select("piece").distinct().count() > 3
        whole = {r.conv_id: r for r in done.conversations.collect()}
        left = done.rows.orderBy("conv_id", "piece", "at", "place").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    seen, marks = set(), []
    for _, _, role, text in given[:1500]:
        marks.append((role[:1], (role, text) in seen, False))
        seen.add((role, text))
    assert (whole[1].cost, whole[1].audit) == cheapest(marks)
    roles = "".join(r.role[:1] for r in left if r.conv_id == 1)
    assert VALID.fullmatch(roles) and len(roles) == sum(e != "D" for e in whole[1].audit)
    assert [(r.role, r.text) for r in left if r.conv_id == 2] == [("user", "Hi."), ("assistant", "Hi!")]


def test_empty_table(spark):
    assert rows(repair.report(frame(spark, []))) == []


def test_a_good_conversation_is_left_alone(spark):
    given = [(3, 0, "system", "Be kind."), (3, 1, "user", "Why?"), (3, 2, "assistant", "So.")]
    found = repair.repair(frame(spark, given).drop("dropped"))
    assert rows(found.conversations, "cost", "audit") == [(0, "KKK")]
    assert rows(found.rows, "role", "text") == [("assistant", "So."), ("system", "Be kind."), ("user", "Why?")]
