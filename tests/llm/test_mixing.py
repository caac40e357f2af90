from collections import defaultdict

import numpy as np
import pytest
from tests.llm import brute

from tidemark.llm import mixing


def test_targets_by_hand():
    # 100 words by 5:2:1; the second source takes at most 9, the rest goes 5:1
    assert mixing.targets([80, 3, 17], [5, 2, 1], 100.0) == pytest.approx([91 * 5 / 6, 9, 91 / 6])
    assert mixing.targets([0, 0], [5, 2], 0.0) == [0, 0]
    # the excess of one lifts another over its limit, which is then reshared too
    assert mixing.targets([10, 10, 1000], [90, 9, 1], 1020.0) == pytest.approx([30, 30, 960])


def test_sources_are_in_code_point_order_null_last():
    names = [s.name for s in mixing.plan({"b": 5, None: 9, "a10": 5, "a2": 5, "É": 1, "Z": 3})]
    assert names == ["Z", "a10", "a2", "b", "É", None]


def _sources(rows):
    size = defaultdict(int)
    for r in rows:
        size[r[3]] += len(brute.words(r[1]))
    return mixing.plan(dict(size))


def test_report(docs, rows_):
    found = mixing.report(docs).collect()
    assert len(found) == len(rows_)
    plan = {s.name: s for s in _sources(rows_)}
    plain = sorted(((r[0], len(brute.words(r[1])), plan[r[3]].size, plan[r[3]].target) for r in rows_), key=repr)
    assert sorted(((r[0], r[1], r[2], r[3]) for r in found), key=repr) == plain
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in found)
    assert sum(s.target for s in plan.values()) == pytest.approx(sum(s.size for s in plan.values()))
    assert sorted(map(tuple, mixing.report(docs).collect()), key=repr) == sorted(map(tuple, found), key=repr)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in found:  # sources of these rows have different sizes
        sizes[r["source_size"]] = r["target"]
        taken[r["source_size"]] += r["taken"]
    for s in plan.values():
        assert abs(taken[s.size] - s.target) <= s.block


def test_schedule_is_even_everywhere(spark):
    plan = mixing.plan({"a": 40_000_000, "b": 30_000_000, "c": 2_000_000})
    rows = np.array(sorted(map(tuple, mixing.schedule(spark, plan).collect())))
    slots = np.array([s.slots for s in plan])
    for k in range(3):
        mine = rows[rows[:, 1] == k]
        assert mine[:, 2].tolist() == list(range(slots[k]))
        ideal = np.arange(slots[k]) / slots[k] * slots.sum()
        assert np.abs(mine[:, 0] - ideal).max() < 12 * slots.sum() / slots[k]


def test_slots_take_their_blocks_in_turn(docs, rows_):
    documents = mixing.sized(docs)
    plan = mixing.planned(documents)
    for s, source in enumerate(plan):
        cut = [r for r in mixing.pieces(documents, plan).collect() if r["s"] == s]
        by_block = defaultdict(int)
        for r in cut:
            by_block[r["block"]] += r["words"]
        sizes = [by_block[b] for b in range(source.blocks)] if source.size else []
        assert sum(sizes) == source.size and all(x == source.block for x in sizes[:-1])


def test_mixed_documents(docs, rows_):
    found = mixing.mixed_documents(docs)
    assert found.columns == docs.columns
    size, taken = defaultdict(int), defaultdict(int)
    for r in found.collect():
        taken[r["source"]] += len(brute.words(r["text"]))
        assert r["text"] and any((t or "").startswith(r["text"]) for d, t, *_ in rows_ if d == r["doc_id"])
    for s in _sources(rows_):
        assert abs(taken[s.name] - s.target) <= s.block


def test_empty_tables(none):
    assert mixing.report(none).collect() == [] and mixing.mixed_documents(none).collect() == []
