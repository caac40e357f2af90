import hashlib
from collections import Counter, defaultdict

import pytest
from tests.llm import brute

from tidemark.llm import exact


def _norm(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("counters", [1000, 1])
def test_decisions(docs, rows_, counters):
    found = exact.decisions(docs, counters=counters).collect()
    groups = defaultdict(list)
    for doc, text, *_ in rows_:
        groups[_norm(text)].append(doc)
    assert len(found) == len(rows_)
    kept = Counter()
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    for r in found:
        ids = groups[by_hash[r["text_sha256"]]]
        known = [i for i in ids if i is not None]
        assert r["keep_id"] == (max(known) if known else None) and r["group_size"] == len(ids)
        assert r["doc_id"] == r["keep_id"] or not r["kept"]
        kept[r["text_sha256"]] += r["kept"]
    assert set(kept.values()) == {1} and len(kept) == len(groups)


@pytest.mark.parametrize("counters", [1000, 1])
def test_deduplicate(docs, rows_, counters):
    found = exact.deduplicate(docs, counters=counters)
    assert found.columns == docs.columns
    best = {}
    for doc, text, *_ in rows_:
        key = _norm(text)
        best[key] = max(best.get(key, -1), -1 if doc is None else doc)
    kept = [(_norm(r["text"]), -1 if r["doc_id"] is None else r["doc_id"]) for r in found.collect()]
    assert sorted(kept) == sorted(best.items())


def test_misra_gries_misses_no_frequent_value():
    values = ["a"] * 400 + ["b"] * 300 + [str(i) for i in range(900)] + ["a"] * 10
    sketch = exact.MisraGries(5)
    for i in range(0, len(values), 7):
        sketch.add(values[i : i + 7])
    sketch.fold()
    true = Counter(values)
    assert len(sketch.counts) <= 5 and sketch.lost <= len(values) / 6
    for v, n in true.items():
        assert sketch.counts.get(v, 0) <= n <= sketch.counts.get(v, 0) + sketch.lost


def test_frequent_digests_are_found_over_all_tasks(spark):
    rows = [(i, "same") for i in range(900)] + [(1000 + i, f"t{i}") for i in range(900)]
    digests = exact._digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), "doc_id", "text")
    hot = exact.winners(digests, 10).collect()
    assert [(bytes(r["digest"]), r["hot_id"], r["hot_size"]) for r in hot] == [(exact.digest(b"same"), 899, 900)]


def test_empty_tables(none):
    assert exact.decisions(none).collect() == [] and exact.deduplicate(none).collect() == []
