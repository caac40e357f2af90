import hashlib

import pytest
from pyspark.sql import functions as F
from tests.llm import brute

from tidemark.llm import substring

LAST = 2**63 - 1


def _plain(rows, k=13):
    first = {}
    for doc, text, *_ in rows:
        w = brute.words(text)
        for i in range(len(w) - k + 1):
            key, d = tuple(w[i : i + k]), LAST if doc is None else doc
            first[key] = min(first.get(key, LAST), d)
    out = []
    for doc, text, *_ in rows:
        w, gone = brute.words(text), set()
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < (LAST if doc is None else doc):
                gone.update(range(i, i + k))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def _found(docs):
    out = substring.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256))
    return sorted(map(tuple, out.collect()), key=repr)


@pytest.mark.parametrize("hot", [None, "all"])
def test_is_the_plain_result(docs, rows_, monkeypatch, hot):
    if hot:  # windows of every minimiser travel alone
        keep = substring._scatter

        def scatter(buckets, k, _):
            values = []
            for _, text, *_ in rows_:
                words = substring.Words([(text or "").encode()])
                values += substring._minimisers(words, k)[1].view("int64").tolist()
            return keep(buckets, k, sorted(set(values)))

        monkeypatch.setattr(substring, "_scatter", scatter)
    assert _found(docs) == _plain(rows_)
    assert sum(r[2] for r in _plain(rows_)) > 100


def test_small_flushes_change_nothing(docs, rows_, monkeypatch):
    import functools

    keep = substring._flushes
    monkeypatch.setattr(substring, "FLUSH_BYTES", 1)
    monkeypatch.setattr(substring, "_flushes", functools.partial(keep))
    assert _found(docs) == _plain(rows_)


def test_a_passage_inside_other_text(spark):
    passage = [f"p{i}" for i in range(60)]
    rows = [(d, " ".join([f"a{d}", *passage, f"z{d}"])) for d in (5, 3, 9)]
    out = {r["doc_id"]: r for r in substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [out[d]["n_removed"] for d in (3, 5, 9)] == [0, 60, 60]
    assert out[9]["text"] == "a9 z9" and out[3]["text"] == rows[1][1]


def test_windows_with_one_hash_are_told_apart(monkeypatch):
    import numpy as np

    words = substring.Words([b"a b c", b"x y z", b"a b c"])
    monkeypatch.setattr(substring, "windows", lambda h, f, k: (np.zeros(7, np.uint64), np.array([1, 0, 0, 1, 0, 0, 1], bool)))
    assert substring._repeated(words, np.array([1, 2, 3]), 3)[1].tolist() == [False, False, True]


def test_columns_stay_and_empty_tables(docs, none):
    out = substring.remove_repeats(docs)
    assert set(out.columns) == {*docs.columns, "n_removed"}
    assert substring.remove_repeats(none).collect() == []
