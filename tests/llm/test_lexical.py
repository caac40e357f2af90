"""Ranked search against scoring every document."""

import math
import random
import re

import numpy as np
import pytest

from tests.conftest import plan, rows
from tidemark.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(documents, queries, k=10):
    """(id, text) of documents and queries -> (query, rank, doc_id, score)."""
    held = [(i, terms(t)) for i, t in documents]
    held = [(i, t) for i, t in held if t]
    n_docs, n_terms = len(held), sum(len(t) for _, t in held)
    wanted = {}
    for q, text in queries:
        wanted.setdefault(q, set()).update(terms(text))
    out = []
    for q, these in wanted.items():
        df = {t: sum(t in d for _, d in held) for t in these}
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in these}
        scored = []
        for i, d in held:
            m = 10 + 90 * len(d) * n_docs // n_terms
            tf = {t: d.count(t) for t in these}
            score = sum(w[t] * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in these if tf[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        for rank, (score, none, i) in enumerate(sorted(scored)[:k], 1):
            out.append((q, rank, None if none else i, -score))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def questions(rows_):
    texts = [r[1] for r in rows_ if r[1]]
    return [
        (1, texts[0][:200]),
        (2, texts[8][:60].upper() + " no-such-term"),
        (2, texts[20][:40]),  # two rows, one query
        (3, None),
        (4, " .,;! "),
        (5, "word"),
        (6, "a" * 50_000),
        (7, "no-such-term"),
        (8, "zukß"),
        (None, texts[4]),
    ]


@pytest.mark.parametrize(("k", "block_terms"), [(10, 100_000), (3, 10), (1, 1)])
def test_awkward_documents(spark, docs, rows_, questions, k, block_terms):
    asked = spark.createDataFrame([(*q, "x") for q in questions], "item_id long, text string, score string")
    found = lexical.search(docs, asked, k, block_terms=block_terms)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(found) == ranked([r[:2] for r in rows_], questions, k)


def test_ties_go_by_id_and_copies_are_documents(spark):
    held = [(i, "same words here") for i in (5, 3, 9, 3, None)] + [(1, "other")]
    found = lexical.search(
        spark.createDataFrame(held, "doc_id long, text string"), spark.createDataFrame([(0, "SAME")], "item_id int, text string"), 4
    )
    assert [r[2] for r in sorted(rows(found), key=lambda r: r[1])] == [3, 3, 5, 9]


def test_empty_tables(spark, none, docs):
    asked = spark.createDataFrame([(1, "word")], "item_id long, text string")
    assert rows(lexical.search(none, asked)) == []
    assert rows(lexical.search(docs, asked.limit(0))) == []


def _block(vocabulary, documents):
    out = lexical.Postings(vocabulary)
    out.add([i for i, _ in documents], [t.encode() for _, t in documents])
    return out


@pytest.mark.parametrize("seed", range(4))
def test_accumulators_stop_and_scores_stay_exact(seed, monkeypatch):
    """Skewed words over many blocks: some terms make no accumulators, no result is lost."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    documents = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 80)))) for i in range(600)]
    queries = [(q, " ".join(rng.sample(words, 12))) for q in range(20)]
    listed = sorted(w.encode() for w in words)
    vocabulary = lexical.Vocabulary(listed)
    held = [(i, terms(t)) for i, t in documents]
    n_docs, n_terms = len(held), sum(len(d) for _, d in held)
    df = [sum(w.decode() in d for _, d in held) for w in listed]
    weight = np.array([lexical.weight(n, n_docs) for n in df], np.int64)
    order = [np.array(sorted({listed.index(t.encode()) for t in terms(q)}, key=lambda i: (df[i], i))) for _, q in queries]
    best, stops = lexical.Best(order, 5), 0
    good = np.partition

    for at in range(0, 600, 150):
        made = []
        monkeypatch.setattr(lexical.np, "partition", lambda a, k: made.append(1) or good(a, k))
        block = _block(vocabulary, documents[at : at + 150])
        best.meet(block, weight, n_docs, n_terms)
        stops += sum(len(o) for o in order) + len(order) > len(made)
    assert stops  # the bound was not asked for after some term
    got = [(q, r, i, -s) for q, found in enumerate(best.found) for r, (s, _, i) in enumerate(found, 1)]
    assert sorted(got, key=repr) == ranked(documents, queries, 5)


def test_terms_of_one_hash_are_told_apart():
    vocabulary = lexical.Vocabulary([b"abc", b"a" * 40, "größe".encode()])
    texts = [b"ABC abd " + b"a" * 40 + b" " + b"a" * 41 + " GRÖßE größe".encode()]
    at, term = vocabulary.find(lexical.terms(texts))
    assert [(int(a), int(t)) for a, t in zip(at, term, strict=True)] == [(0, 0), (2, 1), (5, 2)]


def test_long_texts_do_not_overflow():
    lengths = np.array([1, 10**8], np.int64)
    assert lexical.norms(lengths, 10**12, 10**14).tolist() == [10, 10 + 90 * 10**8 * 10**12 // 10**14]


def test_a_task_sends_few_rows(spark, docs):
    asked = spark.createDataFrame([(1, "word")], "item_id long, text string")
    each = lexical._search(docs.select("doc_id", "text"), [["word"]], 2)
    assert "WindowGroupLimit" in plan(each)
    assert lexical.search(docs, asked, 2).count() <= 2
