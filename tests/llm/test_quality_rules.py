from collections import Counter

from tests.llm import brute

from tidemark.llm import quality_rules as q


def _base(text):
    text = text or ""
    w = brute.words(text)
    runs = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    seen = Counter(runs)
    repeated = {i + k for i, r in enumerate(runs) if seen[r] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if brute.words(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "n_lines": len(lines),
        "capitals": 100 * sum("A" <= c <= "Z" for c in text)
        // max(1, sum(c.isascii() and c.isalpha() for c in text)),
    }


def _keeps(m):
    return not any(bool(r.rejects(*[m[n] for n in r.needs])) for r in q.RULES)


def test_report_is_the_plain_one(docs, rows_):
    found = sorted(map(tuple, q.report(docs).collect()), key=repr)
    plain = []
    for doc, text, *_ in rows_:
        m = _base(text)
        failed = m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"]
        five = [m[n] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        plain.append((doc, *five, failed, not failed and _keeps(m)))
    assert found == sorted(plain, key=repr)
    assert any(r[-1] for r in found) and not all(r[-1] for r in found)


def test_junk_goes_and_prose_stays(spark):
    prose = "Some plain words that follow each other without any repetition of longer runs, as prose does. " + " ".join(
        f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)
    )
    symbols = " ".join(f"{w}###" for w in prose.split())
    lines = "\n".join(["one line of some words here"] * 9 + prose.split(". "))
    rows = [(1, prose), (2, symbols), (3, prose.upper()), (4, lines), (5, "a b " * 30), (6, "x" * 30 + " " + prose)]
    found = {r[0]: r[-1] for r in q.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: True, 2: False, 3: False, 4: False, 5: False, 6: True}


def test_order_is_by_rejections_per_second_of_what_is_left():
    rules = tuple(q.Rule(n, (), None) for n in "abc")
    # a and b reject the same 50 documents, c rejects 10 others
    known = {"masks": {0b011: 50, 0b100: 10, 0: 40}, "seconds": [1.0, 2.0, 1.0]}
    assert [r.name for r in q.order(known, rules)] == ["a", "c", "b"]
    assert [r.name for r in q.order({"masks": {}, "seconds": [0.0] * 3}, rules)] == ["a", "b", "c"]


def test_any_order_gives_the_same_verdict(rows_):
    texts = [(r[1] or "").encode() for r in rows_]
    one = q.judge(q.Measured(texts), q.RULES) < 0
    other = q.judge(q.Measured(texts), q.RULES[::-1]) < 0
    assert (one == other).all()


def test_rules_see_only_documents_that_are_left(monkeypatch):
    seen = []
    monkeypatch.setitem(q.MEASURES, "n_words", lambda t: seen.append(len(t)) or q._n_words(t))
    monkeypatch.setitem(q.MEASURES, "n_symbols", lambda t: seen.append(len(t)) or q._n_symbols(t))
    texts = [b"a b c", b"word " * 30, b"# " * 30]
    assert q.judge(q.Measured(texts), (q.RULES[0], q.RULES[2])).tolist() == [0, -1, 1]
    assert seen == [3, 2]


def test_cascade_keeps_other_columns_and_takes_empty_tables(docs, none):
    out = q.cascade(docs)
    assert set(out.columns) == {*docs.columns, "rejected_by"}
    assert out.count() == docs.count()
    assert q.report(none).collect() == []
