"""Language identification: sets, corrections and held-out accuracy."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.llm import language_id as li


def plain_grams(text):
    """Every n-gram of every word with its borders, as often as it is there."""
    out, word = [], ""
    for c in [*text.lower(), " "]:
        if li._tables()[1][ord(c)]:
            word += c
        elif word:
            line = f" {word} "
            out += [line[i : i + n] for n in li.SIZES for i in range(len(line) - n + 1)]
            word = ""
    return out


def hashes(texts):
    """The n-gram hashes of each text, with repeats."""
    grams = li.Grams([t.encode() for t in texts])
    each = [[] for _ in texts]
    for word, doc in zip(grams.word, grams.doc, strict=True):
        each[doc] += grams.hashes[grams.of == word].tolist()
    return each


TEXTS = ["", "a", "Ab c", "ÉTÉ été!", "x1y22z", "naïve नमस्ते 你好", "İstanbul", "  ", "1 2 3", "a b a b a", "\x00 q r"]


def test_grams_are_those_of_a_loop():
    counts = lambda xs: sorted(xs.count(x) for x in set(xs))
    for text, found in zip(TEXTS, hashes(TEXTS), strict=True):
        assert counts(found) == counts(plain_grams(text))
    every = {g for t in TEXTS for g in plain_grams(t)}
    assert len({h for found in hashes(TEXTS) for h in found}) == len(every)


def test_letters():
    grams = li.Grams([t.encode() for t in TEXTS])
    assert grams.has_letter.tolist() == [any(c.isalpha() for c in t) for t in TEXTS]


def _filters(languages, sets):
    masks = np.zeros((-(-len(languages) // 64), li.SLOTS), np.uint64)
    for i, grams in enumerate(sets):
        for place in li.slots(np.array(sorted(grams), np.uint64)):
            masks[i // 64, place] |= np.uint64(1) << np.uint64(i % 64)
    return li.Filters(languages, masks)


def test_counts_are_corrected_for_mistakes():
    rng = np.random.default_rng(1)
    full = set(rng.integers(0, 1 << 63, 600_000, dtype=np.uint64).tolist())  # a filter two thirds full
    held = {h for x in hashes(["this is the house that was there"]) for h in x}
    filters = _filters(["full", "en"], [full, held])
    assert 0.1 < filters.mistaken[0] < 0.35 and filters.mistaken[1] < 1e-9
    others = "".join(chr(c) for c in range(0x4E00, 0x4E00 + 4000))
    counts = filters.counts(li.Grams([others.encode(), b"this is the house that was there"]))
    total = len(plain_grams(others))
    assert abs(counts[0, 0]) < 0.04 * total  # a quarter would be mistaken
    assert counts[1, 1] == len(plain_grams("this is the house that was there")) > counts[1, 0]


def test_more_languages_than_bits():
    languages = [f"l{i}" for i in range(130)]
    words = ["".join(chr(0x4E00 + 50 * i + j) for j in range(30)) for i in range(130)]
    filters = _filters(languages, [set(h) for h in hashes(words)])
    names, score = filters.judge([w.encode() for w in words])
    assert names == languages and (score > 0.99).all()


def test_sql_and_numpy_use_the_same_slots(spark):
    grams = np.random.default_rng(2).integers(0, 1 << 64, 50, dtype=np.uint64)
    df = spark.createDataFrame([(int(g),) for g in grams.view(np.int64)], "gram long")
    mine = {r[0]: list(r[1]) for r in df.select("gram", li._slots_of(F.col("gram"))).collect()}
    theirs = np.stack(list(li.slots(grams)), 1).astype(np.int64)
    assert all(mine[int(g)] == t.tolist() for g, t in zip(grams.view(np.int64), theirs, strict=True))


def test_learning_against_plain_sets(spark):
    """Which language holds which n-gram, by the rule, from counts in a loop."""
    data = [("en", "the house the the"), ("en", "there the"), ("de", "das haus das the"), ("de", "das " * 30), (None, "zzz zzz")]
    filters = li.learn(spark.createDataFrame(data, "lang string, text string"))
    counts = {l: {} for l in ("de", "en")}
    for lang, text in data:
        for h in hashes([text])[0] if lang else ():
            counts[lang][h] = counts[lang].get(h, 0) + 1
    total = {l: sum(c.values()) for l, c in counts.items()}
    held = []
    for l in filters.languages:
        rate = lambda k, h: counts[k].get(h, 0) / total[k]
        held.append({h for h, n in counts[l].items() if n >= li.LEAST and rate(l, h) >= li.SHARE * max(rate(k, h) for k in counts)})
    assert filters.languages == ["de", "en"]
    assert (_filters(filters.languages, held).masks == filters.masks).all()


def test_awkward_documents(docs, rows_):
    found = rows(li.report(docs))
    assert len(found) == len(rows_)
    texts = {}
    for r in rows_:
        texts.setdefault(r[0], set()).add(r[1])
    for doc_id, held_out, name, score in found:
        assert held_out == (doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2)
        assert name in ("en", "de", "und") and 0 <= score <= 1
        if not any(any(c.isalpha() for c in t or "") for t in texts[doc_id]):
            assert (name, score) == ("und", 0)
        elif len(texts[doc_id]) == 1:
            assert name != "und"


def test_columns_are_carried_and_replaced(spark, docs):
    filters = li.learn(docs)
    out = li.identify(docs.withColumn("SCORE", F.lit("x")), filters)
    assert out.columns == [*docs.columns, "lang_pred", "score"] and out.count() == docs.count()


def test_nothing_to_learn(spark, none):
    assert rows(li.report(none)) == []
    one = spark.createDataFrame([(1, "some text", None), (2, "", "en")], "doc_id long, text string, lang string")
    assert rows(li.report(one), "lang_pred", "score")[0][0] in ("en", "und")


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(li, "MOST_LANGUAGES", 2)
    df = spark.createDataFrame([(c, c) for c in "abc"], "lang string, text string")
    with pytest.raises(ValueError, match="languages"):
        li.learn(df)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = li.report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = sum(r.lang == r.lang_pred for r in found)
    assert len(found) > 200 and right >= 0.99 * len(found)


def test_short_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    filters = li.learn(docs)
    words = docs.where("lang is not null").select("lang", F.expr("array_join(slice(split(text, ' '), 3, 8), ' ')").alias("text"))
    found = li.identify(words.where("length(text) > 20"), filters).collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)
