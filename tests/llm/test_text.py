import re
import random

import numpy as np
import pyarrow as pa
from tests.llm import brute

from tidemark.llm import text, tokens


def _random(n, letters, most):
    rng = random.Random(1)
    return ["".join(rng.choices(letters, k=rng.randint(0, most))) for _ in range(n)]


def test_words_are_those_of_the_pattern():
    texts = _random(200, "ab \n\té\x0b\x0c\r \x1c", 60) + ["", " "]
    found = text.Words([t.encode() for t in texts])
    plain = [w.encode() for t in texts for w in brute.words(t)]
    assert [found.blob[a:b] for a, b in zip(found.start, found.end, strict=True)] == plain
    assert found.counts.tolist() == [len(brute.words(t)) for t in texts]
    blob, start, end = found.joined()
    assert blob == b"".join(w + b" " for w in plain)
    assert [blob[a:b] for a, b in zip(start, end, strict=True)] == plain


def test_hashes_tell_words_apart_and_agree_for_equal_ones():
    texts = ["abcdefgh abcdefgh abcdefghi " + "x" * 16 + " " + "x" * 17 + " a\0 a " + "y" * 40 + "z " + "y" * 40 + "w"]
    found = text.Words([t.encode() for t in texts])
    h = dict(zip(brute.words(texts[0]), found.hashes().tolist(), strict=True))
    assert len(set(h.values())) == len(h) == 8
    assert found.hashes()[0] == found.hashes()[1]


def test_windows_stay_in_their_text():
    texts = _random(80, "ab \n", 30)
    found = text.Words([t.encode() for t in texts])
    for k in (1, 2, 5, 13):
        value, inside = text.windows(found.hashes(), found.first, k)
        plain, names = [], {}
        for t in texts:
            w = brute.words(t)
            plain += [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
        assert inside.sum() == len(plain)
        for name, v in zip(plain, value[inside].tolist(), strict=True):
            assert names.setdefault(name, v) == v
        assert len(set(names.values())) == len(names)


def test_covered():
    assert text.covered(np.array([1, 2, 7]), 3, 9).tolist() == [False, True, True, True, True, False, False, True, True]
    assert text.covered(np.array([], int), 3, 2).tolist() == [False, False]


def test_slices_keep_all_rows(monkeypatch):
    monkeypatch.setattr(text, "SLICE_BYTES", 10)
    batch = pa.RecordBatch.from_pydict({"i": list(range(6)), "text": ["abcdef", None, "", "x" * 30, "abc", "d"]})
    parts = list(text.slices(batch))
    assert [i for rows, _ in parts for i in rows.column("i").to_pylist()] == list(range(6))
    assert [t for _, texts in parts for t in texts] == [b"abcdef", b"", b"", b"x" * 30, b"abc", b"d"]


def test_ids_are_those_of_the_tokenizer(tokenizer):
    texts = _random(1500, "ab' \n\té 1.,s \r\x0b\u0085ñ\x1c|<>", 40) + ["<|endoftext|> it's 12's", "", "  "]
    path = tokens.default_vocabulary()
    for t in texts:
        plain = brute.ids_of(t, tokenizer)
        assert tokens.ids(t.encode(), path).tolist() == plain
        assert tokens.count(t.encode(), path) == len(plain)
