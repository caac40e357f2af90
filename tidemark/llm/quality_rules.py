"""Quality rules as a short-circuit cascade.

A rule rejects a document by its measures. On a sample all rules run on all
documents, which gives each rule's time per document and which rules reject what.
The cascade then starts with the rule that rejects most per second, goes on with the
one that rejects most per second of what is left, and so on. A document meets rules
until one rejects it; the order changes the time, never the verdict.

Documents: null text is empty, of no words; a repeated row is judged twice, alike; an
empty table gives no rows. Columns other than text are carried along.
"""

from __future__ import annotations

import time
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import each_slice, with_columns
from tidemark.llm.text import _SPACE, Words, covered, windows

SAMPLE = 2000
WINDOW = 8
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True


def _per_text(words: Words, flags: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))[words.bounds]
    return np.diff(total)


def _n_words(texts: list[bytes]) -> np.ndarray:
    return Words(texts).counts


def _word_chars(texts: list[bytes]) -> np.ndarray:
    """Code points in words: bytes that are neither white space nor continuations."""
    words = Words(texts)
    return _per_text(words, ~_SPACE[words.data] & (words.data & 0xC0 != 0x80))


def _n_symbols(texts: list[bytes]) -> np.ndarray:
    words = Words(texts)
    return _per_text(words, _SYMBOL[words.data])


def _capitals(texts: list[bytes]) -> np.ndarray:
    """Percentage of A-Z among the letters A-Z and a-z, rounded down; 0 without any."""
    words = Words(texts)
    letters = _per_text(words, _LETTER[words.data])
    return 100 * _per_text(words, _UPPER[words.data]) // np.maximum(letters, 1)


def _lines(texts: list[bytes]) -> list[list[bytes]]:
    return [[x for x in t.split(b"\n") if x.split()] for t in texts]


def _n_lines(texts: list[bytes]) -> np.ndarray:
    return np.array([len(x) for x in _lines(texts)], np.int64)


def _n_dup_lines(texts: list[bytes]) -> np.ndarray:
    return np.array([len(x) - len(set(x)) for x in _lines(texts)], np.int64)


def _n_repeat_words(texts: list[bytes]) -> np.ndarray:
    """Words in windows of ``WINDOW`` words that the text holds twice or more.

    Equal hashes propose windows, their words decide.
    """
    words = Words(texts)
    key, inside = windows(words.hashes(), words.first, WINDOW)
    doc = words.docs()[: len(key)]
    at = np.flatnonzero(inside)
    with np.errstate(over="ignore"):
        key = key[at] ^ (doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order][1:] == key[order][:-1])
    proposed = at[order[np.union1d(same, same + 1)]]
    joined, start, end = words.joined()
    seen = Counter()
    named = []
    for i in proposed.tolist():
        name = (doc[i], joined[start[i] : end[i + WINDOW - 1]])
        named.append(name)
        seen[name] += 1
    starts = np.array([i for i, n in zip(proposed.tolist(), named, strict=True) if seen[n] > 1], np.int64)
    flags = covered(starts, WINDOW, len(words))
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[words.first])


MEASURES: dict[str, Callable[[list[bytes]], np.ndarray]] = {
    "n_words": _n_words,
    "word_chars": _word_chars,
    "n_symbols": _n_symbols,
    "n_dup_lines": _n_dup_lines,
    "n_repeat_words": _n_repeat_words,
    "n_lines": _n_lines,
    "capitals": _capitals,
}


@dataclass(frozen=True)
class Rule:
    """Rejects by some measures, given in the order of ``needs``."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[..., np.ndarray]


RULES = (
    Rule("too_short", ("n_words",), lambda n: n < 20),
    Rule("repetitive", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 30 * n),
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 10 * s > n),
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: (c < 2 * n) | (c > 12 * n)),
    Rule("same_lines", ("n_dup_lines", "n_lines"), lambda d, n: 10 * d > 3 * n),
    Rule("capitals", ("capitals",), lambda c: c > 50),
)


class Measured:
    """The measures of a few texts, each found when first asked for and only where asked for."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.values: dict[str, np.ndarray] = {}
        self.known: dict[str, np.ndarray] = {}

    def get(self, name: str, at: np.ndarray) -> np.ndarray:
        if name not in self.values:
            self.values[name] = np.zeros(len(self.texts), np.int64)
            self.known[name] = np.zeros(len(self.texts), bool)
        new = at[~self.known[name][at]]
        if len(new):
            self.values[name][new] = MEASURES[name]([self.texts[i] for i in new.tolist()])
            self.known[name][new] = True
        return self.values[name][at]

    def rejects(self, rule: Rule, at: np.ndarray) -> np.ndarray:
        return np.asarray(rule.rejects(*[self.get(m, at) for m in rule.needs]), bool)


def judge(measured: Measured, rules: tuple[Rule, ...]) -> np.ndarray:
    """The place in ``rules`` of the first one that rejects each text; -1 for texts that stay."""
    out = np.full(len(measured.texts), -1, np.int64)
    left = np.arange(len(out))
    for k, rule in enumerate(rules):
        if not len(left):
            break
        bad = measured.rejects(rule, left)
        out[left[bad]] = k
        left = left[~bad]
    return out


def estimate(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample: int = SAMPLE) -> dict:
    """What about ``sample`` documents say: seconds per rule, and how often which rules reject together.

    A rule pays for all measures it needs, also for those that another rule shares.
    """
    total = docs.count()
    few = docs.select(F.col(f"`{text}`").cast("string").alias("text"))
    few = few.sample(min(1.0, sample / max(total, 1)), seed=7)

    def step(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        every = np.arange(len(texts))
        mask = np.zeros(len(texts), np.int64)
        spent = []
        for k, rule in enumerate(rules):
            began = time.perf_counter()
            mask |= Measured(texts).rejects(rule, every).astype(np.int64) << k
            spent.append(time.perf_counter() - began)
        seen = Counter(mask.tolist())
        out = [(m, n, None) for m, n in seen.items()] + [(None, None, spent)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([x[0] for x in out], pa.int64()),
                pa.array([x[1] for x in out], pa.int64()),
                pa.array([x[2] for x in out], pa.list_(pa.float64())),
            ],
            names=["mask", "n", "spent"],
        )

    found = each_slice(few, step, "mask bigint, n bigint, spent array<double>")
    sums = [F.sum(F.col("spent")[k]).alias(f"s{k}") for k in range(len(rules))]
    rows = found.groupBy("mask").agg(F.sum("n").alias("n"), *sums).collect()  # one per set of rules
    masks = {r["mask"]: r["n"] for r in rows if r["mask"] is not None}
    spent = next(([r[f"s{k}"] for k in range(len(rules))] for r in rows if r["mask"] is None), [0.0] * len(rules))
    return {"masks": masks, "seconds": spent}


def order(estimates: dict, rules: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    """Rules by rejections per second among the documents that the rules before leave."""
    left, out = dict(estimates["masks"]), []
    todo = list(range(len(rules)))
    while todo:
        gain = defaultdict(int)
        for mask, n in left.items():
            for k in todo:
                gain[k] += n * (mask >> k & 1)
        best = max(todo, key=lambda k: (gain[k] / max(estimates["seconds"][k], 1e-9), -k))
        out.append(rules[best])
        todo.remove(best)
        left = {m: n for m, n in left.items() if not m >> best & 1}
    return tuple(out)


def cascade(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    text: str = "text",
    measures: tuple[str, ...] = (),
    sample: int = SAMPLE,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with ``kept`` and ``rejected_by`` (the first rule that rejects, else null).

    ``measures`` are added for all documents. Columns of these names are replaced;
    without ``keep_text`` the texts do not leave the tasks.
    """
    ordered = order(estimate(docs, rules, text, sample), rules)
    added = {*measures, "kept", "rejected_by"}
    carried = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c == text or c.lower() not in added])
    drop = () if keep_text else (text,)
    typed = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in carried.schema if f.name not in drop)
    typed += "".join(f"`{m}` bigint, " for m in measures) + "`kept` boolean, `rejected_by` string"

    def step(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        measured = Measured(texts)
        first = judge(measured, ordered)
        every = np.arange(len(texts))
        return with_columns(
            rows,
            drop,
            **{m: pa.array(measured.get(m, every)) for m in measures},
            kept=pa.array(first < 0),
            rejected_by=pa.array([ordered[k].name if k >= 0 else None for k in first.tolist()], pa.string()),
        )

    return each_slice(carried, step, typed, text)


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The base measures of each document, whether they fail it, and the cascade's verdict."""
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = cascade(
        docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")),
        measures=base,
        keep_text=False,
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select(
        "doc_id", *base, failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept")
    )
