"""Quality classifier by co-training of two views of a page.

One classifier sees the text's content (which words it has), the other the page's
metadata: source, language, and measures of layout such as lengths of text, lines and
words and the shares of capitals, digits and symbols, but no words. Each round, both views
judge all pages, and the pages that one view is sure about are counted for the other view
with that label. In the end the views are calibrated and combined, on logits of labelled pages
from fits that did not see them. This is done for two targets: ``quality`` (1 is good)
and ``toxic`` (1 is bad); a page stays when it is likely good and likely not toxic.

What a view is told by the other one is a table of its features: in how many pages of either
label each is. Tasks count all their pages and Spark adds the tables up, so the driver gets two
numbers per hashed feature however many pages there are, and no page is left out of the
exchange. Labelled pages take part in it like others. The fit itself uses at most about
``LABELLED`` labelled pages, picked by a hash of doc_id. The models have a fixed size; all
documents are scored where they are read.

Null text is an empty text, null source or language a value of its own. Labels that are
null are ignored, of several labels for a doc_id the worse counts. Where one of a target's
classes has no labels, its probability is that of the labels there are (1 for quality and
0 for toxic without any). A probability of exactly one half is good, one of exactly ``TOXIC`` is
toxic. Repeated rows are judged alike and count as often as they are there. Texts are read whole.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import each_slice, free_names, released, with_columns
from tidemark.llm.text import Words, mix, slices

LABELLED = 4000
ROUNDS = 2
SURE = 0.97
FOLDS = 3  # a fit leaves out one labelled page in so many, and is calibrated on those
TOXIC = 0.3  # a page at least this likely to be toxic goes
BEGINNINGS = (4, 6, 8)  # bytes of a longer word that are a feature too
TEXT_BITS, META_BITS = 18, 12
_BLOCK = 1 << 14
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = 4
_CLASS[128:] = 5


@dataclass
class Bags:
    """Which features each of some pages has: those of page i at ``first[i]:first[i + 1]``."""

    features: np.ndarray
    first: np.ndarray

    def pages(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def among(self, pages: np.ndarray) -> np.ndarray:
        """The features of the flagged pages, one page after the other."""
        return self.features[np.repeat(pages, np.diff(self.first))]

    def where(self, pages: np.ndarray) -> Bags:
        return Bags(self.among(pages), np.concatenate(([0], np.cumsum(np.diff(self.first)[pages]))))


def _bags(page: np.ndarray, feature: np.ndarray, pages: int, bits: int) -> Bags:
    key = np.unique(page.astype(np.int64) << bits | feature.astype(np.int64))
    return Bags((key & (1 << bits) - 1).astype(np.int32), np.searchsorted(key, np.arange(pages + 1) << bits))


def text_view(texts: list[bytes]) -> Bags:
    """The words, as runs of letters in lower case, and how longer ones begin, hashed."""
    words = Words([t.translate(_PLAIN) for t in texts])
    doc, size = words.docs(), words.end - words.start
    head, _ = words.ends()
    docs, hashes = [doc], [words.hashes()]
    for n in BEGINNINGS:
        longer = size > n
        docs.append(doc[longer])
        hashes.append(mix((head[longer] & np.uint64((1 << 8 * n) - 1)) ^ mix(np.array([n], np.uint64))))
    feature = np.concatenate(hashes) >> np.uint64(64 - TEXT_BITS)
    return _bags(np.concatenate(docs), feature, len(texts), TEXT_BITS)


def meta_view(texts: list[bytes], names: list[list[str | None]]) -> Bags:
    """Source, language (``names``) and layout measures in steps, hashed."""
    words = Words(texts)
    kinds = _CLASS[words.data]
    size = np.maximum(np.diff(words.bounds) - 1, 1)

    def count(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(flags)))[words.bounds])

    def steps(x: np.ndarray) -> np.ndarray:
        return np.floor(2 * np.log2(1 + x)).astype(np.int64)

    lines = 1 + count(words.data == 10)
    n = np.maximum(words.counts, 1)
    measures = {
        "size": steps(size - 1),
        "words": steps(words.counts),
        "lines": steps(lines),
        "line": steps(words.counts / lines),
        "word": np.minimum(4 * count(kinds > 0) // n, 80),
    }
    for kind, name in ((1, "small"), (2, "capitals"), (3, "digits"), (4, "symbols"), (5, "other")):
        measures[name] = np.floor(20 * np.sqrt(count(kinds == kind) / size)).astype(np.int64)
    found = []
    for d in range(len(texts)):
        own = [f"{m}={v[d]}" for m, v in measures.items()]
        own += [f"name{i}={'' if x[d] is None else '=' + x[d]}" for i, x in enumerate(names)]
        found.append([xxhash.xxh64_intdigest(x) >> 64 - META_BITS for x in own])
    page = np.repeat(np.arange(len(texts)), [len(x) for x in found])
    return _bags(page, np.array([f for x in found for f in x], np.int64), len(texts), META_BITS)


@dataclass
class Linear:
    """Log odds as a sum of weights of the features that a page has."""

    weights: np.ndarray
    bias: float = 0.0

    def logits(self, bags: Bags) -> np.ndarray:
        out = np.full(len(bags.first) - 1, self.bias)
        full = np.flatnonzero(np.diff(bags.first))
        if len(full):
            out[full] += np.add.reduceat(self.weights[bags.features], bags.first[full])
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


@dataclass
class Told:
    """What one view has told the other: in how many pages of labels 0 and 1 each feature is, and the pages."""

    counts: np.ndarray  # by label and feature
    pages: np.ndarray  # by label


def fit(bags: Bags, y: np.ndarray, bits: int, told: Told | None = None, steps: int = 40, decay: float = 2e-4) -> Linear:
    """Logistic regression on features scaled by their log odds ratio; features of one page are left out.

    The log odds are those of labelled pages and of the pages told, which count for as
    much as the labelled ones of their label at most. All features share one weight, and those of
    labelled pages have one of their own besides, so features known from others only count too.
    """
    size = 1 << bits
    per_page = np.diff(bags.first)
    seen = np.bincount(bags.features, minlength=size).astype(float)
    good = np.bincount(bags.features, np.repeat(y.astype(np.float32), per_page), size)
    counts, pages = np.stack((seen - good, good)), np.array([len(y) - y.sum(), y.sum()], float)
    if told is not None:
        share = np.minimum(1, pages / np.maximum(told.pages, 1))
        counts += share[:, None] * told.counts
        pages = pages + share * told.pages
        seen = seen + told.counts.sum(0)
    odds = np.log((counts[1] + 0.5) / (pages[1] + 1)) - np.log((counts[0] + 0.5) / (pages[0] + 1))
    scale = np.where(seen > 1, odds, 0.0)
    common = seen[bags.features] > 1
    first = np.concatenate(([0], np.cumsum(common)))[bags.first]
    bags = Bags(bags.features[common], first)
    per_page = np.diff(first)
    spread = max(float(np.std(Linear(scale.astype(np.float32)).logits(bags))), 1e-6)
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    # own weights, then the shared one, then the bias; all by Adam on the full batch
    x, m, v = (np.zeros(size + 2) for _ in range(3))
    x[-1] = np.log(rate / (1 - rate))
    for t in range(1, steps + 1):
        error = sigmoid(Linear(((x[:-2] + x[-2] / spread) * scale).astype(np.float32), x[-1]).logits(bags)) - y
        own = np.bincount(bags.features, np.repeat(error.astype(np.float32), per_page), size) * scale / len(y)
        g = np.concatenate((own + decay * x[:-2], [own.sum() / spread + decay * x[-2], error.mean()]))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Linear(((x[:-2] + x[-2] / spread) * scale).astype(np.float32), float(x[-1]))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients of a small logistic regression by Newton's method; the last column is not shrunk."""
    w = np.zeros(x.shape[1])
    keep = np.full(len(w), ridge)
    keep[-1] = 1e-6
    for _ in range(30):
        p = sigmoid(x @ w)
        step = np.linalg.solve(
            (x * (p * (1 - p))[:, None]).T @ x / len(y) + np.diag(keep), x.T @ (p - y) / len(y) + keep * w
        )
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class CoTrained:
    """Two views of one target, how to calibrate each, and how to combine them."""

    views: tuple[Linear, Linear] | None
    prior: float
    calibration: list[np.ndarray] = field(default_factory=list)
    mixture: np.ndarray | None = None

    def calibrated(self, bags: tuple[Bags, Bags]) -> np.ndarray:
        """A column of calibrated log odds per view."""
        return np.stack(
            [c[0] * np.clip(v.logits(b), -30, 30) + c[1] for v, b, c in zip(self.views, bags, self.calibration, strict=True)],
            1,
        )

    def probability(self, bags: tuple[Bags, Bags]) -> np.ndarray:
        n = len(bags[0].first) - 1
        if self.views is None:
            return np.full(n, self.prior)
        return sigmoid(np.column_stack((self.calibrated(bags), np.ones(n))) @ self.mixture)


def _rising(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients of a logistic regression with none below zero but the last, the constant."""
    use = np.ones(x.shape[1], bool)
    while True:
        w = np.zeros(len(use))
        w[use] = _logistic(x[:, use], y)
        low = use[:-1] & (w[:-1] < 0)
        if not low.any():
            return w
        use[np.flatnonzero(low)[np.argmin(w[:-1][low])]] = False


def fitted(
    bags: tuple[Bags, Bags], y: np.ndarray, fold: np.ndarray, default: float, told: tuple[Told | None, Told | None] = (None, None)
) -> CoTrained:
    """Both views from labelled pages (``y``, -1 for none) and what they were told, calibrated and combined.

    Calibration and combination use each page's logits by fits without its fold.
    """
    known = y >= 0
    prior = float(y[known].mean()) if known.any() else default
    y, fold = y[known].astype(float), fold[known]
    parts = [fold == f for f in np.unique(fold)]
    if len(parts) < 2 or any(len(set(y[~out].tolist())) < 2 for out in parts):
        return CoTrained(None, prior)
    model, apart = CoTrained(None, prior), []
    views = []
    for own, bits, said in zip(bags, (TEXT_BITS, META_BITS), told, strict=True):
        own = own if known.all() else own.where(known)
        views.append(fit(own, y, bits, said))
        logits = np.zeros(len(y))
        for out in parts:
            logits[out] = fit(own.where(~out), y[~out], bits, said).logits(own.where(out))
        logits = np.clip(logits, -30, 30)
        model.calibration.append(_rising(np.column_stack((logits, np.ones(len(y)))), y))
        apart.append(model.calibration[-1][0] * logits + model.calibration[-1][1])
    model.views = (views[0], views[1])
    model.mixture = _rising(np.column_stack((*apart, np.ones(len(y)))), y)
    return model


class Exchange:
    """Counts what each view tells the other about pages that it is sure of."""

    def __init__(self, models: dict[str, CoTrained]):
        self.models = {t: m for t, m in models.items() if m.views is not None}
        self.told = {
            t: tuple(Told(np.zeros((2, 1 << bits), np.int64), np.zeros(2, np.int64)) for bits in (TEXT_BITS, META_BITS))
            for t in self.models
        }

    def add(self, bags: tuple[Bags, Bags]) -> None:
        for target, model in self.models.items():
            sure = sigmoid(model.calibrated(bags))
            for k in (0, 1):
                other, told = bags[1 - k], self.told[target][1 - k]
                for label, pages in ((0, sure[:, k] <= 1 - SURE), (1, sure[:, k] >= SURE)):
                    told.pages[label] += int(pages.sum())
                    told.counts[label] += np.bincount(other.among(pages), minlength=told.counts.shape[1])


def _views(texts: list[bytes], rows: pa.RecordBatch, names: tuple[str, ...]) -> tuple[Bags, Bags]:
    return text_view(texts), meta_view(texts, [rows.column(n).cast(pa.string()).to_pylist() for n in names])


def _told_by_all(docs: DataFrame, models: dict[str, CoTrained]) -> dict[str, tuple[Told, Told]]:
    """The exchange over all documents: a row per task and feature is summed, the sums come to the driver."""
    names = list(models)
    codes = [(t, k) for t in names for k in (0, 1)]
    pages = _BLOCK * -(-(1 << max(TEXT_BITS, META_BITS)) // _BLOCK)  # the block after all features has the number of pages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exchange = Exchange(models)
        for batch in batches:
            for rows, texts in slices(batch):
                exchange.add(_views(texts, rows, ("source", "lang")))
        for code, (t, k) in enumerate(codes):
            if t not in exchange.told:
                continue
            told = exchange.told[t][k]
            some = np.flatnonzero(told.counts.any(0))
            place = np.concatenate((some, [pages])).astype(np.int32)
            numbers = np.concatenate((told.counts[:, some], told.pages[:, None]), 1)
            columns = [np.full(len(place), code, np.int32), place, numbers[0], numbers[1]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["code", "place", "n0", "n1"])

    def packed(key: tuple, rows: pa.Table) -> pa.Table:
        """A block of places as one compressed table, so that little comes to the driver at once."""
        block = np.zeros((2, _BLOCK), np.int64)
        block[:, np.asarray(rows["place"]) % _BLOCK] = np.stack([np.asarray(rows[c]) for c in ("n0", "n1")])
        return pa.table({"code": pa.array([key[0].as_py()], pa.int64()), "block": [key[1].as_py()], "n": [zstandard.compress(block.tobytes(), 3)]})

    counted = docs.select("text", "source", "lang").mapInArrow(run, "code int, place int, n0 bigint, n1 bigint")
    summed = counted.groupBy("code", "place").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    blocks = summed.groupBy("code", F.expr(f"place div {_BLOCK}").alias("block")).applyInArrow(packed, "code bigint, block bigint, n binary")
    out = Exchange(models).told
    for code, block, raw in blocks.toLocalIterator():
        told = out[codes[code][0]][codes[code][1]]
        n = np.frombuffer(zstandard.decompress(raw), np.int64).reshape(2, _BLOCK)
        at = block * _BLOCK
        if at >= pages:
            told.pages[:] = n[:, 0]
        else:
            told.counts[:, at : at + _BLOCK] = n[:, : told.counts.shape[1] - at]
    return out


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS) -> dict[str, CoTrained]:
    """Models for ``quality`` and ``toxic`` from documents (doc_id, text, source, lang) and their labels."""
    judged = (
        labels.select(F.col("doc_id").cast("bigint").alias("id"), "quality", "toxic")
        .where("id is not null and quality is not null and toxic is not null")
        .groupBy("id")
        .agg(F.min("quality").cast("int").alias("quality"), F.max("toxic").cast("int").alias("toxic"))
    )
    own = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
    )
    # pages with a label, not labels: many labels may be of pages that are not here
    n_labels = own.select("doc_id").join(judged, F.col("doc_id") == F.col("id")).count()
    parts = 1 << 40
    low = int(parts * min(1.0, labelled / max(n_labels, 1)))
    # by row too, so that one id of very many rows does not come as a whole
    row = F.xxhash64("doc_id", F.xxhash64("text"), F.monotonically_increasing_id(), F.lit(29))
    some = own.where(F.pmod(row, F.lit(parts)) < low).join(judged, F.col("doc_id") == F.col("id"))

    def step(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        both = _views(texts, rows, ("source", "lang"))
        return with_columns(
            rows.select(["doc_id", "quality", "toxic"]),
            **{
                name: pa.array([b.features[i:j].tobytes() for i, j in zip(b.first[:-1], b.first[1:], strict=True)], pa.binary())
                for name, b in zip(("words", "meta"), both, strict=True)
            },
        )

    schema = "doc_id bigint, quality int, toxic int, words binary, meta binary"
    found = each_slice(some.drop("id"), step, schema).toPandas()  # bounded by ``labelled``
    found = found.sort_values(["doc_id", "words"], kind="stable")
    bags = []
    for name in ("words", "meta"):
        sizes = [len(x) // 4 for x in found[name]]
        bags.append(Bags(np.frombuffer(b"".join(found[name]), np.int32), np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)))
    # copies of a page are in one fold: its words decide
    fold = np.array([xxhash.xxh64_intdigest(x) % FOLDS for x in found["words"]], np.int64)
    ys = {t: found[t].to_numpy(np.int64) for t in ("quality", "toxic")}
    del found  # the driver needs the pages once
    released(docs.sparkSession)
    default = {"quality": 1.0, "toxic": 0.0}
    models = {t: fitted(tuple(bags), y, fold, default[t]) for t, y in ys.items()}
    for _ in range(rounds if any(m.views is not None for m in models.values()) else 0):
        told = _told_by_all(own, models)
        released(docs.sparkSession)
        models = {t: fitted(tuple(bags), y, fold, default[t], told.get(t, (None, None))) for t, y in ys.items()}
    return models


def score(docs: DataFrame, models: dict[str, CoTrained], keep_text: bool = True) -> DataFrame:
    """``docs`` with p_quality, p_toxic and kept; columns of these names are replaced."""
    added = ("p_quality", "p_toxic", "kept")
    carried = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in added])
    drop = () if keep_text else ("text",)
    typed = "".join(f"`{c}` {t}, " for c, t in carried.dtypes if c not in drop)

    def step(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        both = _views(texts, rows, ("source", "lang"))
        good, bad = (models[t].probability(both) for t in ("quality", "toxic"))
        return with_columns(
            rows, drop, p_quality=pa.array(good), p_toxic=pa.array(bad), kept=pa.array((good >= 0.5) & (bad < TOXIC))
        )

    return each_slice(carried, step, f"{typed}p_quality double, p_toxic double, kept boolean")


def classify(docs: DataFrame, labels: DataFrame, keep_text: bool = False) -> DataFrame:
    """Train on ``labels``, score all of ``docs``."""
    return score(docs, train(docs, labels), keep_text)


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier keeps, with all their columns and no others."""
    mark = free_names(docs, "accepted")[0]
    models = train(docs, labels)
    typed = "".join(f"`{c}` {t}, " for c, t in docs.dtypes)

    def step(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        both = _views(texts, rows, ("source", "lang"))
        fine = (models["quality"].probability(both) >= 0.5) & (models["toxic"].probability(both) < TOXIC)
        return with_columns(rows, **{mark: pa.array(fine)})

    return each_slice(docs, step, f"{typed}`{mark}` boolean").where(F.col(mark)).drop(mark)
