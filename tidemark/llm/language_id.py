"""Language identification by language-bitmask n-gram filters.

One table of bit-sliced Bloom filters holds the n-grams of all languages: each slot is a
bitmask with one bit per language, and an n-gram sets its languages' bits in ``HASHES``
slots. Looking an n-gram up is the AND of its slots: the bitmask of all languages that
contain it. The bits are counted per language over the n-grams of a text. A filter that is
full to a share f answers by mistake with probability f ** HASHES, which is known per
language, so each count is corrected for the mistakes expected among its misses. The
language with the highest corrected count wins.

A language contains an n-gram if it was seen there ``LEAST`` times or more and at ``SHARE``
or more of the rate of the language where it is most frequent; so foreign passages and junk
in the training texts do not make their n-grams part of the language. N-grams are counted
in tasks, summed by Spark, and set in the filter by Spark too (a bitwise OR per slot). Only
the filter comes to the driver and goes to the tasks: ``SLOTS`` times 8 bytes for each 64
languages, whatever the size of the corpus. A corpus with more n-grams fills the filters
more, which the correction takes into account.

N-grams are runs of 2 to 4 characters of a word with its borders, lower-cased; a character
is a letter or a mark. Null and empty texts and texts without a letter are ``und`` with a
score of 0, and so is everything if nothing could be learned. A text none of whose n-grams
is known gets the language with most training texts, score 0. Equal counts go to the
language with more training texts, then to the smaller name. Repeated rows are judged
alike, and count as often as they are there when learning. Texts are read whole. Further
columns, whatever their names, are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import each_slice, freeze, plain
from tidemark.llm.text import mix, slices, windows

SIZES = (2, 3, 4)
SLOTS = 1 << 21
HASHES = 4
LEAST = 2
SHARE = 0.1
MOST_LANGUAGES = 4096
BLOCK = 1 << 16
UNKNOWN = "und"


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Which code points are letters, and which are letters or marks."""
    kinds = np.array([unicodedata.category(chr(c))[0] for c in range(0x110000)])
    return kinds == "L", (kinds == "L") | (kinds == "M")


class Grams:
    """The n-grams of a few texts, found once for each different word.

    Word occurrence ``i`` is word ``word[i]`` of text ``doc[i]``; n-gram ``hashes[j]`` is one
    of word ``of[j]``. ``has_letter`` says which texts have a letter.
    """

    def __init__(self, texts: list[bytes]):
        lowered = [t.decode("utf-8", "replace").lower() for t in texts]
        code = np.frombuffer(" ".join([*lowered, ""]).encode("utf-32-le", "replace"), "<u4")
        ends = np.cumsum(np.fromiter(map(len, lowered), np.int64, len(texts)) + 1)
        letter, part = _tables()
        some = np.concatenate(([0], np.cumsum(letter[code])))[np.concatenate(([0], ends))]
        self.has_letter = np.diff(some) > 0
        solid = part[code]
        starts = np.flatnonzero(solid & ~np.concatenate(([False], solid[:-1])))
        self.doc = np.searchsorted(ends, starts, side="right")
        line = np.where(solid, code, np.uint32(32)).astype("<u4").tobytes().decode("utf-32-le")
        number: dict[str, int] = {}
        self.word = np.array([number.setdefault(w, len(number)) for w in line.split()], np.int64)
        self.n_words = len(number)
        self.hashes, self.of = _grams_of(list(number))

    def per_text(self, per_word: np.ndarray) -> np.ndarray:
        """Numbers of the words, added up for each text."""
        return np.bincount(self.doc, weights=per_word[self.word], minlength=len(self.has_letter))


def _grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all words with a border before and after each, and the word of each n-gram."""
    line = np.frombuffer(" ".join(["", *words, ""]).encode("utf-32-le"), "<u4").astype(np.uint64)
    border = line == 32
    word = np.cumsum(border) - 1  # a border belongs to the word after it
    hashes, of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for n in SIZES:
        key, _ = windows(line, np.array([0, len(line)]), n)
        within = ~border[: len(key)] | ~border[1 : 1 + len(key)]
        for i in range(1, n - 1):
            within &= ~border[i : i + len(key)]
        hashes.append(mix(key[within] + np.uint64(n)))
        of.append(word[: len(key)][within])
    return np.concatenate(hashes), np.concatenate(of)


def slots(grams: np.ndarray) -> Iterator[np.ndarray]:
    low, high = grams & np.uint64(0xFFFFFFFF), (grams >> np.uint64(32)) | np.uint64(1)
    for j in range(HASHES):
        yield (low + np.uint64(j) * high) & np.uint64(SLOTS - 1)


def _slots_of(gram: Column) -> Column:
    """The same in SQL, as an array."""
    low, high = gram.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(gram, 32).bitwiseOR(F.lit(1).cast("bigint"))
    return F.array(*[(low + F.lit(j) * high).bitwiseAND(F.lit(SLOTS - 1).cast("bigint")) for j in range(HASHES)])


class Filters:
    """The filters of all languages: ``masks[w, slot]`` has the bits of languages 64 w to 64 w + 63."""

    def __init__(self, languages: list[str], masks: np.ndarray):
        self.languages, self.masks = languages, masks
        self.mistaken = np.array([self._bits(masks[i // 64], i % 64).mean() for i in range(len(languages))]) ** HASHES

    @staticmethod
    def _bits(masks: np.ndarray, i: int) -> np.ndarray:
        return (masks >> np.uint64(i)) & np.uint64(1)

    def counts(self, grams: Grams) -> np.ndarray:
        """Corrected counts, by text and language."""
        first, *rest = slots(grams.hashes)
        total = grams.per_text(np.bincount(grams.of, minlength=grams.n_words))
        out = np.zeros((len(total), len(self.languages)))
        for w, mask in enumerate(self.masks):
            found = mask[first]
            for place in rest:
                found &= mask[place]
            for i in range(64 * w, min(64 * w + 64, len(self.languages))):
                hits = np.bincount(grams.of, weights=self._bits(found, i % 64), minlength=grams.n_words)
                mistakes = total * self.mistaken[i]
                out[:, i] = np.maximum(grams.per_text(hits) - mistakes, 0) / max(1 - self.mistaken[i], 1e-9)
        return out

    def judge(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """The language of each text, and by how much it leads, from 0 to 1."""
        grams = Grams(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        counts = self.counts(grams)
        first = counts.argmax(1)
        best = counts[np.arange(len(texts)), first]
        counts[np.arange(len(texts)), first] = 0
        lead = np.where(best > 0, (best - counts.max(1)) / np.where(best > 0, best, 1), 0.0)
        known = grams.has_letter
        return [self.languages[i] if k else UNKNOWN for i, k in zip(first, known, strict=True)], np.where(known, lead, 0.0)


def _counted(docs: DataFrame, languages: list[str]) -> DataFrame:
    """How often each language has each n-gram: gram, language (its place in the list) and n."""
    number = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch):
                grams = Grams(texts)
                own = np.array([number[x] for x in rows.column(rows.schema.get_field_index("lang")).to_pylist()])
                gram, place = np.unique(grams.hashes, return_inverse=True)
                for i in np.unique(own):
                    times = np.bincount(grams.word[own[grams.doc] == i], minlength=grams.n_words)
                    n = np.bincount(place, weights=times[grams.of], minlength=len(gram)).astype(np.int64)
                    some = n > 0
                    columns = [gram[some].view(np.int64), np.full(some.sum(), i, np.int32), n[some]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["gram", "language", "n"])

    rows = docs.select("lang", "text").mapInArrow(count, "gram bigint, language int, n bigint")
    return rows.groupBy("gram", "language").agg(F.sum("n").alias("n"))


def _pack(key: tuple, rows: pa.Table) -> pa.Table:
    """The bitmasks of a block of slots as one string of bytes."""
    block = np.zeros(BLOCK, "<u8")
    block[np.asarray(rows["slot"]) % BLOCK] = np.asarray(rows["mask"]).view(np.uint64)
    return pa.table({"block": [key[0].as_py()], "word": [key[1].as_py()], "masks": [block.tobytes()]})


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Filters:
    """The filters of all languages that ``lang`` names; rows without one teach nothing."""
    docs = plain(docs, text=text, lang=lang).where("lang is not null")
    names = docs.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = [r.lang for r in sorted(names, key=lambda r: (-r.n, r.lang))]
    masks = np.zeros((-(-len(languages) // 64), SLOTS), np.uint64)
    if not languages:
        return Filters(languages, masks)
    counted = freeze(_counted(docs, languages))
    total = dict(counted.groupBy("language").agg(F.sum("n")).collect())
    totals = F.array(*[F.lit(float(total.get(i, 1))) for i in range(len(languages))])
    rate = F.col("n") / F.get(totals, F.col("language"))
    most = F.max("rate").over(Window.partitionBy("gram"))
    held = counted.withColumn("rate", rate).withColumn("most", most).where((F.col("n") >= LEAST) & (F.col("rate") >= SHARE * F.col("most")))
    bit = F.expr("shiftleft(1L, language % 64)")
    each = held.select(F.explode(_slots_of(F.col("gram"))).alias("slot"), F.expr("language div 64").alias("word"), bit.alias("bit"))
    masked = each.groupBy("slot", "word").agg(F.bit_or("bit").alias("mask"))
    blocks = masked.groupBy(F.expr(f"slot div {BLOCK}").alias("block"), "word").applyInArrow(_pack, "block bigint, word bigint, masks binary")
    for block, word, packed in blocks.toLocalIterator():
        masks[word, block * BLOCK : (block + 1) * BLOCK] = np.frombuffer(packed, "<u8")
    return Filters(languages, masks)


def identify(docs: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """The rows with ``lang_pred`` and ``score``, from the text alone; these replace columns of the same name."""
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    docs = docs.select(*[F.col(f"`{c}`") for c in kept])
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def judge(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        names, score = shared.value.judge(texts)
        return pa.RecordBatch.from_arrays(
            [*rows.columns, pa.array(names, pa.string()), pa.array(score, pa.float64())],
            names=[*rows.schema.names, "lang_pred", "score"],
        )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return each_slice(docs, judge, f"{fields}, lang_pred string, score double", text)


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from three quarters of the documents, judge all: doc_id, held_out, lang_pred and score."""
    rows = plain(docs, doc_id=doc_id, text=text, lang=lang)
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    rows = rows.withColumn("held_out", F.coalesce(part == 2, F.lit(False)))
    filters = learn(rows.where("not held_out"))
    return identify(rows.select("doc_id", "held_out", "text"), filters).drop("text")
