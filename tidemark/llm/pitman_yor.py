"""Language-model scores by a hierarchical Pitman-Yor model sampled by approximate Gibbs sweeps.

Tokens are the words of a text after lower-casing A-Z, then one end token. A word's context
is the whole word before it, which is a restaurant of its own. Its parent is one of 1,024
restaurants of how words end, picked by the last three bytes; their parents are the 32
restaurants of the last byte, which share the restaurant of all words, whose parent is
uniform over the training vocabulary and one unknown word. A token that sits down at a new
table of a restaurant is a customer of its parent.

Everything about a word (its counts and tables in all contexts) lives in one bucket by the
word's hash. Buckets exchange the totals of the restaurants: of the 1,057 of endings as a sum
on the driver, of the words before by a shuffle, where a part by the context's hash adds up
what the buckets hold and tells each bucket the totals of its own contexts.

Steps: tasks count (word, context) pairs of their documents, all of them, chunk by chunk, and
send them to their buckets once; nothing else of the documents is kept, the last step reads
them again. A bucket adds up the chunks' counts, keeps which pairs each
chunk has, and seats all customers; then it reseats them level by
level, each party's own tables taken out of its parent first, all parties of a level from the state
before (see the README for how near that is to an exact sampler), for ``BURN`` sweeps and, with totals exchanged in between,
``KEEP`` more, whose predictive probabilities are averaged. It answers each chunk with the
probabilities of the pairs that the chunk holds, and the chunk's documents add theirs up. The
burnt-in seating is not stored: the last step repeats those sweeps from the same seed. A
frequent word costs a bucket one entry per chunk and context, not one per occurrence.

Words are told apart by 64-bit hashes, contexts by 54 bits of them and the ending's class.
Null texts are empty and score their end token. A document with a null doc_id trains and is
not held out; repeated rows train and score each time. Without training tokens all
probabilities are those of the base distribution.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import freeze, input_bytes, released, small_batches, spread
from tidemark.llm.text import Words, mix, slices

FLUSH_BYTES = 10_000_000
BUCKET_BYTES = 10_000_000
LEVEL1, LEVEL2 = 32, 1024
BURN, KEEP = 2, 3
EXACT = 64  # customers seated one by one; then in groups of a 32nd of those seated
STRENGTH = 1.0
STATE, SUMS = -2, -1  # rows that are no part of the contexts
ADDERS = 8  # rows of totals that come to the driver
_END, _START = mix(np.array([0xE0D, 0x57A], np.uint64))
_CLASS = np.uint64(54)  # where the class of a context's ending starts in its id


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes; the first bytes of all numbers, then the second ones, and so on."""
    head = np.array([len(arrays), *[x for a in arrays for x in (ord(a.dtype.char), len(a))]], np.int64)
    planes = (np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)
    return zstandard.compress(head.tobytes() + b"".join(planes), 3)


def _unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 2 * n, 8)
    at, out = 8 * (1 + 2 * n), []
    for kind, size in head.reshape(-1, 2).tolist():
        kind = np.dtype(chr(kind))
        planes = np.frombuffer(raw, np.uint8, size * kind.itemsize, at).reshape(kind.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += planes.nbytes
    return out


def _steps(x: np.ndarray) -> np.ndarray:
    """Differences of sorted numbers, which pack better; np.cumsum gives the numbers again."""
    return np.diff(x, prepend=x.dtype.type(0))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and context of each token, text by text, and the number of tokens of each text."""
    words = Words(texts, lower=True)
    token = np.insert(words.hashes(), words.first[1:], _END)
    counts = words.counts + 1
    # the three bytes that end each word; a space and what is before it for shorter words
    data = np.concatenate((np.full(3, 32, np.uint8), words.data))
    last, second, third = (data[words.end + 2 - k].astype(np.uint64) for k in range(3))
    size = words.end - words.start
    second, third = np.where(size > 1, second, np.uint64(0)), np.where(size > 2, third, np.uint64(0))
    low = mix(last + np.uint64(1)) % np.uint64(LEVEL1)
    fine = mix(second << np.uint64(8) | third) % np.uint64(LEVEL2 // LEVEL1)
    context = (low * np.uint64(LEVEL2 // LEVEL1) + fine).astype(np.int64)
    start = int(mix(np.zeros(1, np.uint64))[0] % np.uint64(LEVEL2))
    # a token's context is the word before it; the first token of a text has the start's
    return token, np.insert(context, words.first[:-1], start), counts


def contexts(token: np.ndarray, ending: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each token's context: the hash of the word before it under the class of that word's ending."""
    before = np.concatenate((token[:1], token[:-1]))
    before[np.cumsum(counts) - counts] = _START
    return ending.astype(np.uint64) << _CLASS | before >> (np.uint64(64) - _CLASS)


def _dealt(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _chunks(buckets: int, documents: bool):
    """Rows of a chunk: its pairs for each bucket, or its documents (bucket -1).

    Both come from the documents, read each time, so neither has to be stored.
    """

    def out(chunk: int, ids: list, held: list, texts: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
        token, ending, counts = tokens(texts)
        word, at = np.unique(token, return_inverse=True)
        context, before = np.unique(contexts(token, ending, counts), return_inverse=True)
        kind, which = np.unique(at * len(context) + before, return_inverse=True)
        own = kind // len(context)
        if documents:
            doc = np.array([0 if i is None else i for i in ids], np.int64)
            known = np.array([i is not None for i in ids], np.uint8)
            size = np.array([len(word), len(kind)], np.int64)
            yield chunk, -1, _pack(doc, known, np.array(held, np.uint8), counts, which.astype(np.int32), _steps(own).astype(np.int32), size)
            return
        train = np.repeat(~np.array(held, bool), counts)
        n = np.bincount(which[train], minlength=len(kind))
        word_cut = np.searchsorted(_dealt(word, buckets), np.arange(buckets + 1))
        kind_cut = np.searchsorted(own, word_cut)
        for b in range(buckets):
            i, j = word_cut[b : b + 2]
            if i < j:
                k = slice(*kind_cut[b : b + 2])
                few, at = np.unique(kind[k] % len(context), return_inverse=True)
                key = (own[k] - i) * len(few) + at
                yield chunk, b, _pack(_steps(word[i:j]), _steps(context[few]), _steps(key), n[k].astype(np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        ids, held, texts, size = [], [], [], 0

        def flush():
            rows = list(zip(*out(base + number, ids, held, texts), strict=True))
            kinds = (pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=["chunk", "bucket", "blob"]
            )

        for batch in batches:
            for rows, found in slices(batch):
                ids += rows.column("doc_id").to_pylist()
                held += rows.column("held").to_pylist()
                texts += found
                size += sum(map(len, found))
                if size >= FLUSH_BYTES:
                    yield flush()
                    number += 1
                    ids, held, texts, size = [], [], [], 0
        if texts:
            yield flush()

    return run


def seat(c: np.ndarray, parent: np.ndarray, others: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of ``c`` customers of one dish each, who come one after another.

    ``parent`` is the dish's probability in the parent, ``others`` the tables of the other
    dishes in the restaurant. Large parties are seated in groups that see the same tables.
    """
    t = (c > 0).astype(np.int64)
    order = np.flatnonzero(c > 1)
    order = order[np.argsort(-c[order], kind="stable")]
    size, p, o = c[order], parent[order], others[order]
    tables = np.ones(len(order), np.int64)
    done, left = 1, len(order)
    while left:
        group = 1 if done < EXACT else done // 32
        n = np.minimum(size[:left] - done, group)
        new = (STRENGTH + d * (o[:left] + tables[:left])) * p[:left]
        chance = new / (new + done - d * tables[:left])
        if group == 1:
            tables[:left] += rng.random(left) < chance
        else:
            tables[:left] += rng.binomial(n, np.clip(chance, 0, 1))
        done += group
        left = int(np.searchsorted(-size[:left], -done, "left"))
    t[order] = tables
    return t


class Bucket:
    """A bucket's words after endings of words: contexts, counts and tables on three levels."""

    def __init__(self, word: np.ndarray, per_word: np.ndarray, context: np.ndarray, c2: np.ndarray):
        self.word, self.per_word, self.context, self.c2 = word, per_word, context.astype(np.int64), c2
        self.of = np.repeat(np.arange(len(word)), per_word)
        key = self.of * LEVEL1 + self.context // (LEVEL2 // LEVEL1)
        new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
        self.up = np.cumsum(new) - 1  # a pair's row on level 1
        self.key1 = key[new]
        self.of1, self.context1 = self.key1 // LEVEL1, self.key1 % LEVEL1
        self.c0_train = np.bincount(self.of, c2, len(word)).astype(np.int64)
        self.t2 = self.t1 = self.t0 = np.zeros(0, np.int64)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Customers of levels 1 and 0: the tables of the level below."""
        c1 = np.bincount(self.up, self.t2, len(self.key1)).astype(np.int64)
        return c1, np.bincount(self.of1, self.t1, len(self.word)).astype(np.int64)

    def first_seating(self) -> None:
        """One table per dish and restaurant."""
        self.t2 = (self.c2 > 0).astype(np.int64)
        self.t1 = (np.bincount(self.up, self.t2, len(self.key1)) > 0).astype(np.int64)
        self.t0 = (np.bincount(self.of1, self.t1, len(self.word)) > 0).astype(np.int64)

    def totals(self) -> np.ndarray:
        """Customers and tables of all restaurants in this bucket, then what the discounts need."""
        c1, c0 = self.counts()
        sums = [np.bincount(self.context, x, LEVEL2) for x in (self.c2, self.t2)]
        sums += [np.bincount(self.context1, x, LEVEL1) for x in (c1, self.t1)]
        seen = [[(c == k).sum() for k in (1, 2)] for c in (self.c2, c1, c0)]
        rest = [c0.sum(), self.t0.sum(), (self.c0_train > 0).sum(), self.c0_train.sum(), *np.ravel(seen)]
        return np.concatenate([*sums, np.array(rest, float)])

    def probabilities(self, g: Totals) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Predictive probabilities of the words, and of the pairs on levels 1 and 2."""
        c1, c0 = self.counts()
        d0, d1, d2 = g.discounts
        p0 = (c0 - d0 * self.t0 + (STRENGTH + d0 * g.t0) / (g.words + 1)) / (STRENGTH + g.c0)
        k = self.context1
        p1 = (c1 - d1 * self.t1 + (STRENGTH + d1 * g.t1[k]) * p0[self.of1]) / (STRENGTH + g.c1[k])
        k = self.context
        p2 = (self.c2 - d2 * self.t2 + (STRENGTH + d2 * g.t2[k]) * p1[self.up]) / (STRENGTH + g.c2[k])
        return p0, p1, p2

    def apart(self, g: Totals, level: int, at: np.ndarray, gone: np.ndarray) -> np.ndarray:
        """The probabilities of some rows of a level, each after ``gone`` of its own customers have left.

        Tables that are more than the customers left go as well, and their customers above.
        """
        c1, c0 = self.counts()
        if level == 2:
            customers, tables, above, all_c, all_t = self.c2, self.t2, self.up, g.c2[self.context[at]], g.t2[self.context[at]]
        elif level == 1:
            customers, tables, above, all_c, all_t = c1, self.t1, self.of1, g.c1[self.context1[at]], g.t1[self.context1[at]]
        else:
            customers, tables, above, all_c, all_t = c0, self.t0, None, g.c0, g.t0
        d = g.discounts[level]
        left = customers[at] - gone
        held = np.minimum(tables[at], left)
        less = tables[at] - held
        parent = 1 / (g.words + 1) if above is None else self.apart(g, level - 1, above[at], less)
        return (left - d * held + (STRENGTH + d * (all_t - less)) * parent) / (STRENGTH + all_c - gone)

    def sweep(self, g: Totals, rng: np.random.Generator) -> None:
        """Reseat the customers of every word in every restaurant, from the leaves to the root.

        A party's own tables are taken out of its parent restaurant first.
        """
        d0, d1, d2 = g.discounts
        p1 = self.apart(g, 1, self.up, self.t2)
        self.t2 = seat(self.c2, p1, g.t2[self.context] - self.t2, d2, rng)
        c1, _ = self.counts()
        p0 = self.apart(g, 0, self.of1, self.t1)
        self.t1 = seat(c1, p0, g.t1[self.context1] - self.t1, d1, rng)
        _, c0 = self.counts()
        base = np.full(len(c0), 1 / (g.words + 1))
        self.t0 = seat(c0, base, g.t0 - self.t0, d0, rng)


class Pairs:
    """All pairs of a bucket's words and the words before them, on top of those words' endings."""

    def __init__(self, word: np.ndarray, per_word: np.ndarray, context: np.ndarray, c3: np.ndarray):
        self.word, self.per_word, self.context, self.c3 = word, per_word, context, c3
        self.of = np.repeat(np.arange(len(word)), per_word)
        key = self.of * LEVEL2 + (context >> _CLASS).astype(np.int64)
        new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
        self.up = np.cumsum(new) - 1  # a pair's row on level 2
        key = key[new]
        per = np.bincount(key // LEVEL2, minlength=len(word))
        self.upper = Bucket(word, per, key % LEVEL2, np.zeros(len(key), np.int64))
        self.upper.c0_train = self.c0_train = np.bincount(self.of, c3, len(word)).astype(np.int64)
        self.contexts, self.at = np.unique(context, return_inverse=True)
        self.asked: list[np.ndarray] = []
        self.chunks = np.zeros(0, np.int64)
        self.discount = 0.5

    @classmethod
    def of_chunks(cls, chunks: np.ndarray, blobs: list[bytes]) -> Pairs:
        parts = [_unpack(b) for b in blobs]
        word, context, key = ([np.cumsum(p[k]) for p in parts] for k in range(3))
        words, contexts = np.unique(np.concatenate(word)), np.unique(np.concatenate(context))
        of = np.concatenate([np.searchsorted(words, w)[k // len(u)] for w, u, k in zip(word, context, key, strict=True)])
        at = np.concatenate([np.searchsorted(contexts, u)[k % len(u)] for u, k in zip(context, key, strict=True)])
        kind, which = np.unique(of * len(contexts) + at, return_inverse=True)
        n = np.bincount(which, np.concatenate([p[3] for p in parts]), len(kind)).astype(np.int64)
        out = cls(words, np.bincount(kind // len(contexts), minlength=len(words)), contexts[kind % len(contexts)], n)
        out.chunks, out.asked = chunks, np.split(which, np.cumsum([len(p[3]) for p in parts])[:-1])
        return out

    def packed(self) -> bytes:
        """Without the tables."""
        sizes = np.array([len(a) for a in self.asked], np.int64)
        key = self.of * len(self.contexts) + self.at
        asked = np.concatenate([_steps(a) for a in self.asked])
        return _pack(_steps(self.word), _steps(self.contexts), _steps(key), self.c3, self.chunks, sizes, asked)

    @classmethod
    def unpacked(cls, blob: bytes) -> Pairs:
        word, contexts, key, c3, chunks, sizes, asked = _unpack(blob)
        word, contexts, key = np.cumsum(word), np.cumsum(contexts), np.cumsum(key)
        out = cls(word, np.bincount(key // len(contexts), minlength=len(word)), contexts[key % len(contexts)], c3)
        out.chunks, out.asked = chunks, [np.cumsum(x) for x in np.split(asked, np.cumsum(sizes)[:-1])]
        out.first_seating()
        return out

    def first_seating(self) -> None:
        self.seated((self.c3 > 0).astype(np.int64))
        self.upper.first_seating()
        self.c_all, self.t_others = self.own(self.c3), np.zeros(len(self.contexts))

    def seated(self, t3: np.ndarray) -> None:
        self.t3 = t3
        self.upper.c2 = np.bincount(self.up, t3, len(self.upper.context)).astype(np.int64)

    def own(self, x: np.ndarray) -> np.ndarray:
        """What this bucket's pairs have in each of its contexts."""
        return np.bincount(self.at, x, len(self.contexts))

    def totals(self) -> np.ndarray:
        return np.concatenate((self.upper.totals(), [(self.c3 == k).sum() for k in (1, 2)]))

    def shares(self, number: int, parts: int) -> pd.DataFrame:
        """Rows for each part of the contexts with what this bucket has there; one with the other totals."""
        to = _dealt(mix(self.contexts), parts)
        order = np.argsort(to, kind="stable")
        columns = [x[order] for x in (self.contexts, self.own(self.c3).astype(np.int64), self.own(self.t3).astype(np.int64))]
        cut = np.searchsorted(to[order], np.arange(parts + 1))
        full = np.flatnonzero(np.diff(cut))
        pieces = [[x[cut[r] : cut[r + 1]] for x in columns] for r in full]
        blobs = [_pack(_steps(u), c, t) for u, c, t in pieces]
        return pd.DataFrame(
            {
                "bucket": number,
                "part": [SUMS, *full.tolist()],
                "blob": [b"", *blobs],
                "totals": [self.totals(), *[None] * len(blobs)],
            }
        )

    def exchanged(self, answers: pd.DataFrame, parts: int) -> None:
        """Take over all buckets' totals of this bucket's contexts."""
        found = [_unpack(b) for b in answers.sort_values("part")["blob"]]
        order = np.argsort(_dealt(mix(self.contexts), parts), kind="stable")
        self.c_all, everyone = np.zeros(len(order)), np.zeros(len(order))
        self.c_all[order] = np.concatenate([f[0] for f in found])
        everyone[order] = np.concatenate([f[1] for f in found])
        self.t_others = everyone - self.own(self.t3)

    def probabilities(self, g: Totals) -> np.ndarray:
        """Predictive probabilities of the pairs."""
        d, k = self.discount, self.at
        tables = (self.t_others + self.own(self.t3))[k]
        p2 = self.upper.probabilities(g)[2][self.up]
        return (self.c3 - d * self.t3 + (STRENGTH + d * tables) * p2) / (STRENGTH + self.c_all[k])

    def sweep(self, g: Totals, rng: np.random.Generator) -> None:
        p2 = self.upper.apart(g, 2, self.up, self.t3)
        others = (self.t_others + self.own(self.t3))[self.at] - self.t3
        self.seated(seat(self.c3, p2, others, self.discount, rng))
        self.upper.sweep(g, rng)


def discount(once: float, twice: float) -> float:
    """Of a level where so many dishes of a restaurant have one customer, and so many have two."""
    return float(np.clip(once / max(once + 2 * twice, 1), 0.05, 0.95))


class Totals:
    """Sums over all buckets."""

    def __init__(self, sums: np.ndarray):
        at = 0

        def take(n: int) -> np.ndarray:
            nonlocal at
            at += n
            return sums[at - n : at]

        self.c2, self.t2, self.c1, self.t1 = take(LEVEL2), take(LEVEL2), take(LEVEL1), take(LEVEL1)
        self.c0, self.t0, self.words, self.tokens = (float(x) for x in take(4))
        once = take(6).reshape(3, 2)[::-1]  # level 0 first
        self.discounts = [discount(a, b) for a, b in once]

    def moved(self, before: np.ndarray, now: np.ndarray, sums: np.ndarray) -> Totals:
        """These totals after one bucket's own share has changed; discounts stay."""
        out = Totals(sums + now - before)
        out.discounts = self.discounts
        return out


def _sweeps(bucket: Bucket | Pairs, sums: np.ndarray, discounts: list[float], n: int, seed: list[int]) -> Iterator[Totals]:
    """Sweeps with the other buckets' totals as they were; yields the totals after each."""
    rng = np.random.default_rng(seed)
    first = bucket.totals()
    g = Totals(sums)
    g.discounts = discounts
    for _ in range(n):
        bucket.sweep(g, rng)
        g = g.moved(first, bucket.totals(), sums)
        yield g


def _summed(state: DataFrame) -> np.ndarray:
    """The buckets' totals added up: as many numbers as there are restaurants, and a few."""
    zero = np.zeros(2 * LEVEL2 + 2 * LEVEL1 + 12)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = zero.copy()
        for batch in batches:
            for x in batch.column("totals"):
                out += x.values.to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([out.tolist()])], names=["totals"])

    # a row per task, then a row for each of a few tasks
    parts = state.where(f"part = {SUMS}").select("totals").mapInArrow(add, "totals array<double>")
    few = parts.repartition(ADDERS).mapInArrow(add, "totals array<double>")
    return sum((np.array(r["totals"]) for r in few.collect()), zero)


_STATE = "bucket bigint, part bigint, blob binary, totals array<double>"


def _begin(parts: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        bucket, number = Pairs.of_chunks(group["chunk"].to_numpy(np.int64), group["blob"].tolist()), int(group["bucket"].iloc[0])
        bucket.first_seating()
        state = pd.DataFrame({"bucket": [number], "part": [STATE], "blob": [bucket.packed()], "totals": [None]})
        return pd.concat((state, bucket.shares(number, parts)), ignore_index=True)

    return run


def _added(group: pd.DataFrame) -> pd.DataFrame:
    """All buckets' customers and tables in a part of the contexts, for each bucket in its own order."""
    found = [_unpack(b) for b in group["blob"]]
    _, at = np.unique(np.concatenate([np.cumsum(f[0]) for f in found]), return_inverse=True)
    cut = np.cumsum([len(f[0]) for f in found])[:-1]
    sums = []
    for k in (1, 2):
        total = np.bincount(at, np.concatenate([f[k] for f in found])).astype(np.int64)
        sums.append(np.split(total[at], cut))
    return pd.DataFrame(
        {"bucket": group["bucket"], "part": group["part"], "blob": [_pack(c, t) for c, t in zip(*sums, strict=True)]}
    )


def _exchange(rows: DataFrame, turn: int) -> DataFrame:
    shares = rows.where("part >= 0").select("bucket", "part", "blob")
    answers = shares.groupBy("part").applyInPandas(_added, "bucket bigint, part bigint, blob binary")
    return freeze(answers.withColumn("turn", F.lit(turn)))


def _burnt(state: pd.DataFrame, answers: pd.DataFrame, number: int, sums: np.ndarray, sweeps: int, parts: int) -> Pairs:
    """A bucket after the first sweeps, the same whenever it is asked for."""
    bucket = Pairs.unpacked(state["blob"].iloc[0])
    bucket.discount = discount(*sums[-2:])
    bucket.exchanged(answers[answers["turn"] == 0], parts)
    for _ in _sweeps(bucket, sums, Totals(sums).discounts, sweeps, [1, number]):
        pass
    return bucket


def _burn(sums: np.ndarray, sweeps: int, parts: int):
    def run(key: tuple, state: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        return _burnt(state, answers, int(key[0]), sums, sweeps, parts).shares(int(key[0]), parts)

    return run


def _answer(first: np.ndarray, sums: np.ndarray, burn: int, keep: int, parts: int):
    def run(key: tuple, state: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        """For each chunk the log probability of each of its pairs, and each of its words' count."""
        bucket = _burnt(state, answers, int(key[0]), first, burn, parts)
        bucket.exchanged(answers[answers["turn"] == 1], parts)
        total = np.zeros(len(bucket.c3))
        for g in _sweeps(bucket, sums, Totals(first).discounts, keep, [2, int(key[0])]):
            total += bucket.probabilities(g)
        log = np.log10(total / keep).astype(np.float32)
        out = []
        for pairs in bucket.asked:
            of = bucket.of[pairs]
            words = of[np.concatenate(([True], of[1:] != of[:-1]))]
            out.append(_pack(log[pairs], bucket.c0_train[words]))
        return pd.DataFrame({"chunk": bucket.chunks, "bucket": int(key[0]), "blob": out})

    return run


def _documents(n: float, v: float):
    """A chunk's documents from the answers to its pairs."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("bucket")
        doc, known, held, counts, which, own, size = _unpack(group["blob"].iloc[0])
        own = np.cumsum(own)
        parts = [_unpack(b) for b in group["blob"].iloc[1:]]
        if group["bucket"].iloc[0] >= 0 or [sum(len(p[k]) for p in parts) for k in (1, 0)] != size.tolist():
            raise RuntimeError("the documents changed between counting and scoring")
        log = np.concatenate([p[0] for p in parts]).astype(float)
        c = np.concatenate([p[1] for p in parts])
        base = np.log10((c + 0.1) / (n + 0.1 * (v + 1)))
        first = np.cumsum(counts) - counts
        return pd.DataFrame(
            {
                "doc_id": pd.Series(doc, dtype="Int64").mask(known == 0),
                "held_out": held > 0,
                "n_tokens": counts,
                "n_known": np.add.reduceat((c > 0)[own][which].astype(np.int64), first),
                "train_tokens": np.full(len(doc), int(n)),
                "base_score": np.add.reduceat(base[own][which], first),
                "score": np.add.reduceat(log[which], first),
            }
        )

    return run


def score(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", burn: int = BURN, keep: int = KEEP
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row.

    A document is held out of training when crc32 of its doc_id as text is a multiple of 10.
    ``docs`` are read twice and have to come in the same partitions, as tables of files do; if they do
    not, that is an error.
    """
    held = F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("bigint").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    own = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
        held.alias("held"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    small_batches(docs.sparkSession)
    spark, buckets = docs.sparkSession, spread(docs, input_bytes(docs, text), BUCKET_BYTES)
    pairs, documents = (own.mapInArrow(_chunks(buckets, d), "chunk bigint, bucket bigint, blob binary") for d in (False, True))
    begun = freeze(pairs.groupBy("bucket").applyInPandas(_begin(buckets), _STATE))
    released(spark)
    state = begun.where(f"part = {STATE}").select("bucket", "blob").groupBy("bucket")
    first, turns = _summed(begun), _exchange(begun, 0)
    burnt = freeze(state.cogroup(turns.groupBy("bucket")).applyInPandas(_burn(first, burn, buckets), _STATE))
    sums, turns = _summed(burnt), turns.unionByName(_exchange(burnt, 1))
    released(spark)
    answers = state.cogroup(turns.groupBy("bucket")).applyInPandas(
        _answer(first, sums, burn, keep, buckets), "chunk bigint, bucket bigint, blob binary"
    )
    g = Totals(sums)
    found = documents.unionByName(answers)
    return found.groupBy("chunk").applyInPandas(
        _documents(g.tokens, g.words),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double",
    )


def perplexity(scored: DataFrame) -> DataFrame:
    """Perplexity per token of the held-out and of the training documents, for model and base."""
    total = F.sum("n_tokens")
    return scored.groupBy("held_out").agg(
        total.alias("n_tokens"),
        F.pow(F.lit(10.0), -F.sum("score") / total).alias("perplexity"),
        F.pow(F.lit(10.0), -F.sum("base_score") / total).alias("base_perplexity"),
    )
