"""Removal of word windows that an earlier document has, by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document. A word goes if a window that
covers it also starts in a document with a smaller doc_id; windows are judged on the
input. Words are compared as they are.

The smallest hash of the ``GRAM``-word runs in a window is its minimiser. Neighbouring
windows mostly share it, and travel as one packed string to the minimiser's bucket. All
windows with the same words have the same minimiser, so a bucket sees every occurrence:
sorting brings equal windows together, and their words decide. What a bucket finds goes
back to its documents as ranges of words.

Hot keys: a packed string that a task has seen in a document with a smaller doc_id needs
no bucket, its windows are judged on the spot, so a passage of a third of all documents
travels once per task and flush. A minimiser that holds many different strings (found on a
sample of documents) sends its windows one by one, dealt out by the window's own hash.
Both change the way, not the result.

Null text has no words. A null doc_id counts as larger than any number. Documents with the
same doc_id are not compared with each other (a 32-bit hash of the text tells them
apart); repeated rows get the same result. An empty
table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import each_slice, free_names, input_bytes, spread, with_columns
from tidemark.llm.text import SLICE_BYTES, Words, covered, mix, slices, windows

WINDOW = 13
GRAM = 2
FLUSH_BYTES = 5_000_000  # text per task between two flushes
BUCKET_BYTES = 4_000_000  # packed strings per bucket, about
SAMPLE = 20_000
_LAST = 2**63 - 1  # stands for a null doc_id


def _minimisers(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of all windows, and the minimiser and hash of each."""
    hashes = words.hashes()
    own, inside = windows(hashes, words.first, k)
    grams = mix(windows(hashes, words.first, GRAM)[0])
    width, n = k - GRAM + 1, len(own)
    least, span = grams, 1
    while 2 * span <= width:  # minima of runs of doubling length
        least, span = np.minimum(least[: len(least) - span], least[span:]), 2 * span
    least = np.minimum(least[:n], least[width - span : width - span + n])
    at = np.flatnonzero(inside)
    return at, least[at], own[at]


def _runs(at: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of neighbouring windows with one minimiser begin, and how many they are."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.concatenate(([True], (np.diff(at) != 1) | (least[1:] != least[:-1])))
    begin = np.flatnonzero(new)
    return begin, np.diff(np.append(begin, len(at)))


# doc_id, key, first word and number of windows; of packed strings, then of judged ones
_KINDS = (np.int64, np.int32, np.int32, np.int32) * 2


def _blob(arrays: list[np.ndarray], strings: list[bytes]) -> bytes:
    head = np.array([len(strings), *map(len, arrays)], np.int64)
    parts = [a.astype(kind) for a, kind in zip(arrays, _KINDS, strict=True)]
    parts = [head, np.array([len(s) for s in strings], np.int32), *parts]
    return zstandard.compress(b"".join([*(p.tobytes() for p in parts), *strings]), 6)


def _unblob(blob: bytes) -> tuple[list[np.ndarray], list[bytes]]:
    raw = zstandard.decompress(blob)
    n, *sizes = np.frombuffer(raw, np.int64, 1 + len(_KINDS)).tolist()
    at = 8 * (1 + len(_KINDS))
    out = []
    for size, kind in zip([n, *sizes], (np.int32, *_KINDS), strict=True):
        out.append(np.frombuffer(raw, kind, size, at))
        at += out[-1].nbytes
    ends = at + np.cumsum(out[0], dtype=np.int64)
    starts = ends - out[0]
    return out[1:], [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """doc_id, key and text of many rows at once, in the order of doc_id."""
    ids, keys, texts, size = [], [], [], 0

    def out():
        i, k = np.concatenate(ids), np.concatenate(keys)
        order = np.argsort(i, kind="stable")
        return i[order], k[order], [texts[j] for j in order.tolist()]

    for batch in batches:
        for rows, found in slices(batch):
            ids.append(rows.column("doc_id").to_numpy(zero_copy_only=False))
            keys.append(rows.column("key").to_numpy(zero_copy_only=False))
            texts += found
            size += sum(map(len, found))
            if size >= FLUSH_BYTES:
                yield out()
                ids, keys, texts, size = [], [], [], 0
    if texts:
        yield out()


def _count_minimisers(k: int):
    """How many different packed strings of the sample each minimiser has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, texts in _flushes(batches):
            words = Words(texts)
            at, least, own = _minimisers(words, k)
            begin, n = _runs(at, least)
            first = own[begin] ^ mix(own[begin + n - 1])
            _, unique = np.unique(first, return_index=True)
            value, count = np.unique(least[begin[unique]], return_counts=True)
            yield pa.RecordBatch.from_pydict({"minimiser": value.view(np.int64), "n": count})

    return run


def hot_minimisers(keyed: DataFrame, buckets: int, k: int, sample: int = SAMPLE) -> list[int]:
    """Minimisers with over half a bucket's share of the packed strings: at most 2 * buckets."""
    total = keyed.count()
    few = keyed.sample(min(1.0, sample / max(total, 1)), seed=11)
    sums = few.mapInArrow(_count_minimisers(k), "minimiser bigint, n bigint")
    sums = sums.groupBy("minimiser").agg(F.sum("n").alias("n"))
    all_runs = F.broadcast(sums.agg(F.sum("n").alias("all")))
    found = sums.join(all_runs, F.expr(f"n > 100 and n > all / {2 * buckets}"))
    return sorted(r[0] for r in found.select("minimiser").collect())


def _scatter(buckets: int, k: int, hot: list[int]):
    hot_values = np.array(hot, np.int64).view(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys, texts in _flushes(batches):
            words = Words(texts)
            at, least, own = _minimisers(words, k)
            is_hot = np.isin(least, hot_values)
            begin, n = _runs(at, np.where(is_hot, own, least))  # hot ones stand alone
            joined, start, end = words.joined()
            first_word = at[begin]
            doc = np.searchsorted(words.first, first_word, "right") - 1
            place = first_word - words.first[doc]
            to = mix(np.where(is_hot[begin], own[begin], least[begin])) % np.uint64(buckets)
            seen: dict[bytes, int] = {}
            travels = np.ones(len(begin), bool)
            strings = []
            ends = end[first_word + n + k - 2]
            for r, (d, a, b) in enumerate(zip(ids[doc].tolist(), start[first_word].tolist(), ends.tolist(), strict=True)):
                s = joined[a:b]
                strings.append(s)
                if seen.setdefault(s, d) < d:
                    travels[r] = False
            told = np.flatnonzero(~travels)
            flags = [ids[doc[told]], keys[doc[told]], place[told], n[told]]
            go = np.flatnonzero(travels)
            go = go[np.argsort(to[go], kind="stable")]
            cut = np.flatnonzero(np.diff(to[go])) + 1 if len(go) else []
            rows = []
            for mine in np.split(go, cut) if len(go) else []:
                arrays = [ids[doc[mine]], keys[doc[mine]], place[mine], n[mine], *flags]
                flags = [np.zeros(0, np.int64)] * 4  # they go along with the first bucket
                rows.append((int(to[mine[0]]), _blob(arrays, [strings[r] for r in mine.tolist()])))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.binary())],
                    names=["bucket", "blob"],
                )

    return run


def _repeated(words: Words, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the packed strings, and which also start in an earlier document."""
    hashes, inside = windows(words.hashes(), words.first, k)
    at = np.flatnonzero(inside)
    of = doc[words.docs()[at]]
    order = np.lexsort((of, hashes[at]))
    key = hashes[at][order]
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    group = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(key))))
    least = begin[group]  # the group's first row has its smallest doc_id
    later = np.flatnonzero(of[order] > of[order][least])
    repeated = np.zeros(len(at), bool)
    repeated[order[later]] = True
    joined, start, end = words.joined()
    a, b = start[at], end[at + k - 1]
    mine, first = order[later], order[least[later]]
    wrong = [
        g
        for i, j, g in zip(mine.tolist(), first.tolist(), group[later].tolist(), strict=True)
        if joined[a[i] : b[i]] != joined[a[j] : b[j]]
    ]
    for g in set(wrong):  # different windows with one hash: their words alone decide
        rows = order[begin[g] : begin[g + 1] if g + 1 < len(begin) else len(order)]
        smallest: dict[bytes, int] = {}
        for i in rows.tolist():  # in the order of doc_id
            repeated[i] = smallest.setdefault(joined[a[i] : b[i]], of[i]) < of[i]
    return at, repeated


def _judge(k: int):
    """A bucket's repeated windows as ranges of first words, by document."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        arrays, strings = [[] for _ in range(8)], []
        for blob in group["blob"]:
            found, more = _unblob(blob)
            for all_of, a in zip(arrays, found, strict=True):
                all_of.append(a)
            strings += more
        ids, keys, place, _, *flags = (np.concatenate(a) for a in arrays)
        words = Words(strings)
        at, repeated = _repeated(words, ids, k)
        run_of = words.docs()[at]
        hit = np.flatnonzero(repeated)
        new = np.concatenate(([True], (np.diff(hit) != 1) | (run_of[hit][1:] != run_of[hit][:-1]))) if len(hit) else []
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(hit)))
        first = hit[begin]
        of = run_of[first]
        out_ids = np.concatenate((ids[of], flags[0]))
        out_keys = np.concatenate((keys[of], flags[1]))
        starts = np.concatenate((place[of] + at[first] - words.first[of], flags[2])).astype(np.int32)
        sizes = np.concatenate((size, flags[3])).astype(np.int32)
        order = np.lexsort((out_keys, out_ids))
        pairs = np.stack((starts[order], sizes[order]), 1)
        out_ids, out_keys = out_ids[order], out_keys[order]
        if not len(order):
            return pd.DataFrame({"doc_id": [], "key": [], "ranges": []})
        cut = np.flatnonzero((np.diff(out_ids) != 0) | (np.diff(out_keys) != 0)) + 1
        at0 = np.concatenate(([0], cut))
        return pd.DataFrame(
            {
                "doc_id": out_ids[at0],
                "key": out_keys[at0],
                "ranges": [p.tobytes() for p in np.split(pairs, cut)],
            }
        )

    return run


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id with a number for null, and a key that tells texts under one doc_id apart."""
    return docs.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(_LAST)).alias("doc_id"),
        F.hash(F.col(f"`{text}`")).alias("key"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )


def repeated_ranges(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """Per document with repeated windows: doc_id, key, and lists of (first word, windows) pairs."""
    keyed = _keyed(docs, doc_id, text)
    buckets = spread(docs, 5 * input_bytes(docs, text), BUCKET_BYTES)
    hot = hot_minimisers(keyed, buckets, window)
    sent = keyed.mapInArrow(_scatter(buckets, window, hot), "bucket bigint, blob binary")
    judged = sent.groupBy("bucket").applyInPandas(_judge(window), "doc_id bigint, key int, ranges binary")
    return judged.groupBy("doc_id", "key").agg(F.collect_list("ranges").alias("ranges"))


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """``docs`` with the text's words that stay, joined by a space, and n_words and n_removed.

    Columns named n_words or n_removed are replaced.
    """
    carried = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_words", "n_removed")])
    own_id, own_key, ranges = free_names(carried, "own_id", "own_key", "ranges")
    found = repeated_ranges(docs, doc_id, text, window).select(
        F.col("doc_id").alias(own_id), F.col("key").alias(own_key), F.col("ranges").alias(ranges)
    )
    keyed = carried.withColumns(
        {
            own_id: F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(_LAST)),
            own_key: F.hash(F.col(f"`{text}`")),
        }
    )
    typed = ", ".join(f"`{c}` {'string' if c == text else t}" for c, t in carried.dtypes)
    wire = ", ".join(f"`{c}` {'binary' if c == text else t}" for c, t in keyed.dtypes)

    def shrink(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        out = {n: rows.column(n) for n in rows.schema.names}
        out[text] = pa.array([zstandard.compress(t, 3) for t in texts], pa.binary())
        return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    # texts cross the shuffle to their ranges compressed
    joined = each_slice(keyed, shrink, wire, text).join(found, [own_id, own_key], "left").drop(own_id, own_key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column(text).to_pylist()
            size = np.cumsum([zstandard.frame_content_size(b) for b in blobs])
            cut = np.flatnonzero(np.diff(size // SLICE_BYTES)) + 1
            for a, b in zip([0, *cut], [*cut, batch.num_rows], strict=True):
                if b > a:
                    yield step(batch.slice(a, b - a), [zstandard.decompress(x) for x in blobs[a:b]])

    def step(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        words = Words(texts)
        gone = np.zeros(len(words), bool)
        for d, lists in enumerate(rows.column(ranges).to_pylist()):
            if lists:
                pairs = np.frombuffer(b"".join(lists), np.int32).reshape(-1, 2).astype(np.int64)
                starts = np.repeat(pairs[:, 0] - np.cumsum(pairs[:, 1]) + pairs[:, 1], pairs[:, 1])
                starts += np.arange(len(starts))
                a, b = words.first[d], words.first[d + 1]
                gone[a:b] = covered(starts, window, b - a)
        blob, start, end = words.joined()
        sizes = end - start + 1
        kept = np.frombuffer(blob, np.uint8)[np.repeat(~gone, sizes)].tobytes()
        stop = np.concatenate(([0], np.cumsum(sizes * ~gone)))[words.first]
        left = [kept[a : max(a, b - 1)].decode() for a, b in zip(stop[:-1].tolist(), stop[1:].tolist(), strict=True)]
        removed = np.diff(np.concatenate(([0], np.cumsum(gone)))[words.first])
        out = {n: rows.column(n) for n in rows.schema.names if n != ranges} | {text: pa.array(left, pa.string())}
        return with_columns(
            pa.RecordBatch.from_arrays(list(out.values()), names=list(out)),
            n_words=pa.array(words.counts.astype(np.int64)),
            n_removed=pa.array(removed.astype(np.int64)),
        )

    return joined.mapInArrow(run, f"{typed}, n_words bigint, n_removed bigint")
