"""Ranked lexical search, term at a time with limited accumulators.

A query meets the documents of a block term by term, its rarest term first. A document
that holds a term gets an accumulator for its partial score. Each term has a bound, the
most that it gives any document of the block. Once the bounds of the terms to come add up
to less than the k-th best partial score, a document without accumulator cannot be among
the best k any more: from then on no accumulators are made, and those that are there are
updated with all remaining terms, so their scores are exact. The best k of the blocks that
a task has seen before count as partial scores too. Nothing is left out: the result is
that of scoring every document.

Documents are read twice, once to count them and the terms of the queries in them, once to
score them. A task sends k documents per query; these meet in two steps, first dealt over
many tasks, then per query. Queries are taken in blocks of ``BLOCK_TERMS`` terms, so what
travels to the tasks is bounded; a query of more terms is a block of its own.

A score sums whole numbers: a term's weight w is floor(1000 ln((2N + 2) / (2 df + 1))), a
document's length norm m is 10 + 90 n N div L, and a term that occurs tf times gives
w ((1000000000 tf) div (1000 tf + 8 m)).

Null texts and texts without terms are no documents, and score nothing. A repeated row is
a document of its own, with the same score. Equal scores go by the smaller id, null ids
last. Rows of one query id are one query, of the terms of all its texts; a query without
terms, or whose terms no document holds, gives no rows. Texts are read whole. Further
columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import freeze, plain
from tidemark.llm.text import Words, slices

# Fixed value: a term is a maximal match of this.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_TERMS = 100_000
BLOCK_BYTES = 8_000_000
PARTS = 64

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# bytes of terms as they are but for A-Z; all other bytes separate
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms(texts: list[bytes]) -> Words:
    """The terms of texts, as words."""
    return Words([t.translate(_FOLD) for t in texts])


class Vocabulary:
    """The terms of a block of queries, looked up by hash and then by their bytes."""

    def __init__(self, listed: list[bytes]):
        self.words = Words(listed)
        hashes = self.words.hashes()
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two terms of a block of queries have one hash; use another block size")
        self.head, self.tail = self.words.ends()
        self.size = self.words.end - self.words.start

    def __len__(self) -> int:
        return len(self.size)

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Which words are terms of the block, and which terms these are."""
        hashes = words.hashes()
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self) - 1)
        at = np.flatnonzero(self.hashes[place] == hashes)
        term = self.order[place[at]]
        head, tail = words.ends()
        size = words.end[at] - words.start[at]
        same = (head[at] == self.head[term]) & (tail[at] == self.tail[term]) & (size == self.size[term])
        for i in np.flatnonzero(same & (size > 16)).tolist():
            mine = words.blob[words.start[at[i]] : words.end[at[i]]]
            same[i] = mine == self.words.blob[self.words.start[term[i]] : self.words.end[term[i]]]
        return at[same], term[same]


class Postings:
    """The occurrences of the block's terms in some documents, summed up per document and term."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.ids, self.lengths, self.pairs, self.tfs = vocabulary, [], [], [], []
        self.rows = self.bytes = 0

    def add(self, ids: list[int | None], texts: list[bytes]) -> None:
        words = terms(texts)
        at, term = self.vocabulary.find(words)
        # term first: the pairs of a block come sorted by term when sorted
        pair, tf = np.unique(term * (1 << 32) + self.rows + words.docs()[at], return_counts=True)
        self.pairs.append(pair)
        self.tfs.append(tf)
        self.ids += ids
        self.lengths.append(words.counts)
        self.rows += len(texts)
        self.bytes += len(words.blob)

    def by_term(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Documents and frequencies, sorted by term; where each term begins; lengths of the documents."""
        pair, tf = np.concatenate(self.pairs), np.concatenate(self.tfs)
        order = np.argsort(pair)
        pair = pair[order]
        first = np.searchsorted(pair, np.arange(len(self.vocabulary) + 1) << 32)
        return pair & 0xFFFFFFFF, tf[order], first, np.concatenate(self.lengths)


def norms(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    if 90 * int(lengths.max(initial=0)) * n_docs >= 1 << 63:
        return np.array([10 + 90 * n * n_docs // n_terms for n in lengths.tolist()], np.int64)
    return 10 + 90 * lengths.astype(np.int64) * n_docs // n_terms


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Best:
    """The best documents of each query so far, best first."""

    def __init__(self, queries: list[np.ndarray], k: int):
        self.queries, self.k = queries, k
        self.found: list[list[tuple[int, bool, int]]] = [[] for _ in queries]

    def meet(self, block: Postings, weights: np.ndarray, n_docs: int, n_terms: int) -> None:
        """Rank the documents of a block for all queries."""
        docs, tf, first, lengths = block.by_term()
        if not len(docs):
            return
        norm = norms(lengths, n_docs, n_terms)
        term = np.repeat(np.arange(len(first) - 1), np.diff(first))
        gain = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * norm[docs]))
        bound = np.zeros(len(first) - 1, np.int64)
        np.maximum.at(bound, term, gain)
        ends = list(zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
        for query, wanted in enumerate(self.queries):
            here = wanted[bound[wanted] > 0]
            left = np.cumsum(bound[here][::-1])[::-1].tolist()
            lists = [(docs[a:b], gain[a:b]) for a, b in (ends[t] for t in here.tolist())]
            self._query(query, lists, left, block.ids)

    def _query(self, query: int, lists: list, left: list[int], ids: list[int | None]) -> None:
        """``lists`` are postings, rarest term first; ``left`` what a term and those after it can give."""
        known = [-score for score, _, _ in self.found[query]]
        partial = np.zeros(len(ids) + self.k, np.int64)  # the last ones are the best of earlier blocks
        partial[len(ids) : len(ids) + len(known)] = known
        making = True
        for (docs, gain), reach in zip(lists, left, strict=True):
            if making and reach < np.partition(partial, -self.k)[-self.k]:
                making = False
            if not making:
                held = partial[docs] > 0
                docs, gain = docs[held], gain[held]
            partial[docs] += gain
        least = max(1, int(np.partition(partial, -self.k)[-self.k]))
        new = np.flatnonzero(partial[: len(ids)] >= least).tolist()
        if new:
            merged = self.found[query] + [(-int(partial[i]), ids[i] is None, ids[i] or 0) for i in new]
            self.found[query] = sorted(merged)[: self.k]

    def rows(self) -> pa.RecordBatch:
        each = [(q, None if null else i, -score) for q, found in enumerate(self.found) for score, null, i in found]
        query, ids, score = zip(*each, strict=True) if each else ((), (), ())
        columns = [pa.array(query, pa.int32()), pa.array(ids, pa.int64()), pa.array(score, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["query", "doc_id", "score"])


def _ids(rows: pa.RecordBatch) -> list[int | None]:
    return rows.column(rows.schema.get_field_index("doc_id")).to_pylist()


def totals(docs: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, int, int]:
    """In how many documents each term occurs, the number of documents, and of all their terms.

    A task sends a row per term at most, and Spark adds them up.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n_docs, n_terms = np.zeros(len(vocabulary), np.int64), 0, 0
        for batch in batches:
            for _, texts in slices(batch):
                words = terms(texts)
                at, term = vocabulary.find(words)
                pair = np.unique(term * (1 << 32) + words.docs()[at])
                df += np.bincount(pair >> 32, minlength=len(df))
                n_docs += int((words.counts > 0).sum())
                n_terms += len(words)
        n = np.concatenate(([n_docs, n_terms], df))
        some = np.flatnonzero(n)
        columns = [pa.array(some - 2, pa.int32()), pa.array(n[some], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["term", "n"])

    found = docs.select("text").mapInArrow(count, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    n = np.zeros(len(vocabulary) + 2, np.int64)
    for term, k in found.collect():
        n[term + 2] = k
    return n[2:], int(n[0]), int(n[1])


def _search(docs: DataFrame, queries: list[list[str]], k: int) -> DataFrame:
    """Query (its place in the list), rank, doc_id and score, for a block of queries."""
    listed = sorted({t.encode() for query in queries for t in query})
    number = {t: i for i, t in enumerate(listed)}
    vocabulary = Vocabulary(listed)
    df, n_docs, n_terms = totals(docs, vocabulary)
    weights = np.array([weight(n, n_docs) for n in df.tolist()], np.int64)
    rarest_first = [
        np.array(sorted((number[t.encode()] for t in query), key=lambda i: (df[i], i)), np.int64) for query in queries
    ]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, block = Best(rarest_first, k), Postings(vocabulary)
        for batch in batches:
            for rows, texts in slices(batch):
                block.add(_ids(rows), texts)
                if block.bytes >= BLOCK_BYTES:
                    best.meet(block, weights, n_docs, n_terms)
                    block = Postings(vocabulary)
        if block.rows:
            best.meet(block, weights, n_docs, n_terms)
        yield best.rows()

    found = docs.mapInArrow(score, "query int, doc_id bigint, score bigint")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # tasks times k rows of a query meet in parts first, so that no task gets the rows of all tasks
    part = Window.partitionBy("query", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))).orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k)
    whole = Window.partitionBy("query").orderBy(*order)
    return found.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)


def _blocks(queries: Iterator[Row], size: int) -> Iterator[list[Row]]:
    block, n = [], 0
    for row in queries:
        if block and n + len(row.terms) > size:
            yield block
            block, n = [], 0
        block.append(row)
        n += len(row.terms)
    if block:
        yield block


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    query_id: str = "item_id",
    query_text: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """The best ``k`` documents of each query: its id, rank from 1, doc_id and score."""
    docs = plain(docs, doc_id=doc_id, text=text)
    lowered = F.translate(F.col(f"`{query_text}`"), _UPPER, _UPPER.lower())
    found = queries.select(
        F.col(f"`{query_id}`").alias("id"), F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term")
    )
    each = found.groupBy("id").agg(F.sort_array(F.collect_set("term")).alias("terms"))
    spark, kind = docs.sparkSession, each.schema["id"].dataType.simpleString()
    results = []
    for block in _blocks(each.toLocalIterator(), block_terms):
        names = spark.createDataFrame([(i, row.id) for i, row in enumerate(block)], f"query int, id {kind}")
        ranked = _search(docs, [row.terms for row in block], k).join(names, "query")
        results.append(freeze(ranked.select(F.col("id").alias(query_id), "rank", "doc_id", "score")))
    if not results:
        return spark.createDataFrame([], f"`{query_id}` {kind}, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionAll, results)
