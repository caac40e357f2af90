"""Mixing sources to target weights with a low-discrepancy schedule.

The words of each source, its documents shuffled by a hash, are cut into blocks of equal
size. Slot i of the mix takes the point i * golden ratio (its fraction), and the source
whose interval of cumulative weight holds the point: any run of slots holds the sources in
nearly their shares. The k-th slot of a source takes its k-th block, and begins again
after the last one. A source gets as many slots as its target needs, the last one rounded.

Running sums and ranks never put a source into one task: sums over hash ranges (or runs
of slots) come first, their running sums are short, and the rest is local to a range.

Null or empty texts have size 0 and are never taken; a null source is a source, the last
one; repeated rows are documents of their own. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import each_slice, free_names, freeze, with_columns
from tidemark.llm.text import Words

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3  # times its size that a source may be taken
BLOCK = 16_384  # words
LEAST_BLOCKS = 1024  # of a source that has as many words
RANGES_LOG2 = 14  # hash ranges of a source
CHUNK = 65_536  # slots
_RATIO = (5**0.5 - 1) / 2
_NO_ID = 2**63 - 1


@dataclass(frozen=True)
class Source:
    """A source's share of the mix: sizes in words, blocks and slots."""

    name: str | None
    size: int
    target: float
    block: int
    blocks: int
    slots: int


def targets(sizes: list[int], weights: list[float], total: float, most: float = MOST) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; the excess is reshared."""
    out = [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    while open_:
        left = total - sum(out)
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in full:
            out[i] = float(most * sizes[i])
        open_ = [i for i in open_ if i not in full]
    return out


def plan(totals: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> list[Source]:
    """The sources in the order of their names by code point, null last; weights repeat along it."""
    names = sorted((n for n in totals if n is not None)) + [n for n in totals if n is None]
    sizes = [totals[n] for n in names]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(names))], float(sum(sizes)), most)
    out = []
    for name, size, target in zip(names, sizes, goal, strict=True):
        wanted = max(-(-size // BLOCK), min(size, LEAST_BLOCKS), 1)
        block = max(1, -(-size // wanted))
        blocks = -(-size // block)
        rounds = int(target // size) if size else 0
        slots = rounds * blocks + round((target - rounds * size) / block) if size else 0
        out.append(Source(name, size, target, block, blocks, min(slots, int(most * blocks))))
    return out


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, key (tells texts under one doc_id apart), source, size and a row number; written once."""

    def step(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        return with_columns(rows, drop=("text",), size=pa.array(Words(texts).counts.astype(np.int64)))

    own = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
        F.xxhash64(F.col(f"`{text}`")).alias("key"),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    found = each_slice(own, step, "doc_id bigint, key bigint, source string, size bigint")
    return freeze(found).withColumn("row", F.monotonically_increasing_id())


def _numbered(spark: SparkSession, sources: list[Source]) -> DataFrame:
    rows = [(i, s.name, s.size, s.target, s.block, s.blocks) for i, s in enumerate(sources)]
    return spark.createDataFrame(
        rows, "s int, source string, source_size bigint, target double, block_size bigint, blocks bigint"
    )


def pieces(documents: DataFrame, sources: list[Source]) -> DataFrame:
    """The shuffled documents cut at block borders: s, block, row, first_word, words."""
    order = F.xxhash64("doc_id", "key", F.lit(17))
    filled = documents.where("size > 0").withColumn("place", order)
    filled = filled.withColumn("range", F.shiftright("place", 64 - RANGES_LOG2))
    numbered = _numbered(documents.sparkSession, sources)
    filled = filled.join(numbered, filled["source"].eqNullSafe(numbered["source"])).drop("source")
    sums = filled.groupBy("s", "range").agg(F.sum("size").alias("sum"))
    before = sums.select(
        "s", "range", (F.sum("sum").over(Window.partitionBy("s").orderBy("range")) - F.col("sum")).alias("before")
    )
    inside = Window.partitionBy("s", "range").orderBy("place", "doc_id", "key", "row")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = filled.withColumn("end", F.sum("size").over(running)).join(before, ["s", "range"])
    placed = placed.withColumn("begin", F.col("before") + F.col("end") - F.col("size"))
    first, last = F.expr("begin div block_size"), F.expr("(begin + size - 1) div block_size")
    cut = placed.withColumn("block", F.explode(F.sequence(first, last)))
    low = F.greatest("begin", F.col("block") * F.col("block_size"))
    high = F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * F.col("block_size"))
    return cut.select(
        "s", "block", "row", (low - F.col("begin")).alias("first_word"), (high - low).alias("words")
    )


def points(slots: np.ndarray) -> np.ndarray:
    """The fraction of (slot + 0.5) * golden ratio, exact enough for slots below 2**46."""
    high, low = np.divmod(slots, 1 << 20)
    step = (_RATIO * (1 << 20)) % 1.0
    return ((high * step) % 1.0 + (low + 0.5) * _RATIO) % 1.0


def _drawn(chunk: int, count: int, borders: np.ndarray) -> np.ndarray:
    slots = np.arange(chunk * CHUNK, min((chunk + 1) * CHUNK, count))
    return np.minimum(np.searchsorted(borders, points(slots), "right"), len(borders) - 1)


def schedule(spark: SparkSession, sources: list[Source]) -> DataFrame:
    """The mix in order: slot, s, rank (of the slot among those of its source).

    More slots are drawn than needed, so that each source gets all of its own; what a
    source gets beyond them is left out.
    """
    wanted = np.array([s.slots for s in sources], np.int64)
    if not wanted.sum():
        return spark.createDataFrame([], "slot bigint, s int, rank bigint")
    borders = np.cumsum(wanted) / wanted.sum()
    share = wanted / wanted.sum()
    count = int(np.ceil(max((w + 8) / p for w, p in zip(wanted, share, strict=True) if w)))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.column(0).to_pylist():
                n = np.bincount(_drawn(chunk, count, borders), minlength=len(borders))
                yield pa.RecordBatch.from_pydict(
                    {"chunk": np.full(len(n), chunk), "s": np.arange(len(n), dtype=np.int32), "n": n}
                )

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = _drawn(chunk, count, borders)
                start = np.zeros(len(borders), np.int64)
                for b in before:
                    start[b["s"]] = b["before"]
                order = np.argsort(s, kind="stable")
                n = np.bincount(s, minlength=len(borders))
                own = np.empty(len(s), np.int64)
                own[order] = np.arange(len(s)) - np.repeat(np.cumsum(n) - n, n)
                at = start[s] + own
                keep = np.flatnonzero(at < wanted[s])
                yield pa.RecordBatch.from_pydict(
                    {"slot": chunk * CHUNK + keep, "s": s[keep].astype(np.int32), "rank": at[keep]}
                )

    chunks = spark.range(-(-count // CHUNK)).withColumnRenamed("id", "chunk")
    tallied = chunks.mapInArrow(tally, "chunk bigint, s int, n bigint")
    running = F.sum("n").over(Window.partitionBy("s").orderBy("chunk")) - F.col("n")
    before = tallied.select("chunk", F.struct("s", running.alias("before")).alias("b"))
    before = before.groupBy("chunk").agg(F.collect_list("b").alias("before"))  # one entry per source
    return before.mapInArrow(rank, "slot bigint, s int, rank bigint")


def mix(documents: DataFrame, sources: list[Source]) -> DataFrame:
    """What each slot takes: slot, s, round (through the source), row, first_word, words."""
    spark = documents.sparkSession
    numbered = _numbered(spark, sources).select("s", "blocks")
    slots = schedule(spark, sources).join(numbered, "s").select(
        "slot", "s", F.expr("rank div blocks").alias("round"), F.expr("rank % blocks").alias("block")
    )
    return pieces(documents, sources).join(slots, ["s", "block"]).select(
        "slot", "s", "round", "row", "first_word", "words"
    )


def planned(documents: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> list[Source]:
    """The plan for :func:`sized` documents; one row per source comes to the driver."""
    sums = documents.groupBy("source").agg(F.sum("size").alias("size")).collect()
    return plan({r["source"]: r["size"] for r in sums}, weights, most)


def report(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, **names: str) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (its source's), taken."""
    documents = sized(docs, **names)
    sources = planned(documents, weights, most)
    taken = mix(documents, sources).groupBy("row").agg(F.sum("words").alias("taken"))
    numbered = _numbered(docs.sparkSession, sources)
    return (
        documents.join(numbered, documents["source"].eqNullSafe(numbered["source"]))
        .join(taken, "row", "left")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    )


def mixed_documents(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The mix as documents: a row with all columns for each time that a document is taken.

    In the last round through a source, its last document may be taken in part: its text
    then ends with the last word taken.
    """
    documents = sized(docs, doc_id, text, source)
    sources = planned(documents, weights, most)
    taken = mix(documents, sources).groupBy("row", "round").agg(F.sum("words").alias("words"))
    own_id, own_key, nth, words = free_names(docs, "own_id", "own_key", "nth", "words")
    same = Window.partitionBy(own_id, own_key)
    keyed = {own_id: F.coalesce("doc_id", F.lit(_NO_ID)), own_key: F.col("key")}
    times = documents.join(taken.groupBy("row").agg(F.collect_list("words").alias(words)), "row")
    times = times.select("row", words, *[c.alias(n) for n, c in keyed.items()])
    # rows alike in doc_id and text are told apart by number
    numbers = documents.select("row", *[c.alias(n) for n, c in keyed.items()])
    numbers = numbers.select("row", F.row_number().over(same.orderBy("row")).alias(nth))
    times = times.join(numbers, "row").drop("row")
    keyed_docs = docs.withColumns(
        {
            own_id: F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(_NO_ID)),
            own_key: F.xxhash64(F.col(f"`{text}`")),
        }
    ).withColumn(nth, F.row_number().over(same.orderBy(own_id)))
    joined = keyed_docs.join(times, [own_id, own_key, nth]).drop(own_id, own_key, nth)
    typed = ", ".join(f"`{c}` {'string' if c == text else t}" for c, t in docs.dtypes)

    def step(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        found = Words(texts)
        which, cut = [], []
        for d, parts in enumerate(rows.column(words).to_pylist()):
            for n in parts:
                which.append(d)
                whole = n >= found.counts[d]
                stop = None if whole else int(found.end[found.first[d] + n - 1] - found.bounds[d])
                cut.append(texts[d][:stop].decode())
        out = rows.select([c for c in rows.schema.names if c != words]).take(pa.array(which, pa.int64()))
        columns = {n: out.column(n) for n in out.schema.names} | {text: pa.array(cut, pa.string())}
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return each_slice(joined, step, typed, text)
