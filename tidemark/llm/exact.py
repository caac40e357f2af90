"""Exact dedup with the frequent digests split off.

Texts are equal when they are the same after lower-casing A-Z; null counts as
empty. SHA-256 of that text is the digest. Of equal texts the row with the largest
doc_id stays; a null doc_id counts as the smallest, and of rows alike in doc_id too
any one stays.

Misra-Gries counters per task find the digests that may hold more than one in
``COUNTERS`` of all rows. Their exact size and winner are counted in a second pass
that folds before it shuffles; at most 2 * ``COUNTERS`` such rows are broadcast, and the
copies that lose against a broadcast winner never reach a shuffle. All other
digests are rare by proof, so an ordinary shuffle has no hot key left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import each_slice, free_names, freeze, plain, with_columns

COUNTERS = 1000


def digest(text: bytes) -> bytes:
    """SHA-256 of the text after lower-casing A-Z (``bytes.lower`` knows ASCII only)."""
    return hashlib.sha256(text.lower()).digest()


class MisraGries:
    """At most ``k`` counters; a value's counter is low by at most ``lost``."""

    def __init__(self, k: int):
        self.k, self.counts, self.lost = k, {}, 0

    def add(self, values: list) -> None:
        # a value may have ``k`` counters more than allowed until the next fold
        counts = self.counts
        for v in values:
            counts[v] = counts.get(v, 0) + 1
            if len(counts) > 2 * self.k:
                self.fold()

    def fold(self) -> None:
        """Subtract the largest count that is no longer kept from all; at most ``k`` stay."""
        if len(self.counts) > self.k:
            cut = sorted(self.counts.values(), reverse=True)[self.k]
            self.counts = {v: c - cut for v, c in self.counts.items() if c > cut}
            self.lost += cut


def _counters(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, rows = MisraGries(k), 0
        for batch in batches:
            sketch.add(batch.column(0).to_pylist())
            rows += batch.num_rows
        sketch.fold()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None, *sketch.counts], pa.binary()),
                pa.array([rows, *sketch.counts.values()], pa.int64()),
            ],
            names=["digest", "n"],
        )

    return run


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Digests that may hold over one in ``counters`` of the rows; none that does is missing.

    A task keeps 2 * counters of them, so all tasks together count a digest low by at
    most rows / (2 * counters + 1). A digest with over rows / counters rows keeps more
    than that, and at most 2 * counters digests can.
    """
    sums = freeze(
        digests.select("digest")
        .mapInArrow(_counters(2 * counters), "digest binary, n bigint")
        .groupBy("digest")
        .agg(F.sum("n").alias("n"))
    )
    total = sums.where("digest is null").agg(F.max("n")).first()[0] or 0
    return sums.where(F.col("digest").isNotNull() & (F.col("n") > total // (2 * counters + 1)))


def winners(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Exact size and winner of each frequent digest; a few rows by the bound above."""
    hot = F.broadcast(frequent(digests, counters).select("digest"))
    return freeze(
        digests.join(hot, "digest")
        .groupBy("digest")
        .agg(F.max("doc_id").alias("hot_id"), F.count("*").alias("hot_size"))
    )


def _digests(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    def step(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        found = pa.array([digest(t) for t in texts], pa.binary())
        return with_columns(rows, drop=("text",), digest=found)

    return each_slice(plain(docs, doc_id=doc_id, text=text), step, "doc_id bigint, digest binary")


def decisions(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", counters: int = COUNTERS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Extra columns are ignored; an empty table gives no rows. Of repeated rows one is
    kept, also where the doc_id is null.
    """
    digests = freeze(_digests(docs, doc_id, text)).withColumn("row", F.monotonically_increasing_id())
    hot = winners(digests, counters)
    marked = digests.join(F.broadcast(hot), "digest", "left")
    group = Window.partitionBy("digest")
    best = group.orderBy(F.desc_nulls_last("doc_id"), "row")
    rare = marked.where("hot_size is null").select(
        "doc_id",
        F.max("doc_id").over(group).alias("keep_id"),
        F.count("*").over(group).alias("group_size"),
        (F.row_number().over(best) == 1).alias("kept"),
        "digest",
    )
    # of a frequent digest only rows with the winning doc_id are left to choose from
    one = marked.where("hot_size is not null and doc_id <=> hot_id").groupBy("digest").agg(
        F.min("row").alias("hot_row")
    )
    common = (
        marked.where("hot_size is not null")
        .join(F.broadcast(one), "digest")
        .select(
            "doc_id",
            F.col("hot_id").alias("keep_id"),
            F.col("hot_size").alias("group_size"),
            (F.col("row") == F.col("hot_row")).alias("kept"),
            "digest",
        )
    )
    return rare.unionByName(common).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def deduplicate(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", counters: int = COUNTERS
) -> DataFrame:
    """The rows that stay, with all their columns.

    Losing copies of frequent texts are dropped where they are read. What is left is
    dealt out by digest; a task keeps one row per digest before it sends any.
    """
    digests = freeze(_digests(docs, doc_id, text))
    hot = winners(digests, counters)
    key, of, hot_key, hot_id = free_names(docs, "digest", "of", "hot_key", "hot_id")
    typed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def step(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        return with_columns(rows, **{key: pa.array([digest(t) for t in texts], pa.binary())})

    keyed = each_slice(docs, step, f"{typed}, `{key}` binary", text)
    hot = hot.select(F.col("digest").alias(hot_key), F.col("hot_id").alias(hot_id), F.lit(True).alias(of))
    left = keyed.join(F.broadcast(hot), F.col(key) == F.col(hot_key), "left").where(
        F.col(of).isNull() | F.col(f"`{doc_id}`").eqNullSafe(F.col(hot_id))
    )
    best = Window.partitionBy(key).orderBy(F.desc_nulls_last(f"`{doc_id}`"))
    rank = free_names(left, "rank")[0]
    return (
        left.withColumn(rank, F.row_number().over(best))
        .where(F.col(rank) == 1)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
