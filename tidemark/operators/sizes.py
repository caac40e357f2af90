"""Broadcast behind a size, and tasks whose number follows the size.

A few changed keys against a large table should be sent to the table, not the
table shuffled to meet them. Spark cannot know how many keys a window or a join
will leave, so jobs that write freeze such keys, count them, and broadcast them
only up to Spark's own broadcast threshold; above it the join is left to shuffle. Both
ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir

# A task of a join or fold by key is to hold the rows of so many bytes of files.
PART_BYTES = 8 << 20
# Leaves of a plan that read tables. Frozen rows carry the estimate of the plan that made them,
# a product of table sizes after a few joins, and count nothing.
_READS = ("LogicalRelation", "HiveTableRelation", "DataSourceV2Relation", "DataSourceV2ScanRelation")


def frozen(rows: DataFrame) -> DataFrame:
    """The rows as they are now, in reliable storage: every later step sees the same."""
    shared_dir(rows.sparkSession)
    return rows.checkpoint()


def threshold(spark: SparkSession) -> int:
    """Bytes that Spark would broadcast by itself; -1 if it never does."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def row_bytes(rows: DataFrame) -> int:
    """Spark's estimate of a row's width, from the types of its columns."""
    schema = rows._jdf.schema()
    return 8 + sum(schema.apply(i).dataType().defaultSize() for i in range(len(rows.columns)))


def byte_size(frozen_rows: DataFrame) -> int:
    """The bytes of the rows, counted now: texts by their lengths, all else by its type."""
    long = [c for c, kind in frozen_rows.dtypes if kind in ("string", "binary")]
    lengths = [F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`"))), F.lit(0)) for c in long]
    n, *sizes = frozen_rows.agg(F.count("*"), *lengths).first()
    return n * row_bytes(frozen_rows) + sum(sizes)


def is_small(frozen_rows: DataFrame, limit: int | None = None) -> bool:
    """Whether the rows stay within ``limit`` bytes (Spark's threshold)."""
    limit = threshold(frozen_rows.sparkSession) if limit is None else limit
    return byte_size(frozen_rows) <= limit


def hinted(rows: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(rows) if small else rows


def measured(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """Frozen rows that joins may broadcast if they are small."""
    rows = frozen(rows)
    return hinted(rows, is_small(rows, limit))


def file_bytes(rows: DataFrame) -> int:
    """The sizes of the tables that the rows are read from, as Spark knows them; others count nothing."""
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    read = [leaf for leaf in map(leaves.apply, range(leaves.size())) if leaf.getClass().getSimpleName() in _READS]
    sizes = [int(str(leaf.stats().sizeInBytes())) for leaf in read]
    return sum(n for n in sizes if n < 1 << 50)


def dealt(frames: Sequence[DataFrame], keys: Sequence[str], part: int | None = None) -> list[DataFrame]:
    """Tables dealt out by key to as many tasks as their files are large, all to the same number.

    Spark merges small partitions up to a size on disk, and sorted rows of that size are many
    times larger in memory. Tables that are no more parts than there are cores stay as they are.
    """
    n = -(-sum(file_bytes(f) for f in frames) // (part or PART_BYTES))
    if n <= frames[0].sparkSession.sparkContext.defaultParallelism:
        return list(frames)
    return [f.repartition(n, *keys) for f in frames]
