"""The keyed upsert as a stream: new source files in, months rewritten."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.plans.sync import sync_by_month


def file_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000
) -> DataFrame:
    """New parquet files below ``path``, a bounded number per batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def upsert_stream(
    rows: DataFrame,
    root: str,
    keys: Sequence[str],
    by: str,
    order: Sequence[Column],
    checkpoint: str,
    at: Callable[[], datetime],
    keep: Sequence[str] = (),
    stamp: str | None = None,
    stamp_cols: Sequence[str] = (),
) -> StreamingQuery:
    """Bring the table up to date with all files there are, then stop.

    A batch that runs again after a failure upserts the same rows, which
    changes nothing. ``at`` gives the load time of a batch; ``order`` says which
    of several rows with one key in a batch is the last.
    """

    def write(batch: DataFrame, _: int) -> None:
        sync_by_month(
            root, batch, keys, by, order=order, keep=keep, stamp=stamp, stamp_cols=stamp_cols, at=at()
        )

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
