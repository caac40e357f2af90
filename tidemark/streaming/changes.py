"""The last change of each collection and month, folded as the log grows.

The change log is read as a stream, so a run reads only what was added since the last one. The
stream's state has the last change of each key and month of change. A batch's changed keys
are written as one folder named by its number: a batch that runs again after a failure
writes the same rows to the same place. Reading takes the newest row of each key, so the
result does not depend on how the log was cut into batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import year_month
from tidemark.operators.aggregates import latest
from tidemark.operators.shape import collected
from tidemark.plans.collections import CHANGE_KIND, DETECT_COLS

KEY = "cardcollec_id"


def counted_changes(log: DataFrame) -> DataFrame:
    """Changes that count, of collections of a month before the change's own, with that month."""
    changes = collected(log.where(F.col("reg") == CHANGE_KIND))
    earlier = changes.where(F.col("fcobrado") < F.trunc("fecha", "month"))
    return earlier.withColumn("ym", year_month("fecha"))


def fold_changes(
    log: DataFrame, root: str, checkpoint: str, cols: Sequence[str] = DETECT_COLS
) -> StreamingQuery:
    """Fold all of the log that is there and new, then stop.

    ``log`` is a stream of change rows. Of two changes at one time the one with the higher
    ``id`` is the last. ``position`` is the highest ``id`` folded into a row.
    """
    change = F.struct("fecha", "id", *cols)
    folded = counted_changes(log).groupBy("ym", KEY).agg(F.max_by(change, F.struct("fecha", "id")).alias("last"), F.max("id").alias("position"))

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.select(KEY, "last.*", "position", "ym")
        rows.write.mode("overwrite").partitionBy("ym").parquet(f"{root}/batch={number}")

    writer = folded.writeStream.outputMode("update").foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def folded_changes(spark: SparkSession, root: str, ym: int, cols: Sequence[str] = DETECT_COLS) -> DataFrame:
    """The last change made in month ``ym`` to each collection of an earlier month.

    Only that month's folders are read. Give it to ``collections.unseen_changes``.
    """
    rows = spark.read.option("basePath", root).parquet(root).where(F.col("ym") == ym)
    return latest(rows, [KEY], "fecha", "id").select(KEY, *cols)
