"""First and last value of each key, kept between loads.

An added row can only widen the range of its key. A row that goes may have been the first
or the last one, which a minimum cannot take back: only for such keys the table is
read again. All other keys follow from the kept table and the signed changes
of the load (``merge.captured``, ``merge.removed``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sizes import frozen, measured
from tidemark.operators.totals import SIGN


def extremes(rows: DataFrame, by: str, value: str) -> DataFrame:
    """Per key: rows, first and last value. Rows without a value count, but are neither."""
    return rows.groupBy(by).agg(
        F.count("*").alias("filas"), F.min(value).alias("primero"), F.max(value).alias("ultimo")
    )


def _folded(kept: DataFrame, signed: DataFrame, by: str, value: str) -> DataFrame:
    """Keys that change: rows more or less, values that come, whether an extreme goes."""
    net = signed.groupBy(by, value).agg(F.sum(SIGN).alias("_net"))
    ends = kept.select(by, F.col("primero").alias("_first"), F.col("ultimo").alias("_last"))
    net = net.join(ends, by, "left")
    goes = (F.col("_net") < 0) & ((F.col(value) <= F.col("_first")) | (F.col(value) >= F.col("_last")))
    comes = F.when(F.col("_net") > 0, F.col(value))
    return net.groupBy(by).agg(
        F.sum("_net").alias("_more"),
        F.min(comes).alias("_min"),
        F.max(comes).alias("_max"),
        F.coalesce(F.max(goes), F.lit(False)).alias("_again"),
    )


def after_changes(kept: DataFrame, signed: DataFrame, now: DataFrame, by: str, value: str) -> DataFrame:
    """The extremes after a load. ``now`` is the table after it, read only for keys that lost an extreme."""
    changes = frozen(_folded(kept, signed, by, value))
    again = measured(changes.where("_again").select(by))
    recounted = extremes(now.join(again, by, "left_semi"), by, value)
    moved = kept.join(changes.where("not _again"), by, "full_outer").join(again, by, "left_anti")
    grown = moved.select(
        by,
        (F.coalesce("filas", F.lit(0)) + F.coalesce("_more", F.lit(0))).alias("filas"),
        F.least("primero", "_min").alias("primero"),
        F.greatest("ultimo", "_max").alias("ultimo"),
    )
    return grown.where("filas > 0").unionByName(recounted)
