"""As-of join: for each row the last value that was set on or before its date.

Rows and settings meet in one sorted window per key and period, and the last setting is carried
forward. What held when a period began is worked out first, from settings and the periods
there are alone, so a window never reaches over a period: a key that most rows share is
spread over as many tasks as it has periods. No row meets more than one setting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _openings(settings: DataFrame, periods: DataFrame) -> DataFrame:
    """What held before each period of each key: a table of periods, not of rows."""
    marks = settings.select("_key", "_at", "_value", F.lit(None).cast("date").alias("_period"))
    starts = periods.select("_key", F.col("_period").alias("_at"), F.lit(None).alias("_value"), "_period")
    # a setting on the first day of a period belongs to the period itself
    order = Window.partitionBy("_key").orderBy("_at", F.col("_period").isNull())
    carried = F.last("_value", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    found = marks.unionByName(starts).withColumn("_value", carried)
    return found.where("_period is not null and _value is not null").select("_key", "_at", "_value", "_period")


def last_before(
    rows: DataFrame,
    settings: DataFrame,
    key: str,
    on: str,
    since: str,
    value: str,
    period: str = "month",
    name: str | None = None,
) -> DataFrame:
    """The rows with the value that held on their date, null before the first one.

    ``settings`` has ``key``, ``since`` (the first day a value holds) and ``value``; of several on
    one day the highest counts. A row without key or date gets null. Null settings are not any.
    """
    name = name or value
    day = F.to_date(on)
    start = F.trunc(F.col("_at"), period)
    listed = (
        settings.where(F.col(value).isNotNull())
        .groupBy(F.col(key).alias("_key"), F.to_date(since).alias("_at"))
        .agg(F.max(value).alias("_value"))
    )
    dated = F.col(key).isNotNull() & day.isNotNull()
    mine = rows.where(dated).select(F.col(key).alias("_key"), day.alias("_at"), F.struct(*rows.columns).alias("_row"))
    mine = mine.withColumn("_period", start)
    periods = mine.select("_key", "_period").distinct()
    own = listed.withColumn("_period", start).join(periods, ["_key", "_period"], "left_semi")
    set_ = own.select("_key", "_at", "_value", "_period", F.lit(1).alias("_rank"))
    set_ = set_.unionByName(_openings(listed, periods).withColumn("_rank", F.lit(0)))
    both = mine.withColumn("_rank", F.lit(2)).unionByName(set_, allowMissingColumns=True)
    order = Window.partitionBy("_key", "_period").orderBy("_at", "_rank")
    carried = F.last("_value", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("_value", carried).where("_row is not null").select("_row.*", F.col("_value").alias(name))
    none = F.lit(None).cast(settings.schema[value].dataType).alias(name)
    return found.unionByName(rows.where(~dated).select("*", none))
