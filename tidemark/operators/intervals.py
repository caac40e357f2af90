"""Sets of keys kept as runs of consecutive keys.

A table of loaded keys has columns lo, hi and n: the keys from lo to hi are all there, in n
rows. Runs never cross a multiple of ``width``, so a run belongs to one bin, a key can be
looked up among the runs of its bin by an equality join with a range condition, and a dense
million keys are about a thousand rows. Runs of several loads may overlap; ``merged`` makes
them one set again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 1024


def _bin(key: Column | str, width: int) -> Column:
    """The first key of the bin, in whole numbers, so that it is exact for any key."""
    key = F.col(key) if isinstance(key, str) else key
    return (key - F.pmod(key, F.lit(width))).cast("bigint")


def runs(rows: DataFrame, key: str, width: int = WIDTH) -> DataFrame:
    """The runs of the rows' keys; a null key is in none. Rows of a key fold before they move."""
    keys = rows.where(F.col(key).isNotNull()).groupBy(_bin(key, width).alias("_bin"), F.col(key).alias("_k"))
    counted = keys.agg(F.count("*").alias("_n"))
    place = F.row_number().over(Window.partitionBy("_bin").orderBy("_k"))
    found = counted.withColumn("_run", F.col("_k") - place).groupBy("_bin", "_run")
    return found.agg(F.min("_k").alias("lo"), F.max("_k").alias("hi"), F.sum("_n").alias("n")).select("lo", "hi", "n")


def merged(sets: DataFrame, width: int = WIDTH) -> DataFrame:
    """One set of runs from several, each run as long as its bin allows."""
    order = Window.partitionBy("_bin").orderBy("lo", "hi")
    before = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    found = sets.select(_bin("lo", width).alias("_bin"), "lo", "hi", "n").withColumn("_before", before)
    starts = F.coalesce(F.col("lo") > F.col("_before") + 1, F.lit(True)).cast("int")
    found = found.withColumn("_starts", starts).withColumn("_run", F.sum("_starts").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = found.groupBy("_bin", "_run")
    return joined.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n")).select("lo", "hi", "n")


def highest(sets: DataFrame) -> DataFrame:
    """One row: the highest key of the runs, 0 without any."""
    return sets.agg(F.coalesce(F.max("hi"), F.lit(0)).alias("max_id"))


def outside(rows: DataFrame, sets: DataFrame, key: str, width: int = WIDTH) -> DataFrame:
    """Rows whose key is in no run."""
    held = sets.select(_bin("lo", width).alias("_bin"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
    place = _bin(key, width)
    inside = (place == F.col("_bin")) & F.col(key).between(F.col("_lo"), F.col("_hi"))
    return rows.join(held, inside, "left_anti")


def holes(sets: DataFrame, width: int = WIDTH) -> DataFrame:
    """The gaps between the runs of a bin and at its ends, for bins that have a run: lo and hi."""
    whole = merged(sets, width).withColumn("_bin", _bin("lo", width))
    order = Window.partitionBy("_bin").orderBy("lo")
    whole = whole.withColumn("_from", F.coalesce(F.lag("hi").over(order) + 1, F.col("_bin")))
    whole = whole.withColumn("_last", F.lead("lo").over(order).isNull())
    before = F.struct(F.col("_from").alias("lo"), (F.col("lo") - 1).alias("hi"))
    end = F.when(F.col("_last"), F.col("_bin") + width - 1)
    after = F.struct((F.col("hi") + 1).alias("lo"), end.alias("hi"))
    gaps = whole.select(F.explode(F.array(before, after)).alias("g"))
    return gaps.select("g.lo", "g.hi").where("lo <= hi")
