"""Totals kept by signed changes.

A total is a row count and sums per group. It is additive: a removed row counts with sign -1
and an added one with +1, a changed row is both. So totals after a load are those before it
plus those of the load's changes, whatever months the rows left or entered, and no load
counts the table again. A sum keeps how many of its amounts are known, so a group without
any has no sum, as in a recount; a group without rows is gone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIGN = "_sign"


def _known(name: str) -> str:
    return f"{name}_known"


def signed_totals(rows: DataFrame, by: Sequence[Column], sums: Mapping[str, Column]) -> DataFrame:
    """Totals of rows with a sign; a table's rows without one count as added."""
    if SIGN not in rows.columns:
        rows = rows.withColumn(SIGN, F.lit(1))
    sign = F.col(SIGN)
    parts = [F.sum(sign).cast("bigint").alias("cnt")]
    for name, amount in sums.items():
        parts.append(F.sum((amount * sign).cast("decimal(38,6)")).alias(name))
        parts.append(F.sum(F.when(amount.isNotNull(), sign).otherwise(0)).cast("bigint").alias(_known(name)))
    return rows.groupBy(*by).agg(*parts)


def added_up(totals: DataFrame, by: Sequence[str]) -> DataFrame:
    """Totals and changes of totals as one: a row per group that still has rows."""
    counts = [c for c in totals.columns if c not in by]
    found = totals.groupBy(*by).agg(*[F.sum(c).cast(totals.schema[c].dataType).alias(c) for c in counts])
    return found.where(F.col("cnt") != 0)


def shown(totals: DataFrame, sums: Sequence[str]) -> DataFrame:
    """The totals a recount would print: a sum of no known amount is null."""
    for name in sums:
        totals = totals.withColumn(name, F.when(F.col(_known(name)) != 0, F.col(name))).drop(_known(name))
    return totals
