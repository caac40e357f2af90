"""Loads by key: append above a watermark, full refresh, repair of gaps.

These return the rows to write; ``tidemark.sources`` writes them. Columns are
matched by name. The watermark is a scalar subquery, so it is found when the
query runs and its value still reaches the scan as a pushed filter. A JDBC
source cannot take a subquery over another system: pass it the number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import intervals
from tidemark.operators.aggregates import max_key
from tidemark.operators.joins import missing_in
from tidemark.operators.shape import above, stamp_insert, stamp_refresh


def watermark(target: DataFrame, key: str) -> Column:
    return max_key(target, key).scalar()


def watermark_value(target: DataFrame, key: str) -> int:
    return max_key(target, key).first()[0]


def append_incremental(
    source: DataFrame,
    target: DataFrame,
    key: str,
    at: datetime | str,
    mark: int | Column | None = None,
) -> DataFrame:
    """Source rows above the highest key of the target, stamped."""
    mark = watermark(target, key) if mark is None else mark
    return stamp_insert(above(source, key, mark), at)


def append_products(
    source: DataFrame,
    target: DataFrame,
    key: str,
    at: datetime | str,
    products: Sequence[str],
    column: str = "product",
) -> DataFrame:
    """The same for several products in one pass, each with its own watermark.

    The watermark table has at most one row per listed product, which bounds
    what is broadcast; a product the target does not hold yet starts from 0.
    """
    listed = F.col(column).isin(*products)
    marks = target.where(listed).groupBy(column).agg(F.max(key).alias("_mark"))
    rows = source.where(listed).join(F.broadcast(marks), column, "left")
    new = rows.where(F.col(key) > F.coalesce("_mark", F.lit(0))).select(source.columns)
    return stamp_insert(new, at)


def refresh_full(source: DataFrame, at: datetime | str) -> DataFrame:
    """The whole source, stamped, to take the place of the target."""
    return stamp_refresh(source, at)


def refresh_products(
    sources: Mapping[str, DataFrame], at: datetime | str, column: str = "product"
) -> DataFrame:
    """One refresh over several source tables, told apart by a product column."""
    named = [df.withColumn(column, F.lit(name)) for name, df in sources.items()]
    return refresh_full(reduce(DataFrame.unionByName, named), at)


def missing_rows(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows at or below the watermark that the target lacks.

    A watermark append never sees them again: rows that arrived late, or that
    an interrupted load left out.
    """
    below = source.where(F.col(key) <= watermark(target, key))
    return missing_in(below, target, key)


def missing_keys(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    return missing_rows(source.select(key), target, key)


def repair_missing(
    source: DataFrame, target: DataFrame, key: str, at: datetime | str
) -> DataFrame:
    """The missing rows, stamped with the run time like any other insert."""
    return stamp_insert(missing_rows(source, target, key), at)


def missing_rows_by_runs(source: DataFrame, held: DataFrame, key: str, width: int = intervals.WIDTH) -> DataFrame:
    """The same from the runs of loaded keys (``intervals.runs``): the target itself is not read."""
    below = source.where(F.col(key) <= intervals.highest(held).scalar())
    return intervals.outside(below, held, key, width)


def missing_keys_by_runs(source: DataFrame, held: DataFrame, key: str, width: int = intervals.WIDTH) -> DataFrame:
    return missing_rows_by_runs(source.select(key), held, key, width)


def repair_missing_by_runs(
    source: DataFrame, held: DataFrame, key: str, at: datetime | str, width: int = intervals.WIDTH
) -> DataFrame:
    return stamp_insert(missing_rows_by_runs(source, held, key, width), at)
