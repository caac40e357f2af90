"""Projections and filters.

Filters compare the bare column with a literal or a scalar subquery, so they
reach the scan; none wraps the column in a function where a range will do.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import as_ntz, month_bounds, month_start, null_default, year_start

# Statuses of a collection that count as collected.
COLLECTED_STATUSES = (1, 2, 3, 6, 7, 9, 10, 12)
PAID_FROM_STATUS = 3


def stamp(
    df: DataFrame, at: datetime | str, created: str = "createdat", empty: Sequence[str] = ()
) -> DataFrame:
    """Add the run time as ``created`` and the ``empty`` timestamps as nulls."""
    nothing = F.lit(None).cast("timestamp_ntz")
    return df.withColumns({created: as_ntz(at), **{c: nothing for c in empty}})


def stamp_insert(df: DataFrame, at: datetime | str) -> DataFrame:
    return stamp(df, at, "createdat", ("updatedat", "deletedat"))


def stamp_refresh(df: DataFrame, at: datetime | str) -> DataFrame:
    return stamp(df, at, "atinsert", ("atupdate",))


def above(df: DataFrame, key: str, watermark: int | Column) -> DataFrame:
    return df.where(F.col(key) > watermark)


def by_ids(df: DataFrame, key: str, ids: Sequence[int] | DataFrame) -> DataFrame:
    """Rows whose key is listed, in key order.

    A short list becomes an IN filter in the scan; a DataFrame of ids (first
    column) is a semi join, for lists too long to write into a plan.
    """
    if isinstance(ids, DataFrame):
        wanted = ids.select(F.col(ids.columns[0]).alias(key)).distinct()
        return df.join(wanted, key, "left_semi").orderBy(key)
    return df.where(F.col(key).isin(*ids)).orderBy(key)


def requested(df: DataFrame, on: str = "fcorreo", status: str = "status_r") -> DataFrame:
    """A request counts once it has a date and a status other than 0 or null."""
    return df.where(F.col(on).isNotNull() & (null_default(status, 0) != 0))


def authorized(df: DataFrame, on: str = "f_authorized") -> DataFrame:
    return df.where(F.col(on).isNotNull())


def paid_date(first: str = "f_excel", second: str = "f_pago") -> Column:
    return F.coalesce(F.col(first), F.col(second))


def paid(df: DataFrame, status: str = "status_p") -> DataFrame:
    return df.where((F.col(status) >= PAID_FROM_STATUS) & paid_date().isNotNull())


def before(df: DataFrame, on: Column | str, asof: date) -> DataFrame:
    return df.where((F.col(on) if isinstance(on, str) else on) < F.lit(asof))


def collected(df: DataFrame, on: str = "fcobrado", status: str = "statusc") -> DataFrame:
    return df.where(F.col(on).isNotNull() & F.col(status).isin(*COLLECTED_STATUSES))


# As the last month of a range: no end. ``None`` as the first month: no beginning.
OPEN = "open"


def month_range(on: str, ym_from: int | None, ym_to: int | str | None = None) -> Column:
    """``on`` falls in the months, as a half-open range of dates.

    Without ``ym_to`` the range is the one month ``ym_from``. A missing date is in no range.
    """
    if ym_from is None and ym_to is None:
        raise ValueError("name a month, or leave the end OPEN")
    inside = F.col(on).isNotNull()
    if ym_from is not None:
        inside = F.col(on) >= F.lit(month_start(ym_from))
    if ym_to != OPEN:
        inside &= F.col(on) < F.lit(month_bounds(ym_from or ym_to, ym_to)[1])
    return inside


def in_month(
    df: DataFrame, on: str, ym_from: int | None, ym_to: int | str | None = None
) -> DataFrame:
    return df.where(month_range(on, ym_from, ym_to))


def before_year(df: DataFrame, on: str, asof: date) -> DataFrame:
    """Rows before the first day of the year of ``asof``."""
    return df.where(F.col(on) < year_start(F.lit(asof)))


def update_column(
    df: DataFrame, column: str, value: Column, where: Column | None = None
) -> DataFrame:
    """Set one column from a rule, on the rows where the condition holds."""
    if where is not None:
        value = F.when(where, value).otherwise(F.col(column))
    return df.withColumn(column, value)
