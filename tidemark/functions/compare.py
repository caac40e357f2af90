"""Null-safe comparison."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_default(c: Column | str, default: object) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(default))


def changed(
    left: Callable[[str], Column], right: Callable[[str], Column], cols: Iterable[str]
) -> Column:
    """True if any of ``cols`` differs between two sides of a joined frame.

    A null equals a null and differs from every value, so no stand-in value
    for null is needed. ``left`` and ``right`` turn a column name into the
    column of that side.
    """
    return reduce(or_, [~left(c).eqNullSafe(right(c)) for c in cols], F.lit(False))
