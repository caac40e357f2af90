"""Joins.

None of these carries a broadcast hint; jobs that count first are in ``sizes``. Spark
broadcasts a side only after comparing its size (file statistics when planning,
shuffle sizes at run time) with ``spark.sql.autoBroadcastJoinThreshold``, and
shuffles both sides otherwise. A hot key on the row side of a shuffled join is
split by AQE, by the size it turns out to have. AQE needs both inputs to come
straight from a shuffle, which an aggregated side does not; ``split_join`` sees
to that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def enrich(df: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Add the columns of a lookup table; a left join keeps unmatched rows."""
    return df.join(dim, on if isinstance(on, str) else list(on), how)


def chain(first: DataFrame, *steps: tuple[DataFrame, Column | str, str]) -> DataFrame:
    """Join one table after another: each step is (table, condition, how)."""
    for table, on, how in steps:
        first = first.join(table, on, how)
    return first


def _keys_of(other: DataFrame, other_key: str, key: str) -> DataFrame:
    # Distinct first: a key held by a third of the other table is folded before
    # its shuffle, and the join then uses the partitioning that fold left.
    return other.select(F.col(other_key).alias(key)).distinct()


def exists_in(
    df: DataFrame, other: DataFrame, key: str, other_key: str | None = None, hot: bool = False
) -> DataFrame:
    """Rows whose key the other table holds. ``hot``: one key may hold many rows of ``df``."""
    keys = _keys_of(other, other_key or key, key)
    return split_join(df, keys, key, "left_semi") if hot else df.join(keys, key, "left_semi")


def missing_in(
    df: DataFrame, other: DataFrame, key: str, other_key: str | None = None, hot: bool = False
) -> DataFrame:
    """Rows whose key the other table lacks."""
    keys = _keys_of(other, other_key or key, key)
    return split_join(df, keys, key, "left_anti") if hot else df.join(keys, key, "left_anti")


def listed_or(condition: Column, key: str, listed: DataFrame) -> Column:
    """A condition that also holds for keys in ``listed`` (its first column).

    Checked in one read of the rows: the list becomes an existence join under
    the OR, which takes over a broadcast hint on the list. ``listed`` should
    name each key once; fold it with ``distinct`` first if it may not.
    """
    return condition | F.col(key).isin(listed)


def split_join(df: DataFrame, lookup: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join to a lookup aggregated by ``key``, where few keys may hold most rows of ``df``.

    The aggregate leaves the lookup partitioned by ``key``, so a join on that
    key alone would use it as it is, and AQE could not split the rows. A second
    key, derived from the first, changes no match but makes both sides shuffle
    for this join. That moves the lookup once more, and rows of a hot key are
    then spread over as many tasks as their size asks for.
    """
    part = F.pmod(F.xxhash64(key), F.lit(1024))
    left, right = df.withColumn("_part", part), lookup.withColumn("_part", part)
    return left.join(right, [key, "_part"], how).drop("_part")
