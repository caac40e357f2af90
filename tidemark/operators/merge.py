"""Finding changed rows and merging them into a keyed table.

Parquet has no MERGE. A merge is a join of the target with the new rows that
gives the next state of the table, and never collapses more than one row into
a key: the new rows are reduced to one per key first, in a declared order.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import as_ntz, changed
from tidemark.operators.aggregates import max_key, one_per_key
from tidemark.operators.sizes import dealt
from tidemark.operators.totals import SIGN

INSERTED, UPDATED, UNCHANGED, KEPT = "I", "U", "=", "K"
# Fixed value: stands for "never" where a change time is missing.
NEVER = "2000-01-01"


def _moment(c: Column, granularity: str) -> Column:
    return F.to_date(c) if granularity == "day" else c


def pending_table(
    source: DataFrame,
    target: DataFrame,
    key: str,
    target_key: str,
    updated: str = "updateat",
    loaded: str = "create_at",
    granularity: str = "timestamp",
) -> DataFrame:
    """Rows above the highest loaded key, or changed after the last load.

    Both marks are scalar subqueries over one scan of the target.
    """
    newest = max_key(target, target_key).scalar()
    last_load = target.agg(F.coalesce(F.max(loaded), as_ntz(NEVER)).alias("m")).scalar()
    moved = _moment(F.col(updated), granularity) > last_load
    return source.where((F.col(key) > newest) | moved)


def pending_row(
    source: DataFrame,
    target: DataFrame,
    key: str,
    target_key: str,
    updated: str = "updateat",
    target_updated: str = "update_at",
    granularity: str = "day",
) -> DataFrame:
    """Rows the target lacks, or that changed after their own row in it.

    By day a second change on the loaded day is not seen; ``"timestamp"``
    sees it.
    """
    known = target.select(
        F.col(target_key).alias(key),
        F.coalesce(F.col(target_updated).cast("timestamp_ntz"), as_ntz(NEVER)).alias("_seen"),
    )
    moved = F.coalesce(F.col(updated).cast("timestamp_ntz"), as_ntz(NEVER))
    newer = _moment(moved, granularity) > _moment(F.col("_seen"), granularity)
    joined = source.join(known, key, "left")
    return joined.where(F.col("_seen").isNull() | newer).select(source.columns)


def _sides(
    target: DataFrame, source: DataFrame, keys: Sequence[str], small_source: bool, filtered: bool = False
) -> DataFrame:
    """Target and source side by side on their keys, columns prefixed t_ and s_."""

    def side(df: DataFrame, prefix: str) -> DataFrame:
        rest = [F.col(c).alias(prefix + c) for c in df.columns if c not in keys]
        return df.select(*keys, *rest, F.lit(True).alias(prefix))

    t, s = side(target, "t_"), side(source, "s_")
    if filtered and not small_source:
        new = s.join(t.select(*keys), list(keys), "left_anti")
        return t.join(s, list(keys), "left").unionByName(new, allowMissingColumns=True)
    if not small_source:
        return t.join(s, list(keys), "full_outer")
    # A few new rows against a large table: the table is scanned twice (whole,
    # and only its keys) but never shuffled.
    known = t.select(*keys).join(F.broadcast(s.select(*keys)), list(keys), "left_semi")
    new = s.join(known, list(keys), "left_anti")
    return t.join(F.broadcast(s), list(keys), "left").unionByName(new, allowMissingColumns=True)


def _action(keys: Sequence[str], compare: Sequence[str]) -> Column:
    differs = changed(lambda c: F.col("t_" + c), lambda c: F.col("s_" + c), compare)
    return (
        F.when(F.col("t_").isNull(), INSERTED)
        .when(F.col("s_").isNull(), KEPT)
        .when(differs, UPDATED)
        .otherwise(UNCHANGED)
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    order: Sequence[Column] | None = None,
    keep: Sequence[str] = (),
    stamp: str | None = None,
    stamp_cols: Sequence[str] = (),
    at: datetime | str | None = None,
    small_source: bool = False,
    filtered: bool = False,
) -> DataFrame:
    """The table after the new rows went in, with the columns of ``target``.

    A known key takes the values of the new row; columns the new row lacks, and
    the ``keep`` columns (first load time), stay. ``stamp`` is moved to ``at``
    only where one of ``stamp_cols`` really differs; an insert leaves it null.
    ``order`` reduces a source that may repeat a key; leave it out for a source
    already unique. ``small_source`` broadcasts the source: set it only after
    its size has been checked, as ``tidemark.plans.sync`` does. ``filtered`` is for a result
    of which a filter on its keys leaves little: a left and an anti join let the filter through
    to both sides, which a full outer join does not.
    """
    if stamp is not None and at is None:
        raise ValueError(f"{stamp} needs the time to set")
    if order is not None:
        source = one_per_key(source, keys, order)
    joined = _sides(target, source, keys, small_source, filtered)
    action = _action(keys, stamp_cols)
    has = set(source.columns)

    def value(c: str) -> Column:
        if c in keys:
            return F.col(c)
        old = F.col("t_" + c)
        if c == stamp:
            return F.when(action == UPDATED, as_ntz(at)).otherwise(old).alias(c)
        if c not in has:
            return old.alias(c)
        new = F.col("s_" + c)
        if c in keep:
            return F.when(F.col("t_").isNull(), new).otherwise(old).alias(c)
        return F.when(F.col("s_").isNull(), old).otherwise(new).alias(c)

    return joined.select(*[value(c) for c in target.columns])


def captured(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    *,
    order: Sequence[Column] | None = None,
    sign: str = SIGN,
) -> DataFrame:
    """What an upsert of the new rows changes, as signed rows of ``keys`` and ``cols``.

    An inserted row has sign 1. Where one of ``cols`` differs, the old row has sign -1 and
    the new one 1; a column that the new rows lack keeps its value. Rows that stay as they
    are, and rows of the table that no new row names, give nothing.
    """
    if order is not None:
        source = one_per_key(source, keys, order)
    has = set(source.columns)
    new = source.select(*keys, *[F.col(c).alias("s_" + c) for c in cols if c in has])
    old = target.select(*keys, *[F.col(c).alias("t_" + c) for c in cols], F.lit(True).alias("t_"))
    kinds = {f.name: f.dataType for f in target.schema}
    now = {c: (F.col("s_" + c).cast(kinds[c]) if c in has else F.col("t_" + c)) for c in cols}
    was = F.col("t_").isNotNull()
    differs = changed(lambda c: F.col("t_" + c), lambda c: now[c], [c for c in cols if c in has])
    both = F.array(
        F.when(was, F.struct(F.lit(-1).alias(sign), *[F.col("t_" + c).alias(c) for c in cols])),
        F.struct(F.lit(1).alias(sign), *[now[c].alias(c) for c in cols]),
    )
    new, old = dealt([new, old], keys)
    rows = new.join(old, list(keys), "left").where(~was | differs)
    return rows.select(*keys, F.explode(both).alias("_row")).where("_row is not null").select(*keys, "_row.*")


def removed(
    target: DataFrame, bad: DataFrame | Column, keys: Sequence[str], cols: Sequence[str], sign: str = SIGN
) -> DataFrame:
    """What a delete of the keys in ``bad`` changes: the rows that go, with sign -1.

    ``bad`` are rows with these keys, or a condition on the keys alone, which needs no join.
    """
    rows = target.select(*keys, *cols)
    if isinstance(bad, Column):
        known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
        gone = rows.where(known & bad)
    else:
        rows, names = dealt([rows, bad.select(*keys)], keys)
        gone = rows.join(names.distinct(), list(keys), "left_semi")
    return gone.withColumn(sign, F.lit(-1))


def merge_counts(
    target: DataFrame, source: DataFrame, keys: Sequence[str], compare: Sequence[str]
) -> DataFrame:
    """One row: how many of the new rows insert, update, or change nothing.

    Reads only the keys and the compared columns.
    """
    cols = [*keys, *compare]
    new = source.select(*keys, *[F.col(c).alias("s_" + c) for c in compare], F.lit(True).alias("s_"))
    old = target.select(*cols).select(
        *keys, *[F.col(c).alias("t_" + c) for c in compare], F.lit(True).alias("t_")
    )
    acted = new.join(old, list(keys), "left").select(_action(keys, compare).alias("a"))
    return acted.agg(
        F.count_if(F.col("a") == INSERTED).alias("inserted"),
        F.count_if(F.col("a") == UPDATED).alias("updated"),
        F.count_if(F.col("a") == UNCHANGED).alias("unchanged"),
    )
