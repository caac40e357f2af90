"""Bringing stored tables up to date.

A large fact is kept by month. A run rewrites only the months its rows leave or
enter, and commits them together; all other months are not read beyond their
keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.aggregates import max_key, one_per_key
from tidemark.operators.cleanup import delete_keys
from tidemark.operators.load import append_incremental, append_products, refresh_full, repair_missing
from tidemark.operators.merge import upsert
from tidemark.operators.sizes import frozen, hinted, is_small
from tidemark.sources import snapshots
from tidemark.sources.snapshots import current, publish


def _months(df: DataFrame, by: str) -> list:
    """Distinct partition values: as many as the calendar has months, not as rows."""
    return [r[0] for r in df.select(by).distinct().collect()]


def sync_by_month(
    root: str,
    rows: DataFrame,
    keys: Sequence[str],
    by: str,
    *,
    order: Sequence[Column] | None = None,
    keep: Sequence[str] = (),
    stamp: str | None = None,
    stamp_cols: Sequence[str] = (),
    at: datetime | str | None = None,
) -> list:
    """Upsert ``rows`` into the table at ``root``; returns the months rewritten.

    A row whose date moved is taken out of its old month, which is rewritten
    even if that leaves it empty. If another run replaced one of these months since
    this one read them, this one ends with ``StaleTable`` and changes nothing.
    """
    seen = snapshots.state(rows.sparkSession, root)
    table = current(rows.sparkSession, root, by, at=seen)
    if order is not None:
        rows = one_per_key(rows, keys, order)
    if table is None:
        # A first load may be the whole history: it is written once, straight.
        if stamp is not None:
            rows = rows.withColumn(stamp, F.lit(None).cast("timestamp_ntz"))
        if seen.parts:  # every month is empty; one may be filled by two runs at a time
            months = sorted(_months(rows, by))
            publish(rows, root, by, months, seen.commit)
            return months
        publish(rows, root, by, base=seen.commit)
        table = current(rows.sparkSession, root, by)
        return [] if table is None else sorted(_months(table, by))
    unknown = [c for c in rows.columns if c not in table.columns]
    if unknown:  # it would be lost without a word
        raise ValueError(f"the table has no column {', '.join(unknown)}; add it first")
    rows = frozen(rows)
    if rows.isEmpty():
        return []
    small = is_small(rows)
    listed = hinted(rows.select(*keys), small)
    hit = table.select(*keys, by).join(listed, list(keys), "left_semi")
    months = sorted(_months(hit.select(by).unionByName(rows.select(by)), by))
    old = table.where(F.col(by).isin(*months))
    new = upsert(
        old, rows, keys, keep=keep, stamp=stamp, stamp_cols=stamp_cols, at=at, small_source=small
    )
    publish(new, root, by, months, seen.commit)
    return months


def clean_by_month(
    spark: SparkSession, root: str, bad: DataFrame, key: str, by: str, soft: bool = False
) -> list:
    """Delete the keys of ``bad`` (key and month columns); rewrites only their months."""
    bad = frozen(bad.select(key, by).distinct())
    months = sorted(_months(bad, by))
    if months:
        seen = snapshots.state(spark, root)
        table = current(spark, root, by, months, at=seen)
        left = delete_keys(table, hinted(bad, is_small(bad)), key, soft)
        publish(left, root, by, months, seen.commit)
    return months


def _free_load(seen: snapshots.State, load: int | None) -> int:
    """The number of a new load: the one given, if no load has it yet, or the next one."""
    taken = {int(name.partition("=")[2]) for name in seen.parts}
    if load in taken:
        raise ValueError(f"load {load} is there already; a load is never replaced or skipped")
    return max(taken, default=0) + 1 if load is None else load


def _watermark(seen: snapshots.State, table: DataFrame | None, key: str) -> int:
    """The highest key, from the commits' marks; from the table where a load has none."""
    marks = [p.mark for p in seen.parts.values() if p.filled]
    if table is None or None not in marks:
        return max(marks, default=0)
    return max_key(table, key).first()[0]


def add_load(new: DataFrame, root: str, key: str, load: int | None, seen: snapshots.State) -> DataFrame:
    """Write rows as a load on top of the state they were found from."""
    number = _free_load(seen, load)
    new = frozen(new).withColumn("load", F.lit(number))
    top = max_key(new, key).first()[0]
    publish(new, root, "load", [number], seen.commit, {number: top})
    return new


def append_load(
    source: DataFrame, root: str, key: str, at: datetime | str, load: int | None = None
) -> DataFrame:
    """Append source rows above the watermark as a new load; returns the load.

    Without ``load`` it gets the next number. A number that is there already is an
    error: its rows would be lost, or the new ones. Of two runs at a time that take the same
    number one ends with ``StaleTable``.
    """
    seen = snapshots.state(source.sparkSession, root)
    table = current(source.sparkSession, root, "load", at=seen)
    mark = _watermark(seen, table, key)
    target = source.limit(0) if table is None else table
    return add_load(append_incremental(source, target, key, at, mark), root, key, load, seen)


def append_product_load(
    source: DataFrame,
    root: str,
    key: str,
    at: datetime | str,
    products: Sequence[str],
    load: int | None = None,
    column: str = "product",
) -> DataFrame:
    """The same for several products in one load, each above its own watermark."""
    seen = snapshots.state(source.sparkSession, root)
    table = current(source.sparkSession, root, "load", at=seen)
    target = source.limit(0) if table is None else table
    new = append_products(source, target, key, at, products, column)
    return add_load(new, root, key, load, seen)


def repair_load(
    source: DataFrame, root: str, key: str, at: datetime | str, load: int | None = None
) -> DataFrame:
    """Append what earlier loads left out, as a load of its own; returns the load.

    Of a table that is not there yet nothing is left out: the first load is an append.
    """
    seen = snapshots.state(source.sparkSession, root)
    table = current(source.sparkSession, root, "load", at=seen)
    target = source.limit(0) if table is None else table
    return add_load(repair_missing(source, target, key, at), root, key, load, seen)


def refresh_table(source: DataFrame, root: str, at: datetime | str) -> DataFrame:
    """Replace the table; if anything fails the old one stays."""
    publish(refresh_full(source, at), root)
    return current(source.sparkSession, root)


def refresh_product(source: DataFrame, root: str, at: datetime | str, product: str) -> None:
    """Replace one product of a table kept by product."""
    named = refresh_full(source, at).withColumn("product", F.lit(product))
    publish(named, root, "product", [product])
