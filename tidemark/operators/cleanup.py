"""Removing facts whose source row was reverted or is gone.

Only facts from before the current year are looked at. The keys to remove are
found from narrow columns; whole rows are read only to write what stays.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import as_ntz, iso_week, null_default
from tidemark.operators.joins import missing_in
from tidemark.operators.shape import before_year


def _lookup(
    facts: DataFrame, source: DataFrame, key: str, source_key: str, bad: Column
) -> DataFrame:
    found = source.select(F.col(source_key).alias(key), bad.alias("_bad"))
    return facts.join(found, key, "left").withColumn(
        "reverted", F.coalesce("_bad", F.lit(False))
    ).drop("_bad")


def suspect_requests(
    target: DataFrame, redeems: DataFrame, asof: date, key: str = "contador", also: Sequence[str] = ()
) -> DataFrame:
    """Prior-year requests, with ``reverted``: status 0 or no date at the source."""
    facts = before_year(target, "fecha", asof).select(key, *also)
    bad = (null_default("status_r", 0) == 0) | F.col("fcorreo").isNull()
    return _lookup(facts, redeems, key, "indice", bad)


def suspect_payments(
    target: DataFrame,
    payments: DataFrame,
    redeems: DataFrame,
    asof: date,
    key: str,
    also: Sequence[str] = (),
) -> DataFrame:
    """Prior-year payment facts, with ``reverted`` (status 0) and ``orphan`` (no request)."""
    facts = before_year(target, "fecha", asof).select(key, *also)
    facts = _lookup(facts, payments, key, "indice", null_default("status_p", 0) == 0)
    # Distinct first: one payment may be named by very many requests.
    asked = redeems.select(F.col("pagoid").alias(key)).distinct().withColumn("_asked", F.lit(True))
    return (
        facts.join(asked, key, "left")
        .withColumn("orphan", F.col("_asked").isNull())
        .drop("_asked")
    )


def delete_keys(
    target: DataFrame, keys: DataFrame, key: str, soft: bool = False, flag: str = "eliminado"
) -> DataFrame:
    """The target without the listed keys, or with their flag set."""
    listed = keys.select(key).distinct()
    if not soft:
        return target.join(listed, key, "left_anti")
    marked = target.join(listed.withColumn("_gone", F.lit(True)), key, "left")
    gone = F.when(F.col("_gone").isNotNull(), 1).otherwise(F.col(flag))
    return marked.withColumn(flag, gone).select(target.columns)


def delete_reverted(target: DataFrame, suspects: DataFrame, key: str, soft: bool = False) -> DataFrame:
    return delete_keys(target, suspects.where("reverted"), key, soft)


def delete_orphans(target: DataFrame, suspects: DataFrame, key: str, soft: bool = False) -> DataFrame:
    return delete_keys(target, suspects.where("orphan"), key, soft)


def archive_rows(
    log: DataFrame, states: Sequence[str], at: datetime, state: str = "estado"
) -> DataFrame:
    """Finished rows as they go to the archive, with its time, ISO week and date."""
    moment = as_ntz(at)
    return log.where(F.col(state).isin(*states)).withColumns(
        {
            "archived_at": moment,
            "archived_week": iso_week(moment),
            "archived_date": F.to_date(moment),
        }
    )


def purge_archived(log: DataFrame, archive: DataFrame, key: str = "id") -> DataFrame:
    """The log without the rows the archive already holds."""
    return missing_in(log, archive, key)
