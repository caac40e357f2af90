"""The scheduled jobs end to end: find what changed, build it, write it.

Finding what changed reads keys and change times only. The keys found are
frozen and counted, and if few they are broadcast to the wide tables, so a
daily run shuffles narrow columns and touches the months that changed.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import as_ntz, previous_period, year_month
from tidemark.operators.cleanup import suspect_payments, suspect_requests
from tidemark.operators.joins import exists_in
from tidemark.operators.merge import pending_row
from tidemark.operators.shape import authorized, paid, requested
from tidemark.operators.sizes import measured
from tidemark.plans import collections as coll
from tidemark.plans.facts import authorized_fact, paid_fact, requested_fact
from tidemark.plans.sync import clean_by_month, sync_by_month
from tidemark.sources.snapshots import current

MONTH = "aniomes"


def _pending_keys(
    spark: SparkSession, root: str, rows: DataFrame, key: str, granularity: str
) -> DataFrame | None:
    """Keys to load, or None while there is no table and all are."""
    table = current(spark, root, MONTH)
    if table is None:
        return None
    narrow = rows.select("indice", "updateat")
    found = pending_row(narrow, table, "indice", key, granularity=granularity)
    return measured(found.select("indice").distinct())


def _only(rows: DataFrame, keys: DataFrame | None, column: str = "indice") -> DataFrame:
    if keys is None:
        return rows
    return rows.join(keys.withColumnRenamed("indice", column), column, "left_semi")


def sync_requested(
    root: str,
    redeems: DataFrame,
    clients: DataFrame,
    developers: DataFrame,
    at: datetime,
    granularity: str = "day",
) -> list:
    """Load new and changed requests; returns the months rewritten."""
    keys = _pending_keys(redeems.sparkSession, root, requested(redeems), "contador", granularity)
    rows = requested_fact(_only(redeems, keys), clients, developers, at)
    return sync_by_month(
        root, rows, ["contador"], MONTH, order=[F.desc("update_at")], keep=("create_at",)
    )


def _sync_payments(root, payments, redeems, clients, developers, at, granularity, counted, build, key):
    # a payment that the load has no request for (or no known client) is not pending either
    named = exists_in(redeems, clients, "clientid") if build is authorized_fact else redeems
    loadable = exists_in(counted(payments), named, "indice", "pagoid")
    keys = _pending_keys(payments.sparkSession, root, loadable, key, granularity)
    asked = _only(redeems, keys, "pagoid")
    rows = build(_only(payments, keys), asked, clients, developers, at)
    return sync_by_month(root, rows, [key], MONTH, order=[F.desc("update_at")], keep=("create_at",))


def sync_authorized(
    root: str,
    payments: DataFrame,
    redeems: DataFrame,
    clients: DataFrame,
    developers: DataFrame,
    at: datetime,
    granularity: str = "day",
) -> list:
    return _sync_payments(
        root, payments, redeems, clients, developers, at, granularity,
        authorized, authorized_fact, "contador",
    )


def sync_paid(
    root: str,
    payments: DataFrame,
    redeems: DataFrame,
    clients: DataFrame,
    developers: DataFrame,
    at: datetime,
    granularity: str = "day",
) -> list:
    return _sync_payments(
        root, payments, redeems, clients, developers, at, granularity, paid, paid_fact, "pagoid"
    )


def load_collections(
    root: str,
    sources: coll.Sources,
    log: DataFrame,
    at: datetime,
    ym: int | None = None,
    ym_to: int | None = None,
    last: DataFrame | None = None,
) -> list:
    """Load a month (the one before ``at`` if none is given) and its late changes.

    ``last`` are the last changes of that month, where a stream folds them
    (``streaming.changes.folded_changes``); else they are found in the whole log.

    With ``ym_to`` the whole range of months is loaded as one job, without
    late changes: every month in it is read anyway.
    """
    spark = log.sparkSession
    ym = ym or previous_period(at.date())
    history = current(spark, root, MONTH)
    late = None
    if history is not None and ym_to is None:
        late = coll.late_keys(log, history, ym, last)
    rows = coll.collections(sources, ym, ym_to, late)
    return sync_by_month(
        root,
        rows.withColumns({MONTH: year_month("pay_date"), "insertat": as_ntz(at)}),
        coll.HISTORY_KEY,
        MONTH,
        keep=("insertat",),
        stamp="updateat",
        stamp_cols=coll.STAMP_COLS,
        at=at,
    )


def clean_facts(
    roots: dict[str, str], redeems: DataFrame, payments: DataFrame, asof: date
) -> dict[str, list]:
    """The monthly cleanup of the three facts; returns the months rewritten of each.

    ``roots`` names the tables ``requested``, ``authorized`` and ``paid``.
    """
    spark = redeems.sparkSession
    done = {}
    for name, key in (("requested", "contador"), ("authorized", "contador"), ("paid", "pagoid")):
        table = current(spark, roots[name], MONTH)
        if table is None:
            done[name] = []
            continue
        if name == "requested":
            bad = suspect_requests(table, redeems, asof, key, also=[MONTH]).where("reverted")
        else:
            bad = suspect_payments(table, payments, redeems, asof, key, also=[MONTH])
            bad = bad.where("reverted or orphan")
        done[name] = clean_by_month(spark, roots[name], bad, key, MONTH)
    return done
