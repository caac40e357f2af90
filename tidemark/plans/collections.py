"""Collection history: two source branches by month, and late corrections.

Branch 1 (not packed) reads collections, branch 2 (packed) reads ticket items.
Amounts are stored as they are, in their own currency; conversion happens when
a report reads them. Any range of months is one job.
"""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    as_ntz,
    changed,
    charge_mode,
    month_start,
    net_amount,
    to_usd,
)
from tidemark.functions.rules import PACK_TYPE
from tidemark.operators.aggregates import corp_report, hot_cold, latest, one_per_key, union_tagged
from tidemark.operators.asof import last_before
from tidemark.operators.joins import listed_or
from tidemark.operators.merge import upsert
from tidemark.operators.shape import collected, in_month, month_range
from tidemark.operators.sizes import frozen, hinted, is_small, measured

# Document types of a packed collection, the change kind that
# counts, and the columns a late change and an upsert are judged by.
PACKED_DOCUMENTS = ("NC", "PA", "DTO")
CHANGE_KIND = "UPDATE"
DETECT_COLS = ("monto", "statusc", "fcobrado", "currency", "pay_method")
STAMP_COLS = (
    "amount_bruta_usd",
    "amount_neta_usd",
    "statusc",
    "pay_date",
    "clientid",
    "idcc",
    "modoin",
    "agente",
    "pay_method",
)
HISTORY_KEY = ("indice", "is_packed")


class Sources(NamedTuple):
    cardcollec: DataFrame
    tickets: DataFrame
    ticket_items: DataFrame
    clients: DataFrame
    developers: DataFrame


def _placed(rows: DataFrame, s: Sources, packed: bool) -> DataFrame:
    """Inner joins to client and developer, which meet first: rows are joined once.

    Leaving out (or asking for) the pack type drops rows without a client, as
    the left join of the not-packed branch does once its filter is applied. A client or
    developer that is there twice counts once, in a declared order, so that a row is
    never doubled and no window over the rows is needed.
    """
    kind = F.col("dppaidin") == PACK_TYPE
    clients = s.clients.where(kind if packed else ~kind)
    clients = clients.select("clientid", "dppaidin", "with_card", F.col("company").alias("iddev"))
    placed = clients.join(s.developers.select("iddev", "idcorp"), "iddev")
    order = [F.asc(c) for c in ("iddev", "idcorp", "dppaidin", "with_card")]
    return rows.join(one_per_key(placed, ["clientid"], order), "clientid")


def _columns(on: Column, mode: Column, gross: Column, net: Column) -> list[Column]:
    return [
        F.col("idcc"),
        F.col("clientid"),
        F.year(on).alias("pay_year"),
        F.month(on).alias("pay_month"),
        F.to_date(on).alias("pay_date"),
        F.col("idcorp"),
        F.col("iddev"),
        mode.alias("modoin"),
        F.col("agente"),
        gross.cast("decimal(18,6)").alias("amount_bruta_usd"),
        net.cast("decimal(18,6)").alias("amount_neta_usd"),
        F.col("currency"),
        F.col("pay_method"),
        F.col("statusc"),
    ]


def not_packed(
    s: Sources,
    ym_from: int | None,
    ym_to: int | str | None = None,
    late: DataFrame | None = None,
) -> DataFrame:
    """Collections of the months, and those ``late`` names whatever their month.

    ``late`` has one column of collection keys. Both conditions are checked in
    one read of the collections.
    """
    wanted = month_range("fcobrado", ym_from, ym_to)
    if late is not None:
        wanted = listed_or(wanted, "indice", late)
    rows = collected(s.cardcollec).where(wanted).withColumn("idcc", F.col("indice"))
    gross = F.col("monto")
    return _placed(rows, s, packed=False).select(
        "indice",
        *_columns(
            F.col("fcobrado"),
            charge_mode(F.col("dppaidin"), F.col("with_card"), F.col("clientid")),
            gross,
            net_amount(gross, statusc=F.col("statusc")),
        ),
    )


def packed(s: Sources, ym_from: int | None, ym_to: int | str | None = None) -> DataFrame:
    """Ticket items of the months, with the collection each belongs to."""
    tickets = in_month(s.tickets, "reference_date", ym_from, ym_to)
    items = s.ticket_items.select(F.col("id").alias("item"), "ticket_id", "idcc", "tipodoc", "abono")
    belongs = (F.col("ticket_id") == F.col("idticket")) & F.col("tipodoc").isin(*PACKED_DOCUMENTS)
    card = s.cardcollec.select(
        F.col("indice").alias("idcc"), "clientid", "statusc", "currency", "agente", "pay_method"
    )
    rows = tickets.join(items, belongs).join(card, "idcc")
    gross = F.col("abono")
    return _placed(rows, s, packed=True).select(
        F.col("item").alias("indice"),
        *_columns(
            F.col("reference_date"),
            F.lit(2),
            gross,
            net_amount(gross, tipodoc=F.col("tipodoc")),
        ),
    )


def collections(
    s: Sources,
    ym_from: int | None,
    ym_to: int | str | None = None,
    late: DataFrame | None = None,
) -> DataFrame:
    """Both branches, one row per (indice, is_packed): the keys of collection and ticket item."""
    return union_tagged(not_packed(s, ym_from, ym_to, late), packed(s, ym_from, ym_to))


def last_changes(log: DataFrame, ym: int) -> DataFrame:
    """The last change made in month ``ym`` to each collection of an earlier month."""
    changes = collected(in_month(log.where(F.col("reg") == CHANGE_KIND), "fecha", ym))
    earlier = changes.where(F.col("fcobrado") < F.lit(month_start(ym)))
    return latest(earlier, ["cardcollec_id"], "fecha", "id").select("cardcollec_id", *DETECT_COLS)


def unseen_changes(changes: DataFrame, history: DataFrame, small: bool = False) -> DataFrame:
    """Last changes the history does not show: the row differs, or is not there.

    ``small`` sends the changed keys to the history instead of shuffling it.
    """
    held = history.where(F.col("is_packed") == 1).select(
        F.col("indice").alias("cardcollec_id"),
        F.lit(True).alias("_held"),
        F.col("amount_bruta_usd").alias("h_monto"),
        F.col("statusc").alias("h_statusc"),
        F.col("pay_date").alias("h_fcobrado"),
        F.col("currency").alias("h_currency"),
        F.col("pay_method").alias("h_pay_method"),
    )
    if small:
        wanted = F.broadcast(changes.select("cardcollec_id"))
        held = held.join(wanted, "cardcollec_id", "left_semi")
    new = changes.withColumn("fcobrado", F.to_date("fcobrado"))
    differs = changed(F.col, lambda c: F.col("h_" + c), DETECT_COLS)
    joined = new.join(held, "cardcollec_id", "left")
    return joined.where(F.col("_held").isNull() | differs).select(new.columns)


def late_changes(log: DataFrame, history: DataFrame, ym: int) -> DataFrame:
    return unseen_changes(last_changes(log, ym), history)


def late_keys(log: DataFrame, history: DataFrame, ym: int, last: DataFrame | None = None) -> DataFrame:
    """The collections with late changes, frozen; a few are sent to the tables they are in.

    ``last`` are the month's last changes, where they are kept (``streaming.changes``); the log is
    not read then.
    """
    changes = frozen(last_changes(log, ym) if last is None else last)
    small = is_small(changes)
    unseen = unseen_changes(hinted(changes, small), history, small)
    return measured(unseen.select("cardcollec_id"))


def load_rows(s: Sources, log: DataFrame, history: DataFrame, ym: int) -> DataFrame:
    """What the load of month ``ym`` writes: the month, and late changes before it."""
    return collections(s, ym, late=late_changes(log, history, ym).select("cardcollec_id"))


def load_month(
    s: Sources, log: DataFrame, history: DataFrame, ym: int, at: datetime | str
) -> DataFrame:
    """The history after the load; a second run changes nothing.

    A plan and no job: late keys, rows and merge run when the result is read. The stored job
    (``daily.load_collections``) freezes its keys and rewrites touched months only.
    """
    return merge_history(history, load_rows(s, log, history, ym), at)


def load_months(
    s: Sources, history: DataFrame, ym_from: int | None, ym_to: int | str, at: datetime | str
) -> DataFrame:
    """The history after a range of months was loaded again, as one job."""
    return merge_history(history, collections(s, ym_from, ym_to), at)


def merge_history(
    history: DataFrame, rows: DataFrame, at: datetime | str, small: bool = False
) -> DataFrame:
    return upsert(
        history,
        rows.withColumn("insertat", as_ntz(at)),
        HISTORY_KEY,
        keep=("insertat",),
        stamp="updateat",
        stamp_cols=STAMP_COLS,
        at=at,
        small_source=small,
    )


def in_usd(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """Gross and net in USD by the rate of (currency, pay_year)."""
    table = rates.select("currency", F.col("anio").alias("pay_year"), "rate")
    rated = rows.join(table, ["currency", "pay_year"], "left")
    for amount in ("amount_bruta_usd", "amount_neta_usd"):
        usd = to_usd(F.col(amount), F.col("currency"), F.col("rate")).cast("decimal(18,6)")
        rated = rated.withColumn(amount, usd)
    return rated.drop("rate")


def in_usd_on_date(rows: DataFrame, rates: DataFrame, amount: str = "amount_bruta_usd", since: str = "desde") -> DataFrame:
    """``amount_usd`` by the rate that held on the payment date; ``rates`` has currency, ``since`` and rate."""
    rated = last_before(rows, rates, "currency", "pay_date", since, "rate")
    usd = to_usd(F.col(amount), F.col("currency"), F.col("rate")).cast("decimal(18,6)")
    return rated.withColumn("amount_usd", usd)


def corp_year_report(
    history: DataFrame, live: DataFrame, ym: int, rates: DataFrame | None = None
) -> DataFrame:
    """Year and corporation, from the history before month ``ym`` and the source from it on."""
    shared = [c for c in live.columns if c in history.columns]
    rows = hot_cold(history.select(shared), live.select(shared), ym)
    return corp_report(rows if rates is None else in_usd(rows, rates))
