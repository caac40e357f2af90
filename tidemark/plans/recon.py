"""Reconciliation: does the target hold what the source holds, month by month."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import name_of_month, year_month
from tidemark.functions.rules import PACK_TYPE
from tidemark.operators.aggregates import filled_counts, month_count
from tidemark.operators.cleanup import suspect_payments, suspect_requests
from tidemark.operators.differences import WIDTH, Side, differing_rows
from tidemark.operators.shape import (
    authorized,
    before,
    collected,
    in_month,
    paid,
    paid_date,
    requested,
)
from tidemark.plans.collections import PACKED_DOCUMENTS
from tidemark.plans.facts import request_counts


def month_diff(source: DataFrame, target: DataFrame, asof: date, how: str = "left") -> DataFrame:
    """Counts by month on both sides and their difference, in month order.

    ``source`` is already counted; ``target`` is the fact table. A left join
    leaves out months only the target has; ``how="full"`` shows them.
    """
    held = (
        before(target, "fecha", asof)
        .groupBy("anio", "mes")
        .agg(F.count("*").alias("cant_destino"))
    )
    both = source.withColumnRenamed("cant", "cant_origen").join(held, ["anio", "mes"], how)
    origin = F.coalesce("cant_origen", F.lit(0))
    dest = F.coalesce("cant_destino", F.lit(0))
    return both.select(
        "anio",
        "mes",
        name_of_month("mes").alias("nommes"),
        origin.alias("cant_origen"),
        dest.alias("cant_destino"),
        (origin - dest).alias("diferencia"),
    ).orderBy("anio", "mes")


def recon_requested(
    redeems: DataFrame,
    target: DataFrame,
    asof: date,
    clients: DataFrame | None = None,
    how: str = "left",
) -> DataFrame:
    """Requests against their fact.

    A left join to clients changes a count only if a clientid repeats there.
    Clients are keyed by clientid, so the join and its shuffle are left out;
    pass ``clients`` where that key does not hold.
    """
    rows = before(requested(redeems), "fcorreo", asof)
    if clients is not None:
        rows = rows.select("clientid", "fcorreo").join(clients.select("clientid"), "clientid", "left")
    return month_diff(month_count(rows, F.col("fcorreo")), target, asof, how)


def recon_authorized(
    payments: DataFrame,
    redeems: DataFrame,
    clients: DataFrame,
    target: DataFrame,
    asof: date,
    how: str = "left",
) -> DataFrame:
    rows = before(authorized(payments), "f_authorized", asof).select("indice", "f_authorized")
    rows = rows.join(request_counts(redeems, clients), "indice")
    months = month_count(rows, F.col("f_authorized"), F.col("requests"))
    return month_diff(months, target, asof, how)


def recon_paid(
    payments: DataFrame, redeems: DataFrame, target: DataFrame, asof: date, how: str = "left"
) -> DataFrame:
    """Paid: the client is joined on the left, so it does not matter here."""
    rows = before(paid(payments), paid_date(), asof)
    rows = rows.select("indice", paid_date().alias("_on")).join(request_counts(redeems), "indice")
    return month_diff(month_count(rows, F.col("_on"), F.col("requests")), target, asof, how)


def _fact_side(target: DataFrame, key: str, asof: date, values: tuple[str, ...]) -> Side:
    month = F.col("anio") * 100 + F.col("mes")
    cells = [F.col("fecha"), *[F.col(v) for v in values]]
    return Side(before(target, "fecha", asof), [F.col(key).cast("bigint")], month, cells)


def _source_side(
    rows: DataFrame, on: Column, values: dict[str, Column], target: DataFrame, weight: Column | None = None
) -> Side:
    """Values in the types that the fact stores them in."""
    kinds = {f.name: f.dataType for f in target.schema}
    cells = [F.to_date(on), *[v.cast(kinds[name]) for name, v in values.items()]]
    return Side(rows, [F.col("indice").cast("bigint")], year_month(on), cells, weight)


def requested_differences(redeems: DataFrame, target: DataFrame, asof: date, width: int = WIDTH) -> DataFrame:
    """The requests behind the differences of ``recon_requested``, and those whose values differ.

    A row per request: which side has it (``lado``), its month and rows on both sides.
    """
    rows = before(requested(redeems), "fcorreo", asof)
    values = {"monto": F.col("monto"), "status_r": F.col("status_r")}
    mine = _source_side(rows, F.col("fcorreo"), values, target)
    return differing_rows(mine, _fact_side(target, "contador", asof, tuple(values)), ["contador"], width)


def authorized_differences(
    payments: DataFrame, redeems: DataFrame, clients: DataFrame, target: DataFrame, asof: date, width: int = WIDTH
) -> DataFrame:
    """The payments behind ``recon_authorized``: a payment stands for all its requests, as it does there."""
    rows = before(authorized(payments), "f_authorized", asof).join(request_counts(redeems, clients), "indice")
    mine = _source_side(rows, F.col("f_authorized"), {"monto": F.col("monto")}, target, F.col("requests"))
    return differing_rows(mine, _fact_side(target, "contador", asof, ("monto",)), ["contador"], width)


def paid_differences(
    payments: DataFrame, redeems: DataFrame, target: DataFrame, asof: date, width: int = WIDTH
) -> DataFrame:
    """The payments behind ``recon_paid``."""
    rows = before(paid(payments), paid_date(), asof).join(request_counts(redeems), "indice")
    mine = _source_side(rows, paid_date(), {"monto": F.col("monto")}, target, F.col("requests"))
    return differing_rows(mine, _fact_side(target, "pagoid", asof, ("monto",)), ["pagoid"], width)


def amount_differences(source: DataFrame, history: DataFrame, width: int = WIDTH) -> DataFrame:
    """The collections behind ``recon_amount``: missing, left over, or of another month or amount."""

    def side(rows: DataFrame) -> Side:
        keys = [F.col("indice").cast("bigint"), F.col("is_packed").cast("int")]
        return Side(rows, keys, F.col("pay_year") * 100 + F.col("pay_month"), [F.col("amount_bruta_usd").cast("decimal(18,6)")])

    return differing_rows(side(source), side(history), ["indice", "is_packed"], width)


def recon_amount(source: DataFrame, history: DataFrame) -> DataFrame:
    """Collections of the source against the history, count and amount by month.

    ``source`` is what the load reads (``plans.collections.collections``), so
    audit and load cannot disagree about which rows count. A month without any
    match has a null amount and a null difference.
    """
    held = history.select(
        "indice",
        "is_packed",
        F.lit(True).alias("d_"),
        *[
            F.col(c).alias("d_" + c)
            for c in ("amount_bruta_usd", "idcc", "clientid", "agente", "pay_method", "modoin")
        ],
    )
    rows = source.select(
        "indice",
        "is_packed",
        (F.col("pay_year") * 100 + F.col("pay_month")).alias("pay_year_month"),
        "amount_bruta_usd",
    ).join(held, ["indice", "is_packed"], "left")
    origin, dest = F.sum("amount_bruta_usd"), F.sum("d_amount_bruta_usd")
    return (
        rows.groupBy("pay_year_month")
        .agg(
            F.count("indice").alias("cnt_origen"),
            F.round(origin, 2).alias("monto_origen"),
            F.count("d_").alias("cnt_destino"),
            F.round(dest, 2).alias("monto_destino"),
            (F.count("indice") - F.count("d_")).alias("diff_cnt"),
            F.round(origin - dest, 2).alias("diff_monto"),
            *filled_counts("d_"),
        )
        .orderBy("pay_year_month")
    )


def recon_amount_independent(s, history: DataFrame, ym_from: int | None, ym_to: int | str | None = None) -> DataFrame:
    """The same audit from a source of its own, so that it also shows a fault of the load.

    It joins clients but no developers: a collection that the load loses for want of a
    developer is counted here and missing there. ``s`` are the load's ``Sources``.
    """
    kinds = s.clients.select("clientid", (F.col("dppaidin") == PACK_TYPE).alias("_packs"))
    plain = collected(in_month(s.cardcollec, "fcobrado", ym_from, ym_to)).join(kinds, "clientid").where("not _packs")
    items = s.ticket_items.where(F.col("tipodoc").isin(*PACKED_DOCUMENTS))
    items = items.join(in_month(s.tickets, "reference_date", ym_from, ym_to), F.col("ticket_id") == F.col("idticket"))
    card = s.cardcollec.select(F.col("indice").alias("idcc"), "clientid")
    packs = items.join(card, "idcc").join(kinds, "clientid").where("_packs")

    def side(rows: DataFrame, key: str, packed: int, on: str, amount: str) -> DataFrame:
        return rows.select(
            F.col(key).alias("indice"),
            F.lit(packed).alias("is_packed"),
            F.year(on).alias("pay_year"),
            F.month(on).alias("pay_month"),
            F.col(amount).cast("decimal(18,6)").alias("amount_bruta_usd"),
        )

    both = side(plain, "indice", 1, "fcobrado", "monto").unionByName(side(packs, "id", 2, "reference_date", "abono"))
    return recon_amount(both, history)


def orphan_audit(
    requested_t: DataFrame,
    authorized_t: DataFrame,
    paid_t: DataFrame,
    redeems: DataFrame,
    payments: DataFrame,
    asof: date,
) -> DataFrame:
    """Five labelled counts of facts to clean; a row may count under two labels.

    Each target is read once, and one row per target is unfolded into labels.
    """

    def counts(suspects: DataFrame, labels: dict[str, str]) -> DataFrame:
        one = suspects.agg(*[F.count_if(F.col(flag)).alias(name) for name, flag in labels.items()])
        return one.unpivot([], list(labels), "tabla", "huerfanos")

    aut = suspect_payments(authorized_t, payments, redeems, asof, "contador")
    pag = suspect_payments(paid_t, payments, redeems, asof, "pagoid")
    return (
        counts(suspect_requests(requested_t, redeems, asof), {"Solicitados": "reverted"})
        .unionByName(
            counts(aut, {"Autorizados_status0": "reverted", "Autorizados_huerfanos": "orphan"})
        )
        .unionByName(counts(pag, {"Pagados_status0": "reverted", "Pagados_huerfanos": "orphan"}))
    )


def cleanup_counts(
    requested_t: DataFrame,
    authorized_t: DataFrame,
    paid_t: DataFrame,
    redeems: DataFrame,
    payments: DataFrame,
    asof: date,
) -> DataFrame:
    """What the monthly cleanup removes: each row once, and the run-log message."""

    def doomed(suspects: DataFrame, label: str) -> DataFrame:
        flags = [c for c in ("reverted", "orphan") if c in suspects.columns]
        bad = suspects.where(" or ".join(flags))
        return bad.select(F.lit(label).alias("t"))

    rows = (
        doomed(suspect_requests(requested_t, redeems, asof), "SOL")
        .unionByName(
            doomed(suspect_payments(authorized_t, payments, redeems, asof, "contador"), "AUT")
        )
        .unionByName(doomed(suspect_payments(paid_t, payments, redeems, asof, "pagoid"), "PAG"))
    )
    n = {t: F.count_if(F.col("t") == t) for t in ("SOL", "AUT", "PAG")}
    text = F.concat_ws(" | ", *[F.concat(F.lit(f"{t}: "), c.cast("string")) for t, c in n.items()])
    return rows.agg(
        n["SOL"].alias("sol"),
        n["AUT"].alias("aut"),
        n["PAG"].alias("pag"),
        F.count("*").alias("total"),
        text.alias("mensaje"),
    )
