"""The three event facts: requested, authorized, paid.

A payment fact takes one request. Requests are matched to their client, reduced
to one per payment (the highest request number) and only then joined, so a
payment named by very many requests never fans out.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import as_ntz, date_parts, pack_flag
from tidemark.operators.aggregates import one_per_key
from tidemark.operators.shape import authorized, paid, paid_date, requested

# Name and level of each fact.
LEVELS = {"Solicitados": 1, "Autorizados": 2, "Pagados": 3}


def client_dims(clients: DataFrame, developers: DataFrame) -> DataFrame:
    """Client type, developer and corporation by client; the two lookups meet first."""
    named = developers.select(F.col("iddev").alias("company"), "iddev", "idcorp")
    return clients.select("clientid", "dppaidin", "company").join(named, "company", "left").drop(
        "company"
    )


def _fact(rows: DataFrame, kind: str, on: Column, key: str, status: str, at) -> DataFrame:
    return rows.select(
        F.lit(kind).alias("tipo"),
        *date_parts(on),
        F.col("indice").alias(key),
        "clientid",
        pack_flag(F.col("dppaidin")).alias("pack"),
        "monto",
        "currency",
        "idcorp",
        "iddev",
        status,
        F.lit(LEVELS[kind]).alias("nivel"),
        F.lit(0).alias("eliminado"),
        as_ntz(at).alias("create_at"),
        F.col("updateat").alias("update_at"),
    )


def requested_fact(
    redeems: DataFrame, clients: DataFrame, developers: DataFrame, at: datetime | str
) -> DataFrame:
    """Requests with a date and a status; the client may be unknown.

    ``update_at`` is the change time of the source row, not the load time: a
    change made while a load runs is then still newer than its row.
    """
    rows = requested(redeems).join(client_dims(clients, developers), "clientid", "left")
    return _fact(rows, "Solicitados", F.col("fcorreo"), "contador", "status_r", at)


def request_of_payment(
    redeems: DataFrame, dims: DataFrame, how: str, cols: Sequence[str] = ()
) -> DataFrame:
    """One request per payment, joined to its client (the first one, should it be there twice).

    A left join drops no request, so the requests are reduced first and only what
    is left meets the clients; an inner join has to come first.
    """
    links = redeems.where(F.col("pagoid").isNotNull()).select(
        "pagoid", "clientid", "currency", F.col("indice").alias("_request")
    )
    dims = one_per_key(dims, ["clientid"], [F.asc(c) for c in ("iddev", "idcorp", "dppaidin")])
    if how == "left":
        links = one_per_key(links, ["pagoid"], [F.desc("_request")]).join(dims, "clientid", how)
    else:
        links = one_per_key(links.join(dims, "clientid", how), ["pagoid"], [F.desc("_request")])
    return links.withColumnRenamed("pagoid", "indice").drop("_request")


def _payment_fact(payments, redeems, clients, developers, how, kind, on, key, at) -> DataFrame:
    links = request_of_payment(redeems, client_dims(clients, developers), how)
    return _fact(payments.join(links, "indice"), kind, on, key, "status_p", at)


def authorized_fact(
    payments: DataFrame,
    redeems: DataFrame,
    clients: DataFrame,
    developers: DataFrame,
    at: datetime | str,
) -> DataFrame:
    """Authorized payments of a known request of a known client."""
    return _payment_fact(
        authorized(payments), redeems, clients, developers, "inner",
        "Autorizados", F.col("f_authorized"), "contador", at,
    )


def paid_fact(
    payments: DataFrame,
    redeems: DataFrame,
    clients: DataFrame,
    developers: DataFrame,
    at: datetime | str,
) -> DataFrame:
    """Payments from status 3 with a date; the client may be unknown."""
    return _payment_fact(
        paid(payments), redeems, clients, developers, "left",
        "Pagados", paid_date(), "pagoid", at,
    )


def request_counts(redeems: DataFrame, clients: DataFrame | None = None) -> DataFrame:
    """Requests per payment (of known clients, if given), for audits that count them all.

    Counting per payment folds a hot payment before its join.
    """
    links = redeems.where(F.col("pagoid").isNotNull()).select("pagoid", "clientid")
    if clients is not None:
        links = links.join(clients.select("clientid"), "clientid")
    return links.groupBy(F.col("pagoid").alias("indice")).agg(F.count("*").alias("requests"))
