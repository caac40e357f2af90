"""Conformed client and phone tables, and the table of active clients.

The source system states only what these tables are for. Which row represents a
client, and what counts as active or first, is declared here.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import as_ntz
from tidemark.operators.aggregates import one_per_key
from tidemark.operators.joins import exists_in, split_join
from tidemark.operators.merge import upsert
from tidemark.operators.shape import update_column

CLIENT_COLS = ("firstname", "lastname", "email", "country", "product", "contractid")


def bronze_union(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Bronze tables of several products as one, told apart by ``product``."""
    return reduce(
        DataFrame.unionByName, [df.withColumn("product", F.lit(p)) for p, df in tables.items()]
    )


def client_rows(bronze: DataFrame) -> DataFrame:
    """One row per client: best rank, then product and contract in order."""
    order = [F.asc_nulls_last("rank"), F.asc("product"), F.asc("contractid")]
    return one_per_key(bronze, ["clientid"], order).select("clientid", *CLIENT_COLS)


def gold_clients(target: DataFrame, bronze: DataFrame, at: datetime | str) -> DataFrame:
    """The client table after an upsert from Bronze; ``updatedat`` moves on real changes."""
    return upsert(
        target,
        client_rows(bronze).withColumn("createdat", as_ntz(at)),
        ["clientid"],
        keep=("createdat",),
        stamp="updatedat",
        stamp_cols=CLIENT_COLS,
        at=at,
    )


def gold_client_detail(bronze: DataFrame) -> DataFrame:
    """One row per product, client and contract."""
    keys = ["product", "clientid", "contractid"]
    rows = one_per_key(bronze, keys, [F.asc_nulls_last("rank"), F.asc("ingreso")])
    return rows.select(*keys, "corpcode", "ingreso", "egreso", "rank", "estatusn")


def gold_phones(phones: DataFrame) -> DataFrame:
    """Each phone of each client once, whatever products it came from."""
    return phones.where(F.col("phone").isNotNull()).select("clientid", "phone").distinct()


def active_clients(redeems: DataFrame, clients: DataFrame, developers: DataFrame) -> DataFrame:
    """Clients that hold a first request, with developer and corporation."""
    known = exists_in(clients, redeems.where(F.col("redeem_no") == 1), "clientid")
    named = known.select("clientid", F.col("company").alias("iddev"))
    return named.join(developers.select("iddev", "idcorp"), "iddev", "left")


def expire_contracts(active: DataFrame, redeems: DataFrame, asof: date) -> DataFrame:
    """``finalizado`` is 1 where the last request is from last year or before."""
    return expire_by_last(active, redeems.groupBy("clientid").agg(F.max("fcorreo").alias("ultimo")), asof)


def expire_by_last(active: DataFrame, last: DataFrame, asof: date) -> DataFrame:
    """The same from each client's last request, as ``operators.extremes`` keeps it."""
    last = last.select("clientid", F.to_date("ultimo").alias("ultimo"))
    over = F.year("ultimo") <= asof.year - 1
    return active.join(last, "clientid", "left").withColumn(
        "finalizado", F.when(over, 1).otherwise(0)
    )


def set_first_request(redeems: DataFrame, column: str = "inicio_r") -> DataFrame:
    """Write each client's first request date into all requests of that client."""
    first = redeems.groupBy("clientid").agg(F.to_date(F.min("fcorreo")).alias("_first"))
    joined = split_join(redeems, first, "clientid")
    done = update_column(joined, column, F.col("_first"), F.col("_first").isNotNull())
    return done.select(redeems.columns)
