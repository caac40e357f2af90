"""Aggregates and the one window: the latest row of each key.

All sums and counts fold on the map side first, so a hot group sends one
partial row per task through its shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import month_start, name_of_month, year_month


def max_key(df: DataFrame, key: str) -> DataFrame:
    """One row: the highest key, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(key), F.lit(0)).alias("max_id"))


def count_max(df: DataFrame, key: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("cnt"), F.coalesce(F.max(key), F.lit(0)).alias("max_id")
    )


def month_count(df: DataFrame, on: Column, weight: Column | None = None) -> DataFrame:
    """Rows by year and month, or the sum of ``weight`` where a row stands for several.

    Grouped by the two numbers alone; the name is added to the months, not to the rows.
    """
    rows = F.count("*") if weight is None else F.sum(weight)
    months = df.groupBy(F.year(on).alias("anio"), F.month(on).alias("mes"))
    counted = months.agg(rows.alias("cant"))
    return counted.select("anio", "mes", name_of_month("mes").alias("nommes"), "cant")


def month_amount(df: DataFrame, on: str, amount: str) -> DataFrame:
    return df.groupBy(year_month(on).alias("pay_year_month")).agg(
        F.count("*").alias("cnt"), F.round(F.sum(amount), 2).alias("monto")
    )


def filled_counts(prefix: str = "") -> list[Column]:
    """How far the columns of a collection row are filled, as the amount audit prints it."""
    c = lambda name: F.col(prefix + name)
    return [
        F.count(c("idcc")).alias("cnt_idcc"),
        F.count_distinct(c("clientid")).alias("cnt_clientid_uniq"),
        F.count(c("agente")).alias("cnt_agente"),
        F.count(c("pay_method")).alias("cnt_pay_method"),
        F.coalesce(F.sum(F.when(c("modoin").isNotNull(), 1).otherwise(0)), F.lit(0)).alias(
            "cnt_modoin"
        ),
    ]


def null_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: all rows, and the nulls of each column."""
    return df.agg(
        F.count("*").alias("total_registros"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols],
    )


def _sum_if(condition: Column, amount: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0))


def year_totals(history: DataFrame) -> DataFrame:
    """Per year: gross, packed gross, net."""
    return history.groupBy("pay_year").agg(
        F.sum("amount_bruta_usd").alias("total_bruta"),
        _sum_if(F.col("is_packed") == 2, F.col("amount_bruta_usd")).alias("packed_bruta"),
        F.sum("amount_neta_usd").alias("total_neta"),
    )


def corp_report(rows: DataFrame) -> DataFrame:
    """Year and corporation: packed and not packed, gross and net, and totals."""
    gross, net = F.col("amount_bruta_usd"), F.col("amount_neta_usd")
    plain, packed = F.col("is_packed") == 1, F.col("is_packed") == 2
    return rows.groupBy("pay_year", "idcorp").agg(
        _sum_if(plain, gross).alias("no_packed"),
        _sum_if(packed, gross).alias("packed"),
        _sum_if(plain, net).alias("no_packed_neta"),
        _sum_if(packed, net).alias("packed_neta"),
        F.coalesce(F.sum(gross), F.lit(0)).alias("total"),
        F.coalesce(F.sum(net), F.lit(0)).alias("total_neta"),
    )


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the declared order.

    ``row_number() = 1`` is planned as a group limit on both sides of the
    shuffle: a task sends at most one row per key, however hot the key.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def latest(df: DataFrame, keys: Sequence[str], at: str, tie: str) -> DataFrame:
    """The newest row of each key; of two at the same time the one with the higher ``tie``."""
    return one_per_key(df, keys, [F.desc(at), F.desc(tie)])


def state_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("paquete", "estado").agg(F.count("*").alias("cnt"))


def recent(
    log: DataFrame, n: int, state: str | None = None, job: str | None = None
) -> DataFrame:
    """The last ``n`` runs: of all jobs, of one state, of one job."""
    if state is not None:
        log = log.where(F.col("estado") == state)
    if job is not None:
        log = log.where(F.col("paquete") == job)
    return log.orderBy(F.desc("fecha_inicio"), F.desc("id")).limit(n)


def union_tagged(plain: DataFrame, packed: DataFrame) -> DataFrame:
    """Both branches of the collections, told apart by ``is_packed`` 1 and 2."""
    return plain.withColumn("is_packed", F.lit(1)).unionByName(
        packed.withColumn("is_packed", F.lit(2))
    )


def hot_cold(history: DataFrame, live: DataFrame, ym: int, on: str = "pay_date") -> DataFrame:
    """History before month ``ym``, the live source from that month on."""
    start = F.lit(month_start(ym))
    return history.where(F.col(on) < start).unionByName(live.where(F.col(on) >= start))
