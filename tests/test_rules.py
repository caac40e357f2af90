from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import functions as fn
from tidemark.operators.shape import requested, update_column


@pytest.mark.parametrize(
    "dppaidin, with_card, clientid, mode",
    [
        (1, 1, 5, 1),
        (9, 1, -5, 1),
        (1, 0, 5, 0),
        (1, 0, -5, 3),
        (2, 1, 5, 2),
        (4, 1, 5, 3),
        (5, 0, 5, 3),
        (10, 1, 5, 4),
        (10, 1, -5, 3),
        (11, 0, 5, 5),
        (12, 1, 5, 0),
        (None, None, 5, 0),
        (None, 1, -1, 3),
    ],
)
def test_charge_mode(spark, dppaidin, with_card, clientid, mode):
    df = spark.createDataFrame([(dppaidin, with_card, clientid)], "d int, w int, c int")
    assert df.select(fn.charge_mode(F.col("d"), F.col("w"), F.col("c"))).first()[0] == mode


def test_to_usd_without_a_usable_rate(spark):
    data = [
        ("MXN", Decimal(100), Decimal(20)),
        ("MXN", Decimal(100), Decimal(0)),
        ("MXN", Decimal(100), None),
        ("USD", Decimal(100), None),
        (None, Decimal(100), None),
    ]
    df = spark.createDataFrame(data, "cur string, a decimal(18,6), r decimal(9,4)")
    got = [r[0] for r in df.select(fn.to_usd(F.col("a"), F.col("cur"), F.col("r"))).collect()]
    assert got == [5, None, None, 100, 100]


def test_net_amount(spark):
    df = spark.createDataFrame([(1, "PA"), (6, "NC"), (None, None)], "s int, d string")
    g = F.lit(Decimal(7)).cast("decimal(18,6)")
    got = df.select(fn.net_amount(g, statusc=F.col("s")), fn.net_amount(g, tipodoc=F.col("d")))
    assert [tuple(r) for r in got.collect()] == [(7, 7), (0, 0), (0, 0)]


def test_changed_takes_null_for_a_value(spark):
    data = [(1, None, None), (2, None, 0), (3, 1, 1), (4, 1, 2), (5, -1, None)]
    df = spark.createDataFrame(data, "id int, a int, b_a int")
    differs = fn.changed(F.col, lambda c: F.col("b_" + c), ["a"])
    assert [r[0] for r in df.where(differs).orderBy("id").collect()] == [2, 4, 5]


def test_periods():
    assert fn.previous_period(date(2026, 1, 31)) == 202512
    assert fn.previous_period(date(2026, 7, 1)) == 202606
    assert fn.month_bounds(202512) == (date(2025, 12, 1), date(2026, 1, 1))
    assert fn.month_bounds(202601, 202603) == (date(2026, 1, 1), date(2026, 4, 1))


def test_dates_on_columns(spark):
    data = [(datetime(2024, 2, 29, 23, 59),), (datetime(2021, 1, 3),), (None,)]
    df = spark.createDataFrame(data, "d timestamp_ntz")
    got = df.select(
        fn.month_name("d"), fn.year_month("d"), fn.previous_month("d"), fn.year_start("d"), fn.iso_week("d")
    ).collect()
    assert tuple(got[0]) == ("Febrero", 202402, 202401, date(2024, 1, 1), 9)
    assert tuple(got[1]) == ("Enero", 202101, 202012, date(2021, 1, 1), 53)
    assert tuple(got[2]) == (None,) * 5


def test_a_null_status_is_not_a_request(spark):
    data = [(1, date(2020, 1, 1), 1), (2, date(2020, 1, 1), None), (3, date(2020, 1, 1), 0), (4, None, 1)]
    df = spark.createDataFrame(data, "indice int, fcorreo date, status_r int")
    assert rows(requested(df), "indice") == [(1,)]


def test_update_column_only_where(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k int, v int")
    got = update_column(df, "v", F.lit(0), F.col("k") > 1)
    assert rows(got, "v") == [(0,), (10,), (30,)]
