"""Located differences: the right keys, whatever differs, and only differing ranges opened."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tidemark.operators import differences as diff

SCHEMA = "k long, ym int, v decimal(10,2), s string"


def side(df, weight=None):
    return diff.Side(df, [F.col("k")], F.col("ym"), [F.col("v"), F.col("s")], weight)


def located(spark, left, right, width=16):
    a, b = (side(spark.createDataFrame(x, SCHEMA)) for x in (left, right))
    return rows(diff.differing_rows(a, b, ["k"], width))


def table(n=400):
    return [(k, 200001 + k % 7, Decimal(k) / 4, None if k % 5 == 0 else f"s{k}") for k in range(n)]


def test_equal_tables_differ_nowhere_in_any_order(spark):
    base = table()
    assert located(spark, base, random.Random(1).sample(base, len(base))) == []
    assert located(spark, [], []) == []


def test_each_kind_of_difference(spark):
    source, target = table(), table()
    del target[7], source[20]
    target[100] = (*target[100][:2], target[100][2] + 1, target[100][3])
    k, ym, v, s = target[200]
    target[200] = (k, ym + 1, v, s)  # another month
    source += [(None, None, None, None)]
    target += [target[300]]  # twice
    assert located(spark, source, target) == sorted(
        [
            (7, "origen", 200001, None, 1, 0),
            (20, "destino", None, 200007, 0, 1),
            (target[100][0], "distinto", target[100][1], target[100][1], 1, 1),
            (k, "distinto", ym, ym + 1, 1, 1),
            (None, "origen", None, None, 1, 0),
            (target[300][0], "distinto", target[300][1], target[300][1], 1, 2),
        ],
        key=repr,
    )


def test_nulls_are_not_passed_over(spark):
    a, b = [(1, 200001, None, "1")], [(1, 200001, Decimal(1), None)]
    assert [r[1] for r in located(spark, a, b)] == ["distinto"]


def test_a_row_may_stand_for_several(spark):
    one = spark.createDataFrame([(1, 200001, Decimal(1), "a", 3), (2, 200001, Decimal(1), "a", 1)], SCHEMA + ", n int")
    many = spark.createDataFrame([(1, 200001, Decimal(1), "a")] * 3 + [(2, 200001, Decimal(1), "a")] * 2, SCHEMA)
    found = diff.differing_rows(side(one, F.col("n")), side(many), ["k"])
    assert rows(found) == [(2, "distinto", 200001, 200001, 1, 2)]


@pytest.mark.parametrize("seed", range(3))
def test_random_changes_against_sets(spark, seed):
    rng = random.Random(seed)
    source = table(300)
    target = [r for r in source if rng.random() > 0.05]
    target = [(k, ym + (rng.random() < 0.05), v, s if rng.random() > 0.05 else "x") for k, ym, v, s in target]
    expected = {r[0] for r in set(source) ^ set(target)}
    assert {r[0] for r in located(spark, source, target)} == expected


def test_only_differing_ranges_are_opened(spark):
    big = spark.range(200_000).select(
        F.col("id").alias("k"), (200001 + F.col("id") % 5).cast("int").alias("ym"),
        F.col("id").cast("decimal(10,2)").alias("v"), F.lit("x").alias("s"),
    )
    other = big.where("k <> 77777")
    left, right = (diff.checksums(side(df), ["k"], 1000) for df in (big, other))
    ranges = diff.differing_ranges(left, right, 1000)
    assert rows(ranges, "_month", "_range") == [(200001 + 77777 % 5, 77000)]
    found = diff.differing_rows(side(big), side(other), ["k"], 1000)
    assert rows(found, "k", "lado") == [(77777, "origen")]
    assert left.count() == 1000  # what is compared is sums of ranges


def test_no_join_of_the_tables(spark, small):
    from tests.test_plans import conf
    from workload import QUERIES

    with conf(spark, autoBroadcastJoinThreshold="-1"):
        text = plan(QUERIES["recon_requested_rows"](spark, small))
    # the only joins keep the rows of the differing ranges, which are a frozen table of sums
    assert text.count("Join") == text.count("LeftSemi") > 0
