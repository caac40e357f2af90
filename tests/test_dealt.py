"""Tasks whose number follows the size of the tables, and filters that pass an upsert."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tidemark.operators import merge, sizes
from tidemark.operators.differences import Side, differing_rows

KEYS, COLS = ["k", "p"], ["v"]
KINDS = "k long, p int, v int"


@pytest.fixture
def sides(spark, tmp_path):
    """Two tables with keys that repeat or are null."""
    old = [(i % 90, 1 + i % 2, i) for i in range(100)] + [(None, 1, 5), (41, None, 6)]
    new = [(i % 120, 1 + i % 2, i * 2) for i in range(30, 130)] + [(None, 1, 7), (82, None, 8)]
    found = []
    for name, data in (("old", old), ("new", new)):
        spark.createDataFrame(data, KINDS).write.parquet(f"{tmp_path}/{name}")
        found.append(spark.read.parquet(f"{tmp_path}/{name}"))
    return found


def test_large_tables_are_dealt_out_alike(spark, sides):
    cores = spark.sparkContext.defaultParallelism
    assert sizes.dealt(sides, KEYS) == sides
    part = sum(map(sizes.file_bytes, sides)) // (3 * cores)
    one, two = sizes.dealt(sides, KEYS, part)
    assert one.rdd.getNumPartitions() == two.rdd.getNumPartitions() >= 3 * cores
    assert rows(one) == rows(sides[0]) and rows(two) == rows(sides[1])


def test_joins_and_folds_by_key_are_dealt_out(spark, sides, monkeypatch):
    old, new = sides
    side = lambda df: Side(df, [F.col("k")], F.col("p"), [F.col("v")])
    found = lambda: [
        merge.captured(old, new, KEYS, COLS),
        merge.removed(old, new, KEYS, COLS),
        differing_rows(side(old), side(new), ["k"]),
    ]
    before = [rows(df) for df in found()]
    monkeypatch.setattr(sizes, "PART_BYTES", 20)
    after = found()
    assert all("REPARTITION_BY_NUM" in plan(df) for df in after)
    assert [rows(df) for df in after] == before


def test_a_condition_removes_as_its_rows_do(sides):
    old = sides[0]
    gone = merge.removed(old, F.expr("k % 41 = 0"), KEYS, COLS)
    assert "Join" not in plan(gone)
    assert rows(gone) == rows(merge.removed(old, old.where("k % 41 = 0"), KEYS, COLS)) != []


def test_a_key_filter_passes_a_filtered_upsert(sides):
    old, new = sides
    assert rows(merge.upsert(old, new, KEYS, filtered=True)) == rows(merge.upsert(old, new, KEYS))
    some = merge.upsert(old, new, KEYS, filtered=True).where("k % 41 = 0")
    text = plan(some)
    assert "FullOuter" not in text and text.count("FileScan") == text.count("% 41) = 0") // 2 == 4
    assert rows(some) == rows(merge.upsert(old, new, KEYS).where("k % 41 = 0"))


def test_frozen_rows_do_not_add_tasks(spark, sides, monkeypatch):
    old, new = sides
    # a join that Spark expects to be as large as the product of its sides
    few = sizes.frozen(old.alias("o").join(new.alias("n"), F.expr("o.v < n.v - 150")).select("o.k"))
    assert sizes.file_bytes(few) == 0
    assert sizes.file_bytes(old.join(few, "k", "left_semi")) == sizes.file_bytes(old)
    files = sum(map(sizes.file_bytes, sides))
    monkeypatch.setattr(sizes, "PART_BYTES", files // 20)
    side = lambda df: Side(df, [F.col("k")], F.col("p"), [F.col("v")])
    found = plan(differing_rows(side(old), side(new), ["k"]))
    assert re.findall(r"hashpartitioning\(k#\d+L, (\d+)\), REPARTITION_BY_NUM", found) == [str(-(-files // (files // 20)))]
