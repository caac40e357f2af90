"""Plans: what reaches the scan, what is shuffled, what a hot key does."""

import re
from contextlib import contextmanager
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tidemark.operators import aggregates as agg
from tidemark.operators import cleanup, joins, load, merge, shape, sizes
from tidemark.plans import collections as coll
from tidemark.plans import gold, sync
from tidemark.sources.snapshots import current
from workload import QUERIES


@contextmanager
def conf(spark, **settings):
    names = {k: "spark.sql." + k.replace("__", ".") for k in settings}
    old = {k: spark.conf.get(n, None) for k, n in names.items()}
    try:
        for k, v in settings.items():
            spark.conf.set(names[k], v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(names[k]) if v is None else spark.conf.set(names[k], v)


@pytest.fixture
def no_auto_broadcast(spark):
    """Tables too big to broadcast, as far as Spark can tell."""
    with conf(spark, autoBroadcastJoinThreshold="-1"):
        yield


# only watermarks of listed products are broadcast whatever the size of the tables
BOUNDED = {"append_five_products"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_no_python_no_unchecked_broadcast(name, spark, small, no_auto_broadcast):
    text = plan(QUERIES[name](spark, small))
    assert not re.search("NestedLoop|Cartesian|Python|Pandas|MapInArrow", text)
    assert "BroadcastExchange" not in text or name in BOUNDED
    # whole rows never meet in one task: only aggregates and small reports do
    for child in re.findall(r"Exchange SinglePartition.*\n\W*(\w+)", text):
        assert child in ("HashAggregate", "ObjectHashAggregate", "SortAggregate", "TakeOrderedAndProject")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Client rows in several files, so that a pushed key prunes."""
    path = str(tmp_path_factory.mktemp("stored") / "clients")
    df = spark.range(0, 4000, 1, 4).select(
        F.col("id").alias("clientid"),
        F.expr("timestamp_ntz '2020-01-01' + make_interval(0, 0, 0, cast(id as int))").alias("ingreso"),
        F.lit("x").alias("email"),
        F.lit("unused").alias("other"),
    )
    df.write.parquet(path)
    return path


def test_watermark_and_columns_reach_the_scan(spark, stored):
    source = spark.read.parquet(stored).select("clientid", "email")
    target = spark.read.parquet(stored).where("clientid < 3000").select("clientid")
    new = load.append_incremental(source, target, "clientid", "2024-01-01 00:00:00")
    text = plan(new)
    assert re.search(r"PushedFilters: \[IsNotNull\(clientid\), GreaterThan\(clientid,ScalarSubquery", text)
    assert "other" not in text
    assert new.count() == 1000
    literal = load.append_incremental(source, target, "clientid", "2024-01-01 00:00:00", mark=2999)
    assert "GreaterThan(clientid,2999)" in plan(literal)
    assert load.watermark_value(target, "clientid") == 2999


def test_months_reach_the_scan_as_a_range(spark, stored):
    df = shape.in_month(spark.read.parquet(stored), "ingreso", 202003, 202004)
    text = plan(df)
    assert "GreaterThanOrEqual(ingreso,2020-03-01T00:00)" in text
    assert "LessThan(ingreso,2020-05-01T00:00)" in text
    assert df.count() == 61


def test_year_start_reaches_the_scan(spark, stored):
    df = shape.before_year(
        spark.read.parquet(stored).withColumn("fecha", F.col("ingreso")), "fecha", date(2021, 5, 1)
    )
    assert re.search(r"PushedFilters: \[.*LessThan\(ingreso,2021-01-01", plan(df))


def test_marks_of_a_table_come_from_one_scan(spark, stored):
    source = spark.read.parquet(stored).select("clientid", F.col("ingreso").alias("updateat"))
    target = spark.read.parquet(stored).select("clientid", F.col("ingreso").alias("create_at"))
    df = merge.pending_table(source, target, "clientid", "clientid")
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    subqueries = set(re.findall(r"Subquery (?:subquery|scalar-subquery)#(\d+)", final))
    aggregates = set(re.findall(r"partial_max\((\w+#\d+)", final))
    assert len(aggregates) == 2 and len(subqueries) >= 1
    assert "mergedValue" in final


def test_latest_is_limited_before_its_shuffle(spark, stored):
    df = agg.latest(spark.read.parquet(stored), ["email"], "ingreso", "clientid")
    text = plan(df)
    assert re.search(r"WindowGroupLimit .* 1, Final", text)
    assert re.search(r"Exchange hashpartitioning\(email.*\n.*WindowGroupLimit .* 1, Partial", text)
    assert df.count() == 1


def test_top_rows_are_not_sorted_whole(spark, tables):
    assert "TakeOrderedAndProject" in plan(agg.recent(tables.runlog, 5))


def test_broadcast_only_up_to_the_bound(spark, stored, no_auto_broadcast):
    table = spark.read.parquet(stored)
    keys = table.where("clientid < 10").select("clientid")
    width = sizes.row_bytes(keys)
    few, many = sizes.measured(keys, 10 * width), sizes.measured(keys, 10 * width - 1)
    assert sizes.threshold(spark) == -1 and not sizes.is_small(keys)
    assert "BroadcastHashJoin" in plan(table.join(few, "clientid", "left_semi"))
    assert "SortMergeJoin" in plan(table.join(many, "clientid", "left_semi"))
    found = table.where(joins.listed_or(F.col("clientid") > 3990, "clientid", few))
    assert re.search(r"BroadcastHashJoin .*ExistenceJoin", plan(found))
    assert found.count() == 19


def test_long_texts_are_not_small(spark, no_auto_broadcast):
    rows_ = sizes.frozen(spark.range(10).select("id", F.repeat(F.lit("x"), 100_000).alias("text")))
    assert sizes.byte_size(rows_) >= 1_000_000
    assert sizes.is_small(rows_, 1_100_000) and not sizes.is_small(rows_, 900_000)
    assert sizes.is_small(sizes.frozen(spark.range(0)), 0)


def test_the_load_of_a_month_is_a_plan_only(spark, tables):
    from workload.basic import AT, sources

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "")
    try:
        coll.load_month(sources(tables), tables.colleclog, tables.history_target, 202401, AT)
        assert not tracker.getJobIdsForGroup("plan-only")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_small_merge_does_not_shuffle_the_table(spark, stored, no_auto_broadcast):
    table = spark.read.parquet(stored)
    new = sizes.frozen(table.where("clientid > 3995").withColumn("email", F.lit("y")))
    text = plan(merge.upsert(table, new, ["clientid"], small_source=True))
    # the join that keeps the wide rows of the table broadcasts the new ones
    wide = text.split("SortMergeJoin")[0]
    assert re.search(r"BroadcastHashJoin \[clientid#\d+L\], \[clientid#\d+L\], LeftOuter, BuildRight", wide)
    assert "Exchange hashpartitioning" not in wide


def test_a_merge_prunes_months(spark, tmp_path):
    root = str(tmp_path / "t")
    base = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 10).cast("int").alias("ym"))
    sync.sync_by_month(root, base, ["k"], "ym")
    some = current(spark, root, "ym").where(F.col("ym").isin(3, 4))
    assert re.search(r"PartitionFilters: \[.*ym#\d+ IN \(3,4\)", plan(some))
    done = sync.sync_by_month(root, base.where("k = 13"), ["k"], "ym")
    assert done == [3]
    assert current(spark, root, "ym").count() == 100


def test_deleting_reads_keys_only(spark, tables, no_auto_broadcast):
    t = tables
    bad = cleanup.suspect_requests(t.requested_target, t.redeems, date(2001, 7, 1))
    assert "o_totalprice" not in plan(bad)


# --- hot keys


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one client and one payment."""
    n = 120_000
    return spark.range(0, n, 1, 8).select(
        F.col("id").alias("indice"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).cast("bigint").alias("clientid"),
        F.when(F.col("id") % 3 == 0, 11).otherwise(F.col("id")).cast("bigint").alias("pagoid"),
        F.expr("timestamp_ntz '2020-01-01' + make_interval(0, 0, 0, cast(id % 900 as int))").alias("fcorreo"),
        F.lit(None).cast("date").alias("inicio_r"),
        F.repeat(F.sha2(F.col("id").cast("string"), 256), 4).alias("currency"),
        F.lit(1).alias("status_r"),
    )


@pytest.fixture
def eager_to_split(spark):
    """AQE as on a cluster, with thresholds that fit a small table."""
    with conf(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="256k",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="512k",
        adaptive__skewJoin__skewedPartitionFactor="2",
    ):
        yield


def test_a_hot_client_is_split(spark, hot, eager_to_split):
    clients = spark.range(5000).select(F.col("id").alias("clientid"), F.lit("c").alias("name"))
    joined = joins.enrich(hot, clients, "clientid")
    assert len(joined.collect()) == 120_000
    assert "skew=true" in plan(joined)


def test_a_hot_client_is_split_where_an_aggregate_meets_it(spark, hot, eager_to_split):
    first = {
        r.clientid: r.first
        for r in hot.groupBy("clientid").agg(F.to_date(F.min("fcorreo")).alias("first")).collect()
    }
    done = gold.set_first_request(hot)
    got = done.collect()
    assert "skew=true" in plan(done)
    assert len(got) == 120_000
    assert all(r.inicio_r == first[r.clientid] for r in got)
    # without the second key the same join is not split
    plain = hot.join(hot.groupBy("clientid").agg(F.min("fcorreo").alias("f")), "clientid", "left")
    plain.collect()
    assert "skew=true" not in plan(plain)


@pytest.mark.parametrize("some", [joins.exists_in, joins.missing_in])
def test_a_hot_key_is_split_in_existence_checks(spark, hot, eager_to_split, some):
    keys = spark.range(0, 5000, 7).withColumnRenamed("id", "clientid")
    found = some(hot, keys, "clientid", hot=True)
    n = len(found.collect())
    want = hot.where("clientid % 7 = 0" if some is joins.exists_in else "clientid % 7 <> 0").count()
    assert n == want == some(hot, keys, "clientid").count()
    assert "skew=true" in plan(found)


def test_a_hot_payment_sends_one_row_per_task(spark, hot, no_auto_broadcast):
    from tidemark.plans.facts import client_dims, request_counts, request_of_payment

    clients = spark.range(5000).selectExpr("id as clientid", "1 as dppaidin", "1 as company")
    devs = spark.createDataFrame([(1, 1)], "iddev int, idcorp int")
    one = request_of_payment(hot, client_dims(clients, devs), "inner")
    assert "1, Partial" in plan(one)
    # payment 11 is named by every third request, and by request 11 itself
    assert rows(one.where("indice = 11"), "indice", "clientid") == [(11, 7)]
    assert one.count() == hot.select("pagoid").distinct().count()
    counts = {r.indice: r.requests for r in request_counts(hot).where("requests > 1").collect()}
    assert counts == {11: 40_001}


def test_missing_and_existing_keys_with_a_hot_other_side(spark, hot, no_auto_broadcast):
    payments = spark.range(20).withColumnRenamed("id", "indice")
    there = {r.pagoid for r in hot.select("pagoid").distinct().collect()}
    assert rows(joins.exists_in(payments, hot, "indice", "pagoid")) == sorted(
        [(k,) for k in range(20) if k in there], key=repr
    )
    assert rows(joins.missing_in(payments, hot, "indice", "pagoid")) == sorted(
        [(k,) for k in range(20) if k not in there], key=repr
    )


def test_last_change_of_a_hot_collection(spark, hot):
    log = hot.select(
        F.col("indice").alias("id"),
        F.lit(1).cast("bigint").alias("cardcollec_id"),
        F.lit("UPDATE").alias("reg"),
        F.expr("timestamp_ntz '2024-01-05' + make_interval(0, 0, 0, 0, 0, 0, indice)").alias("fecha"),
        F.col("indice").cast("decimal(18,6)").alias("monto"),
        F.lit(1).alias("statusc"),
        F.expr("timestamp_ntz '2023-05-05'").alias("fcobrado"),
        F.lit("USD").alias("currency"),
        F.lit("CC").alias("pay_method"),
    )
    last = coll.last_changes(log, 202401)
    assert [int(r.monto) for r in last.collect()] == [119_999]
