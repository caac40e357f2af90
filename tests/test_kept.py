"""State kept between loads follows the table, and says what a full run says."""

import random
import re
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tidemark.operators import asof, extremes, intervals, load, merge, profiles, totals
from tidemark.plans import collections as coll
from tidemark.plans import daily, kept, runlog, sync
from tidemark.sources import keyed
from tidemark.sources.snapshots import current
from tidemark.streaming import changes

AT = datetime(2001, 7, 20, 5, 30)


def keys_of(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k long")


# --- runs


@pytest.mark.parametrize("seed", range(3))
def test_runs_hold_exactly_their_keys(spark, seed):
    rng = random.Random(seed)
    keys = [rng.randint(-40, 400) for _ in range(300)] + [5] * 40
    found = intervals.runs(keys_of(spark, keys + [None]), "k", 16).collect()
    assert sorted(k for r in found for k in range(r.lo, r.hi + 1)) == sorted(set(keys))
    assert sum(r.n for r in found) == len(keys)
    assert all(r.lo // 16 == r.hi // 16 for r in found)
    parts = [intervals.runs(keys_of(spark, keys[i::3]), "k", 16) for i in range(3)]
    one = intervals.merged(parts[0].unionByName(parts[1]).unionByName(parts[2]), 16)
    assert rows(one) == rows(intervals.runs(keys_of(spark, keys), "k", 16))
    holes = intervals.holes(one, 16).collect()
    bins = {k // 16 for k in keys}
    assert {k for r in holes for k in range(r.lo, r.hi + 1)} == {k for b in bins for k in range(16 * b, 16 * b + 16)} - set(keys)


@pytest.mark.parametrize("seed", range(3))
def test_missing_keys_are_those_of_the_anti_join(spark, seed):
    rng = random.Random(seed)
    source = keys_of(spark, [rng.randint(0, 500) for _ in range(400)])
    target = keys_of(spark, rng.sample(range(450), 300))
    held = intervals.runs(target, "k", 32)
    assert rows(load.missing_keys_by_runs(source, held, "k", 32)) == rows(load.missing_keys(source, target, "k"))


def test_recorded_keys_are_read_instead_of_the_target(spark, tmp_path):
    root, table = str(tmp_path / "runs"), str(tmp_path / "target")
    for number, part in ((1, range(100)), (2, range(150, 5000)), (2, range(150, 5000))):
        kept.record_keys(root, keys_of(spark, part), "k", number)
    keys_of(spark, range(5000)).write.parquet(table)
    source = spark.read.parquet(table)
    missing = kept.repair(source, root, "k", AT)
    assert [r[0] for r in rows(missing, "k")] == list(range(100, 150))
    # the table, which is the source as well here, is read once, as the source
    assert plan(missing).count("/target]") == 1
    assert kept.held_keys(spark, root).agg(F.sum("n")).first()[0] == 4950
    assert kept.repair(source.where("k > 0"), str(tmp_path / "none"), "k", AT).isEmpty()


def test_loads_keep_their_keys_and_repairs_read_nothing_else(spark, tmp_path, monkeypatch):
    root, runs, path = (str(tmp_path / n) for n in ("table", "runs", "source"))
    spark.range(1, 3001).select(F.col("id").alias("k"), F.lit("x").alias("v")).write.parquet(path)
    source = spark.read.parquet(path)
    gap = "k not between 500 and 520 and k <= 2000"
    assert kept.append_recorded(source.where(gap), root, runs, "k", AT).count() == 1979
    # a job that died before it recorded its load
    sync.append_load(source.where("k <= 2500 and k <> 2222"), root, "k", AT)
    assert kept.held_keys(spark, runs).agg(F.sum("n")).first()[0] == 1979
    good = kept.repair_missing_by_runs
    plans = []
    monkeypatch.setattr(kept, "repair_missing_by_runs", lambda *a, **k: plans.append(good(*a, **k)) or plans[-1])
    fixed = kept.repair_recorded(source, root, runs, "k", AT)
    assert sorted(r.k for r in fixed.collect()) == [*range(500, 521), 2222]
    assert "/table/" not in plan(plans[0])
    assert kept.repair_recorded(source, root, runs, "k", AT).count() == 0
    assert sorted(r.k for r in current(spark, root, "load").collect()) == list(range(1, 2501))
    assert kept.catch_up(spark, root, runs, "k") == []


# --- signed changes, totals, extremes

TABLE = "k long, c long, ym int, d date, m decimal(10,2)"


def random_table(rng, n=60):
    return {
        k: (k, rng.randint(0, 6), 200001 + rng.randint(0, 5), date(2000, 1, 1) + timedelta(rng.randint(0, 40)),
            None if rng.random() < 0.2 else Decimal(rng.randint(0, 99)))
        for k in rng.sample(range(100), n)
    }


@pytest.mark.parametrize("seed", range(4))
def test_totals_and_extremes_equal_a_recount(spark, seed):
    rng = random.Random(seed)
    old, new = random_table(rng), random_table(rng, 30)
    bad = rng.sample(sorted(old | new), 20)
    frame = lambda t: spark.createDataFrame(list(t.values()), TABLE)
    before, after = frame(old), frame({k: r for k, r in (old | new).items() if k not in bad})
    cols = ["c", "ym", "d", "m"]
    loaded = merge.upsert(before, frame(new), ["k"])
    signed = merge.captured(before, frame(new), ["k"], cols)
    signed = signed.unionByName(merge.removed(loaded, keys_of(spark, bad), ["k"], cols))

    by, sums = [F.col("ym")], {"m": F.col("m")}
    both = totals.signed_totals(before, by, sums).unionByName(totals.signed_totals(signed, by, sums))
    found = totals.shown(totals.added_up(both, ["ym"]), ["m"])
    assert rows(found) == rows(totals.shown(totals.signed_totals(after, by, sums), ["m"]))

    kept_ = extremes.extremes(before, "c", "d")
    assert rows(extremes.after_changes(kept_, signed, after, "c", "d")) == rows(extremes.extremes(after, "c", "d"))


def test_only_real_changes_are_captured(spark):
    old = spark.createDataFrame([(1, 1, 200001, None, None), (2, 1, 200001, None, Decimal(5))], TABLE)
    new = spark.createDataFrame([(1, 1, None), (2, 1, Decimal(6)), (2, 1, Decimal(7)), (3, 2, None)], "k long, c long, m decimal(10,2)")
    got = merge.captured(old, new, ["k"], ["c", "ym", "m"], order=[F.desc("m")])
    assert rows(got, "k", "_sign", "c", "ym", "m") == [
        (2, -1, 1, 200001, Decimal("5.00")), (2, 1, 1, 200001, Decimal("7.00")), (3, 1, 2, None, None),
    ]


def test_clients_that_lose_no_extreme_are_not_recounted(spark):
    table = spark.createDataFrame(
        [(k, k % 5, 200001, date(2000, 1, 1) + timedelta(k), None) for k in range(100)], TABLE
    )
    gone = table.where("k = 52")  # neither first nor last of client 2
    signed = merge.removed(table, gone, ["k"], ["c", "d"])
    never = table.where("k <> 52").withColumn("d", F.raise_error(F.lit("read again")).cast("date"))
    found = extremes.after_changes(extremes.extremes(table, "c", "d"), signed, never, "c", "d")
    assert rows(found) == rows(extremes.extremes(table.where("k <> 52"), "c", "d"))


def test_recorded_totals_count_a_repeated_load_once(spark, tmp_path):
    root = str(tmp_path / "totals")
    by, sums = {"ym": F.col("ym")}, {"m": F.col("m")}
    assert kept.totals(spark, root, ["ym"]) is None
    first = spark.createDataFrame([(1, 1, 200001, None, Decimal(5))], TABLE)
    moved = spark.createDataFrame([(1, 1, 200002, None, Decimal(6))], TABLE)
    kept.record_totals(root, first, by, sums, 1)
    for _ in range(2):
        kept.record_totals(root, merge.captured(first, moved, ["k"], ["ym", "m"]), by, sums, 2)
    found = totals.shown(kept.totals(spark, root, ["ym"]), ["m"])
    assert rows(found, "ym", "cnt", "m") == [(200002, 1, Decimal("6.000000"))]


# --- the log as a stream


@pytest.mark.parametrize("files_per_batch", [1, 3, 100])
def test_any_batch_size_folds_to_the_last_changes(spark, tables, tmp_path, files_per_batch):
    log, ym = tables.colleclog, 202401
    base = str(tmp_path)
    log.repartition(7).write.parquet(f"{base}/log")

    def run():
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", files_per_batch)
        changes.fold_changes(stream.parquet(f"{base}/log"), f"{base}/last", f"{base}/check").awaitTermination()
        return rows(changes.folded_changes(spark, f"{base}/last", ym))

    expected = rows(coll.last_changes(log, ym))
    assert run() == expected and len(expected) > 100
    assert run() == expected  # nothing new
    # a later and an earlier change of one collection arrive in a later file
    one = changes.counted_changes(log).where(F.col("ym") == ym).orderBy("id").limit(1)
    one = one.withColumn("monto", (F.col("monto") + 1).cast("decimal(18,6)"))
    late, old = (
        one.withColumns({"id": F.col("id") + 10**9 + i, "fecha": F.lit(f"2024-01-{day} 23:30:00").cast("timestamp_ntz")})
        for i, day in enumerate(("31", "01"))
    )
    late.unionByName(old).select(log.columns).coalesce(1).write.mode("append").parquet(f"{base}/log")
    everything = spark.read.schema(log.schema).parquet(f"{base}/log")
    assert run() == rows(coll.last_changes(everything, ym)) != expected


def test_a_load_from_folded_changes_is_that_from_the_log(spark, tables, tmp_path):
    t, ym, base = tables, 202401, str(tmp_path)
    sources = coll.Sources(t.cardcollec, t.tickets, t.ticket_items, t.clients, t.developers)
    t.colleclog.write.parquet(f"{base}/log")
    stream = spark.readStream.schema(t.colleclog.schema).parquet(f"{base}/log")
    changes.fold_changes(stream, f"{base}/last", f"{base}/check").awaitTermination()
    folded = changes.folded_changes(spark, f"{base}/last", ym)
    found = []
    for name, log, last in (("a", t.colleclog, None), ("b", t.colleclog.limit(0), folded)):
        daily.load_collections(f"{base}/{name}", sources, t.colleclog, AT, 199501, 199912)
        daily.load_collections(f"{base}/{name}", sources, log, AT, ym, last=last)
        found.append(rows(current(spark, f"{base}/{name}", "aniomes").drop("aniomes")))
    assert found[0] == found[1] and len(found[0]) > 100


def test_only_the_month_asked_for_is_read(spark, tables, tmp_path):
    base = str(tmp_path)
    tables.colleclog.write.parquet(f"{base}/log")
    stream = spark.readStream.schema(tables.colleclog.schema).parquet(f"{base}/log")
    changes.fold_changes(stream, f"{base}/last", f"{base}/check").awaitTermination()
    assert re.search(r"PartitionFilters: \[isnotnull\(ym#\d+\), \(ym#\d+ = 202401\)", plan(changes.folded_changes(spark, f"{base}/last", 202401)))


# --- key tables, overlaps, profiles, rates


def test_the_target_is_not_shuffled(spark, tmp_path):
    from tests.test_plans import conf

    target = spark.range(2000).select(F.col("id").alias("contador"), F.lit(AT).cast("timestamp_ntz").alias("update_at"))
    source = spark.range(2500).select(F.col("id").alias("indice"), F.lit(AT).cast("timestamp_ntz").alias("updateat"))
    held = keyed.write_keys(target, "keys_of_requested", "contador", "update_at", buckets=8, path=str(tmp_path / "keys"))
    with conf(spark, autoBroadcastJoinThreshold="-1", shuffle__partitions="8"):
        found = merge.pending_row(source, held, "indice", "contador")
        text = plan(found)
        assert [r[0] for r in rows(found, "indice")] == list(range(2000, 2500))
    assert text.count("Exchange hashpartitioning") == 1
    side = text[text.index("FileScan parquet") - 400 :]
    assert "Exchange" not in side and "Bucketed: true" in text
    spark.sql("drop table keys_of_requested")


def test_overlaps_against_all_pairs(spark):
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    log = []
    for i in range(120):
        a = start + timedelta(minutes=rng.randint(0, 2000))
        b = None if rng.random() < 0.1 else a + timedelta(minutes=rng.choice((0, 1, 30, 60, 400)))
        log.append((i, rng.choice(("x", "y", None)), a, b))
    df = spark.createDataFrame(log, "id long, tabla_destino string, fecha_inicio timestamp_ntz, fecha_fin timestamp_ntz")
    df = df.withColumn("estado", F.when(F.col("fecha_fin").isNull(), "RUNNING").otherwise("OK"))
    # as the log has it: a row of the start, too
    df = df.unionByName(df.withColumns({"estado": F.lit("RUNNING"), "fecha_fin": F.lit(None).cast("timestamp_ntz")}))
    for until in (None, start + timedelta(minutes=2500)):
        runs = [(i, t, a, b or until) for i, t, a, b in log if t and (b or until) and (b or until) > a]
        expected = [
            (t, i, j, c, min(b, d))
            for i, t, a, b in runs
            for j, u, c, d in runs
            if t == u and (a, i) < (c, j) and c < b
        ]
        for hours in (1, 6):
            assert rows(runlog.overlaps(df, until=until, hours=hours)) == sorted(expected, key=repr)


def test_overlaps_deal_out_earlier_runs_only(spark):
    start = datetime(2024, 1, 1)
    log = [(i, "x", start + timedelta(minutes=7 * (i // 2)), start + timedelta(minutes=7 * i + 90)) for i in range(30)]
    log.append((None, "x", start, start + timedelta(minutes=5)))
    df = spark.createDataFrame(log, "id long, tabla_destino string, fecha_inicio timestamp_ntz, fecha_fin timestamp_ntz")
    df = df.withColumn("estado", F.lit("OK"))
    plain, text = runlog.overlaps(df), runlog.overlaps(df, text=True)
    assert plan(text).count("Generate explode") == 1 and "BroadcastHashJoin" not in plan(text)
    assert rows(text) == rows(plain.withColumns({c: F.col(c).cast("string") for c in ("desde", "hasta")}))
    # a run without a number is the earlier one of those that start together
    assert [(None, 0), (None, 1)] == [(r[1], r[2]) for r in rows(plain) if r[1] is None]


def test_overlaps_of_one_hour_are_dealt_out(spark):
    start = datetime(2024, 1, 1)
    log = [(i, "x", start + timedelta(seconds=i % 90), start + timedelta(seconds=i % 90 + 1 + 47 * i % 5000)) for i in range(120)]
    log += [(None, "x", start, start + timedelta(seconds=40)), (200, "x", start - timedelta(hours=3), start + timedelta(hours=2))]
    df = spark.createDataFrame(log, "id long, tabla_destino string, fecha_inicio timestamp_ntz, fecha_fin timestamp_ntz")
    df = df.withColumn("estado", F.lit("OK"))
    runs = sorted(log, key=lambda r: (r[2], -1 if r[0] is None else r[0]))
    expected = [
        ("x", x[0], y[0], y[2], min(x[3], y[3]))
        for i, x in enumerate(runs) for y in runs[i + 1 :] if y[2] < x[3]
    ]
    for part in (1, 7, 1000):
        assert rows(runlog.overlaps(df, part=part)) == sorted(expected, key=repr)
    tasks = lambda found: found.groupBy(F.spark_partition_id()).count().count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert tasks(runlog.overlaps(df)) == 1 and tasks(runlog.overlaps(df, part=7)) > 3
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_profiles_add_up(spark):
    df = spark.range(20_000).select((F.col("id") % 12).alias("mes"), F.when(F.col("id") % 10 > 0, F.col("id") % 3000).alias("v"))
    months = profiles.profile(df, [F.col("mes")], ["v"])
    year = profiles.read(profiles.merged(months, [F.lit(1).alias("anio")], ["v"]), ["v"]).first()
    assert (year.total_registros, year.null_v) == (20_000, 2_000)
    exact = df.agg(F.count_distinct("v")).first()[0]
    assert abs(year.distinct_v - exact) < 0.05 * exact


def test_last_rate_against_a_loop(spark):
    rng = random.Random(2)
    day = lambda: date(2000, 1, 1) + timedelta(rng.randint(0, 200))
    rates = [(rng.choice("ab"), day(), rng.choice((None, rng.randint(1, 9)))) for _ in range(25)]
    mine = [(i, rng.choice(("a", "b", "c", None)), rng.choice((None, day(), day(), day()))) for i in range(200)]
    df = spark.createDataFrame(mine, "i long, cur string, on date")
    table = spark.createDataFrame(rates, "cur string, desde date, rate int")

    def held(cur, on):
        fits = [(d, r) for c, d, r in rates if r is not None and on is not None and c == cur and d <= on]
        return max(fits)[1] if fits else None

    expected = sorted([(i, held(c, d)) for i, c, d in mine], key=repr)
    for period in ("month", "year", "week"):
        found = asof.last_before(df, table, "cur", "on", "desde", "rate", period)
        assert rows(found, "i", "rate") == expected
