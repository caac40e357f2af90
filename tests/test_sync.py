"""Stored tables: what a load leaves behind, also when it fails or runs twice."""

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.aggregates import one_per_key
from tidemark.operators.cleanup import delete_keys, suspect_requests
from tidemark.operators.load import missing_keys
from tidemark.operators.merge import pending_row
from tidemark.operators.shape import authorized, paid, requested
from tidemark.plans import collections as coll
from tidemark.plans import daily, recon, sync
from tidemark.plans.facts import request_counts
from tidemark.sources import snapshots
from tidemark.sources.snapshots import current, publish

AT = datetime(2001, 7, 20, 5, 30)
ASOF = date(2001, 7, 1)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "table")


def test_a_failed_refresh_keeps_the_old_table(spark, root):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "clientid long, phone string")
    sync.refresh_table(old, root, AT)
    broken = old.withColumn("phone", F.raise_error(F.lit("lost the source")).cast("string"))
    with pytest.raises(PySparkException):
        sync.refresh_table(broken, root, AT)
    assert rows(current(spark, root), "clientid", "phone") == [(1, "a"), (2, "b")]
    sync.refresh_table(old.where("clientid = 2"), root, AT)
    assert rows(current(spark, root), "clientid") == [(2,)]


def test_a_product_is_refreshed_alone(spark, root):
    for product, phone in (("x", "1"), ("y", "2"), ("x", "3")):
        df = spark.createDataFrame([(1, phone)], "clientid long, phone string")
        sync.refresh_product(df, root, AT, product)
    assert rows(current(spark, root, "product"), "product", "phone") == [("x", "3"), ("y", "2")]


def test_rows_of_other_partitions_are_refused(spark, root):
    df = spark.createDataFrame([(1, 200001), (2, 200002)], "k long, ym int")
    with pytest.raises(ValueError):
        publish(df, root, "ym", [200001])
    assert current(spark, root, "ym") is None
    publish(df, root, "ym")
    with pytest.raises(ValueError):
        publish(df, root, "ym")
    assert current(spark, root, "ym").count() == 2


def test_appends_and_repair_give_a_full_copy(spark, root):
    source = spark.range(100).withColumnRenamed("id", "clientid").withColumn("name", F.lit("n"))
    first = source.where("clientid < 60 and clientid % 7 <> 0")
    sync.append_load(first, root, "clientid", AT, 1)
    assert sync.append_load(source, root, "clientid", AT, 2).count() == 40
    with pytest.raises(ValueError, match="load 2 is there"):
        sync.append_load(source, root, "clientid", AT, 2)
    table = current(spark, root, "load")
    assert table.count() == table.select("clientid").distinct().count()
    # 0 is not above the watermark of an empty table, so it was never loaded either
    assert rows(missing_keys(source, table, "clientid")) == [(k,) for k in (0, 14, 21, 28, 35, 42, 49, 56, 7)]
    with pytest.raises(ValueError, match="load 1 is there"):
        sync.repair_load(source, root, "clientid", AT, 1)
    assert current(spark, root, "load").count() == table.count()
    assert sync.repair_load(source, root, "clientid", AT).first()["load"] == 3
    table = current(spark, root, "load")
    assert rows(table, "clientid") == rows(source, "clientid")
    assert table.where("createdat is null").count() == 0


def test_loads_without_rows(spark, root, tmp_path):
    source = spark.createDataFrame([], "clientid long, name string")
    assert sync.append_load(source, root, "clientid", AT, 1).count() == 0
    some = spark.createDataFrame([(5, "a")], "clientid long, name string")
    assert rows(sync.append_load(some, root, "clientid", AT, 2), "clientid", "load") == [(5, 2)]
    assert sync.append_load(some, root, "clientid", AT, 3).count() == 0
    assert current(spark, root, "load").count() == 1
    facts_ = str(tmp_path / "facts")
    none = spark.createDataFrame([], "k long, ym int")
    assert sync.sync_by_month(facts_, none, ["k"], "ym") == []
    assert sync.sync_by_month(facts_, none, ["k"], "ym") == []
    one = spark.createDataFrame([(1, 7)], "k long, ym int")
    assert sync.sync_by_month(facts_, one, ["k"], "ym") == [7]
    assert sync.sync_by_month(facts_, none, ["k"], "ym") == []
    assert rows(current(spark, facts_, "ym")) == [(1, 7)]


def test_a_repair_before_any_load(spark, root):
    source = spark.createDataFrame([(5, "a")], "clientid long, name string")
    assert sync.repair_load(source, root, "clientid", AT).count() == 0
    assert rows(sync.append_load(source, root, "clientid", AT), "clientid", "load") == [(5, 2)]


def test_the_watermark_comes_from_the_commits(spark, root, monkeypatch):
    source = spark.createDataFrame([(5, "a"), (9, "b")], "clientid long, name string")
    sync.append_load(source, root, "clientid", AT)
    assert snapshots.state(spark, root).parts["load=1"].mark == 9
    monkeypatch.setattr(sync, "max_key", lambda df, key: good(df.where("name = 'c'"), key))
    good = __import__("tidemark.operators.aggregates", fromlist=["max_key"]).max_key
    more = source.unionByName(spark.createDataFrame([(12, "c")], source.schema))
    assert rows(sync.append_load(more, root, "clientid", AT), "clientid") == [(12,)]


def test_products_are_appended_above_their_own_marks(spark, root):
    schema = "clientid long, product string"
    first = spark.createDataFrame([(5, "x"), (9, "y")], schema)
    assert sync.append_product_load(first, root, "clientid", AT, ["x", "y", "z"]).count() == 2
    more = first.unionByName(spark.createDataFrame([(6, "x"), (8, "y"), (1, "z"), (7, "w")], schema))
    added = sync.append_product_load(more, root, "clientid", AT, ["x", "y", "z"])
    assert rows(added, "clientid", "product") == [(1, "z"), (6, "x")]
    assert sync.append_product_load(more, root, "clientid", AT, ["x", "y", "z"]).count() == 0


def test_a_new_column_is_an_error(spark, root):
    sync.sync_by_month(root, spark.createDataFrame([(1, 7)], "k long, ym int"), ["k"], "ym")
    with pytest.raises(ValueError, match="extra"):
        sync.sync_by_month(root, spark.createDataFrame([(1, 7, 2)], "k long, ym int, extra int"), ["k"], "ym")
    assert rows(current(spark, root, "ym")) == [(1, 7)]


def _between(monkeypatch, act):
    """Run ``act`` after a sync has read its table and before it writes."""
    good = sync.upsert

    def late(*args, **kwargs):
        monkeypatch.setattr(sync, "upsert", good)
        act()
        return good(*args, **kwargs)

    monkeypatch.setattr(sync, "upsert", late)


def test_overlapping_syncs_lose_nothing(spark, root, monkeypatch):
    schema = "k long, v string, ym int"
    make = lambda *r: spark.createDataFrame(list(r), schema)
    sync.sync_by_month(root, make((1, "a", 1), (2, "b", 2)), ["k"], "ym")
    _between(monkeypatch, lambda: sync.sync_by_month(root, make((3, "c", 1)), ["k"], "ym"))
    with pytest.raises(snapshots.StaleTable, match="ym=1"):
        sync.sync_by_month(root, make((4, "d", 1)), ["k"], "ym")
    assert rows(current(spark, root, "ym"), "k") == [(1,), (2,), (3,)]
    sync.sync_by_month(root, make((4, "d", 1)), ["k"], "ym")
    # runs on different months do not disturb each other, whoever commits first
    _between(monkeypatch, lambda: sync.sync_by_month(root, make((5, "e", 2)), ["k"], "ym"))
    sync.sync_by_month(root, make((6, "f", 1)), ["k"], "ym")
    assert rows(current(spark, root, "ym"), "k") == [(k,) for k in range(1, 7)]


def _before_a_commit(monkeypatch, act):
    """Run ``act`` after a writer has checked the table and before its commit appears."""
    good = snapshots._Folder.put_new

    def late(self, path, text):
        monkeypatch.setattr(snapshots._Folder, "put_new", good)
        act()
        return good(self, path, text)

    monkeypatch.setattr(snapshots._Folder, "put_new", late)


def test_a_commit_between_check_and_write_is_not_lost(spark, root, monkeypatch):
    make = lambda k, ym: spark.createDataFrame([(k, ym)], "k long, ym int")
    publish(make(1, 1), root, "ym")
    # another month: both commits count
    _before_a_commit(monkeypatch, lambda: publish(make(2, 2), root, "ym", [2], base=1))
    publish(make(3, 3), root, "ym", [3], base=1)
    assert rows(current(spark, root, "ym"), "k") == [(1,), (2,), (3,)]
    assert snapshots.state(spark, root).commit == 3
    # the same month: the second one is refused, and what the first one wrote stays
    _before_a_commit(monkeypatch, lambda: publish(make(4, 1), root, "ym", [1], base=3))
    with pytest.raises(snapshots.StaleTable, match="ym=1"):
        publish(make(5, 1), root, "ym", [1], base=3)
    assert rows(current(spark, root, "ym"), "k") == [(2,), (3,), (4,)]


def test_many_writers_at_a_time(spark, root):
    publish(spark.createDataFrame([(0, 0)], "k long, ym int"), root, "ym")
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda k: publish(spark.createDataFrame([(k, k)], "k long, ym int"), root, "ym", [k]), range(1, 13)))
    assert sorted(r[0] for r in rows(current(spark, root, "ym"), "k")) == list(range(13))
    assert snapshots.state(spark, root).commit == 13


def test_reading_looks_at_few_folders(spark, root, monkeypatch):
    schema = "k long, ym int"
    for k in range(3):
        publish(spark.createDataFrame([(k, k)], schema), root, "ym", [k])
    folder = snapshots._Folder(spark, root)
    parts = snapshots.state(spark, root).parts
    for n in range(4, 1004):  # a thousand commits of one month
        parts["ym=1"] = parts["ym=1"]._replace(commit=n)
        folder.write(f"{root}/{snapshots.COMMITS}/{n}", json.dumps(parts))
    calls = []
    for name in ("names", "read"):
        good = getattr(snapshots._Folder, name)
        monkeypatch.setattr(snapshots._Folder, name, lambda self, p, f=good: calls.append(p) or f(self, p))
    assert rows(current(spark, root, "ym"), "k") == [(0,), (1,), (2,)]
    assert len(calls) == 2


def test_expiry_keeps_what_holds_a_partition(spark, root):
    make = lambda k, ym: spark.createDataFrame([(k, ym)], "k long, ym int")
    publish(make(1, 1).unionByName(make(2, 2)), root, "ym")
    for k in range(3, 9):
        publish(make(k, 1), root, "ym", [1])
    assert snapshots.expire(spark, root, keep=2, older_than=3600) == []
    gone = snapshots.expire(spark, root, keep=2)
    assert f"{root}/snapshot=1/ym=1" in gone and f"{root}/snapshot=1" not in gone
    assert rows(current(spark, root, "ym"), "k", "ym") == [(2, 2), (8, 1)]
    assert sorted(snapshots._versions(snapshots._Folder(spark, root), root)) == [1, 6, 7]
    assert snapshots.expire(spark, root, keep=2) == []


def test_a_row_that_moves_empties_its_month(spark, root):
    schema = "k long, v string, ym int"
    sync.sync_by_month(root, spark.createDataFrame([(1, "a", 1), (2, "b", 2)], schema), ["k"], "ym")
    done = sync.sync_by_month(root, spark.createDataFrame([(1, "c", 2)], schema), ["k"], "ym")
    assert done == [1, 2]
    assert rows(current(spark, root, "ym"), "k", "v", "ym") == [(1, "c", 2), (2, "b", 2)]
    assert current(spark, root, "ym", [1]) is None
    # a third run finds the empty month and fills it again
    sync.sync_by_month(root, spark.createDataFrame([(3, "d", 1)], schema), ["k"], "ym")
    assert rows(current(spark, root, "ym"), "k", "ym") == [(1, 2), (2, 2), (3, 1)]


def test_a_failed_sync_keeps_all_months(spark, root, monkeypatch):
    schema = "k long, v string, ym int"
    sync.sync_by_month(root, spark.createDataFrame([(1, "a", 1), (2, "b", 2)], schema), ["k"], "ym")

    def broken(*args, **kwargs):
        return good(*args, **kwargs).withColumn("v", F.raise_error(F.lit("disk")).cast("string"))

    good = sync.upsert
    monkeypatch.setattr(sync, "upsert", broken)
    with pytest.raises(PySparkException):
        sync.sync_by_month(root, spark.createDataFrame([(1, "z", 2)], schema), ["k"], "ym")
    assert rows(current(spark, root, "ym"), "k", "v", "ym") == [(1, "a", 1), (2, "b", 2)]


@pytest.mark.parametrize("small", [True, False])
def test_broadcast_and_shuffle_give_the_same(spark, root, monkeypatch, small):
    monkeypatch.setattr(sync, "is_small", lambda rows: small)
    base = spark.range(200).select(
        F.col("id").alias("k"), F.lit("old").alias("v"), (F.col("id") % 5).cast("int").alias("ym")
    )
    sync.sync_by_month(root, base, ["k"], "ym")
    new = spark.range(150, 260, 3).select(
        F.col("id").alias("k"), F.lit("new").alias("v"), ((F.col("id") + 1) % 5).cast("int").alias("ym")
    )
    sync.sync_by_month(root, new, ["k"], "ym")
    want = {k: ("old", k % 5) for k in range(200)}
    want |= {k: ("new", (k + 1) % 5) for k in range(150, 260, 3)}
    got = current(spark, root, "ym").select("k", "v", "ym")
    assert rows(got) == sorted(((k, *x) for k, x in want.items()), key=repr)


@pytest.fixture(scope="module")
def facts(spark, tables, tmp_path_factory):
    t = tables
    base = tmp_path_factory.mktemp("facts")
    roots = {n: str(base / n) for n in ("requested", "authorized", "paid")}
    # the first load is of what was there some months ago
    early = t.redeems.where("indice % 4 <> 0").withColumn("monto", (F.col("monto") + 1).cast("decimal(11,2)"))
    early = early.withColumn("updateat", F.to_timestamp_ntz(F.lit("1994-01-01 00:00:00")))
    daily.sync_requested(roots["requested"], early, t.clients, t.developers, datetime(2001, 1, 1))
    for _ in range(2):
        daily.sync_requested(roots["requested"], t.redeems, t.clients, t.developers, AT)
        daily.sync_authorized(roots["authorized"], t.payments, t.redeems, t.clients, t.developers, AT)
        daily.sync_paid(roots["paid"], t.payments, t.redeems, t.clients, t.developers, AT)
    return roots


def test_after_a_load_nothing_is_pending(spark, tables, facts):
    t = tables
    done = {n: current(spark, r, "aniomes") for n, r in facts.items()}
    asked = request_counts(t.redeems).select("indice")
    for name, rows_, key in (
        ("requested", requested(t.redeems), "contador"),
        ("authorized", authorized(t.payments).join(asked, "indice", "left_semi"), "contador"),
        ("paid", paid(t.payments).join(asked, "indice", "left_semi"), "pagoid"),
    ):
        for granularity in ("day", "timestamp"):
            left = pending_row(rows_, done[name], "indice", key, granularity=granularity)
            assert left.count() == 0
        assert done[name].count() == rows_.count() == done[name].select(key).distinct().count()


def test_after_a_load_counts_agree(spark, tables, facts):
    t = tables
    done = {n: current(spark, r, "aniomes") for n, r in facts.items()}
    # the audits count every request, a fact takes one per payment
    one = one_per_key(t.redeems.where("pagoid is not null"), ["pagoid"], [F.desc("indice")])
    for audit in (
        recon.recon_requested(t.redeems, done["requested"], ASOF, how="full"),
        recon.recon_authorized(t.payments, one, t.clients, done["authorized"], ASOF, how="full"),
        recon.recon_paid(t.payments, one, done["paid"], ASOF, how="full"),
    ):
        assert audit.count() > 60
        assert audit.where("diferencia <> 0").count() == 0


def test_a_first_load_time_is_kept(spark, facts):
    table = current(spark, facts["requested"], "aniomes")
    early = table.where("create_at = timestamp_ntz '2001-01-01 00:00:00'")
    assert rows(early.selectExpr("count(*) > 0", "count_if(contador % 4 = 0)")) == [(True, 0)]


def test_cleanup_leaves_nothing_to_clean(spark, tables, facts, tmp_path):
    t = tables
    # what support reverts at the source without touching the change time
    redeems = t.redeems.withColumn("status_r", F.when(F.col("indice") % 10 == 3, 0).otherwise(F.col("status_r")))
    redeems = redeems.withColumn("pagoid", F.when(F.col("indice") % 10 != 7, F.col("pagoid")))
    before = {n: current(spark, r, "aniomes") for n, r in facts.items()}
    args = (redeems, t.payments, ASOF)
    found = recon.cleanup_counts(*before.values(), *args).first()
    assert min(found.sol, found.aut, found.pag) > 0
    counts = {n: df.count() for n, df in before.items()}
    daily.clean_facts(facts, *args)
    after = {n: current(spark, r, "aniomes") for n, r in facts.items()}
    gone = [counts[n] - after[n].count() for n in ("requested", "authorized", "paid")]
    assert gone == [found.sol, found.aut, found.pag]
    assert recon.orphan_audit(*after.values(), *args).where("huerfanos <> 0").count() == 0
    # the current year is left alone
    for n in facts:
        kept = "anio = 2001"
        assert after[n].where(kept).count() == before[n].where(kept).count()


def test_history_by_month_and_by_range(spark, tables, tmp_path):
    t = tables
    s = coll.Sources(t.cardcollec, t.tickets, t.ticket_items, t.clients, t.developers)
    whole, stepwise = str(tmp_path / "a"), str(tmp_path / "b")
    daily.load_collections(whole, s, t.colleclog, AT, 200001, 200004)
    for ym in (200001, 200002, 200003, 200004):
        daily.load_collections(stepwise, s, t.colleclog, AT, ym)
    table = current(spark, whole, "aniomes")
    assert rows(table) == rows(current(spark, stepwise, "aniomes"), *table.columns)
    source = coll.collections(s, 200001, 200004)
    audit = recon.recon_amount(source, table)
    assert audit.count() == 4
    assert audit.where("diff_cnt <> 0 or diff_monto <> 0 or cnt_agente <> cnt_destino").count() == 0


def _history_source(spark, card):
    cards = spark.createDataFrame(
        card,
        "indice long, clientid long, fcobrado timestamp_ntz, statusc int, monto decimal(18,6), "
        "currency string, agente string, pay_method string",
    )
    none = "id long, ticket_id long, idcc long, tipodoc string, abono decimal(18,6)"
    return coll.Sources(
        cards,
        spark.createDataFrame([], "idticket long, reference_date timestamp_ntz"),
        spark.createDataFrame([], none),
        spark.createDataFrame([(1, 1, 1, 5)], "clientid long, dppaidin int, with_card int, company int"),
        spark.createDataFrame([(5, 50)], "iddev int, idcorp int"),
    )


def _card(k, day, amount, status=1, method="CC"):
    return (k, 1, datetime(*day), status, Decimal(amount), "USD", "ag", method)


LOG = (
    "id long, cardcollec_id long, reg string, fecha timestamp_ntz, monto decimal(18,6), statusc int, "
    "fcobrado timestamp_ntz, currency string, pay_method string"
)


def _change(n, k, at, day, amount, kind="UPDATE"):
    return (n, k, kind, datetime(*at), Decimal(amount), 1, datetime(*day), "USD", "CC")


def test_late_changes_reach_closed_months(spark, root):
    s = _history_source(spark, [_card(k, (2024, 1, 10), 100) for k in (1, 2, 3, 4)])
    empty = spark.createDataFrame([], LOG)
    daily.load_collections(root, s, empty, datetime(2024, 2, 1), 202401)
    # in March support changes 1 twice, back and forth; moves 2; touches 3 in vain; 9 is new
    now = [
        _card(1, (2024, 1, 10), 100),
        _card(2, (2024, 2, 5), 100),
        _card(3, (2024, 1, 10), 100),
        _card(4, (2024, 1, 10), 100),
        _card(9, (2024, 1, 20), 900),
    ]
    log = spark.createDataFrame(
        [
            _change(1, 1, (2024, 3, 1), (2024, 1, 10), 500),
            _change(2, 1, (2024, 3, 2), (2024, 1, 10), 100),
            _change(3, 2, (2024, 3, 3), (2024, 2, 5), 100),
            _change(4, 3, (2024, 3, 3), (2024, 1, 10), 100),
            _change(5, 9, (2024, 3, 3), (2024, 1, 20), 900),
            _change(6, 4, (2024, 2, 3), (2024, 1, 10), 400),  # not in March
            _change(7, 4, (2024, 3, 3), (2024, 1, 10), 400, "INSERT"),
        ],
        LOG,
    )
    history = current(spark, root, "aniomes")
    assert rows(coll.late_changes(log, history, 202403), "cardcollec_id") == [(2,), (9,)]
    later = datetime(2024, 4, 1)
    s = _history_source(spark, now)
    done = daily.load_collections(root, s, log, later, 202403)
    assert done == [202401, 202402]
    got = rows(current(spark, root, "aniomes"), "indice", "aniomes", "amount_bruta_usd", "updateat")
    assert got == [
        (1, 202401, Decimal("100.000000"), None),
        (2, 202402, Decimal("100.000000"), later),
        (3, 202401, Decimal("100.000000"), None),
        (4, 202401, Decimal("100.000000"), None),
        (9, 202401, Decimal("900.000000"), None),
    ]
    assert daily.load_collections(root, s, log, later, 202403) == []


def test_months_only_the_target_has(spark):
    redeems = spark.createDataFrame(
        [(1, 1, datetime(2020, 1, 5), 1), (2, 1, datetime(2020, 1, 9), 1)],
        "indice long, clientid long, fcorreo timestamp_ntz, status_r int",
    )
    target = spark.createDataFrame(
        [(1, date(2020, 1, 5), 2020, 1), (7, date(2020, 3, 1), 2020, 3), (8, date(2022, 1, 1), 2022, 1)],
        "contador long, fecha date, anio int, mes int",
    )
    asof = date(2021, 1, 1)
    left = recon.recon_requested(redeems, target, asof)
    full = recon.recon_requested(redeems, target, asof, how="full")
    january = (2020, 1, "Enero", 2, 1, 1)
    assert rows(left) == [january]
    assert rows(full) == [january, (2020, 3, "Marzo", 0, 1, -1)]
    # a client listed twice counts twice in a left join
    clients = spark.createDataFrame([(1,), (1,)], "clientid long")
    doubled = recon.recon_requested(redeems, target, asof, clients=clients)
    assert rows(doubled, "cant_origen") == [(4,)]


def test_soft_delete_sets_the_flag(spark):
    target = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "contador long, eliminado int")
    bad = spark.createDataFrame([(2,), (2,)], "contador long")
    assert rows(delete_keys(target, bad, "contador")) == [(1, 0), (3, 1)]
    assert rows(delete_keys(target, bad, "contador", soft=True)) == [(1, 0), (2, 1), (3, 1)]


def test_the_current_year_is_not_looked_at(spark):
    target = spark.createDataFrame(
        [(1, date(2023, 12, 31)), (2, date(2024, 1, 1)), (3, None)], "contador long, fecha date"
    )
    redeems = spark.createDataFrame(
        [(k, None, None) for k in (1, 2, 3)], "indice long, status_r int, fcorreo timestamp_ntz"
    )
    assert rows(suspect_requests(target, redeems, date(2024, 6, 1))) == [(1, True)]
