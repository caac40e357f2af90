"""Jobs that log themselves, and stored tables that are only written where something changed."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.plans import gold, jobs, runlog, sync
from tidemark.sources import snapshots
from tidemark.sources.snapshots import current, publish

AT = datetime(2001, 7, 20, 5, 30)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "table")


def test_a_job_logs_how_it_went(spark, tmp_path, root):
    log = str(tmp_path / "log")
    source = spark.createDataFrame([(5, "a"), (9, "b")], "clientid long, name string")
    append = lambda run: sync.append_load(source, root, "clientid", AT)
    assert jobs.logged(spark, log, "clients", append, key="clientid") == (2, 9)
    assert jobs.logged(spark, log, "clients", append, key="clientid") == (0, 0)
    with pytest.raises(ValueError, match="no source"):
        jobs.logged(spark, log, "clients", lambda run: (_ for _ in ()).throw(ValueError("no source")))
    seen = runlog.read_log(spark, log)
    assert seen.count() == 6 and seen.select("id").distinct().count() == 3
    got = runlog.ended(seen).orderBy("id").select("estado", "filas_insertadas", "max_id_inicio", "mensaje_error")
    assert [tuple(r) for r in got.collect()] == [("OK", 2, 9, None), ("OK", 0, 0, None), ("ERROR", 0, None, "no source")]
    # the reports take the log as it was written
    one = runlog.summary(seen).first()
    assert (one.corridas, one.errores, one.ultimo_estado, one.filas) == (3, 1, "ERROR", 2)
    # rows that carry their run's id meet their log row
    runs = [r.id for r in runlog.ended(seen).orderBy("id").collect()]
    loaded = current(spark, root, "load").withColumn("run_id", F.lit(runs[0]))
    (found,) = runlog.load_metrics(loaded, seen, "clientid").collect()
    assert (found.paquete, found.filas, found.max_id) == ("clients", 2, 9) and found.segundos is not None


def test_gold_clients_are_written_on_change_only(spark, tables, root):
    bronze = tables.client_view
    n = bronze.select("clientid").distinct().count()
    assert jobs.store_gold_clients(root, bronze, AT).rows == n
    assert jobs.store_gold_clients(root, bronze, AT).rows == 0
    assert snapshots.state(spark, root).commit == 1
    moved = bronze.withColumn("email", F.when(F.col("clientid") == 3, "new").otherwise(F.col("email")))
    assert jobs.store_gold_clients(root, moved, AT).rows == 1
    assert current(spark, root).where("updatedat is not null").count() == 1


@pytest.mark.parametrize("make", [gold.gold_client_detail, None])
def test_whole_tables_are_written_on_change_only(spark, tables, root, make):
    rows_ = make(tables.client_view) if make else gold.gold_phones(tables.phones)
    assert jobs.store_if_changed(root, rows_).rows == rows_.count()
    assert jobs.store_if_changed(root, rows_).rows == 0
    fewer = rows_.where("clientid > 5")
    assert jobs.store_if_changed(root, fewer).rows == fewer.count() == current(spark, root).count()


def test_first_requests_touch_the_months_of_changed_clients(spark, root):
    schema = "indice long, clientid long, fcorreo date, inicio_r date, aniomes int"
    day = lambda m: date(2001, m, 3)
    data = [(1, 1, day(1), None, 200101), (2, 1, day(3), None, 200103), (3, 2, day(2), None, 200102)]
    publish(spark.createDataFrame(data, schema), root, "aniomes")
    job = jobs.store_first_request(root)
    assert job(spark).rows == 3 and job(spark).rows == 0
    assert snapshots.state(spark, root).commit == 2
    more = spark.createDataFrame([(4, 2, day(5), None, 200105)], schema)
    publish(more, root, "aniomes", [200105])
    assert job(spark).rows == 1
    parts = snapshots.state(spark, root).parts
    assert {n: p.commit for n, p in parts.items()} == {
        "aniomes=200101": 2, "aniomes=200102": 2, "aniomes=200103": 2, "aniomes=200105": 4,
    }
    assert rows(current(spark, root, "aniomes"), "indice", "inicio_r") == [
        (1, day(1)), (2, day(1)), (3, day(2)), (4, day(2)),
    ]


def test_the_archive_takes_finished_runs_once(spark, tmp_path):
    log, archive = str(tmp_path / "log"), str(tmp_path / "archive")
    archived = lambda: rows(current(spark, archive, "archived_date"), "estado", "filas_insertadas")
    job = jobs.archive_log(log, archive, ("OK", "ERROR"), AT)
    assert job(spark).rows == 0  # there is no log yet
    jobs.logged(spark, log, "clients", lambda run: jobs.Written(2, 9))
    with pytest.raises(ValueError):
        jobs.logged(spark, log, "clients", lambda run: (_ for _ in ()).throw(ValueError("no source")))
    runlog.log_run(spark, log, id=7, paquete="long", estado=runlog.RUNNING, filas_insertadas=0, fecha_inicio=AT)
    first = runlog.read_log(spark, log).where("id <> 7")
    kept = first.collect()
    assert job(spark).rows == 2 and job(spark).rows == 0
    assert rows(runlog.read_log(spark, log), "id", "estado") == [(7, "RUNNING")]
    assert archived() == [("ERROR", 0), ("OK", 2)]
    # a run of the job that died after the archive was written: the rows are removed, not archived again
    for r in kept:
        runlog.log_run(spark, log, **r.asDict())
    runlog.log_run(spark, log, id=7, paquete="long", estado=runlog.OK, filas_insertadas=5, fecha_inicio=AT, fecha_fin=AT)
    assert job(spark).rows == 1 and job(spark).rows == 0
    assert archived() == [("ERROR", 0), ("OK", 2), ("OK", 5)]
    # the job may log itself in the log that it archives
    jobs.logged(spark, log, "archive", lambda run: job(spark))
    assert runlog.summary(runlog.read_log(spark, log)).first().corridas == 1
