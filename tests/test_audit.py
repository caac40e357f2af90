import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.plans import audit, runlog

TASKS = [
    {"task_id": "behind", "dag_id": "load_a", "descripcion": "d",
     "origen": {"sql_count": "select count(*), max(id) from src"},
     "destino": {"sql_count": "select count(*), max(id) from tgt"}},
    {"task_id": "even", "dag_id": "load_b",
     "origen": {"sql_count": "select count(*), max(id) from tgt"},
     "destino": {"sql_count": "select count(*), max(id) from tgt"}},
    {"task_id": "by_key", "dag_id": "load_c",
     "origen": {"tabla": "src", "id_col": "id"}, "destino": {"tabla": "tgt", "id_col": "id"}},
    {"task_id": "empty", "dag_id": "load_d",
     "origen": {"tabla": "nothing", "id_col": "id"}, "destino": {"tabla": "tgt", "id_col": "id"}},
    {"task_id": "no_table", "dag_id": "load_e",
     "origen": {"tabla": "absent", "id_col": "id"}, "destino": {"tabla": "tgt", "id_col": "id"}},
    {"task_id": "no_side", "dag_id": "load_f", "origen": {"tabla": "src", "id_col": "id"}},
]
FAILS = {
    "task_id": "breaks", "dag_id": "load_g",
    "origen": {"sql_count": "select count(*), max(cast(concat('x', id) as int)) from src"},
    "destino": {"tabla": "tgt", "id_col": "id"},
}


@pytest.fixture
def views(spark):
    spark.range(10).createOrReplaceTempView("src")
    spark.range(7).createOrReplaceTempView("tgt")
    spark.range(0).createOrReplaceTempView("nothing")


def outcome(df):
    return {r.task_id: (r.diferencia, r.estado) for r in df.collect()}


WANT = {
    "behind": (3, "DIFERENCIA"),
    "even": (0, "SINCRONIZADO"),
    "by_key": (3, "DIFERENCIA"),
    "empty": (-6, "SINCRONIZADO"),
    "no_table": (None, "ERROR"),
    "no_side": (None, "ERROR"),
}


@pytest.mark.parametrize("isolate", [False, True])
def test_outcomes(spark, views, isolate):
    got = audit.audit(spark, TASKS, isolate=isolate)
    assert outcome(got) == WANT
    assert [r[0] is not None for r in got.where("estado = 'ERROR'").select("error").collect()] == [True, True]
    assert got.columns == [c.split()[0] for c in audit.RESULT.split(", ")]


def test_a_task_that_breaks_while_running_does_not_stop_others(spark, views):
    got = audit.audit(spark, [*TASKS, FAILS])
    assert outcome(got) == {**WANT, "breaks": (None, "ERROR")}


def test_by_highest_key(spark, views):
    tasks = [t for t in TASKS if t["task_id"] in ("by_key", "empty")]
    assert outcome(audit.audit(spark, tasks, by="max")) == {k: WANT[k] for k in ("by_key", "empty")}


def test_catalogue_from_a_file(spark, views, tmp_path):
    path = tmp_path / "catalogue.json"
    path.write_text(json.dumps(TASKS[:3], indent=2))
    tasks = audit.read_catalogue(spark, str(path))
    assert outcome(audit.audit(spark, tasks)) == {k: WANT[k] for k in ("behind", "even", "by_key")}


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    start = datetime(2024, 1, 1, 6)
    common = {"vista_origen": "v", "tabla_destino": "t", "max_id_inicio": 0, "tipo_ejecucion": "MANUAL"}
    for n, (state, end) in enumerate((("SUCCESS", start.replace(minute=1)), ("ERROR", start), ("RUNNING", None))):
        runlog.log_run(
            spark, path, id=n, paquete="job", filas_insertadas=n * 10, estado=state, mensaje_error=None,
            fecha_inicio=start.replace(hour=6 + n), fecha_fin=end and end.replace(hour=6 + n), **common,
        )
    log = spark.read.parquet(path)
    log = log.withColumn("estado", runlog.normal_state())
    assert rows(log, "id", "estado") == [(0, "OK"), (1, "ERROR"), (2, "RUNNING")]
    got = runlog.summary(log).first()
    assert (got.corridas, got.errores, got.ultimo_estado, got.filas) == (3, 1, "RUNNING", 30)
    assert got.segundos_prom == 30.0
    assert [r.id for r in runlog.last_result(log, "job", 2).collect()] == [2, 1]
    loaded = spark.createDataFrame([(k, 0 if k < 120 else 77) for k in range(130)], "clientid long, run_id long")
    # two runs that started together, and a load whose run left no log row
    twin = log.where("id = 0").withColumns({"id": F.lit(5), "paquete": F.lit("twin")})
    found = {r.run_id: r for r in runlog.load_metrics(loaded, log.unionByName(twin), "clientid").collect()}
    one = found[0]
    assert (one.paquete, one.filas, one.min_id, one.max_id, one.segundos, one.filas_seg) == ("job", 120, 0, 119, 60, 2.0)
    assert (found[77].paquete, found[77].filas, found[77].segundos) == (None, 10, None) and len(found) == 2


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_seconds_do_not_follow_clock_changes(spark, zone):
    data = [
        (datetime(2024, 3, 10, 1, 30), datetime(2024, 3, 10, 3, 30, 5)),
        (datetime(2024, 3, 9, 23, 59, 59), datetime(2024, 3, 11)),
    ]
    df = spark.createDataFrame(data, "fecha_inicio timestamp_ntz, fecha_fin timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert [r[0] for r in df.select(runlog._seconds()).collect()] == [7205, 86401]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
