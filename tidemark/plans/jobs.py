"""Jobs that keep their own log, and the stored-table jobs of gold, requests and archive.

A job writes a RUNNING row when it starts and an OK or ERROR row, under the same id, when it
ends. A stored-table job reports what it wrote, and writes nothing where nothing changed.
"""

from __future__ import annotations

import secrets
import time
from collections.abc import Callable, Sequence
from datetime import UTC, datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import as_ntz
from tidemark.operators.aggregates import count_max
from tidemark.operators.cleanup import archive_rows, purge_archived
from tidemark.operators.joins import exists_in, split_join
from tidemark.operators.merge import merge_counts
from tidemark.operators.sizes import frozen
from tidemark.plans import gold, runlog
from tidemark.sources import snapshots
from tidemark.sources.snapshots import current, publish


class Written(NamedTuple):
    rows: int
    highest: int | None = None


def _id() -> int:
    """Larger for later runs, and different for two that start together."""
    return (int(time.time() * 1_000_000) << 10) + secrets.randbelow(1 << 10)


def logged(
    spark: SparkSession,
    log: str,
    job: str,
    work: Callable[[int], Written | DataFrame],
    source: str = "",
    target: str = "",
    kind: str = "MANUAL",
    key: str | None = None,
    clock: Callable[[], datetime] = lambda: datetime.now(UTC).replace(tzinfo=None),
) -> Written:
    """Run ``work(run_id)`` and log how it went; an error is logged and raised.

    ``work`` returns what it wrote, or the written rows, which are counted.
    """
    run, start = _id(), clock()

    def note(state: str, done: Written, end: datetime | None, message: str | None = None) -> None:
        runlog.log_run(
            spark, log, id=run, paquete=job, vista_origen=source, tabla_destino=target,
            max_id_inicio=done.highest, filas_insertadas=done.rows, tipo_ejecucion=kind,
            estado=state, mensaje_error=message, fecha_inicio=start, fecha_fin=end,
        )

    note(runlog.RUNNING, Written(0), None)
    try:
        done = work(run)
        if isinstance(done, DataFrame):
            found = count_max(done, key).first() if key else (done.count(), None)
            done = Written(found[0], found[1])
    except Exception as error:
        note(runlog.ERROR, Written(0), clock(), str(error)[:1000])
        raise
    note(runlog.OK, done, clock())
    return done


def store_if_changed(root: str, rows: DataFrame) -> Written:
    """Replace a whole table, unless it holds these rows already."""
    seen = snapshots.state(rows.sparkSession, root)
    old = current(rows.sparkSession, root, at=seen)
    rows = frozen(rows)
    if old is not None and set(old.columns) == set(rows.columns):
        old = old.select(rows.columns)
        if rows.exceptAll(old).isEmpty() and old.exceptAll(rows).isEmpty():
            return Written(0)
    publish(rows, root, base=seen.commit)
    return Written(rows.count())


def store_gold_clients(root: str, bronze: DataFrame, at: datetime) -> Written:
    """Upsert the conformed clients; the rows written are those inserted or really changed."""
    spark = bronze.sparkSession
    seen = snapshots.state(spark, root)
    old = current(spark, root, at=seen)
    if old is None:
        first = gold.client_rows(bronze).withColumns(
            {"createdat": as_ntz(at), "updatedat": F.lit(None).cast("timestamp_ntz")}
        )
        return store_if_changed(root, first)
    counts = merge_counts(old, gold.client_rows(bronze), ["clientid"], gold.CLIENT_COLS).first()
    changed = counts["inserted"] + counts["updated"]
    if changed:
        publish(gold.gold_clients(old, bronze, at), root, base=seen.commit)
    return Written(changed)


def store_first_request(root: str, by: str = "aniomes", column: str = "inicio_r") -> Callable[[SparkSession], Written]:
    """A job that writes each client's first request date into the stored requests.

    Only the months in which a client's stored date differs are rewritten.
    """

    def run(spark: SparkSession) -> Written:
        seen = snapshots.state(spark, root)
        table = current(spark, root, by, at=seen)
        if table is None:
            return Written(0)
        first = table.groupBy("clientid").agg(F.to_date(F.min("fcorreo")).alias("_first")).where("_first is not null")
        stale = split_join(table.select("clientid", by, column), first, "clientid").where(
            ~F.col(column).eqNullSafe(F.col("_first"))
        )
        stale = frozen(stale.groupBy(by).agg(F.count("*").alias("n")))  # one row per month
        months = {r[by]: r["n"] for r in stale.collect()}
        if months:
            old = current(spark, root, by, sorted(months), at=seen)
            done = split_join(old, first, "clientid")
            done = done.withColumn(column, F.coalesce("_first", column)).select(old.columns)
            publish(done, root, by, sorted(months), seen.commit)
        return Written(sum(months.values()))

    return run


def archive_log(log_root: str, archive_root: str, states: Sequence[str], at: datetime) -> Callable[[SparkSession], Written]:
    """A job that moves the ended runs of a log to the archive, by date, and then out of the log.

    The log is what ``logged`` writes. The archive gets one row per run. If the job dies in
    between, the next run finds the rows archived and only removes them.
    """

    def run(spark: SparkSession) -> Written:
        folder = snapshots._Folder(spark, log_root)
        if not folder.names(log_root):
            return Written(0)
        log = runlog.read_log(spark, log_root)
        before = snapshots.state(spark, archive_root)
        held = current(spark, archive_root, "archived_date", at=before)
        finished = archive_rows(runlog.ended(log), states, at)
        new = frozen(finished if held is None else purge_archived(finished, held))
        n = new.count()
        if n:
            day = at.date()
            same = None if held is None else current(spark, archive_root, "archived_date", [day], at=before)
            whole = new if same is None else same.select(new.columns).unionByName(new)
            publish(whole, archive_root, "archived_date", [day], before.commit)
        held = current(spark, archive_root, "archived_date")
        if held is not None:
            done = exists_in(log.select("id").distinct(), held, "id")
            for row in done.toLocalIterator():  # one folder per run that leaves the log
                folder.delete(runlog.run_folder(log_root, row.id))
        return Written(n)

    return run
