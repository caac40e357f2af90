"""Audits driven by a catalogue of tasks, and small checks of whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.aggregates import count_max

# Outcome of a task.
BEHIND, IN_STEP, FAILED = "DIFERENCIA", "SINCRONIZADO", "ERROR"

RESULT = (
    "task_id string, descripcion string, dag_id string, count_origen bigint, "
    "count_destino bigint, max_origen bigint, max_destino bigint, diferencia bigint, "
    "estado string, error string"
)


def read_catalogue(spark: SparkSession, path: str) -> list[dict]:
    """A JSON array of tasks. It is configuration: a few rows, read to the driver."""
    rows = spark.read.option("multiLine", True).json(path)
    return [row.asDict(recursive=True) for row in rows.collect()]


def _side(spark: SparkSession, side: Mapping, by: str) -> DataFrame:
    """One row (cnt, max_id): the task's own count query, or the highest key."""
    text = side.get("sql_count") if by == "count" else None
    if text:
        found = spark.sql(text).toDF("cnt", "max_id")
        return found.select(
            F.coalesce(F.col("cnt").cast("bigint"), F.lit(0)).alias("cnt"),
            F.coalesce(F.col("max_id").cast("bigint"), F.lit(0)).alias("max_id"),
        )
    plain = _plain(side, by)
    return fused(spark, plain.table, [plain], by).toDF("cnt", "max_id")


def _task(spark: SparkSession, task: Mapping, by: str) -> DataFrame:
    sides = [
        _side(spark, task.get(name) or {}, by).withColumn("side", F.lit(name))
        for name in ("origen", "destino")
    ]
    of = lambda name, c: F.max(F.when(F.col("side") == name, F.col(c)))
    both = sides[0].unionByName(sides[1]).agg(
        of("origen", "cnt").alias("count_origen"),
        of("destino", "cnt").alias("count_destino"),
        of("origen", "max_id").alias("max_origen"),
        of("destino", "max_id").alias("max_destino"),
    )
    by_count = F.col("count_origen") - F.col("count_destino")
    gap = F.coalesce(by_count, F.col("max_origen") - F.col("max_destino"))
    return both.select(
        *_labels(task),
        "count_origen",
        "count_destino",
        "max_origen",
        "max_destino",
        gap.alias("diferencia"),
        F.when(gap > 0, BEHIND).otherwise(IN_STEP).alias("estado"),
        F.lit(None).cast("string").alias("error"),
    )


def _labels(task: Mapping) -> list[Column]:
    return [
        F.lit(task.get("task_id", "unknown")).alias("task_id"),
        F.lit(task.get("descripcion", "")).alias("descripcion"),
        F.lit(task.get("dag_id", "")).alias("dag_id"),
    ]


def _failure(task: Mapping, error: Exception) -> tuple:
    labels = (task.get("task_id", "unknown"), task.get("descripcion", ""), task.get("dag_id", ""))
    return (*labels, None, None, None, None, None, FAILED, str(error))


class _Plain(NamedTuple):
    """A side without a text of its own: a table, its key, and a condition its rows have to meet."""

    table: str
    key: str
    where: str | None


def _plain(side: Mapping, by: str) -> _Plain | None:
    if by == "count" and side.get("sql_count"):
        return None
    return _Plain(side["tabla"], side["id_col"], side.get("filtro"))


def fused(spark: SparkSession, table: str, sides: Sequence[_Plain], by: str) -> DataFrame:
    """All sides over one table in one read of it: one row with a count and a key for each.

    A side with a condition has a count of its own; one without has none, as it had no text to count by.
    """
    parts = []
    for i, side in enumerate(sides):
        met = F.expr(side.where) if side.where else F.lit(True)
        counted = by == "count" and side.where
        parts.append((F.count_if(met) if counted else F.lit(None)).cast("bigint").alias(f"n{i}"))
        parts.append(F.coalesce(F.max(F.when(met, F.col(side.key))), F.lit(0)).cast("bigint").alias(f"m{i}"))
    return spark.table(table).agg(*parts)


Found = tuple[int | None, int | None] | Exception


def _isolated(spark: SparkSession, catalogue: Sequence[Mapping], by: str) -> list[tuple]:
    """A job per table, and one per text. Where a table's job fails, its sides are tried one by one."""
    places = [(i, name) for i in range(len(catalogue)) for name in ("origen", "destino")]
    found: dict[tuple[int, str], Found] = {}
    tables: dict[str, list[tuple[tuple[int, str], _Plain]]] = {}
    texts = []
    for i, name in places:
        try:
            side = _plain(catalogue[i].get(name) or {}, by)
        except KeyError as error:
            found[i, name] = error
            continue
        if side is None:
            texts.append((i, name))
        else:
            tables.setdefault(side.table, []).append(((i, name), side))

    def of_table(table: str) -> None:
        places, sides = zip(*tables[table], strict=True)
        try:
            row = fused(spark, table, sides, by).first()
            found.update({place: (row[f"n{k}"], row[f"m{k}"]) for k, place in enumerate(places)})
        except PySparkException as error:
            if len(places) == 1:
                found[places[0]] = error
                return
            for place, side in tables[table]:
                try:
                    found[place] = tuple(fused(spark, table, [side], by).first())
                except PySparkException as own:
                    found[place] = own

    def of_text(place: tuple[int, str]) -> None:
        try:
            found[place] = tuple(_side(spark, catalogue[place[0]][place[1]], by).first())
        except PySparkException as error:
            found[place] = error

    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(of_table, tables))
        list(pool.map(of_text, texts))
    return [_outcome(task, found[i, "origen"], found[i, "destino"]) for i, task in enumerate(catalogue)]


def _outcome(task: Mapping, origin: Found, target: Found) -> tuple:
    for side in (origin, target):
        if isinstance(side, Exception):
            return _failure(task, side)
    (n, m), (k, l) = origin, target
    gap = m - l if n is None or k is None else n - k
    labels = (task.get("task_id", "unknown"), task.get("descripcion", ""), task.get("dag_id", ""))
    return (*labels, n, k, m, l, gap, BEHIND if gap > 0 else IN_STEP, None)


def audit(
    spark: SparkSession, catalogue: Sequence[Mapping], by: str = "count", isolate: bool = True
) -> DataFrame:
    """One row per task: both sides, their difference, and the outcome.

    The difference is of counts where both sides have a count, by a text of their own
    (``sql_count``) or a condition (``filtro``), else of highest keys; ``by="max"`` ignores texts.
    All sides without a text that name one table are one read of it. A task that names an
    unknown table or column, or fails while it runs, is an ERROR row and stops no other. Without
    ``isolate`` all tasks are one job, a read per side, which a failing task stops. Each task gives
    one row, whatever it reads.
    """
    if isolate:
        return spark.createDataFrame(_isolated(spark, catalogue, by), RESULT)

    def ready(task: Mapping) -> DataFrame | tuple:
        try:
            return _task(spark, task, by)
        except (PySparkException, KeyError) as error:
            return _failure(task, error)

    made = [ready(task) for task in catalogue]
    frames = [m for m in made if isinstance(m, DataFrame)]
    failed = [m for m in made if not isinstance(m, DataFrame)]
    if failed or not frames:
        frames.append(spark.createDataFrame(failed, RESULT))
    return reduce(DataFrame.unionByName, frames)


def pending_report(pending: Mapping[tuple[str, str], tuple[DataFrame, Column]]) -> DataFrame:
    """Tasks with pending source rows and the job that loads them.

    Takes (task, job) -> (pending rows, their weight); tasks without any are left out.
    """
    frames = [
        rows.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("pendientes")).select(
            F.lit(task).alias("task_id"), F.lit(job).alias("dag_id"), "pendientes"
        )
        for (task, job), (rows, weight) in pending.items()
    ]
    return reduce(DataFrame.unionByName, frames).where("pendientes > 0")


def table_check(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and highest key of each table."""
    frames = [
        count_max(df, key).select(F.lit(name).alias("tabla"), "cnt", "max_id")
        for name, (df, key) in tables.items()
    ]
    return reduce(DataFrame.unionByName, frames)
