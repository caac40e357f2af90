"""State kept between loads, as ordinary tables of rows: key runs and totals, one partition per load.

A load that is recorded again replaces what it recorded before, so a repeated load counts
once. Reading adds the loads up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import intervals
from tidemark.operators.load import repair_missing_by_runs
from tidemark.operators.totals import added_up, signed_totals
from tidemark.plans.sync import add_load, append_load
from tidemark.sources import snapshots
from tidemark.sources.snapshots import current, publish


def record(root: str, rows: DataFrame, load: int) -> None:
    """Keep the rows as those of one load, in place of what it had."""
    publish(rows.withColumn("load", F.lit(load)), root, "load", [load])


def recorded(spark: SparkSession, root: str) -> DataFrame | None:
    found = current(spark, root, "load")
    return None if found is None else found.drop("load")


def record_keys(root: str, rows: DataFrame, key: str, load: int, width: int = intervals.WIDTH) -> None:
    """Keep the runs of the keys that a load wrote."""
    record(root, intervals.runs(rows, key, width), load)


def held_keys(spark: SparkSession, root: str, width: int = intervals.WIDTH) -> DataFrame | None:
    """The runs of all keys that the recorded loads wrote."""
    found = recorded(spark, root)
    return None if found is None else intervals.merged(found, width)


def repair(source: DataFrame, root: str, key: str, at: datetime | str, width: int = intervals.WIDTH) -> DataFrame:
    """Source rows below the watermark that no load wrote, stamped; the target is not read."""
    held = held_keys(source.sparkSession, root, width)
    if held is None:
        held = source.sparkSession.createDataFrame([], "lo bigint, hi bigint, n bigint")
    return repair_missing_by_runs(source, held, key, at, width)


def catch_up(spark: SparkSession, root: str, runs_root: str, key: str, width: int = intervals.WIDTH) -> list[int]:
    """Record the keys of all loads of the table at ``root`` that are not recorded yet; returns these loads.

    Reads those loads only. A job that died between writing a load and recording it loses nothing.
    """
    loads = lambda r: {int(n.partition("=")[2]) for n in snapshots.partitions(spark, r, "load")}
    new = sorted(loads(root) - loads(runs_root))
    for load in new:
        rows = current(spark, root, "load", [load])
        if rows is None:  # a load of no rows
            rows = spark.createDataFrame([], f"`{key}` bigint")
        record_keys(runs_root, rows, key, load, width)
    return new


def append_recorded(source: DataFrame, root: str, runs_root: str, key: str, at: datetime | str) -> DataFrame:
    """Append source rows above the watermark as a load, and keep its keys; returns the load."""
    new = append_load(source, root, key, at)
    catch_up(source.sparkSession, root, runs_root, key)
    return new


def repair_recorded(
    source: DataFrame, root: str, runs_root: str, key: str, at: datetime | str, width: int = intervals.WIDTH
) -> DataFrame:
    """Append what earlier loads left out, found by their runs alone; returns the load.

    If another run appends a load meanwhile, this one ends with ``StaleTable`` and adds nothing.
    """
    spark = source.sparkSession
    seen = snapshots.state(spark, root)
    catch_up(spark, root, runs_root, key, width)
    new = add_load(repair(source, runs_root, key, at, width), root, key, None, seen)
    catch_up(spark, root, runs_root, key, width)
    return new


def record_totals(
    root: str, signed: DataFrame, by: Mapping[str, Column], sums: Mapping[str, Column], load: int
) -> None:
    """Keep what a load's signed changes add to the totals."""
    record(root, signed_totals(signed, [c.alias(n) for n, c in by.items()], sums), load)


def totals(spark: SparkSession, root: str, by: Sequence[str]) -> DataFrame | None:
    found = recorded(spark, root)
    return None if found is None else added_up(found, by)
