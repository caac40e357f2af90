"""Registration of a query together with its SQL twin and its output columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workload.standins import Tables, tables, with_standins

# Output types both engines agree on: name, name:i (integer), name:d (double), name:s (text).
_TYPES = {"i": ("bigint", "bigint"), "d": ("double", "double"), "s": ("string", "varchar")}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _columns(spec: str) -> list[tuple[str, str | None]]:
    return [(c.partition(":")[0], c.partition(":")[2] or None) for c in spec.split()]


def query(name: str, cols: str, sql: str | None):
    """Register ``fn(tables)`` under ``name``; ``cols`` are its output columns and types."""
    columns = _columns(cols)

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            out = fn(tables(spark, folder))
            return out.select(
                *[F.col(c).cast(_TYPES[t][0]).alias(c) if t else F.col(c) for c, t in columns]
            )

        QUERIES[name] = run
        if sql is not None:
            casts = ", ".join(
                f"cast({c} as {_TYPES[t][1]}) as {c}" if t else c for c, t in columns
            )
            ORACLES[name] = with_standins(f"select {casts} from ({sql}) q")
        return fn

    return register
