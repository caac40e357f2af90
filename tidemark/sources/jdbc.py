"""JDBC tables as sources and sinks.

Rows go from executor to database and back; the driver sees a row count and cut points,
as many as partitions. A JDBC append is atomic per partition only: after a failed append
some partitions are in. Append by key with ``operators.load`` and fill gaps with
``missing_rows``; the next run then brings exactly what is not there. A replace goes to a
staging table first and is taken over in one transaction.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.tables import run_template

# Rows per insert batch of a load, and of an ad-hoc copy.
LOAD_BATCH = 1_000
COPY_BATCH = 10_000
ROWS_EACH = 1_000_000  # of a partition that is read
STAGE = "__stage"
_QUERY = re.compile(r"\s*(select|with)\b", re.IGNORECASE)
_NAME = re.compile(r"[\w.$`\"\[\]]+")


def is_query(table_or_query: str) -> bool:
    """Whether the text is a query; a table called ``selections`` is not."""
    return bool(_QUERY.match(table_or_query))


def _from(table_or_query: str) -> str:
    text = table_or_query.strip()
    return f"({text}) q" if is_query(text) else text


def read_options(
    url: str,
    table_or_query: str,
    fetchsize: int = 10_000,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": _from(table_or_query),
        "fetchsize": str(fetchsize),
        **(extra or {}),
    }


def size_query(table_or_query: str) -> str:
    return f"select count(*) as n from {_from(table_or_query)}"


def cuts_query(table_or_query: str, key: str, parts: int) -> str:
    """The lowest key of each of ``parts`` runs of equally many rows, in order."""
    ranked = f"select {key} as k, ntile({parts}) over (order by {key}) as part from {_from(table_or_query)}"
    return f"select min(k) as cut from ({ranked} where {key} is not null) r group by part order by cut"


def predicates(key: str, cuts: Sequence[object]) -> list[str]:
    """Conditions that split a table at the cut points: every row, also without key, meets one."""
    marks = [_literal(c) for c in dict.fromkeys(cuts)][1:]
    if not marks:
        return ["1 = 1"]
    middle = [f"{key} >= {a} and {key} < {b}" for a, b in zip(marks, marks[1:], strict=False)]
    return [f"{key} < {marks[0]} or {key} is null", *middle, f"{key} >= {marks[-1]}"]


def _literal(value: object) -> str:
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"


def _rows(spark: SparkSession, url: str, query: str, extra: Mapping[str, str]) -> list:
    return spark.read.format("jdbc").options(**read_options(url, query, extra=extra)).load().collect()


def read_table(
    spark: SparkSession,
    url: str,
    table_or_query: str,
    key: str | None = None,
    cuts: Sequence[object] | None = None,
    rows_each: int = ROWS_EACH,
    **extra: str,
) -> DataFrame:
    """A table or query over JDBC.

    With a ``key`` it is read in parallel: as many partitions as the row count asks for,
    cut where the database finds the key's quantiles, so that uneven keys give even
    partitions. ``cuts`` gives the cut points instead.

    Some databases take no ``with`` inside a subquery, which Spark makes of every query. Give them the
    clause apart, as ``prepareQuery="with x as (...)"``, and the rest of the query as the query.
    """
    if key and cuts is None:
        n = _rows(spark, url, size_query(table_or_query), extra)[0][0]
        parts = max(1, -(-n // rows_each))
        cuts = [r[0] for r in _rows(spark, url, cuts_query(table_or_query, key, parts), extra)] if parts > 1 else []
    if not key or len(cuts) < 2:
        return spark.read.format("jdbc").options(**read_options(url, table_or_query, extra=extra)).load()
    options = read_options(url, table_or_query, extra=extra)
    table = options.pop("dbtable")
    return spark.read.jdbc(options.pop("url"), table, predicates=predicates(key, cuts), properties=options)


def write_options(
    url: str,
    table: str,
    batchsize: int = LOAD_BATCH,
    connections: int = 16,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a write; ``connections`` bounds how many partitions insert at once."""
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batchsize),
        "numPartitions": str(connections),
        **(extra or {}),
    }


def append(df: DataFrame, url: str, table: str, batchsize: int = LOAD_BATCH, **extra: str) -> None:
    options = write_options(url, table, batchsize, extra=extra)
    df.write.format("jdbc").mode("append").options(**options).save()


def take_over(table: str, columns: Sequence[str]) -> list[str]:
    """Statements of one transaction that put the staged rows in place of the table's."""
    if not _NAME.fullmatch(table):
        raise ValueError(f"not the name of a table: {table}")
    listed = ", ".join(columns)
    return [f"delete from {table}", f"insert into {table} ({listed}) select {listed} from {table}{STAGE}"]


def run_in_transaction(
    spark: SparkSession, url: str, statements: Sequence[str], extra: Mapping[str, str] | None = None
) -> None:
    """All statements or none, on one connection of the driver."""
    jvm = spark._jvm
    settings = jvm.java.util.Properties()
    for name, value in (extra or {}).items():
        settings.setProperty(name, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.setAutoCommit(False)
        for text in statements:
            connection.createStatement().execute(text)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def replace(df: DataFrame, url: str, table: str, batchsize: int = LOAD_BATCH, **extra: str) -> None:
    """Replace all rows of a table; its definition and grants stay.

    The rows are written to ``<table>__stage``, which Spark makes, and taken over in one
    transaction: a failure before it leaves the table as it was.
    """
    statements = take_over(table, df.columns)
    options = write_options(url, table + STAGE, batchsize, extra=extra)
    df.write.format("jdbc").mode("overwrite").options(**options).save()
    run_in_transaction(df.sparkSession, url, statements, extra)
    run_in_transaction(df.sparkSession, url, [f"drop table {table}{STAGE}"], extra)


def copy_query(
    spark: SparkSession,
    text: str,
    url: str,
    table: str,
    mode: str = "append",
    args: Mapping[str, object] | None = None,
    **extra: str,
) -> None:
    """Write the result of any query to a table, adding to it or replacing it."""
    df = run_template(spark, text, args)
    if mode not in ("append", "replace"):
        raise ValueError(f"mode is append or replace, not {mode}")
    (append if mode == "append" else replace)(df, url, table, batchsize=COPY_BATCH, **extra)
