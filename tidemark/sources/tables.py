"""Reading named tables and running SQL text with parameters."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of a client source view, in its order.
CLIENT_COLUMNS = (
    "productid",
    "contractid",
    "clientid",
    "email",
    "capdata",
    "firstname",
    "lastname",
    "countrycode",
    "country",
    "estate",
    "ciudad",
    "address",
    "zip",
    "corpcode",
    "corp",
    "ingreso",
    "egreso",
    "rank",
    "estatusn",
    "estatusl",
)
PHONE_COLUMNS = ("clientid", "phone")


def scan(source: SparkSession | DataFrame, cols: Sequence[str], name: str | None = None) -> DataFrame:
    """The listed columns of a table, by name in any case, under the listed names.

    ``source`` is a DataFrame, or a session together with a table or view name.
    """
    df = source if isinstance(source, DataFrame) else source.table(name)
    return df.select(*[F.col(c).alias(c) for c in cols])


_BRACED = re.compile(r"\{(\w+)\}")


def run_template(
    spark: SparkSession,
    text: str,
    args: Mapping[str, object] | None = None,
    tables: Mapping[str, str] | None = None,
) -> DataFrame:
    """Run SQL text whose ``:name`` or ``{name}`` places are filled from ``args``.

    Values are bound, never pasted, so a value cannot change the statement. A
    name listed in ``tables`` is a table name and goes through ``identifier``.
    """
    tables = dict(tables or {})

    def place(match: re.Match) -> str:
        name = match.group(1)
        return f"identifier(:{name})" if name in tables else f":{name}"

    return spark.sql(_BRACED.sub(place, text), args={**(args or {}), **tables})


def read_template(spark: SparkSession, path: str) -> str:
    """SQL text from a file on any file system Spark reads."""
    return spark.read.text(path, wholetext=True).first()[0]
