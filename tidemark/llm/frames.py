"""What the operators share as Spark jobs: frozen rows, free names, tasks over texts."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import slices
from tidemark.session import shared_dir


BATCH = 1000
_BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


def freeze(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder, so that every later step sees the same ones."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def released(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files behind frames that nobody refers to any more.

    It does so when the driver's JVM collects its garbage, which a driver with little to do puts off.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession) -> None:
    """Batches of ``BATCH`` rows between Spark and Python, where the session has the default of 10,000.

    Rows have whole texts here: 10,000 of them are tens of megabytes, several times over in each task.
    """
    if spark.conf.get(_BATCHES) == "10000":
        spark.conf.set(_BATCHES, str(BATCH))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def plain(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names and types that the steps expect."""
    small_batches(docs.sparkSession)
    return docs.select(*[F.col(f"`{c}`").cast(_TYPES[name]).alias(name) for name, c in columns.items()])


_TYPES = {"doc_id": "bigint", "text": "string", "source": "string", "lang": "string"}


def each_slice(
    df: DataFrame,
    step: Callable[[pa.RecordBatch, list[bytes]], Iterator[pa.RecordBatch] | pa.RecordBatch],
    schema: str,
    text: str = "text",
) -> DataFrame:
    """``step`` on slices of rows with their texts as bytes (null as empty), rows to rows."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch, text):
                yield step(rows, texts)

    return df.mapInArrow(run, schema)


def with_columns(rows: pa.RecordBatch, drop: tuple[str, ...] = (), **columns) -> pa.RecordBatch:
    """The batch with further columns, without the dropped ones."""
    names = [n for n in rows.schema.names if n not in drop]
    arrays = [rows.column(n) for n in names] + [
        c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[*names, *columns])


def input_bytes(docs: DataFrame, text: str = "text") -> int:
    """About the size of the documents; decides partition counts only.

    Spark's own estimate, where it has one, else the size of the texts.
    """
    known = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if known < 1 << 50:
        return known
    return docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0


def spread(docs: DataFrame, size: int, bytes_each: int) -> int:
    """A partition count: Spark's setting, and more where partitions would get too large."""
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-size // bytes_each))
