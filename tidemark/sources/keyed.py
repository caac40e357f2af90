"""Key tables of a target, laid out by their key.

The search for changed rows needs a target's keys and change times only. Kept as a table
bucketed and sorted by key, they are read where they lie: the join shuffles the
source rows to the buckets and moves nothing of the target, however often it runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import new_folder


def write_keys(
    target: DataFrame, name: str, key: str, *cols: str, buckets: int = 64, path: str | None = None
) -> DataFrame:
    """Write the key table ``name``; its files go to ``path`` or to a new shared folder.

    Rows are dealt out by key first, so that a bucket is one file.
    """
    spark = target.sparkSession
    rows = target.select(key, *cols).repartition(buckets, key)
    writer = rows.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    writer.option("path", path or new_folder(spark, name)).saveAsTable(name)
    return read_keys(spark, name)


def read_keys(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
