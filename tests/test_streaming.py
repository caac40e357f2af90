from datetime import datetime

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.sources.snapshots import current
from tidemark.streaming.append import file_stream, upsert_stream

AT = datetime(2024, 5, 1)


def test_files_are_upserted_once(spark, tmp_path):
    inbox, root, state = (str(tmp_path / n) for n in ("inbox", "table", "state"))

    def arrive(data):
        df = spark.createDataFrame(data, "k long, v string, n int, ym int")
        df.coalesce(1).write.mode("append").parquet(inbox)
        return df.schema

    def run(schema):
        stream = file_stream(spark, inbox, schema, files_per_batch=1)
        query = upsert_stream(
            stream, root, ["k"], "ym", [F.desc("n")], state, lambda: AT, stamp="moved", stamp_cols=["v"]
        )
        query.awaitTermination()
        return rows(current(spark, root, "ym"), "k", "v", "ym", "moved")

    schema = arrive([(1, "a", 1, 1), (1, "b", 2, 1), (2, "c", 1, 2)])
    first = [(1, "b", 1, None), (2, "c", 2, None)]
    assert run(schema) == first
    assert run(schema) == first
    arrive([(1, "z", 3, 2), (3, "d", 1, 1)])
    assert run(schema) == [(1, "z", 2, AT), (2, "c", 2, None), (3, "d", 1, None)]
