"""Every registered query against its SQL twin on DuckDB."""

import duckdb
import pytest

from tests.conftest import rows
from workload import ORACLES, QUERIES

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"create view {name} as select * from '{small}/{name}.parquet'")
    return con


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(name, spark, small, duck):
    mine = QUERIES[name](spark, small)
    theirs = duck.execute(ORACLES[name])
    assert mine.columns == [c[0] for c in theirs.description]
    assert [TYPES[t] for _, t in mine.dtypes] == [str(c[1]) for c in theirs.description]
    found = rows(mine)
    assert found and found == sorted(theirs.fetchall(), key=repr)


def test_entry(spark):
    import __spark_entry__ as driver

    found = driver.entry(spark)
    assert found.columns[:3] == ["anio", "mes", "nommes"]
    assert found.count() > 0
