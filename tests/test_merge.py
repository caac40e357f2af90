"""Upsert and pending rows against a plain dictionary, and their null rules."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import merge

AT = datetime(2024, 5, 1, 6, 0)
OLD = datetime(2024, 1, 1)
T_SCHEMA = "k long, v int, w string, made timestamp_ntz, moved timestamp_ntz"
S_SCHEMA = "k long, v int, w string, n int, made timestamp_ntz"

value = st.one_of(st.none(), st.integers(-1, 1))
word = st.one_of(st.none(), st.sampled_from(["", "a"]))
target_rows = st.dictionaries(st.integers(0, 6), st.tuples(value, word), max_size=6)
source_rows = st.lists(st.tuples(st.integers(0, 6), value, word), max_size=8)


def expected(target, source):
    """Apply the source row by row; the last row of a key counts."""
    state = {k: (v, w, OLD, None) for k, (v, w) in target.items()}
    last = {k: (v, w) for k, v, w in source}
    for k, (v, w) in last.items():
        if k in state:
            moved = AT if state[k][:2] != (v, w) else state[k][3]
            state[k] = (v, w, OLD, moved)
        else:
            state[k] = (v, w, AT, None)
    return sorted(((k, *rest) for k, rest in state.items()), key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=target_rows, source=source_rows, small=st.booleans())
def test_upsert_is_what_applying_rows_in_turn_gives(spark, target, source, small):
    t = spark.createDataFrame([(k, v, w, OLD, None) for k, (v, w) in target.items()], T_SCHEMA)
    s = spark.createDataFrame([(k, v, w, n, AT) for n, (k, v, w) in enumerate(source)], S_SCHEMA)

    def run(state):
        return merge.upsert(
            state, s, ["k"], order=[F.desc("n")], keep=["made"], stamp="moved",
            stamp_cols=["v", "w"], at=AT, small_source=small,
        )

    once = run(t)
    assert rows(once) == expected(target, source)
    frozen = spark.createDataFrame(once.collect(), T_SCHEMA)
    assert rows(run(frozen)) == rows(frozen)


def test_counts_add_up(spark):
    t = spark.createDataFrame([(1, 1), (2, None), (3, 3)], "k long, v int")
    s = spark.createDataFrame([(1, 1), (2, None), (3, 4), (4, 1)], "k long, v int")
    assert rows(merge.merge_counts(t, s, ["k"], ["v"])) == [(1, 1, 2)]


def test_upsert_into_an_empty_table(spark):
    t = spark.createDataFrame([], "k long, v int")
    s = spark.createDataFrame([(1, 1)], "k long, v int")
    assert rows(merge.upsert(t, s, ["k"])) == [(1, 1)]


def test_columns_the_source_lacks_stay(spark):
    t = spark.createDataFrame([(1, 1, "x")], "k long, v int, extra string")
    s = spark.createDataFrame([(1, 2), (5, 3)], "k long, v int")
    assert rows(merge.upsert(t, s, ["k"])) == [(1, 2, "x"), (5, 3, None)]


@pytest.fixture
def changes(spark):
    source = spark.createDataFrame(
        [
            (1, datetime(2024, 1, 1, 9)),  # same moment
            (2, datetime(2024, 1, 1, 18)),  # later on the loaded day
            (3, datetime(2024, 1, 2)),  # a later day
            (4, None),  # never changed
            (9, None),  # not loaded
        ],
        "indice long, updateat timestamp_ntz",
    )
    target = spark.createDataFrame(
        [(k, datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 9)) for k in (1, 2, 3, 4)],
        "contador long, create_at timestamp_ntz, update_at timestamp_ntz",
    )
    return source, target


def test_pending_by_row(changes):
    source, target = changes
    by_day = merge.pending_row(source, target, "indice", "contador")
    exact = merge.pending_row(source, target, "indice", "contador", granularity="timestamp")
    assert rows(by_day, "indice") == [(3,), (9,)]
    assert rows(exact, "indice") == [(2,), (3,), (9,)]


def test_pending_by_table(changes):
    source, target = changes
    assert rows(merge.pending_table(source, target, "indice", "contador"), "indice") == [(2,), (3,), (9,)]
    none = target.limit(0)
    assert rows(merge.pending_table(source, none, "indice", "contador"), "indice") == [
        (1,), (2,), (3,), (4,), (9,),
    ]
