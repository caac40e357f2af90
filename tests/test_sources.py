"""Named scans and SQL templates; JDBC options.

No database is started here, so the JDBC calls are checked up to the point
where Spark would connect.
"""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import readwriter

from tests.conftest import rows
from tidemark.operators.joins import chain
from tidemark.operators.shape import by_ids
from tidemark.sources import jdbc
from tidemark.sources.tables import read_template, run_template, scan

URL = "jdbc:any://host/db"


def test_scan_takes_names_in_any_case(spark):
    df = spark.createDataFrame([(1, "c", 2)], "ClientID int, Ciudad string, other int")
    df.createOrReplaceTempView("named")
    assert scan(df, ["clientid", "ciudad"]).columns == ["clientid", "ciudad"]
    assert rows(scan(spark, ["CIUDAD"], "named")) == [("c",)]
    with pytest.raises(AnalysisException):
        scan(df, ["absent"])


def test_template_binds_values_and_tables(spark):
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string").createOrReplaceTempView("things")
    text = "select id from {t} where id > {least} and name <> :name"
    assert rows(run_template(spark, text, {"least": 0, "name": "b"}, {"t": "things"})) == [(1,)]
    # a value stays a value
    assert rows(run_template(spark, text, {"least": 0, "name": "b' or '1'='1"}, {"t": "things"})) == [(1,), (2,)]


def test_template_from_a_file(spark, tmp_path):
    path = tmp_path / "q.sql"
    path.write_text("select {n} + 1 as m\n-- end\n")
    assert rows(run_template(spark, read_template(spark, str(path)), {"n": 41})) == [(42,)]


def test_by_ids(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string")
    wanted = spark.createDataFrame([(3,), (1,), (3,)], "any int")
    assert [r.k for r in by_ids(df, "k", [3, 1]).collect()] == [1, 3]
    assert [r.k for r in by_ids(df, "k", wanted).collect()] == [1, 3]


def test_chain(spark):
    a = spark.createDataFrame([(1, 5), (2, 6)], "k int, v int")
    b = spark.createDataFrame([(1, "x")], "k int, name string")
    assert rows(chain(a, (b, "k", "left"))) == [(1, 5, "x"), (2, 6, None)]


def test_read_options():
    whole = jdbc.read_options(URL, "db.clients")
    assert whole["dbtable"] == "db.clients" and "partitionColumn" not in whole
    query = jdbc.read_options(URL, "select id from t ", extra={"user": "u"})
    assert (query["dbtable"], query["user"]) == ("(select id from t) q", "u")


@pytest.mark.parametrize(
    ("text", "query"),
    [("select 1", True), ("SELECT\tid from t", True), ("\n with x as (select 1) select * from x", True),
     ("selections", False), ("with_x", False), ("db.select_log", False)],
)
def test_what_is_a_query(text, query):
    assert jdbc.is_query(text) is query
    assert (jdbc.read_options(URL, text)["dbtable"] != text.strip()) is query
    assert jdbc.size_query(text) == f"select count(*) as n from {f'({text.strip()}) q' if query else text}"


def test_a_with_clause_goes_apart():
    options = jdbc.read_options(URL, "select id from x", extra={"prepareQuery": "with x as (select 1 as id)"})
    assert options["dbtable"] == "(select id from x) q" and options["prepareQuery"] == "with x as (select 1 as id)"


def test_cut_points_split_all_rows():
    """The statements, run by DuckDB."""
    import duckdb

    con = duckdb.connect()
    con.execute("create table t as select case when i % 10 = 0 then i else 7 end as k from range(1000) r(i)")
    con.execute("insert into t select null from range(5)")
    cuts = [r[0] for r in con.execute(jdbc.cuts_query("t", "k", 8)).fetchall()]
    conditions = jdbc.predicates("k", cuts)
    n = [con.execute(f"select count(*) from t where {c}").fetchone()[0] for c in conditions]
    assert sum(n) == 1005 and len(n) > 1
    assert jdbc.predicates("k", []) == jdbc.predicates("k", [3]) == ["1 = 1"]
    assert jdbc.predicates("k", ["a", "o'b"]) == ["k < 'o''b' or k is null", "k >= 'o''b'"]


def test_a_staged_table_is_taken_over_whole():
    import duckdb

    con = duckdb.connect()
    con.execute("create table t as select 1 as a, 'x' as b")
    con.execute("create table t__stage as select 'y' as b, 2 as a")
    for text in jdbc.take_over("t", ["a", "b"]):
        con.execute(text)
    assert con.execute("select a, b from t").fetchall() == [(2, "y")]
    with pytest.raises(ValueError):
        jdbc.take_over("t; drop table x", ["a"])


def test_write_options():
    assert jdbc.write_options(URL, "t")["batchsize"] == "1000"
    assert jdbc.write_options(URL, "t", extra={"user": "u"})["user"] == "u"


@pytest.fixture
def calls(monkeypatch):
    """What a write or read would have been asked to do."""
    seen = []

    def note(self, **options):
        self._seen = {**getattr(self, "_seen", {}), **options}
        return self

    def mode(self, name):
        self._seen = {**getattr(self, "_seen", {}), "mode": name}
        return self

    for kind in (readwriter.DataFrameWriter, readwriter.DataFrameReader):
        monkeypatch.setattr(kind, "options", note)
    monkeypatch.setattr(readwriter.DataFrameWriter, "mode", mode)
    monkeypatch.setattr(readwriter.DataFrameWriter, "save", lambda self: seen.append(self._seen))
    monkeypatch.setattr(readwriter.DataFrameReader, "load", lambda self: seen.append(self._seen))
    return seen


def test_append_replace_and_copy(spark, calls, monkeypatch):
    ran = []
    monkeypatch.setattr(jdbc, "run_in_transaction", lambda spark, url, texts, extra=None: ran.append(list(texts)))
    df = spark.range(1)
    jdbc.append(df, URL, "t", user="u")
    jdbc.replace(df, URL, "t")
    jdbc.copy_query(spark, "select :n as n", URL, "c", "replace", {"n": 1})
    jdbc.copy_query(spark, "select 1 as n", URL, "c")
    got = [(c["dbtable"], c["mode"], c["batchsize"]) for c in calls]
    assert got == [
        ("t", "append", "1000"),
        ("t__stage", "overwrite", "1000"),
        ("c__stage", "overwrite", "10000"),
        ("c", "append", "10000"),
    ]
    assert ran[0] == ["delete from t", "insert into t (id) select id from t__stage"]
    assert ran[1] == ["drop table t__stage"] and len(ran) == 4
    assert calls[0]["user"] == "u"
    with pytest.raises(ValueError):
        jdbc.copy_query(spark, "select 1 as n", URL, "c", "upsert")


def test_a_read_is_split_by_key(spark, calls):
    seen = []
    keep = readwriter.DataFrameReader.jdbc
    try:
        readwriter.DataFrameReader.jdbc = lambda self, *args, **kwargs: seen.append((args, kwargs))
        jdbc.read_table(spark, URL, "t", "id", [0, 5, 9], user="u")
    finally:
        readwriter.DataFrameReader.jdbc = keep
    (args, kwargs), = seen
    assert args == (URL, "t") and kwargs["properties"] == {"fetchsize": "10000", "user": "u"}
    assert kwargs["predicates"] == ["id < 5 or id is null", "id >= 5 and id < 9", "id >= 9"]
    jdbc.read_table(spark, URL, "t")
    assert calls[0]["dbtable"] == "t"
