import corpus_pipeline
import duckdb
import pytest
from tests.conftest import rows
from tests.llm import brute

from tidemark.llm import packing
from tidemark.llm.queries import ORACLES, QUERIES


def test_stages_keep_the_columns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
        sizes.append(docs.count())
    assert 200 > sizes[0] > sizes[1] > sizes[2] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
    assert len({r["doc_id"] for r in last}) == len({r["doc_id"] for r in docs.collect()})


def test_run_is_the_stages(spark, small):
    found = corpus_pipeline.run(spark, small)
    by = {}
    for r in found.collect():
        by[r["sequence_id"]] = by.get(r["sequence_id"], 0) + r["length"]
    assert by and max(by.values()) <= packing.CAPACITY
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "minhash_near_dedup", "source_mixing", "best_fit_packing",
    ]


def test_awkward_documents_pass_all_stages(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i % 5 > 0), int(i % 7 == 0)) for i in range(60)] + [(None, 1, 0), (4, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_an_empty_table_passes_all_stages(spark, none, tmp_path):
    none.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_result_as_sql(name, spark, small):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"create view {table} as select * from '{small}/{table}.parquet'")
    mine, theirs = QUERIES[name](spark, small), con.execute(ORACLES[name])
    columns = [c[0] for c in theirs.description]
    assert sorted(mine.columns) == sorted(columns)
    assert rows(mine, *columns) == sorted(theirs.fetchall(), key=repr)


def test_the_entry_knows_all_queries():
    import __spark_entry__ as driver

    names = driver.queries()
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op")}
    assert "pipeline" in names


def test_words_of_the_contract():
    assert brute.words("a\x0bb\x0cc\rd\te\nf g\x1ch i") == ["a", "b", "c", "d", "e", "f", "g\x1ch", "i"]
