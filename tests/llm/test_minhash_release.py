"""The near-duplicate search lets go of what its earlier steps shuffled."""

from tests.conftest import rows
from tidemark.llm import minhash


def test_each_step_starts_without_the_shuffles_of_the_last(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(minhash, "released", lambda s: calls.append(s))
    docs = [(i, " ".join(f"w{i % 3}_{j}" for j in range(40))) for i in range(9)]
    found = minhash.report(spark.createDataFrame(docs, "doc_id long, text string"))
    assert [r[0] for r in rows(found.where("kept"), "doc_id")] == [0, 1, 2]
    assert len(calls) == 5
