from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from tests.llm import brute

from tidemark.llm import queries, rollup
from tidemark.llm.tokens import default_vocabulary
from tidemark.sources import snapshots

VERSIONS = {"bpe": default_vocabulary(), "words": None}


def _plain(rows, tokenizer):
    out = defaultdict(lambda: [0, 0])
    for _, text, lang, source, _ in rows:
        for version, n in (("bpe", len(brute.ids_of(text, tokenizer))), ("words", len(brute.words(text)))):
            out[source, lang, version][0] += 1
            out[source, lang, version][1] += n
    return {k: tuple(v) for k, v in out.items()}


def _totals(spark, table):
    return {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals(spark, table).collect()}


@pytest.fixture
def counted(spark, docs):
    return rollup.counts(docs, VERSIONS)


def test_inserts_deletes_and_revisions(spark, counted, rows_, tokenizer, tmp_path):
    table = str(tmp_path / "t")
    assert rollup.commit(table, "b1", rollup.changes(counted))
    assert _totals(spark, table) == _plain(rows_, tokenizer)

    gone, old = rows_[:20], rows_[20:40]
    new = [(i, "now other words", "fr", s, 3) for i, _, _, s, _ in old]
    count = lambda r: rollup.counts(brute.frame(spark, r), VERSIONS)
    batch = rollup.changes(deleted=count(gone), revised=(count(old), count(new)))
    assert rollup.commit(table, "b2", batch)
    left = _plain(rows_[40:] + new, tokenizer)
    assert _totals(spark, table) == left

    # delivered again, nothing changes
    assert not rollup.commit(table, "b2", batch) and not rollup.commit(table, "b1", rollup.changes(counted))
    assert _totals(spark, table) == left

    rollup.compact(spark, table, ["b1", "b2"], "b1")
    assert _totals(spark, table) == left
    assert rollup.committed(spark, table, "b2") and not rollup.commit(table, "b2", batch)
    with pytest.raises(ValueError):
        rollup.compact(spark, table, ["b1", "b9"], "b1")


def test_a_batch_that_fails_leaves_the_totals(spark, counted, rows_, tokenizer, tmp_path):
    table = str(tmp_path / "t")
    rollup.commit(table, "b1", rollup.changes(counted))
    broken = counted.selectExpr("source", "lang", "tokenizer", "n_docs", "raise_error('lost') as n_tokens")
    with pytest.raises(Exception, match="lost"):
        rollup.commit(table, "b2", broken)
    assert not rollup.committed(spark, table, "b2")
    assert _totals(spark, table) == _plain(rows_, tokenizer)
    assert rollup.commit(table, "b2", rollup.negated(counted)) and _totals(spark, table) == {}


def test_empty(spark, none, tmp_path):
    table = str(tmp_path / "t")
    assert _totals(spark, table) == {}
    assert rollup.commit(table, "b1", rollup.changes(rollup.counts(none, VERSIONS)))
    assert rollup.committed(spark, table, "b1") and _totals(spark, table) == {}
    with pytest.raises(ValueError):
        rollup.changes()


def test_the_query_revises_and_deletes(spark, docs, rows_, tokenizer, tmp_path, monkeypatch):
    """The registered query covers all documents by each kind of change and still gives a plain recount."""
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    tables, done = [], []
    folder, commit = queries.new_folder, rollup.commit

    def kept_folder(*args):
        tables.append(folder(*args))
        return tables[-1]

    def kept_commit(table, batch, signed):
        done.append((batch, commit(table, batch, signed)))
        return done[-1][1]

    monkeypatch.setattr(queries, "new_folder", kept_folder)
    monkeypatch.setattr(rollup, "commit", kept_commit)
    found = {tuple(r)[:3]: tuple(r)[3:] for r in queries.op8_token_counts(spark, str(tmp_path)).collect()}
    names = {rollup.BPE: "bpe", rollup.WORDS: "words"}
    assert {(*k[:2], names[k[2]]): v for k, v in found.items()} == _plain(rows_, tokenizer)
    stored = snapshots.current(spark, tables[0], "batch").where("tokenizer = 'words-1'")
    sums = {r["batch"]: (r["up"], r["down"]) for r in stored.groupBy("batch").agg(
        F.expr("coalesce(sum(n_docs) filter (where n_docs > 0), 0)").alias("up"),
        F.expr("coalesce(sum(n_docs) filter (where n_docs < 0), 0)").alias("down"),
    ).collect()}
    assert sums["insert"] == (len(rows_), 0)
    assert sums["revise"][1] < 0 < sums["revise"][0]
    assert sums["delete"][1] == -sums["again"][0] < 0
    assert [d for _, d in done] == [True, False] * 4
