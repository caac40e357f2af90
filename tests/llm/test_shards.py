import os
import zlib

import numpy as np
import pytest
from tests.llm import brute

from tidemark.llm import shards


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 5001])
def test_permutation(n):
    one, two = shards.permute(np.arange(n), n, 1), shards.permute(np.arange(n), n, 2)
    assert sorted(one.tolist()) == sorted(two.tolist()) == list(range(n))
    if n > 1000:
        assert (one == two).mean() < 0.01 and abs(np.corrcoef(np.arange(n), one)[0, 1]) < 0.1


@pytest.fixture(scope="module")
def stored(spark, docs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("docs"))
    docs.write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def test_round_trip(stored, rows_, tokenizer, tmp_path):
    folder = str(tmp_path / "out")
    found = shards.write_shards(stored, folder, key=7, length=32, rows_each=100).collect()
    plain = []
    for doc, text, *_ in rows_:
        ids = [*brute.ids_of(text, tokenizer), 0]
        plain += [(doc, a // 32, ids[a : a + 32]) for a in range(0, len(ids), 32)]
    assert sorted(r["slot"] for r in found) == list(range(len(plain)))
    data = shards.read(folder, 0, len(plain))
    assert data.shape == (len(plain), 32)
    back = [(r["doc_id"], r["piece"], data[r["slot"]][: r["length"]].tolist()) for r in found]
    assert sorted(back, key=repr) == sorted(plain, key=repr)
    for r in found[:20]:
        assert r["shard"] == r["slot"] // 100 and r["byte_offset"] == r["slot"] % 100 * 64
        with open(f"{folder}/{shards.shard_name(r['shard'])}", "rb") as f:
            f.seek(r["byte_offset"])
            assert zlib.crc32(f.read(2 * r["length"])) == r["crc32"]
    # reading goes on from any slot, over shard borders, to the end
    assert (shards.read(folder, 95, 20) == data[95:115]).all()
    assert (shards.read(folder, len(plain) - 3, 50) == data[-3:]).all()
    assert not [n for n in os.listdir(folder) if n.startswith(".shard") and n.endswith(".bin")]


def test_a_path_without_scheme_is_one_of_sparks_file_system(spark, tmp_path):
    folder = str(tmp_path / "out")
    assert shards.qualified(spark, folder) == f"file:{folder}"
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.defaultFS", "viewfs://lake/")
    conf.set("fs.viewfs.mounttable.lake.link./data", f"file://{tmp_path}")
    try:
        assert shards.qualified(spark, "/data/out") == "viewfs://lake/data/out"
    finally:
        conf.set("fs.defaultFS", "file:///")


def test_wide_ids(stored, tokenizer, rows_, tmp_path):
    folder = str(tmp_path / "out")
    found = shards.write_shards(stored, folder, length=32, dtype="<u4")
    data = shards.read(folder, 0, 10**9)
    assert data.dtype == np.uint32 and data.sum() == sum(sum(brute.ids_of(t, tokenizer)) for _, t, *_ in rows_)
    assert found.agg({"length": "sum"}).first()[0] == sum(len(brute.ids_of(t, tokenizer)) + 1 for _, t, *_ in rows_)


def test_same_key_same_bytes(stored, tmp_path):
    one, two, other = (str(tmp_path / n) for n in "abc")
    for folder, key in ((one, 1), (two, 1), (other, 2)):
        shards.write_shards(stored, folder, key=key, length=64).collect()
    n = len(shards.read(one, 0, 10**9))
    assert (shards.read(one, 0, n) == shards.read(two, 0, n)).all()
    assert (shards.read(one, 0, n) != shards.read(other, 0, n)).any()


def test_documents_that_change_are_an_error(stored, tmp_path, monkeypatch):
    keep = shards._sequences
    monkeypatch.setattr(
        shards, "_sequences", lambda v, n, d, first, *a: keep(v, n, d, {p: (x, y, c + 1) for p, (x, y, c) in first.items()}, *a)
    )
    with pytest.raises(Exception, match="changed"):
        shards.write_shards(stored, str(tmp_path / "out"))
    assert not (tmp_path / "out" / shards.SUCCESS).exists()


def test_empty_table(none, tmp_path):
    folder = str(tmp_path / "out")
    assert shards.write_shards(none, folder).collect() == []
    assert shards.read(folder, 0, 5).shape == (0, shards.LENGTH)
