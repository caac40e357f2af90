import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm import brute

from tidemark.llm import packing


def _pieces(rows, tokenizer, capacity):
    out = []
    for doc, text, *_ in rows:
        ids = [*brute.ids_of(text, tokenizer), 0]
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            out.append((doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return sorted(out, key=repr)


def _gapless(found, capacity):
    bins = defaultdict(list)
    for r in found:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("capacity", [2048, 50])
def test_pieces_and_sequences(docs, rows_, tokenizer, capacity):
    found = packing.best_fit(docs, capacity=capacity).collect()
    plain = _pieces(rows_, tokenizer, capacity)
    assert sorted(((r[0], r[1], r[2], r[3], r[4]) for r in found), key=repr) == plain
    bins = _gapless(found, capacity)
    total = sum(p[3] for p in plain)
    assert -(-total // capacity) <= bins <= 1.03 * total / capacity + 1


def _bins(spark, sizes, parts, **kw):
    rows = [(i, i, 0, 0, s, 0) for i, s in enumerate(sizes)]
    found = packing.pack(spark.createDataFrame(rows, packing._PIECE).repartition(parts), 100, **kw)
    got = found.collect()
    assert sorted((r["doc_id"], r["length"]) for r in got) == list(enumerate(sizes))
    return _gapless(got, 100)


def test_rounds_reach_the_quality_of_one_best_fit(spark):
    rng = random.Random(4)
    sizes = [rng.randint(1, 100) for _ in range(3000)]
    fit = packing.BestFit(100)
    for s in sorted(sizes, reverse=True):
        fit.add(0, s)
    assert _bins(spark, sizes, 24) == len(fit.content)
    assert _bins(spark, sizes, 24, first=400) <= 1.04 * len(fit.content)  # eight tasks, then one


def test_merging_stops_at_the_bound_and_loses_nothing(spark):
    assert _bins(spark, [51] * 200, 9, first=20, items=50) == 200
    assert _bins(spark, [30, 30, 40] * 40, 9, first=15, items=30) <= 48


def test_best_fit_takes_the_fullest_bin():
    fit = packing.BestFit(10)
    for i, s in enumerate([6, 5, 4, 5, 3, 3]):
        fit.add(i, s)
    assert fit.content == [[0, 2], [1, 3], [4, 5]]


def test_cuts():
    assert packing.cuts(1, 4) == [1] and packing.cuts(4, 4) == [4]
    assert packing.cuts(5, 4) == [1, 5] and packing.cuts(11, 4) == [3, 7, 11]


def test_empty_tables(none):
    assert packing.best_fit(none).collect() == []


def test_a_task_that_runs_again_packs_the_same(docs):
    one, two = (packing.best_fit(docs).groupBy("sequence_id").agg(F.sum("length")).count() for _ in range(2))
    assert one == two
