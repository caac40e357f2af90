import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm import brute

from tidemark.llm import minhash
from tidemark.llm.components import components


def _set(text):
    w = brute.words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def _roots(n, edges):
    root = list(range(n))
    for a, b in edges:
        old, new = max(root[a], root[b]), min(root[a], root[b])
        root = [new if r == old else r for r in root]
    return root


def _plain(rows, percent):
    sets = [_set(r[1]) for r in rows]
    edges = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    root = _roots(len(rows), edges)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((r[0], len(sets[i]), component, r[0] == component))
    return sorted(out, key=repr)


@pytest.mark.parametrize("percent", [80, 85])
def test_report_is_the_plain_one(docs, rows_, percent):
    found = sorted(map(tuple, minhash.report(docs, percent=percent).drop("key").collect()), key=repr)
    assert found == _plain(rows_, percent)
    assert sum(not r[3] for r in found) > 8


def test_links_the_first_round_misses(spark):
    """A large group of near copies in which few are linked with the smallest one."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for d in range(70):
        w = list(base)
        for at in rng.sample(range(len(w)), rng.choice((1, 2, 3))):
            w[at] = f"new{d}"
        rows.append((d, " ".join(w)))
    found = sorted(map(tuple, minhash.report(spark.createDataFrame(rows, "doc_id long, text string"), percent=85).drop("key").collect()), key=repr)
    assert found == _plain(rows, 85)


def test_blocks_of_a_bucket_lose_nothing(spark):
    rng = random.Random(9)
    rows = []
    for d in range(60):
        w = [f"w{i}" for i in range(80)]
        for at in rng.sample(range(len(w)), 2):
            w[at] = f"new{d}"
        rows.append((d, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, classes, links = minhash.classes_and_links(docs, percent=80, block=7)
    roots = {r["u"]: r["v"] for r in components(links.toDF("u", "v")).collect()}
    ids = {r["node"]: r["doc_id"] for r in classes.collect()}
    groups = {}
    for node, d in ids.items():
        groups.setdefault(roots.get(node, node), []).append(d)
    plain = {}
    for d, _, c, _ in _plain(rows, 80):
        plain.setdefault(c, []).append(d)
    assert sorted(sorted(g) for g in groups.values()) == sorted(sorted(g) for g in plain.values())


def test_one_outsider_costs_a_row_per_block(spark):
    """20,000 members of one component and one outsider: rows grow with the members, not their square."""
    buckets = spark.range(20_001).select(F.lit(1).cast("long").alias("bucket"), F.lit(0).alias("band"), F.col("id").alias("node"))
    roots = spark.range(1, 20_000).select(F.col("id").alias("u"), F.lit(0).cast("long").alias("v"))
    dealt = minhash._open_buckets(buckets, roots, 500)
    guests = dealt.where("guest").collect()
    assert {r.node for r in guests} == {20_000} and len(guests) == 41
    assert dealt.count() == 20_001 + 41
    assert dealt.groupBy("bucket", "low", "high").count().agg(F.max("count")).first()[0] <= 1000


def test_every_pair_of_two_components_meets_at_home_or_as_guest(spark):
    rng = random.Random(3)
    comp = {n: rng.choice((0, 0, 0, 1, 2, n)) for n in range(60)}
    buckets = spark.createDataFrame([(1, 4, n) for n in comp], "bucket long, band int, node long")
    roots = spark.createDataFrame([(n, c) for n, c in comp.items() if n != c], "u long, v long")
    met = set()
    groups = {}
    for r in minhash._open_buckets(buckets, roots, 7).collect():
        groups.setdefault((r.low, r.high), []).append(r)
    for rows_ in groups.values():
        guests = [r for r in rows_ if r.guest]
        for r in guests or rows_:
            met |= {frozenset((r.node, h.node)) for h in rows_ if not h.guest and h.comp != r.comp}
    assert met == {frozenset((a, b)) for a in comp for b in comp if comp[a] != comp[b]}


def test_bands_and_agreement():
    for percent in (50, 80, 85, 95):
        n, r = minhash.bands(percent)
        assert n * r <= 128 and (1 - (percent / 100) ** r) ** n <= 1e-6
    assert 70 < minhash.least_agreement(80) < 90
    with pytest.raises(ValueError):
        minhash.bands(5)


def test_signatures_estimate_similarity():
    one = " ".join(f"a{i}" for i in range(1000)).encode()
    two = " ".join(f"a{i}" for i in range(100, 1100)).encode()
    s = minhash.signatures(*minhash.shingles([one, two, b""]))
    assert abs((s[0] == s[1]).mean() - 896 / 1096) < 0.12 and not s[2].any()


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    edges = rng.integers(0, 60, (45, 2)).tolist() + [[7, 7], [1, 2], [2, 1], *[[100 + i, 101 + i] for i in range(20)]]
    edges += [[200, 201 + i] for i in range(40)]
    found = {r["u"]: r["v"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = _roots(300, edges)
    assert found == {i: r for i, r in enumerate(root) if i != r}


def test_deduplicate(docs, rows_, none):
    found = minhash.deduplicate(docs)
    assert found.columns == docs.columns
    kept = sorted((r["doc_id"] for r in found.collect()), key=repr)
    plain = _plain(rows_, 80)
    named = {r[0] for r in plain if r[3] and r[1] and r[0] is not None}
    empty = [r[0] for r in plain if r[3] and not r[1]]
    nameless = [None for r in plain if r[0] is None and r[2] is None and r[1]]
    both = [507]  # one doc_id with two texts: only the row that names the component counts
    assert [k for k in kept if k not in both] == sorted([x for x in [*named, *empty, *nameless] if x not in both], key=repr)
    assert minhash.deduplicate(none).collect() == [] and minhash.report(none).collect() == []
