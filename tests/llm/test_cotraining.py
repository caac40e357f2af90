import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import cotraining as co


def test_held_out_accuracy(spark):
    """Trained without one label in four, the classifier knows those pages."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    apart = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(4)) == 0
    seen = labels.where(~apart)
    found = co.classify(docs.select("doc_id", "text", "source", "lang"), seen).join(labels.where(apart), "doc_id").toPandas()
    clean = found[(found.quality == 1) & (found.toxic == 0)]
    assert len(found) > 700 and clean.kept.mean() > 0.97
    assert (~found[found.toxic == 1].kept).mean() > 0.9
    assert (~found[found.quality == 0].kept).mean() > 0.85


def _pages(n, seed):
    """A text word and a source that each say the label in most pages, independently of each other."""
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    word = np.where(rng.random(n) < 0.9, y, 1 - y)
    name = np.where(rng.random(n) < 0.9, y, 1 - y)
    texts = [f"{'good' if w else 'bad'} filler{i % 7} filler{i % 11}".encode() for i, w in enumerate(word)]
    return (co.text_view(texts), co.meta_view(texts, [[f"site{k}" for k in name]])), y


def _model(bags, y, rounds):
    """Co-training of pages that are all here; ``y`` is -1 where a page has no label."""
    fold = np.arange(len(y)) % co.FOLDS
    model = co.fitted(bags, y, fold, 1.0)
    for _ in range(rounds):
        exchange = co.Exchange({"y": model})
        exchange.add(bags)
        model = co.fitted(bags, y, fold, 1.0, exchange.told["y"])
    return model


def _right(p, y):
    return ((p >= 0.5) == y)[300:].mean()


@pytest.mark.parametrize("seed", range(1, 6))
def test_pseudo_labels_and_both_views_help(seed):
    bags, y = _pages(4000, seed)
    known = np.where(np.arange(4000) < 300, y, -1)
    model = _model(bags, known, co.ROUNDS)
    right = _right(model.probability(bags), y)
    one, two = (_right(co.sigmoid(v.logits(b)), y) for v, b in zip(model.views, bags, strict=True))
    # 0.9 is the best there is for a view, and for both where they differ
    assert right > 0.87 and right > max(one, two) - 0.02
    assert (model.mixture[:-1] >= 0).all() and all(c[0] >= 0 for c in model.calibration)
    assert right >= _right(_model(bags, known, 0).probability(bags), y) - 0.01


def _worded(n, seed):
    """Pages of which a view sees one of many words; only some of the words are in labelled pages."""
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    texts = [" ".join(f"w{'good' if k else 'evil'}{chr(97 + c % 26)}{chr(97 + c // 26)}" for c in rng.integers(0, 500, 3)).encode() for k in y]
    name = np.where(rng.random(n) < 0.995, y, 1 - y)
    return (co.text_view(texts), co.meta_view(texts, [[f"site{k}" for k in name]])), y


@pytest.mark.parametrize("seed", range(5))
def test_a_view_learns_words_from_the_other(seed, monkeypatch):
    monkeypatch.setattr(co, "BEGINNINGS", ())  # or the words would give themselves away
    bags, y = _worded(4000, seed)
    known = np.where(np.arange(4000) < 250, y, -1)
    alone, taught = _model(bags, known, 0), _model(bags, known, co.ROUNDS)
    view = lambda m: _right(co.sigmoid(m.views[0].logits(bags[0])), y)
    assert view(taught) > view(alone) + 0.1 and view(taught) > 0.9
    assert _right(taught.probability(bags), y) >= _right(alone.probability(bags), y) - 0.005


def test_the_exchange_counts_all_pages(spark, monkeypatch):
    """Over all documents, in tasks, the same numbers as in one place."""
    bags, y = _pages(300, 2)
    model = _model(bags, y, 0)
    model.calibration = [np.array([0.1, 8.0]), np.array([0.1, -8.0])]  # sure of nearly all pages
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source", "lang").repartition(7)
    rows = docs.collect()
    models = {"quality": model, "toxic": co.CoTrained(None, 0.1)}
    here = co.Exchange(models)
    here.add((co.text_view([r.text.encode() for r in rows]), co.meta_view([r.text.encode() for r in rows], [[r.source for r in rows], [r.lang for r in rows]])))
    told = co._told_by_all(docs, models)
    assert set(told) == {"quality"}
    for mine, theirs in zip(told["quality"], here.told["quality"], strict=True):
        assert (mine.counts == theirs.counts).all() and (mine.pages == theirs.pages).all()
    assert sum(t.pages.sum() for t in told["quality"]) > 0


def test_the_views_share_no_feature():
    texts = [b"some words", b"other text\nwith lines"]
    a = co.meta_view(texts, [["s", None], ["en", "en"]])
    b = co.meta_view([b"xome wards", b"third text\nmade linee"], [["s", None], ["en", "en"]])
    assert (a.features == b.features).all()  # spelled otherwise, laid out alike
    assert (co.text_view([b"The THE the###"]).features == co.text_view([b"the"]).features).all()


def test_one_class_or_no_labels(spark, docs, none):
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = co.classify(docs, nothing, keep_text=True)
    assert set(out.columns) == {*docs.columns, "p_quality", "p_toxic"}
    got = out.collect()
    assert len(got) == docs.count() and {(r["p_quality"], r["p_toxic"], r["kept"]) for r in got} == {(1.0, 0.0, True)}
    bad = spark.createDataFrame([(i, 0, None if i == 3 else 1) for i in range(5)], nothing.schema)
    assert {r["kept"] for r in co.classify(docs, bad).collect()} == {False}
    assert co.classify(none, nothing).collect() == [] and co.accepted(none, nothing).collect() == []


def test_accepted_keeps_the_columns(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    found = co.accepted(docs, labels)
    assert found.columns == docs.columns
    marked = co.classify(docs, labels).where("kept")
    assert found.count() == marked.count()


def test_conflicting_labels_count_as_the_worse(spark, docs, monkeypatch):
    seen = {}
    monkeypatch.setattr(co, "fitted", lambda bags, y, fold, default, told=None: seen.setdefault(default, y) is y and co.CoTrained(None, 0.5))
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    co.train(docs, labels)
    assert sorted(seen[1.0].tolist()) == [0, 1] and seen[0.0].max() == 1


@pytest.mark.parametrize("seed", range(2))
def test_pages_of_bags(seed):
    bags, _ = _pages(50, seed)
    some = np.arange(50) % 3 == 0
    found = bags[0].where(some)
    assert len(found.first) == 18 and found.first[-1] == len(found.features)
    for i, page in enumerate(np.flatnonzero(some)):
        mine = found.features[found.first[i] : found.first[i + 1]]
        assert (mine == bags[0].features[bags[0].first[page] : bags[0].first[page + 1]]).all()


@pytest.mark.parametrize("ids", ["own", "one"])
def test_what_comes_to_the_driver_is_bounded(spark, monkeypatch, ids):
    """Labels of other pages do not count, and the rows of one id do not come as one block."""
    sizes = []
    monkeypatch.setattr(co, "fitted", lambda bags, y, fold, default: sizes.append(len(y)) or co.CoTrained(None, 0.5))
    docs = spark.range(2000).selectExpr(
        "id as doc_id" if ids == "own" else "cast(7 as bigint) as doc_id", "concat('word', id % 9) as text", "'s' as source", "'en' as lang"
    )
    labels = spark.range(0, 8000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    co.train(docs, labels, labelled=100)
    assert 50 < sizes[0] < 200
