"""Near-duplicates: MinHash signatures, banding, verification on full sets, components.

A document's set holds its different shingles: runs of ``SHINGLE`` words after lower-casing
A-Z, or all its words where it has fewer. Documents are linked when
100 * intersection >= percent * union. Documents with the same set (by a 128-bit
fingerprint) form a class, and classes are compared, by one document for each.

``HASHES`` universal hash functions give a signature; bands of it give buckets. How many
rows a band has follows from the similarity asked for: as many as leave a link at the
threshold a chance below ``MISS`` of never sharing a bucket.

Candidates, first round: each bucket's smallest member against all others, so a bucket of any
size gives fewer pairs than it has members. Pairs whose signatures agree well enough
(the margin has the same tiny chance of missing a link) are confirmed on the words of the
texts, and components are formed. Second round: a bucket whose members are not all in one
component yet may hide links between those that were not compared. It is compared in blocks,
across components only: pairs that agree by signature are confirmed inside the block's
task, which has the texts, and only links that join something new leave it. So no link
between different texts is lost, no pair is a row that is not likely a link, and pairs
that can no longer change a component are not looked at.

Null or empty texts have an empty set and are linked with nothing. A null doc_id is no
component's name unless no member has one. Repeated rows are alike in all results.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.frames import each_slice, free_names, freeze, released, with_columns
from tidemark.llm.text import SLICE_BYTES, Words, binary, mix, windows

SHINGLE = 5
PERCENT = 80
HASHES = 128
MISS = 1e-6
BLOCK = 500
_NO_ID = 2**63 - 1


def bands(percent: int, hashes: int = HASHES, miss: float = MISS) -> tuple[int, int]:
    """Number of bands and rows per band: most rows for which a link is missed too seldom."""
    fits = [r for r in range(1, hashes + 1) if (1 - (percent / 100) ** r) ** (hashes // r) <= miss]
    if not fits:
        raise ValueError("too few hash functions for this similarity")
    return hashes // fits[-1], fits[-1]


def least_agreement(percent: int, hashes: int = HASHES, miss: float = MISS) -> int:
    """How many of the hash minima two linked sets share, but for a chance below ``miss``."""
    p, below = percent / 100, 0.0
    for k in range(hashes + 1):
        below += comb(hashes, k) * p**k * (1 - p) ** (hashes - k)
        if below > miss:
            return k
    return hashes


def _family(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(71)
    a = rng.integers(0, 2**63, hashes, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
    return a, rng.integers(0, 2**63, hashes, dtype=np.uint64)


def shingles(texts: list[bytes], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each text as hashes, text by text, and where each text's begin."""
    words = Words(texts, lower=True)
    hashes, doc = words.hashes(), words.docs()
    run, inside = windows(hashes, words.first, k)
    at = np.flatnonzero(inside)
    found, of = [run[at]], [doc[at]]
    for n in range(1, k):  # texts of fewer words
        short = np.flatnonzero(words.counts == n)
        if len(short):
            found.append(mix(windows(hashes, words.first, n)[0][words.first[short]] + np.uint64(n)))
            of.append(short)
    value, owner = np.concatenate(found), np.concatenate(of)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(len(texts) + 1))


def signatures(value: np.ndarray, first: np.ndarray, hashes: int = HASHES) -> np.ndarray:
    """A row of minima per text; zeros for empty sets."""
    out = np.zeros((len(first) - 1, hashes), np.uint32)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        a, b = _family(hashes)
        starts = first[full]
        for i in range(hashes):
            out[full, i] = np.minimum.reduceat(value * a[i] + b[i], starts) >> np.uint64(32)
    return out


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([np.uint64(0)], np.cumsum(values, dtype=np.uint64)))[first])


def _sets(docs: DataFrame, doc_id: str, text: str, k: int, hashes: int) -> DataFrame:
    """doc_id, key (tells texts under one doc_id apart), n, fingerprint and signature of each row.

    ``small`` is the lowest byte of each minimum, enough to compare signatures with: bytes
    that agree by chance only add candidates.
    """

    def step(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        value, first = shingles(texts, k)
        one, two = _sums(mix(value), first), _sums(mix(value ^ np.uint64(0x5851F42D4C957F2D)), first)
        prints = np.stack((one, two), 1)
        signs = signatures(value, first, hashes)
        return with_columns(
            rows,
            drop=("text",),
            n=pa.array(np.diff(first)),
            print=pa.array([x.tobytes() for x in prints], pa.binary()),
            sign=pa.array([x.tobytes() for x in signs], pa.binary()),
            small=pa.array([x.tobytes() for x in signs.astype(np.uint8)], pa.binary()),
        )

    keyed = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
        F.xxhash64(F.col(f"`{text}`")).alias("key"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    return each_slice(keyed, step, "doc_id bigint, key bigint, n bigint, print binary, sign binary, small binary")


def _buckets(classes: DataFrame, count: int, rows: int) -> DataFrame:
    """node, band and bucket of each class, one row per band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column("node").to_numpy()
            sign = np.frombuffer(b"".join(batch.column("sign").to_pylist()), np.uint32).reshape(len(node), -1)
            keys = np.zeros((len(node), count), np.uint64)
            for b in range(count):
                key = np.full(len(node), b + 1, np.uint64)
                for r in range(rows):
                    key = mix(key + sign[:, b * rows + r].astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
                keys[:, b] = key
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(node, count)),
                    pa.array(np.tile(np.arange(count, dtype=np.int32), len(node))),
                    pa.array(keys.ravel().view(np.int64)),
                ],
                names=["node", "band", "bucket"],
            )

    return classes.select("node", "sign").mapInArrow(run, "node bigint, band int, bucket bigint")


def _agreeing(pairs: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) whose signatures share at least ``least`` minima."""
    signs = classes.select(F.col("node").alias("b"), F.col("small").alias("sign_b"))
    other = classes.select(F.col("node").alias("a"), F.col("small").alias("sign_a"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                    for c in ("sign_a", "sign_b")
                )
                fit = pa.array((one == two).sum(axis=1) >= least)
                yield batch.select(["a", "b"]).filter(fit)

    return pairs.join(signs, "b").join(other, "a").mapInArrow(run, "a bigint, b bigint")


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int, k: int) -> DataFrame:
    """The pairs that are links by the full sets of their texts; ``texts`` has node and text."""
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (binary(batch.column(c)) for c in ("text_a", "text_b"))
            sizes = [
                len(x.as_py()) + len(y.as_py()) for x, y in zip(left, right, strict=True)
            ]
            cut = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_BYTES)) + 1
            for a, b in zip([0, *cut], [*cut, batch.num_rows], strict=True):
                if b > a:
                    linked = _linked(left[a:b].to_pylist(), right[a:b].to_pylist(), percent, k)
                    yield batch.slice(a, b - a).select(["a", "b"]).filter(pa.array(linked))

    return pairs.join(two, "b").join(one, "a").mapInArrow(run, "a bigint, b bigint").distinct()


def _linked(left: list[bytes], right: list[bytes], percent: int, k: int) -> np.ndarray:
    """Which texts of two lists are linked, pair by pair."""
    (one, first), (two, second) = shingles(left, k), shingles(right, k)
    n_one, n_two = np.diff(first), np.diff(second)
    pair = np.concatenate((np.repeat(np.arange(len(left)), n_one), np.repeat(np.arange(len(left)), n_two)))
    value = np.concatenate((one, two))
    order = np.lexsort((value, pair))
    value, pair = value[order], pair[order]
    both = pair[1:][(value[1:] == value[:-1]) & (pair[1:] == pair[:-1])]
    shared = np.bincount(both, minlength=len(left))
    return 100 * shared >= percent * (n_one + n_two - shared)


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Runs of rows that agree in ``names``; the rows come sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(n).to_numpy() for n in names], 1)
        cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cut], [*cut, batch.num_rows], strict=True):
            key = tuple(keys[a])
            if last is not None and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _matrix(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _links_across(least: int, percent: int, k: int, count: int, rows: int):
    """Links between components among the blocks of a group, found on full sets in the task.

    Guests are compared with those at home; where there are none, all are at home and compared
    with each other. Of the pairs that agree by signature, those that share an earlier band are left to it.
    Links that join nothing new within the blocks are not needed and not given.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["bucket", "low", "high"]):
            node, comp = (group.column(c).to_numpy() for c in ("node", "comp"))
            guest = np.array(group.column("guest").to_pylist(), bool)
            band = group.column("band")[0].as_py()
            sign = _matrix(group.column("sign"), np.uint32)
            value, first = shingles([zstandard.decompress(t) for t in group.column("packed").to_pylist()], k)
            size = np.diff(first)
            comp, found = comp.copy(), []
            for i in range(len(node)):
                if guest.any():
                    to = ~guest & (comp != comp[i]) if guest[i] else np.zeros(len(node), bool)
                else:
                    to = (np.arange(len(node)) > i) & (comp != comp[i])
                to &= 100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])
                others = np.flatnonzero(to)
                same = sign[others] == sign[i]
                earlier = same[:, : count * rows].reshape(-1, count, rows).all(axis=2)[:, :band].any(axis=1)
                others = others[(same.sum(axis=1) >= least) & ~earlier]
                if not len(others):
                    continue
                mine = value[first[i] : first[i + 1]]
                stop = np.cumsum(size[others])
                at = np.repeat(first[others] - (stop - size[others]), size[others]) + np.arange(stop[-1])
                theirs = value[at]
                place = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
                shared = np.add.reduceat((mine[place] == theirs).astype(np.int64), stop - size[others])
                linked = others[100 * shared >= percent * (size[i] + size[others] - shared)]
                for j in linked.tolist():
                    if comp[j] != comp[i]:
                        comp[comp == comp[j]] = comp[i]
                        found.append(sorted((node[i], node[j])))
            if found:
                pair = np.array(found)
                yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["a", "b"])

    return run


def _open_buckets(buckets: DataFrame, roots: DataFrame, block: int) -> DataFrame:
    """Members of buckets of three and more that hold several components, dealt out to groups.

    Of two members of different components at least one is outside the bucket's largest component.
    So members are dealt into blocks, outsiders into blocks of their own, and each block of members
    meets each block of outsiders: n ceil(o / block) + o ceil(n / block) rows for n members
    and o outsiders, which is about n where outsiders are few. A group holds two blocks at most.
    """
    labelled = buckets.join(roots.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left")
    labelled = labelled.select("bucket", "band", "node", F.coalesce("root", "node").alias("comp"))
    shares = labelled.groupBy("bucket", "comp").agg(F.count("*").alias("m"))
    largest = F.max(F.struct("m", "comp"))
    mixed = shares.groupBy("bucket").agg(F.sum("m").alias("n"), F.count("*").alias("comps"), largest.alias("l"))
    blocks = lambda n: F.ceil(n / block).cast("int")
    mixed = mixed.where("n > 2 and comps > 1").select(
        "bucket", F.col("l.comp").alias("giant"), blocks(F.col("n")).alias("blocks"),
        blocks(F.col("n") - F.col("l.m")).alias("others"),
    )
    found = labelled.join(mixed, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    found = freeze(found)  # both kinds of rows come from it
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    at_home = found.withColumn("other", upto("others")).withColumn("guest", F.lit(False))
    # the outsiders of a bucket of one block are at home there
    outside = found.where("comp <> giant and blocks > 1")
    outside = outside.withColumn("other", F.pmod(F.xxhash64("node", F.lit(5)), F.col("others")).cast("int"))
    guests = outside.withColumn("own", upto("blocks")).withColumn("guest", F.lit(True))
    columns = ["bucket", "band", "node", "comp", F.col("own").alias("low"), F.col("other").alias("high"), "guest"]
    return at_home.select(*columns).unionByName(guests.select(*columns))


def _packed(texts: DataFrame) -> DataFrame:
    """Texts compressed, since each goes to all open buckets that its document is in."""

    def step(rows: pa.RecordBatch, found: list[bytes]) -> pa.RecordBatch:
        return with_columns(rows, ("text",), packed=pa.array([zstandard.compress(t, 3) for t in found], pa.binary()))

    return each_slice(texts, step, "node bigint, packed binary")


def _dealt(members: DataFrame) -> DataFrame:
    keys = ("bucket", "low", "high")
    return members.repartition(*keys).sortWithinPartitions(*keys)


def classes_and_links(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    k: int = SHINGLE,
    hashes: int = HASHES,
    block: int = BLOCK,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sets of all rows; classes (node, print, smallest doc_id); links between nodes."""
    released(docs.sparkSession)  # what an earlier step shuffled
    sets = freeze(_sets(docs, doc_id, text, k, hashes)).withColumn("row", F.monotonically_increasing_id())
    order = F.struct(F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), "row")
    best = sets.where("n > 0").groupBy("print").agg(F.min(order).alias("first"))
    best = best.select("print", F.col("first.row").alias("row"))
    classes = freeze(
        sets.join(best.select("row"), "row")
        .select(F.col("row").alias("node"), "doc_id", "key", "print", "sign", "small")
    )
    buckets = _buckets(classes, *bands(percent, hashes))
    pivots = buckets.groupBy("bucket").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1")
    stars = buckets.join(pivots, "bucket").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    least = least_agreement(percent, hashes)
    first = freeze(_agreeing(stars, classes, least))
    released(docs.sparkSession)  # buckets and signatures that were shuffled for it

    def texts(pairs: DataFrame) -> DataFrame:
        return texts_of(pairs.select(F.explode(F.array("a", "b")).alias("node")))

    def texts_of(nodes: DataFrame) -> DataFrame:
        wanted = nodes.select("node").distinct()
        ids = classes.select("node", F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), "key").join(wanted, "node")
        own = docs.select(
            F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(_NO_ID)).alias("id"),
            F.xxhash64(F.col(f"`{text}`")).alias("key"),
            F.col(f"`{text}`").cast("string").alias("text"),
        )
        return own.join(ids, ["id", "key"]).select("node", "text")

    links = freeze(_confirmed(first, texts(first), percent, k))
    released(docs.sparkSession)  # texts that were shuffled for the first round

    roots = components(links.toDF("u", "v"))
    open_ = freeze(_open_buckets(buckets, roots, block))
    released(docs.sparkSession)
    # signature and text meet once per document, then go to all groups that it is in
    held = freeze(classes.select("node", "sign").join(_packed(texts_of(open_)), "node"))
    released(docs.sparkSession)  # whole texts that were shuffled to be packed
    whole = open_.join(held, "node")
    rest = _dealt(whole).mapInArrow(
        _links_across(least, percent, k, *bands(percent, hashes)), "a bigint, b bigint"
    )
    # the components so far are stars, which stand for the links that made them
    links = roots.select(F.col("v").alias("a"), F.col("u").alias("b")).unionByName(freeze(rest))
    return sets, classes, links


def report(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, k: int = SHINGLE
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept; and its key."""
    sets, classes, links = classes_and_links(docs, doc_id, text, percent, k)
    roots = components(links.toDF("u", "v")).select(F.col("u").alias("node"), F.col("v").alias("root"))
    named = classes.join(roots, "node", "left").select(
        "print", "doc_id", F.coalesce("root", "node").alias("root")
    )
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    found = named.join(least, "root").select("print", "component_id")
    own = sets.select("doc_id", "key", F.col("n").alias("n_shingles"), "print")
    filled = own.where("n_shingles > 0").join(found, "print")
    empty = own.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id", "key"]
    out = filled.select(*columns).unionByName(empty.select(*columns))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        "doc_id", "n_shingles", "component_id", "kept", "key"
    )


def deduplicate(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, k: int = SHINGLE
) -> DataFrame:
    """The documents of ``docs`` that stay, one per component, with all their columns.

    Of rows alike in doc_id and text one stays; documents without words all stay.
    """
    own_id, own_key, words, rank = free_names(docs, "own_id", "own_key", "has_words", "rank")
    kept = report(docs, doc_id, text, percent, k).where("kept").select(
        F.coalesce("doc_id", F.lit(_NO_ID)).alias(own_id),
        F.col("key").alias(own_key),
        (F.col("n_shingles") > 0).alias(words),
    ).distinct()
    keyed = docs.withColumns(
        {
            own_id: F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(_NO_ID)),
            own_key: F.xxhash64(F.col(f"`{text}`")),
        }
    )
    same = Window.partitionBy(own_id, own_key).orderBy(own_id)
    left = keyed.join(kept, [own_id, own_key]).withColumn(rank, F.row_number().over(same))
    return left.where(~F.col(words) | (F.col(rank) == 1)).select(*[F.col(f"`{c}`") for c in docs.columns])
