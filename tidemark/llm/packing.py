"""Best-fit packing of tokenised documents into sequences, by hierarchical rounds.

A document becomes its token ids and an end id. One longer than a sequence is cut so
that all pieces but the first are full. Each partition packs its pieces best-fit,
longest first, and emits its nearly full bins; the others travel on, as items of the
size they are filled to, to fewer partitions, where best-fit runs again, and so on
like a tree. A bin carries the list of its pieces (at most one per token), so no join
puts the rounds together. Pieces of one length go by row and piece, so ties are settled the same way
in every run; a repeated row is packed twice, a null id is an id. A round stops merging where a task would get more than
``ITEMS`` bins: then the leftovers of that many bins are lost room, a share below
1 / ``ITEMS``.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import each_slice, freeze, plain
from tidemark.llm.tokens import default_vocabulary, ids

CAPACITY = 2048
END = 0
FIRST = 20_000
ITEMS = 400_000
MERGE = 8  # partitions that meet in one of the next round
NEARLY_FULL = 0.99  # a bin filled to this share of the capacity is emitted at once
_PIECE = "doc_id bigint, row bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def tokens(text: bytes, vocabulary: str, end: int = END) -> np.ndarray:
    return np.append(ids(text, vocabulary), np.uint32(end)).astype("<u4")


def cuts(n: int, capacity: int) -> list[int]:
    """Where the pieces of a document of ``n`` tokens end; all but the first are full."""
    return list(range((n - 1) % capacity + 1, n + 1, capacity))


def pieces(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
) -> DataFrame:
    """The pieces of each row: doc_id, row, piece, start, length, ids_crc32.

    A null text is empty and gives one piece, its end id. ``row`` tells rows with the
    same doc_id apart.
    """
    vocabulary = vocabulary or default_vocabulary()

    def step(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        out = []
        for doc, row, t in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), texts, strict=True):
            found, a = tokens(t, vocabulary), 0
            for k, b in enumerate(cuts(len(found), capacity)):
                out.append((doc, row, k, a, b - a, zlib.crc32(found[a:b].tobytes())))
                a = b
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
            names=["doc_id", "row", "piece", "start", "length", "ids_crc32"],
        )

    own = plain(docs, doc_id=doc_id, text=text)
    own = own.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    return each_slice(own, step, _PIECE)


class BestFit:
    """Bins by the room left; the fullest bin that still takes an item gets it."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rooms: list[int] = []  # the different amounts of room, in order
        self.bins: dict[int, list[int]] = {}
        self.content: list[list[int]] = []

    def add(self, item: int, size: int) -> None:
        at = bisect_left(self.rooms, size)
        if at == len(self.rooms):
            room, b = self.capacity, len(self.content)
            self.content.append([])
        else:
            room = self.rooms[at]
            b = self.bins[room].pop()
            if not self.bins[room]:
                del self.bins[room]
                self.rooms.pop(at)
        self.content[b].append(item)
        left = room - size
        if left:
            if left not in self.bins:
                self.bins[left] = []
                self.rooms.insert(bisect_left(self.rooms, left), left)
            self.bins[left].append(b)


def _pack(capacity: int, nearly: int):
    """Bins of a partition into fuller bins; ``open`` says whether a bin travels on.

    Arrow arrays hold the pieces; Python handles a size and an index per bin.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [b for b in batches if b.num_rows]
        if not table:
            return
        all_bins = pa.Table.from_batches(table).combine_chunks()
        sizes = all_bins.column("load").to_numpy()
        lists = all_bins.column("pieces").combine_chunks()
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.chunk(0)
        offsets = np.asarray(lists.offsets)
        flat = lists.values
        first = flat.field("row").to_numpy(zero_copy_only=False)[offsets[:-1]]
        part = flat.field("piece").to_numpy(zero_copy_only=False)[offsets[:-1]]
        fit = BestFit(capacity)
        for i in np.lexsort((part, first, -sizes)).tolist():
            fit.add(i, int(sizes[i]))
        order = np.array([i for c in fit.content for i in c], np.int64)
        per_bin = np.array([len(c) for c in fit.content], np.int64)
        # where each old bin begins inside its new one
        load = sizes[order]
        stop = np.cumsum(load)
        ends = np.cumsum(per_bin)
        base = np.repeat(np.concatenate(([0], stop[ends[:-1] - 1])), per_bin)
        shift = stop - load - base
        count = np.diff(offsets)[order]
        take = np.repeat(offsets[:-1][order] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        moved = flat.take(pa.array(take))
        fields = {f.name: moved.field(f.name) for f in moved.type}
        fields["offset"] = pa.array(fields["offset"].to_numpy(zero_copy_only=False) + np.repeat(shift, count))
        many = np.add.reduceat(count, np.concatenate(([0], ends[:-1])))
        packed = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(many))), pa.int32()),
            pa.StructArray.from_arrays(list(fields.values()), fields=list(moved.type)),
        )
        total = np.add.reduceat(load, np.concatenate(([0], ends[:-1])))
        yield from pa.Table.from_arrays(
            [pa.array(total), packed, pa.array(total < nearly)], names=["load", "pieces", "open"]
        ).to_batches(max_chunksize=5000)

    return run


_BIN = (
    "load bigint, pieces array<struct<doc_id: bigint, row: bigint, piece: int, start: bigint, "
    "length: bigint, ids_crc32: bigint, offset: bigint>>"
)


def pack(
    found: DataFrame, capacity: int = CAPACITY, nearly_full: float = NEARLY_FULL, first: int = FIRST, items: int = ITEMS
) -> DataFrame:
    """Pieces with the sequence each is in and its place there.

    ``found`` are pieces as :func:`pieces` gives them, none longer than ``capacity``. A task
    of the first round gets about ``first`` of them.
    Sequence numbers are any different numbers. An empty table gives an empty one.
    """
    found = freeze(found)
    nearly = int(np.ceil(capacity * nearly_full))
    one = F.struct("doc_id", "row", "piece", "start", "length", "ids_crc32", F.lit(0).cast("bigint").alias("offset"))
    bins = found.select(F.col("length").alias("load"), F.array(one).alias("pieces"))
    done = [bins.where(F.col("load") >= nearly)]
    left = bins.where(F.col("load") < nearly)
    n = found.count()
    rounds = [max(1, -(-n // items))]
    while rounds[0] * first < n:
        rounds.insert(0, min(rounds[0] * MERGE, -(-n // first)))
    for k, parts in enumerate(rounds):
        key = F.xxhash64(F.col("pieces")[0]["row"], F.col("pieces")[0]["piece"], F.lit(k))
        packed = freeze(left.repartition(parts, key).mapInArrow(_pack(capacity, nearly), f"{_BIN}, open boolean"))
        last = k == len(rounds) - 1
        done.append(packed.where(F.lit(last) | ~F.col("open")).select("load", "pieces"))
        left = packed.where("open").select("load", "pieces")
    numbered = [
        d.withColumn("sequence_id", F.monotonically_increasing_id() * len(done) + i).select(
            "sequence_id", F.explode("pieces").alias("p")
        )
        for i, d in enumerate(done)
    ]
    out = numbered[0]
    for d in numbered[1:]:
        out = out.unionByName(d)
    return out.select("p.doc_id", "p.piece", "p.start", "p.length", "p.ids_crc32", "sequence_id", "p.offset")


def best_fit(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
) -> DataFrame:
    """Documents packed into sequences: one row per piece."""
    return pack(pieces(docs, doc_id, text, vocabulary, capacity), capacity)
