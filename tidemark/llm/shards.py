"""Token sequences in training order, as shards of fixed-stride binary rows.

Documents become sequences of ``LENGTH`` ids (the last one of a document is filled up),
counted in the order in which the documents are read. A keyed Feistel network with
cycle-walking permutes the numbers 0 to N-1: sequence i gets the slot in training order
that no other sequence gets, and neither a table nor a sort is needed to know it.
A shard holds the slots from ``rows`` * s on; its rows have equal size, so that slot t
starts at byte (t - rows * s) * stride and reading can go on at any slot.

Counting and writing read the documents twice; ``docs`` must give the same rows in the
same partitions both times, as a table read from files does. That is checked partition by
partition before anything counts as written. A task that runs again writes the same bytes; a
file appears under its name only when complete, and ``_SHARDS.json`` comes last.

Null text is empty; a document has at least one sequence (its end id). Repeated rows are
sequences of their own. An empty table gives no shard.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.frames import plain
from tidemark.llm.packing import END
from tidemark.llm.text import mix, slices
from tidemark.llm.tokens import count, default_vocabulary, listed

LENGTH = 256
ROWS = 65_536
FILL = 0
ROUNDS = 6
SUCCESS = "_SHARDS.json"


def permute(i: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slots of the numbers ``i`` below ``n``: a permutation of 0 to n-1 that ``key`` picks."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(key % 2**63) * np.uint64(ROUNDS + 1))
    out = np.asarray(i, np.uint64).copy()
    walking = np.arange(len(out))
    while len(walking):  # values at or above n walk on along their cycle until below it
        x = out[walking]
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        x = left << np.uint64(half) | right
        out[walking] = x
        walking = walking[x >= n]
    return out.astype(np.int64)


def _sizes(vocabulary: str, length: int):
    """A partition's number of sequences, and a checksum of its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, check = 0, 0
        for batch in batches:
            for rows, texts in slices(batch):
                for doc, t in zip(rows.column("doc_id").to_pylist(), texts, strict=True):
                    n += -(-(count(t, vocabulary) + 1) // length)
                    check = zlib.crc32(t, zlib.crc32(str(doc).encode(), check))
        yield pa.RecordBatch.from_pydict(
            {"part": [TaskContext.get().partitionId()], "n": [n], "check": [check]}
        )

    return run


def _sequences(vocabulary: str, length: int, dtype: str, first: dict, total: int, key: int, rows_each: int):
    """The sequences of a partition with their slots; ``first`` says what the counting found."""
    size = np.dtype(dtype).itemsize
    each = length * size
    wide = np.dtype(dtype) != np.dtype(np.uint16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, end, wanted = first.get(TaskContext.get().partitionId(), (0, 0, 0))
        check = 0
        for batch in batches:
            for rows, texts in slices(batch):
                docs, pieces, own, blobs = [], [], [], []
                for doc, t in zip(rows.column("doc_id").to_pylist(), texts, strict=True):
                    check = zlib.crc32(t, zlib.crc32(str(doc).encode(), check))
                    found = listed(t, vocabulary)
                    found.append(END)
                    raw = np.array(found, dtype).tobytes() if wide else array("H", found).tobytes()
                    starts = range(0, len(raw), each)
                    blobs += [raw[a : a + each] for a in starts]
                    docs += [doc] * len(starts)
                    pieces += range(len(starts))
                    own += [length] * (len(starts) - 1) + [(len(raw) - starts[-1]) // size]
                if n + len(docs) > end:
                    raise RuntimeError("the documents changed between counting and writing")
                slot = permute(np.arange(n, n + len(docs)), total, key)
                n += len(docs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(slot // rows_each, pa.int32()),
                        pa.array(slot),
                        pa.array(docs, pa.int64()),
                        pa.array(pieces, pa.int32()),
                        pa.array(own, pa.int32()),
                        pa.array(blobs, pa.binary()),
                    ],
                    names=["shard", "slot", "doc_id", "piece", "length", "ids"],
                )
        if n != end or check != wanted:
            raise RuntimeError("the documents changed between counting and writing")

    return run


def shard_name(shard: int) -> str:
    return f"shard-{shard:07d}.bin"


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system, which is Spark's default one for a path without scheme."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified folder; in the driver any folder may be given."""
    spark = SparkSession.getActiveSession() if TaskContext.get() is None else None
    if spark is not None:
        folder = qualified(spark, folder)
    return fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)


def _write(folder: str, stride: int, rows_each: int, total: int):
    """Write the rows, sorted by slot, into their shards; returns a row per sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        shard, out, at, name = -1, None, 0, ""

        def close() -> None:
            if out is None:
                return
            out.close()
            if at != min(total, (shard + 1) * rows_each):
                raise RuntimeError(f"shard {shard} lacks rows from slot {at} on")
            store.move(name, f"{root}/{shard_name(shard)}")

        for batch in batches:
            if not batch.num_rows:
                continue
            shards, slots = (np.asarray(batch.column(c)) for c in ("shard", "slot"))
            rows = batch.column("ids").to_pylist()
            crc = [zlib.crc32(row) for row in rows]
            places = (slots - shards.astype(np.int64) * rows_each) * stride
            cuts = np.flatnonzero(np.diff(shards)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
                s = int(shards[a])
                if s != shard:
                    close()
                    shard, at = s, s * rows_each
                    name = f"{root}/.{shard_name(s)}.{TaskContext.get().taskAttemptId()}"
                    out = store.open_output_stream(name)
                if (slots[a:b] != np.arange(at, at + b - a)).any():
                    raise RuntimeError(f"slots from {slots[a]} on stand where {at} should")
                out.write(b"".join([row.ljust(stride, b"\0") for row in rows[a:b]]))
                at += b - a
            kept = [batch.column(c) for c in ("slot", "shard", "doc_id", "piece", "length")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(places), pa.array(crc, pa.int64())],
                names=["slot", "shard", "doc_id", "piece", "length", "byte_offset", "crc32"],
            )
        close()

    return run


def write_shards(
    docs: DataFrame,
    folder: str,
    key: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    length: int = LENGTH,
    rows_each: int = ROWS,
    dtype: str = "<u2",
) -> DataFrame:
    """Write all shards to ``folder``, a path that every executor sees; one row per sequence.

    Ids are stored as ``dtype``, which must hold every id of the vocabulary (the default
    one has ids up to 50256). The rows are written to
    ``<folder>/index`` and are what :func:`read` needs besides the shards.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    vocabulary = vocabulary or default_vocabulary()
    own = plain(docs, doc_id=doc_id, text=text)
    sized = own.mapInArrow(_sizes(vocabulary, length), "part bigint, n bigint, check bigint")
    found = sorted(tuple(r) for r in sized.collect())  # three numbers per partition
    first, total = {}, 0
    for part, n, check in found:
        first[part] = (total, total + n, check)
        total += n
    shards = max(1, -(-total // rows_each))
    stride = length * np.dtype(dtype).itemsize
    made = own.mapInArrow(
        _sequences(vocabulary, length, dtype, first, total, key, rows_each),
        "shard int, slot bigint, doc_id bigint, piece int, length int, ids binary",
    )
    store, root = _open(folder)
    store.create_dir(root, recursive=True)
    (
        made.repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("slot")
        .mapInArrow(
            _write(folder, stride, rows_each, total),
            "slot bigint, shard int, doc_id bigint, piece int, length int, byte_offset bigint, crc32 bigint",
        )
        .write.parquet(f"{folder}/index")
    )
    about = {"sequences": total, "rows": rows_each, "length": length, "dtype": dtype, "key": key}
    with store.open_output_stream(f"{root}/{SUCCESS}") as out:
        out.write(json.dumps(about).encode())
    return spark.read.parquet(f"{folder}/index")


def read(folder: str, slot: int, count: int) -> np.ndarray:
    """``count`` sequences in training order from ``slot`` on, fewer at the end; filled up with 0."""
    store, root = _open(folder)
    with store.open_input_stream(f"{root}/{SUCCESS}") as f:
        about = json.loads(f.read())
    stride = about["length"] * np.dtype(about["dtype"]).itemsize
    out, stop = [], min(slot + count, about["sequences"])
    while slot < stop:
        shard = slot // about["rows"]
        n = min(stop, (shard + 1) * about["rows"]) - slot
        with store.open_input_file(f"{root}/{shard_name(shard)}") as f:
            f.seek((slot - shard * about["rows"]) * stride)
            out.append(f.read(n * stride))
        slot += n
    return np.frombuffer(b"".join(out), about["dtype"]).reshape(-1, about["length"])
