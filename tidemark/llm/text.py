"""Words of many texts at once, as arrays over one byte buffer.

A word is a run of bytes other than 0x20 and 0x09-0x0D. UTF-8 never uses those
bytes inside a longer character, so bytes give the words of the characters too.
Tasks see texts in Arrow batches; ``slices`` cuts a batch so that the arrays of
one step stay small, whatever the batch size. A single text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 2_000_000
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64); keeps them distinct."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class Words:
    """The words of a few texts.

    ``data`` holds the texts, each followed by a space; word ``i`` is
    ``data[start[i]:end[i]]`` and text ``d`` has the words ``first[d]:first[d + 1]``.
    """

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.blob = b" ".join([*texts, b""]) if texts else b""
        self.data = np.frombuffer(self.blob, np.uint8)
        if lower:
            self.data = _LOWER[self.data]
            self.blob = self.data.tobytes()
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.bounds = np.concatenate(([0], np.cumsum(sizes + 1)))
        solid = np.zeros(len(self.data) + 2, bool)
        solid[1:-1] = ~_SPACE[self.data]
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        self.start, self.end = edges[0::2], edges[1::2]
        self.first = np.searchsorted(self.start, self.bounds)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.start)

    def docs(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        """The first and the last eight bytes of each word; the last ones of longer words only.

        With its length they give a word of up to 16 bytes in full.
        """
        data = np.concatenate((self.data, np.zeros(8, np.uint8)))
        eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        size = self.end - self.start
        head = eight[self.start] & _MASK[np.minimum(size, 8)]
        tail = np.where(size > 8, eight[np.maximum(self.end - 8, 0)], np.uint64(0))
        return head, tail

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, the same in every process."""
        head, tail = self.ends()
        size = self.end - self.start
        with np.errstate(over="ignore"):
            out = mix(mix(head + size.astype(np.uint64) * _STEP) ^ (tail * _STEP))
        for i in np.flatnonzero(size > 16).tolist():
            out[i] = xxhash.xxh64_intdigest(self.blob[self.start[i] : self.end[i]])
        return out

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words with one space after each, with the start and end of each word."""
        size = self.end - self.start
        end = np.cumsum(size + 1) - 1
        keep = ~_SPACE[self.data]
        keep[self.end] = True  # the separator after each word; texts end in one
        out = self.data[keep]
        out[end] = 32
        return out.tobytes(), end - size, end


def windows(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words, by the run's first word; and which runs lie in one text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    with np.errstate(over="ignore"):
        out = hashes[:n].copy()
        for i in range(1, k):
            out *= _STEP
            out += hashes[i : n + i]
    inside = np.ones(n, bool)
    for j in range(1, k):  # runs that reach over the end of a text
        at = first[1:-1] - j
        inside[at[(at >= 0) & (at < n)]] = False
    return mix(out), inside


def covered(starts: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a run of ``k`` words that starts at one of ``starts``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + k, n), -1)
    return np.cumsum(change[:-1]) > 0


def binary(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Texts as bytes, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.string()), "").cast(pa.large_binary())


def slices(batch: pa.RecordBatch, text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batch in runs of rows of about ``SLICE_BYTES`` of text, with their texts as bytes."""
    if not batch.num_rows:
        return
    column = binary(batch.column(batch.schema.get_field_index(text)))
    ends = np.cumsum(np.asarray(pc.binary_length(column)))
    cut = np.flatnonzero(np.diff(ends // SLICE_BYTES)) + 1
    for a, b in zip([0, *cut], [*cut, batch.num_rows], strict=True):
        yield batch.slice(a, b - a), column.slice(a, b - a).to_pylist()
