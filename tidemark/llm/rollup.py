"""Token counts kept by signed changes: totals by source, language and tokenizer version.

A batch of changes holds inserts (+), deletes (-) and revisions (old values -, new
values +). Its sums are stored as one partition of a table and count from the moment
that partition is committed; a batch that is committed again changes nothing, so a job
that died may simply run again. Totals add up all committed batches. ``compact`` folds
them into fewer rows without changing a total.

Null source or language is a group of its own; null text has no token and counts as one
document; repeated rows count each time; empty batches are committed too. Texts are counted whole, one at a
time, so a very long one costs the memory of its own ids only.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.llm.frames import each_slice, plain
from tidemark.llm.text import Words
from tidemark.llm.tokens import count, default_vocabulary
from tidemark.sources import snapshots

KEYS = ("source", "lang", "tokenizer")
SUMS = ("n_docs", "n_tokens")
WORDS = "words-1"
BPE = "byte_bpe_50k"
_SCHEMA = StructType(
    [StructField(k, StringType()) for k in KEYS] + [StructField(s, LongType()) for s in SUMS]
)
_STORED = StructType([*_SCHEMA.fields, StructField("batch", StringType())])


def counts(docs: DataFrame, vocabularies: dict[str, str | None], **names: str) -> DataFrame:
    """Documents and tokens by key and tokenizer version, summed within each task's slices.

    ``vocabularies`` maps a version to its vocabulary file, or to None for words. ``names``
    may give other columns for ``text``, ``source`` and ``lang``.
    """
    own = plain(docs, **{c: names.get(c, c) for c in ("text", "source", "lang")})

    def step(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        keys = list(zip(rows.column("source").to_pylist(), rows.column("lang").to_pylist(), strict=True))
        sums: dict[tuple, list[int]] = defaultdict(lambda: [0, 0])
        for version, path in vocabularies.items():
            sizes = Words(texts).counts if path is None else [count(t, path) for t in texts]
            for key, n in zip(keys, np.asarray(sizes).tolist(), strict=True):
                total = sums[(*key, version)]
                total[0] += 1
                total[1] += n
        found = [(*key, *total) for key, total in sums.items()]
        kinds = [pa.string()] * 3 + [pa.int64()] * 2
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)],
            names=[*KEYS, *SUMS],
        )

    schema = ", ".join([f"{k} string" for k in KEYS] + [f"{s} bigint" for s in SUMS])
    return _fold(each_slice(own, step, schema))


def _fold(df: DataFrame) -> DataFrame:
    return df.groupBy(*KEYS).agg(*[F.sum(s).alias(s) for s in SUMS])


def negated(counted: DataFrame) -> DataFrame:
    return counted.select(*KEYS, *[(-F.col(s)).alias(s) for s in SUMS])


def changes(
    inserted: DataFrame | None = None,
    deleted: DataFrame | None = None,
    revised: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """One batch from counted documents; ``revised`` are the old and the new version."""
    old, new = revised or (None, None)
    parts = [x for x in (inserted, new) if x is not None]
    parts += [negated(x) for x in (deleted, old) if x is not None]
    if not parts:
        raise ValueError("a batch needs at least one kind of change")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _fold(out)


def committed(spark: SparkSession, table: str, batch: str) -> bool:
    return f"batch={batch}" in snapshots.partitions(spark, table, "batch")


def commit(table: str, batch: str, signed: DataFrame) -> bool:
    """Add a batch; False, and no work done, if it is in already."""
    if committed(signed.sparkSession, table, batch):
        return False
    rows = signed.select(*KEYS, *SUMS, F.lit(batch).alias("batch"))
    snapshots.publish(rows, table, "batch", [batch])
    return True


def totals(spark: SparkSession, table: str) -> DataFrame:
    """The sums of all committed batches; groups that are gone have no row."""
    stored = snapshots.current(spark, table, "batch", schema=_STORED)
    summed = _fold(stored if stored is not None else spark.createDataFrame([], _STORED))
    return summed.where(" or ".join(f"{s} <> 0" for s in SUMS))


def compact(spark: SparkSession, table: str, batches: list[str], into: str) -> None:
    """Fold the sums of ``batches`` into the first one that is kept, ``into``; the others become empty.

    All of them change in one commit, and each stays known as committed.
    """
    if into not in batches or not all(committed(spark, table, b) for b in batches):
        raise ValueError("only committed batches can be folded, into one of them")
    rows = snapshots.current(spark, table, "batch", batches, schema=_STORED)
    folded = _fold(rows).select(*KEYS, *SUMS, F.lit(into).alias("batch"))
    snapshots.publish(folded, table, "batch", batches)


def production_versions() -> dict[str, str | None]:
    return {BPE: default_vocabulary(), WORDS: None}
