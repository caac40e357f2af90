"""Which rows of two tables differ, without joining the tables.

Each side is folded into checksums per month and range of keys: sums of two 64-bit hashes of
its rows, so the order of rows does not matter and sums of ranges add up to those of wider
ranges. Sides are compared by adding them up with opposite signs: what is left over
differs. That goes coarse to fine, months first, then blocks of ranges in the months that
differ, then ranges in these blocks. Only rows of differing ranges are read again and folded
per key. A difference goes unseen only if all sums agree by chance, one in 2 ** 128. The sums
are of 21 or 22 bits of a hash each, so that a key of a trillion rows does not overflow them.

A row may stand for several (``weight``). Values are compared null-safe. A key whose month
differs is found in both months' ranges and reported once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sizes import dealt, frozen, measured

WIDTH = 4096
BLOCK = 256
SOURCE, TARGET, DIFFERENT = "origen", "destino", "distinto"
_PARTS = ((0, 21), (21, 21), (42, 22))
_SUMS = tuple(f"_{h}{at}" for h in ("one", "two") for at, _ in _PARTS)


def _start(key: Column, width: int) -> Column:
    """The first key of the range that a key is in."""
    return (key - F.pmod(key, F.lit(width))).cast("bigint")


@dataclass(frozen=True)
class Side:
    """One table: its keys (the first a number), the month of a row, the values to compare."""

    rows: DataFrame
    keys: Sequence[Column]
    month: Column
    values: Sequence[Column]
    weight: Column | None = None

    def prepared(self, names: Sequence[str], width: int) -> DataFrame:
        """Keys, month, range, weight and hash sums of each row."""
        weight = F.lit(1) if self.weight is None else self.weight
        cells = [*self.keys, self.month, *self.values]
        # a hash passes over nulls, so it takes them as values of their own
        seen = [*cells, *[c.isNull() for c in cells]]
        plain = self.rows.select(
            *[k.alias(n) for k, n in zip(self.keys, names, strict=True)],
            self.month.cast("int").alias("_month"),
            weight.cast("bigint").alias("_n"),
            F.xxhash64(*seen).alias("_one"),
            F.xxhash64(F.lit("second"), *seen).alias("_two"),
        )
        part = lambda h, at, bits: F.shiftrightunsigned(h, at).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))
        sums = [part(h, *p) * F.col("_n") for h in ("_one", "_two") for p in _PARTS]
        return plain.select(
            *names,
            "_month",
            _start(F.col(names[0]), width).alias("_range"),
            "_n",
            *[s.alias(n) for s, n in zip(sums, _SUMS, strict=True)],
        )


def checksums(side: Side, names: Sequence[str], width: int = WIDTH) -> DataFrame:
    """Row count and hash sums per month and range of keys; one row per task and range is shuffled."""
    rows = side.prepared(names, width)
    return rows.groupBy("_month", "_range").agg(*[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("_n", *_SUMS)])


def _signed(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    minus = right.select(*[(-F.col(c)).alias(c) if c in cols else F.col(c) for c in right.columns])
    return left.unionByName(minus)


def _left_over(signed: DataFrame, by: Sequence[Column | str]) -> DataFrame:
    sums = ("_n", *_SUMS)
    found = signed.groupBy(*by).agg(*[F.sum(c).alias(c) for c in sums])
    return found.where(reduce(Column.__or__, [F.col(c) != 0 for c in sums])).drop(*sums)


def _within(rows: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the listed groups; null is a group as well."""
    named = groups.select(*[F.col(k).alias(k + "_g") for k in keys])
    match = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(k + "_g")) for k in keys])
    return rows.join(named, match, "left_semi")


def differing_ranges(left: DataFrame, right: DataFrame, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """Months and key ranges whose checksums differ, compared by month, by block, by range."""
    signed = _signed(left, right, ("_n", *_SUMS)).withColumn("_block", _start(F.col("_range"), width * block))
    months = measured(_left_over(signed, ["_month"]))
    signed = _within(signed, months, ["_month"])
    blocks = measured(_left_over(signed, ["_month", "_block"]))
    signed = _within(signed, blocks, ["_month", "_block"])
    return _left_over(signed, ["_month", "_range"])


def differing_rows(
    source: Side, target: Side, names: Sequence[str], width: int = WIDTH, sums: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """Keys that only one side has, or whose rows differ, with months and row counts of both.

    ``sums`` are checksums of both sides that were kept, if there are any.
    """
    left, right = sums or (frozen(checksums(source, names, width)), frozen(checksums(target, names, width)))
    ranges = measured(differing_ranges(left, right, width))
    opened = [_within(s.prepared(names, width), ranges, ["_month", "_range"]) for s in (source, target)]
    n, none = F.col("_n"), F.lit(None).cast("bigint")
    mine = opened[0].withColumns({"_ours": n, "_other": none})
    theirs = opened[1].withColumns({"_ours": none, "_other": n})
    month = lambda side: F.min(F.when(F.col(side).isNotNull(), F.col("_month")))
    # keys hardly repeat, so folding before the shuffle would only fill a map per task
    rows = dealt([_signed(mine, theirs, _SUMS)], names)[0]
    folded = (
        rows.groupBy(*names)
        .agg(
            month("_ours").alias("mes_origen"),
            month("_other").alias("mes_destino"),
            F.coalesce(F.sum("_ours"), F.lit(0)).alias("filas_origen"),
            F.coalesce(F.sum("_other"), F.lit(0)).alias("filas_destino"),
            *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in _SUMS],
        )
    )
    side = F.when(F.col("filas_destino") == 0, SOURCE).when(F.col("filas_origen") == 0, TARGET).otherwise(DIFFERENT)
    differs = reduce(Column.__or__, [F.col(c) != 0 for c in _SUMS])
    return folded.where(differs).select(
        *names, side.alias("lado"), "mes_origen", "mes_destino", "filas_origen", "filas_destino"
    )
