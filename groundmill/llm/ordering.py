"""Seeded orders and running sums that no single task has to hold."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 60
#: Rows of a group that one slice of the hash range holds on average, and slices that meet in a window, as a power of two.
SLICE_ROWS, LEVEL = 512, 10


def seeded_hash(*parts: Column | str) -> Column:
    """A number of 60 bits from the MD5 of the parts joined by colons; null parts count as empty."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string") if isinstance(p, Column) else F.lit(p), F.lit("")) for p in parts])), 1, BITS // 4), 16, 10).cast("long")


def _starts(sums: DataFrame, group: list[str], bits: int) -> DataFrame:
    """(group..., _slice, _offset): what all slices before hold, for (group..., _slice, _sum) with slices of ``bits`` bits.

    Slices meet in windows of 2 ** ``LEVEL``; where there are more, so do the sums of windows, level by level.
    """
    if bits <= LEVEL:
        return sums.select(*group, "_slice", (F.sum("_sum").over(Window.partitionBy(*group).orderBy("_slice")) - F.col("_sum")).alias("_offset"))
    fine = sums.withColumn("_up", F.shiftright("_slice", LEVEL))
    coarse = fine.groupBy(*group, "_up").agg(F.sum("_sum").alias("_sum")).withColumnRenamed("_up", "_slice")
    above = _starts(coarse, group, bits - LEVEL).select(*group, F.col("_slice").alias("_up"), F.col("_offset").alias("_base"))
    inside = F.sum("_sum").over(Window.partitionBy(*group, "_up").orderBy("_slice")) - F.col("_sum")
    return fine.withColumn("_inside", inside).join(above, [*group, "_up"]).select(*group, "_slice", (F.col("_base") + F.col("_inside")).alias("_offset"))


def sums_before(df: DataFrame, group: list[str], order: list[str], value: str, name: str, rows: int) -> DataFrame:
    """Add ``name``: the sum of ``value`` over rows of the same group that come before, by ``order``.

    ``order`` begins with a column made by ``seeded_hash``. The hash range is cut into slices, sums per slice
    give each slice its offset, and only rows of one slice of a group meet in a window, so a group of any
    size spreads over many tasks. ``rows`` is the number of rows of ``df``. Groups must not be null.
    """
    bits = max(0, math.ceil(math.log2(max(1, rows) / SLICE_ROWS)))
    cut = df.withColumn("_slice", F.shiftright(F.col(order[0]), BITS - bits))
    offsets = _starts(cut.groupBy(*group, "_slice").agg(F.sum(value).alias("_sum")), group, bits)
    inside = Window.partitionBy(*group, "_slice").orderBy(*order)
    local = F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(value)
    return cut.join(offsets, [*group, "_slice"]).withColumn(name, F.col("_offset") + local).drop("_slice", "_offset")
