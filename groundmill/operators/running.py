"""Running sums that no single task has to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_sum(rows: DataFrame, by: list[str], order: list[str], value: str, name: str, slices: int) -> DataFrame:
    """Add ``name``: the sum of ``value`` over rows of the same ``by`` up to this one, by ``order``, whose first column is a number without nulls.

    That column's quantiles cut each group into ``slices`` of like size; sums per slice give each slice its start,
    and only rows of one slice of a group meet in a window. So a group of any size spreads over many tasks, and
    what the driver sees is one number a slice. ``rows`` is read three times: write it before if it is dear.
    """
    cuts = sorted(set(rows.approxQuantile(order[0], [i / slices for i in range(1, slices)], 0.5 / slices))) if slices > 1 else []
    placed = rows.withColumn("_slice", F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col(order[0])))) if cuts else rows.withColumn("_slice", F.lit(0))
    sums = placed.groupBy(*by, "_slice").agg(F.sum(value).alias("_sum"))
    starts = sums.select(*by, "_slice", (F.sum("_sum").over(Window.partitionBy(*by).orderBy("_slice")) - F.col("_sum")).alias("_start"))
    inside = Window.partitionBy(*by, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return placed.join(starts, [*by, "_slice"]).withColumn(name, F.col("_start") + F.sum(value).over(inside)).drop("_slice", "_start", "_sum")
