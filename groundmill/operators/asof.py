"""The value that was valid at a time: the last one of a key that is not later, without an inequality join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VALID, ASKED = 0, 1


def as_of(asked: DataFrame, valid: DataFrame, on: list[str], time: str, valid_time: str, slices: int, inclusive: bool = True) -> DataFrame:
    """``asked`` with ``found``: the row of ``valid`` with equal ``on`` and the latest ``valid_time`` that is not after ``time`` (before it, if not ``inclusive``), as a struct; null without one.

    Of rows of one key and time the greatest by all columns counts. Rows of ``valid`` without a time are never valid; rows
    of ``asked`` without one find nothing; null keys find nothing. Both tables go in one pass through windows of a key and a
    slice of time: quantiles of all times cut ``slices`` of them, and what holds when a slice begins comes from the
    last rows of the slices before, of which there is one each. So a key of any size is many tasks' work. A column
    ``found`` is replaced.
    """
    asked = asked.drop("found")
    none_of = lambda df: F.lit(None).cast(df.select(F.struct("*").alias("r")).schema["r"].dataType)
    keyed = lambda df, t, side: df.select(*on, F.unix_micros(F.col(t).cast("timestamp")).alias("_t"), F.lit(side).alias("_side"), (F.struct(*df.columns) if side == ASKED else none_of(asked)).alias("_asked"), (F.struct(*df.columns) if side == VALID else none_of(valid)).alias("_valid"))
    whole = F.lit(True)
    for c in on:
        whole = whole & F.col(c).isNotNull()
    left = keyed(asked, time, ASKED)
    rows = left.where(whole & F.col("_t").isNotNull()).unionByName(keyed(valid, valid_time, VALID).where(whole & F.col("_t").isNotNull()))
    cuts = sorted({int(x) for x in rows.approxQuantile("_t", [i / slices for i in range(1, slices)], 0.25 / slices)}) if slices > 1 else []
    # rows of one time are in one slice
    placed = rows.withColumn("_slice", F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("_t"))) if cuts else F.lit(0))
    last = placed.where(F.col("_side") == VALID).groupBy(*on, "_slice").agg(F.max(F.struct("_t", "_valid")).alias("_last"))
    # a row for each slice that asks, too, so that what holds comes across slices without a value
    asking = placed.where(F.col("_side") == ASKED).select(*on, "_slice").distinct()
    before = Window.partitionBy(*on).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = asking.join(last, [*on, "_slice"], "full").withColumn("_carried", F.last("_last", ignorenulls=True).over(before)["_valid"]).select(*on, "_slice", "_carried")
    first, then = (VALID, ASKED) if inclusive else (ASKED, VALID)
    turn: Column = F.when(F.col("_side") == VALID, first).otherwise(then)
    order = Window.partitionBy(*on, "_slice").orderBy("_t", turn, "_valid").rowsBetween(Window.unboundedPreceding, 0)
    inside = placed.withColumn("_inside", F.last("_valid", ignorenulls=True).over(order)).where(F.col("_side") == ASKED)
    known = inside.join(carried, [*on, "_slice"], "left").select("_asked.*", F.coalesce("_inside", "_carried").alias("found"))
    lost = left.where(~whole | F.col("_t").isNull()).select("_asked.*", none_of(valid).alias("found"))
    return known.unionByName(lost)
