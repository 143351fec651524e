"""Spans that overlap, such as quotes, lines, sections and chunks of a document, met by their places."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _binned(rows: DataFrame, on: list[str], width: int, side: str) -> DataFrame:
    """Each span once for each bin of ``width`` that it reaches into; its columns but the keys travel as one."""
    first, last = F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width)
    whole = rows.where("start < end")  # an empty span overlaps nothing; null bounds neither
    return whole.select(*on, F.struct(*[c for c in rows.columns if c not in on]).alias(side), F.explode(F.sequence(first, last)).alias("_bin"))


def bin_width(left: DataFrame, right: DataFrame) -> int:
    """The mean length of all spans, so that a span stands in two bins on average, whatever the lengths are."""
    lengths = left.select((F.col("end") - F.col("start")).alias("n")).unionByName(right.select((F.col("end") - F.col("start")).alias("n")))
    return max(1, round(lengths.where("n > 0").agg(F.avg("n")).first()[0] or 1))


def overlapping(left: DataFrame, right: DataFrame, on: list[str], width: int | None = None) -> DataFrame:
    """(on..., l, r, start, end) of all pairs of spans with equal ``on`` that share a place, each once; ``l`` and ``r`` are their rows, ``start`` and ``end`` what they share.

    Spans have ``start`` and ``end``, end exclusive. They meet in bins, by keys and bin, so that the spans of one document
    are many tasks' work; a pair that meets in several bins counts in the one where what they share begins. Null keys
    meet nothing. ``width`` changes the cost alone.
    """
    width = width or bin_width(left, right)
    # spans are a few bytes each in files: chosen by those, a broadcast would hold all of one side in every task
    met = _binned(left, on, width, "l").join(_binned(right, on, width, "r").hint("merge"), [*on, "_bin"])
    start = F.greatest("l.start", "r.start")
    shared = met.withColumns({"start": start, "end": F.least("l.end", "r.end")}).where((F.col("start") < F.col("end")) & (F.floor(F.col("start") / width) == F.col("_bin")))
    row = lambda side, of: F.struct(*[F.col(c if c in on else f"{side}.{c}").alias(c) for c in of.columns]).alias(side)
    return shared.select(*on, row("l", left), row("r", right), "start", "end")


def covered(spans: DataFrame, by: DataFrame, on: list[str], key: str, width: int | None = None) -> DataFrame:
    """(on..., key, n, shared, whole): for each of ``spans``, by its ``key`` among those of equal ``on``, how many of ``by`` overlap it, the places they share with it, and whether one of them holds all of it.

    Keys are unique among the spans of equal ``on``. Spans that nothing overlaps have zeros.
    """
    met = overlapping(spans.select(*on, key, "start", "end"), by.select(*on, "start", "end"), on, width)
    inside = (F.col("r.start") <= F.col("l.start")) & (F.col("r.end") >= F.col("l.end"))
    found = met.select(*on, F.col(f"l.{key}").alias(key), F.lit(1).cast("long").alias("n"), (F.col("end") - F.col("start")).cast("long").alias("shared"), inside.alias("whole"))
    zero = F.lit(0).cast("long")
    none = {"n": zero, "shared": zero, "whole": F.lit(False)}
    meets = F.coalesce(F.col("start") < F.col("end"), F.lit(False))
    for c in (*on, key):
        meets &= F.col(c).isNotNull()
    # a row of zeros for each span, summed with what it shares, takes the place of a join of all spans with the sums
    counted = spans.where(meets).select(*on, key).withColumns(none).unionByName(found).groupBy(*on, key).agg(F.sum("n").alias("n"), F.sum("shared").alias("shared"), F.max("whole").alias("whole"))
    return counted.unionByName(spans.where(~meets).select(*on, key).withColumns(none))


def line_spans(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line, start, end) of the lines of each text, as code points without the line feed. Keys are unique; a null text has no lines."""
    lengths = F.transform(F.split(F.col(text), "\n", -1), lambda x: F.length(x))
    lines = docs.where(F.col(text).isNotNull()).select(key, F.posexplode(lengths).alias("line", "n"))
    end = F.sum(F.col("n") + 1).over(Window.partitionBy(key).orderBy("line")) - 1
    return lines.select(key, "line", (end - F.col("n")).alias("start"), end.alias("end"))


def window_spans(docs: DataFrame, key: str, text: str, size: int, overlap: int) -> DataFrame:
    """(key, piece, start, end) of pieces of ``size`` code points that share ``overlap`` with the one before; the last may be shorter."""
    step = size - overlap
    last = F.floor(F.greatest(F.lit(0), F.length(text) - overlap - 1) / step)
    pieces = docs.where(F.length(text) > 0).select(key, F.length(text).cast("long").alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    return pieces.select(key, "piece", (F.col("piece") * step).alias("start"), F.least(F.col("piece") * step + size, "n").alias("end"))
