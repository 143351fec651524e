"""Approximate nearest neighbours by shifted space-filling curves.

Every second curve takes rows by their direction; the others lift them onto a sphere by one more coordinate, so that
the largest inner product with a query is the smallest distance to it, whatever their lengths. Each curve projects
them by a rotation of its own, shifts them by a random offset, and orders them along a Hilbert curve through the
cells; queries are placed among them. Ranks along a curve come from a range partitioning; a query looks
at the rows within ``window`` ranks on either side, and the best of all curves are merged and ranked again by exact
inner products.

How wide the window is, and whether curves of one kind are left out, follows from a sample of the queries, whose
exact neighbours are found by comparing them with all rows: the cheapest choice that reaches the wanted recall on it. Where vectors
have structure the window is a matter of how many neighbours lie together and does not grow with the table; where
they have none, no order of rows narrows the search, and the window grows with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import cut, mark, parallelism, release

#: Curves at most, and cells of a curve: dimensions and bits of each.
CURVES, DIMS, BITS = 28, 16, 3
#: Recall that the window is chosen for, and queries that it is measured on, at most.
RECALL, TRIED = 0.95, 256
#: Rows and queries that meet in one group, at most, and rows at least where the window is small.
MOST, CALLS, FEW = 8192, 4096, 256
SEED = 7
#: Rows that fix the range of each projected axis, at most.
SAMPLE = 4096


class Vectors(NamedTuple):
    """``points`` (point, v), of the copy ``own``: different vectors, packed, by their smallest id; ``groups`` (point, ids): ids of equal vectors; ``asked`` (query_id, point)."""

    own: DataFrame
    groups: DataFrame
    asked: DataFrame
    rows: int
    size: int
    kind: str
    norm: float

    @property
    def points(self) -> DataFrame:
        return self.own.select("point", "v")


class Fit(NamedTuple):
    """``curves`` and ``window`` that are read, the recall on the sample, and the share of rows that a query meets, those met twice counted twice."""

    curves: list[int]
    window: int
    recall: float
    share: float


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (rows of small integers) along the Hilbert curve, as int64.

    Works from the high bit down: an axis with the bit set reflects the lower bits of the first axis, one without
    swaps them with it; a Gray decoding of the axes then gives the digits.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(n):
            on = (x[i] >> b) & 1 == 1
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(len(cells), np.int64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= flip
    key = np.zeros(len(cells), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _curve(c: int, size: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(projection, shift) of curve ``c``."""
    rng = np.random.default_rng([SEED, c])
    q, _ = np.linalg.qr(rng.normal(size=(size, max(size, dims))))
    return q[:, :dims], rng.random(dims)


def _directed(x: np.ndarray) -> np.ndarray:
    """Vectors scaled to length 1, with a coordinate of 0: queries on all curves, and rows on those that go by direction."""
    return np.hstack([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros((len(x), 1))])


def _lifted(x: np.ndarray, norm: float) -> np.ndarray:
    """Rows on a sphere of radius 1 by the coordinate that makes inner products distances; the longest has 0 there."""
    x = x / norm
    return np.hstack([x, np.sqrt(np.maximum(0.0, 1 - np.square(x).sum(axis=1, keepdims=True)))])


def _unpacked(column, kind: str, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(-1, size).astype(np.float64)


def _usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v) of rows with an id and a vector of finite numbers that is not zero."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(key).cast("long").alias("vec_id"), v.alias("v"), good.alias("ok")).where("ok AND vec_id IS NOT NULL").select("vec_id", "v")


def prepare(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20) -> Vectors | None:
    """Different vectors once each, and which of them are asked for; None if no row takes part."""
    usable = _usable(vectors, key, vector)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    seen = usable.agg(F.min_by(F.size("v"), "vec_id").alias("n"), F.count("*").alias("rows")).first()
    if not seen["rows"]:
        return None
    size = seen["n"]
    kind = "<f4" if dict(usable.dtypes)["v"] == "array<float>" else "<f8"
    rows = usable.where(F.size("v") == size)
    rows = rows.withColumn("v", F.col("v").cast("array<double>")) if kind == "<f8" else rows

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = np.asarray(b.column(2).flatten()).astype(kind)
            flat = (flat + 0).reshape(-1, size)  # no negative zero: equal vectors have equal bytes
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes() for r in flat], pa.binary())], ["vec_id", "norm", "v"])

    points = rows.select("vec_id", norm.alias("norm"), "v").mapInArrow(packed, "vec_id long, norm double, v binary")
    points = cut(points.withColumn("f", F.xxhash64("v")), "vectors")
    # the smallest ids of equal vectors, first in slices and then of the slices' winners, so that no copy count hurts
    w = lambda *by: Window.partitionBy(*by).orderBy("vec_id")
    few = points.select("f", "vec_id").distinct().withColumn("s", F.pmod(F.xxhash64("vec_id"), F.lit(64))).withColumn("r", F.row_number().over(w("f", "s"))).where(F.col("r") <= k + 1)
    few = few.withColumn("r", F.row_number().over(w("f"))).where(F.col("r") <= k + 1)
    groups = cut(few.groupBy("f").agg(F.min("vec_id").alias("point"), F.sort_array(F.collect_list("vec_id")).alias("ids")), "groups")
    asked = queries.select(F.col("query_id").cast("long").alias("vec_id")).distinct()
    asked = cut(points.select("vec_id", "f").join(asked, "vec_id", "left_semi").join(groups.select("f", "point"), "f").select(F.col("vec_id").alias("query_id"), "point").distinct(), "asked")
    own = points.join(groups.select(F.col("point").alias("vec_id"), "f"), ["vec_id", "f"]).groupBy("vec_id").agg(F.first("v").alias("v"), F.first("norm").alias("norm"))
    own = cut(own.withColumnRenamed("vec_id", "point"), "points")
    most = own.agg(F.count("*").alias("n"), F.max("norm").alias("norm")).first()
    return Vectors(own, groups, asked, most["n"], size, kind, most["norm"])


def places(vectors: Vectors, curves: int = CURVES) -> DataFrame:
    """(curve, point, asks, place, turn): ranks of rows along each curve; of queries, the rows before them and their own rank among queries."""
    spark = vectors.points.sparkSession
    size, kind, norm = vectors.size, vectors.kind, vectors.norm
    dims, bits = min(DIMS, size + 1), BITS
    some = _unpacked([r["v"] for r in vectors.points.orderBy(F.xxhash64("point"), "point").limit(SAMPLE).collect()], kind, size)
    some = [_directed(some), _lifted(some, norm)]
    tools = []
    for c in range(curves):
        a, shift = _curve(c, size + 1, dims)
        y = some[c % 2] @ a
        lo, hi = np.quantile(y, 0.005, axis=0), np.quantile(y, 0.995, axis=0)
        tools.append((a, shift, lo, np.maximum(hi - lo, 1e-12)))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _unpacked(b.column(1).to_pylist(), kind, size)
            ask = np.array(b.column(2).to_pylist(), bool)
            point = np.asarray(b.column(0))
            ids = np.concatenate([point, point[ask]])
            asks = np.concatenate([np.zeros(len(x), bool), np.ones(int(ask.sum()), bool)])
            directed = _directed(x)
            forms = [np.vstack([directed, directed[ask]]), np.vstack([_lifted(x, norm), directed[ask]])]
            for c, (a, shift, lo, width) in enumerate(tools):
                z = (np.clip((forms[c % 2] @ a - lo) / width, 0, 1) + shift) / 2
                cells = np.minimum((z * (1 << bits)).astype(np.int64), (1 << bits) - 1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), c, np.int32)), pa.array(hilbert_keys(cells, bits)), pa.array(ids), pa.array(asks)], ["curve", "h", "point", "asks"])

    parts = parallelism(spark)
    asking = vectors.asked.select("point").distinct().withColumn("ask", F.lit(True))
    marked = vectors.points.join(asking, "point", "left").select("point", "v", F.coalesce("ask", F.lit(False)).alias("ask"))
    placed = marked.mapInArrow(keyed, "curve int, h long, point long, asks boolean").repartitionByRange(parts, "curve", "h", "point").sortWithinPartitions("curve", "h", "point", "asks")

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            curve, asks = np.asarray(b.column(0)), np.array(b.column(3).to_pylist(), bool)
            local, turn = np.empty(len(curve), np.int64), np.empty(len(curve), np.int64)
            for c in np.unique(curve).tolist():  # sorted, so a curve's rows stand together
                at = np.flatnonzero(curve == c)
                rows, calls = seen.get(c, (0, 0))
                own = ~asks[at]
                local[at], turn[at] = rows + np.cumsum(own) - own, calls + np.cumsum(~own) - ~own
                seen[c] = (rows + int(own.sum()), calls + int((~own).sum()))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(curve), part, np.int32)), b.column(0), b.column(2), b.column(3), pa.array(local), pa.array(turn)], ["part", "curve", "point", "asks", "local", "turn"])

    local = cut(placed.mapInArrow(numbered, "part int, curve int, point long, asks boolean, local long, turn long"), "ranks")
    sizes = local.groupBy("curve", "part").agg(F.count_if(~F.col("asks")).alias("n"), F.count_if("asks").alias("q"))
    before = Window.partitionBy("curve").orderBy("part")
    # a row for each partition and curve that meet
    starts = cut(sizes.select("curve", "part", (F.sum("n").over(before) - F.col("n")).alias("start"), (F.sum("q").over(before) - F.col("q")).alias("first")), "starts")
    ranks = local.join(F.broadcast(starts), ["curve", "part"])
    return cut(ranks.select("curve", "point", "asks", (F.col("start") + F.col("local")).alias("place"), (F.col("first") + F.col("turn")).alias("turn")), "places")


def exact(vectors: Vectors, queries: list[int], k: int) -> DataFrame:
    """(query, point): the ``k`` best other points of each query, by comparing the queries, which are few, with all rows."""
    held = vectors.points.where(F.col("point").isin(queries)).collect()
    ids, q = np.array([r["point"] for r in held], np.int64), _unpacked([r["v"] for r in held], vectors.kind, vectors.size)
    kind, size = vectors.kind, vectors.size

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, len(b), 4096):
                part = b.slice(i, 4096)
                point = np.asarray(part.column(0))
                score = q @ _unpacked(part.column(1).to_pylist(), kind, size).T
                score[ids[:, None] == point] = -np.inf
                m = min(k, len(point))
                least = np.partition(score, len(point) - m, axis=1)[:, len(point) - m]
                at, to = np.nonzero((score >= least[:, None]) & (score > -np.inf))
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(point[to]), pa.array(score[at, to])], ["query", "point", "score"])

    found = vectors.points.mapInArrow(best, "query long, point long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "point")
    return found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).select("query", "point")


def fit(vectors: Vectors, placed: DataFrame, k: int = 20, recall: float = RECALL, tried: int = TRIED) -> Fit:
    """All curves, or those of one kind, and the window that finds ``recall`` of the exact neighbours of ``tried`` queries, those with the
    smallest hashes; the choice with the fewest rows to meet.

    What reaches the driver is bounded by ``tried``, ``k`` and the number of curves.
    """
    queries = [r["point"] for r in vectors.asked.select("point").distinct().orderBy(F.xxhash64("point"), "point").limit(tried).collect()]
    truth = cut(exact(vectors, queries, k), "truth") if queries else None
    if truth is None or truth.isEmpty():
        return Fit([0], 1, 1.0, min(1.0, 2 / vectors.rows))
    ends = placed.select("curve", "point", "asks", "place")
    at = ends.where("asks").select("curve", F.col("point").alias("query"), F.col("place").alias("from"))
    # at most ``tried`` times ``k`` pairs are broadcast
    far = ends.where("NOT asks").select("curve", "point", "place").join(F.broadcast(truth), "point").join(at.join(F.broadcast(truth.select("query").distinct()), "query"), ["curve", "query"])
    # the row at ``place`` comes right after the rows before it
    far = far.select("curve", "query", "point", F.abs(F.col("place") - F.col("from")).alias("d")).collect()
    pairs = {p: i for i, p in enumerate(sorted({(r["query"], r["point"]) for r in far}))}
    d = np.zeros((max(r["curve"] for r in far) + 1, len(pairs)), np.int64)
    for r in far:
        d[r["curve"], pairs[r["query"], r["point"]]] = r["d"]
    found = []
    for chosen in (range(len(d)), range(0, len(d), 2), range(1, len(d), 2)):
        if len(chosen):
            best = d[chosen].min(axis=0)
            w = max(1, int(np.quantile(best, recall, method="higher")))
            found.append((len(chosen) * w, list(chosen), w, float((best <= w).mean())))
    _, chosen, w, reached = min(found)
    return Fit(chosen, w, reached, len(chosen) * 2 * w / vectors.rows)


def nearest(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20, curves: int = CURVES, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): for each id in ``queries`` (query_id) its nearest rows by inner product.

    Vectors that are null, zero, or hold null or non-finite numbers take no part, on either side. Equal vectors
    are one point that keeps its ``k`` + 1 smallest ids, which is all that a result can show; so copies of any
    number stay exact. Ties go to the smaller id. All vectors must have the length of the first one; shorter or
    longer ones take no part. Rows that repeat an id with the same vector are one. Fewer than ``k`` rows come back
    only where a query has fewer candidates in reach of its windows than that.

    Rows of a curve are dealt into blocks of ranks and queries into blocks of theirs; a group is one of each that
    lie within the window, so none grows with the table.
    """
    spark, since = vectors.sparkSession, mark()
    ready = prepare(vectors, queries, key, vector, k)
    if ready is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    along = places(ready, curves)
    placed = along
    used, window = fit(ready, placed, k, recall)[:2]
    kind, size = ready.kind, ready.size
    block = min(MOST, max(FEW, window))
    placed = placed.where(F.col("curve").isin(used))
    rows = placed.where("NOT asks").select("curve", F.expr(f"place div {block}").alias("block"), "place", "point")
    calls = placed.where("asks").select("curve", F.expr(f"turn div {CALLS}").alias("call"), "place", "point")
    reach = F.sequence(F.greatest(F.lit(0), F.expr(f"(least - {window}) div {block}")), F.least(F.lit((ready.rows - 1) // block), F.expr(f"(most + {window}) div {block}")))
    cells = calls.groupBy("curve", "call").agg(F.min("place").alias("least"), F.max("place").alias("most"))
    cells = cut(cells.select("curve", "call", F.explode(reach).alias("block")), "cells")
    release(spark, since, along, cells, ready.groups, ready.asked, ready.own)
    calls = calls.withColumn("block", F.explode(F.sequence(F.greatest(F.lit(0), F.expr(f"(place - {window}) div {block}")), F.least(F.lit((ready.rows - 1) // block), F.expr(f"(place + {window}) div {block}")))))
    rows = rows.join(cells, ["curve", "block"])
    names = ["curve", "block", "call", "place", "point"]
    both = rows.select(*names, F.lit(False).alias("asks")).unionByName(calls.select(*names, F.lit(True).alias("asks"))).join(ready.points, "point")

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        calls, rows = pdf[pdf["asks"]], pdf[~pdf["asks"]]
        if not len(calls) or not len(rows):
            return pd.DataFrame({"query": [], "point": [], "score": []}).astype({"query": "int64", "point": "int64", "score": "float64"})
        base, place, ids = _unpacked(rows["v"], kind, size), rows["place"].to_numpy(), rows["point"].to_numpy()
        out = []
        for i in range(0, len(calls), 256):
            some = calls.iloc[i : i + 256]
            score = _unpacked(some["v"], kind, size) @ base.T
            score[np.abs(some["place"].to_numpy()[:, None] - place) > window] = -np.inf
            m = min(k + 1, score.shape[1])
            least = np.partition(score, score.shape[1] - m, axis=1)[:, score.shape[1] - m]
            q, c = np.nonzero((score >= least[:, None]) & (score > -np.inf))  # ties with the last stay
            out.append(pd.DataFrame({"query": some["point"].to_numpy()[q], "point": ids[c], "score": score[q, c]}))
        return pd.concat(out)

    found = both.groupBy("curve", "block", "call").applyInPandas(merge, "query long, point long, score double")
    found = found.groupBy("query", "point").agg(F.max("score").alias("score"))
    best = found.withColumn("r", F.rank().over(Window.partitionBy("query").orderBy(F.desc("score")))).where(F.col("r") <= k + 1)
    ids = best.join(ready.groups.select("point", "ids"), "point").select(F.col("query").alias("point"), "score", F.explode("ids").alias("vec_id"))
    answers = ready.asked.join(ids, "point").where("vec_id <> query_id")
    answers = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return answers.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of ``embeddings`` for each id that 20 divides."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(table, table.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id")))
