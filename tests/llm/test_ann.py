import math
import random

import numpy as np

from groundmill.llm import ann
from groundmill.llm.queries import QUERIES

from ..conftest import DATA

KIND = "vec_id long, embedding array<float>, label int"


def brute(rows, queries, k):
    good = {i: np.array(v, np.float64) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == 8}
    out = {}
    for q in queries:
        if q in good:
            near = sorted(((-float(good[q] @ v), i) for i, v in good.items() if i != q))[:k]
            out[q] = [i for _, i in near]
    return out


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r["vec_id"])
    return out


def test_hilbert_curve_visits_each_cell_by_single_steps():
    grid = np.array([[a, b, c] for a in range(8) for b in range(8) for c in range(8)])
    keys = ann.hilbert_keys(grid, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert set(np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1).tolist()) == {1}


def test_small_tables_are_exact(spark):
    """All queries are in the sample that the window is fitted to, so copies, ties and rows that take no part can be held against all pairs."""
    rng = random.Random(1)
    # eighths have exact products, so ties are ties in any order of summing
    rows = [(i, [rng.randint(-8, 8) / 8 for _ in range(8)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(60)] + [(300, None), (301, [0.0] * 8), (302, [float("nan")] + [1.0] * 7), (303, [None] * 8), (304, [float("inf")] * 8), (305, []), (306, [1.0] * 7), (None, [1.0] * 8), (0, rows[0][1])]
    t = spark.createDataFrame([(i, v, 0) for i, v in rows], KIND)
    queries = [0, 3, 20, 140, 205, 300, 301, 302, 999]
    got = results(ann.nearest(t, spark.createDataFrame([(q,) for q in queries], "query_id long"), k=20, recall=1.0))
    assert got == brute(rows, queries, 20)


def test_few_and_no_rows(spark):
    t = spark.createDataFrame([(20, [1.0] * 8, 0), (7, [0.5] * 8, 0), (9, [2.0] * 8, 0)], KIND)
    asked = t.selectExpr("vec_id AS query_id")
    assert results(ann.nearest(t, asked, k=20)) == {7: [9, 20], 9: [20, 7], 20: [9, 7]}
    assert ann.nearest(t.where("false"), asked).count() == 0


def test_recall_of_op9(spark):
    rows = [(r["vec_id"], np.array(r["embedding"], np.float64)) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    got = QUERIES["op9_ann"](spark, DATA).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append(r)
    vectors, hits = dict(rows), 0
    assert set(by) == {i for i, _ in rows if i % 20 == 0}
    for q, found in by.items():
        best = {i for _, i in sorted((-(vectors[q] @ v), i) for i, v in rows if i != q)[:20]}
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 21)) and found == sorted(found, key=lambda r: (-r["score"], r["vec_id"]))
        assert all(abs(r["score"] - vectors[q] @ vectors[r["vec_id"]]) < 1e-12 for r in found)
        hits += len(best & {r["vec_id"] for r in found})
    assert hits >= 0.9 * 20 * len(by)


def measured(spark, x, asked):
    """(fit, recall on all queries) over the rows of ``x``."""
    t = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], KIND).repartition(4)
    queries = spark.createDataFrame([(int(q),) for q in asked], "query_id long")
    ready = ann.prepare(t, queries)
    fit = ann.fit(ready, ann.places(ready))
    got = results(ann.nearest(t, queries))
    y = x.astype(np.float32).astype(np.float64)
    hits = 0
    for q in asked:
        score = y @ y[q]
        score[q] = -np.inf
        hits += len(set(np.argsort(-score)[:20].tolist()) & set(got[int(q)]))
    return fit, hits / 20 / len(asked)


def test_windows_follow_the_structure_of_vectors(spark):
    """On rows in clusters a few rows are compared, of whatever length they are; on rows without structure windows must be wide."""
    rng = np.random.default_rng(12)
    asked = np.arange(0, 10_000, 25)
    middles = rng.normal(size=(250, 32))
    clustered = middles[rng.integers(0, 250, 10_000)] + 0.3 * rng.normal(size=(10_000, 32))
    fit, recall = measured(spark, clustered, asked)
    assert recall >= 0.9 and fit.share < 0.25
    scaled = clustered * rng.uniform(0.6, 1.4, size=(10_000, 1))  # lengths decide which inner products are large
    fit, recall = measured(spark, scaled, asked)
    assert recall >= 0.9 and fit.share < 1.5
    plain = rng.normal(size=(10_000, 32))
    fit, recall = measured(spark, plain / np.linalg.norm(plain, axis=1, keepdims=True), asked)
    assert recall >= 0.9 and fit.share < 1.5
