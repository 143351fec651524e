"""Sketches by batch against exact figures, however the rows are cut into batches."""

import random

import pytest
from pyspark.sql import functions as F

from groundmill.operators import monitoring as M

KIND = "part string, confidence double, accepted boolean, question string"


def rows(n, seed):
    rng = random.Random(seed)
    return [(rng.choice("abc"), rng.choice([None, rng.random() ** 3, 0.5]), rng.choice([True, False, None]), rng.choice([None, f"question number {rng.randrange(n // 3)}"])) for _ in range(n)]


@pytest.mark.parametrize("batches", [1, 7])
def test_merged_batches_keep_to_their_errors(spark, tmp_path, batches):
    data = rows(20_000, 5)
    df = spark.createDataFrame(data, KIND)
    for b in range(batches):
        got = M.store(spark.createDataFrame(data[b::batches], KIND), str(tmp_path / "m"), str(b))
        assert got == {"n": len(data[b::batches]), "n_accepted": sum(bool(r[2]) for r in data[b::batches])}
    M.store(spark.createDataFrame(data[0::batches], KIND), str(tmp_path / "m"), "0")  # again
    table = M.stored(spark, str(tmp_path / "m"))
    assert table.count() == batches
    found = M.figures(M.merged(table, []))
    r = found.first()
    known = [x[1] for x in data if x[1] is not None]
    assert (r["n"], r["n_accepted"]) == (20_000, sum(bool(x[2]) for x in data)) and r["mean_confidence"] == pytest.approx(sum(known) / len(known))
    different = len({x[3] for x in data if x[3]})
    assert abs(r["n_questions"] - different) <= M.DISTINCT_ERROR * different
    ranks = M.exact_ranks(df, found, [])
    assert ranks.count() == 5 and ranks.where(~M.inside(F.col("low"), F.col("high"), F.col("quantile"))).count() == 0
    assert max(len(x["confidences"]) for x in table.collect()) < 20_000


def test_groups_and_nothing(spark, tmp_path):
    df = spark.createDataFrame(rows(600, 6), KIND)
    by_part = M.figures(M.sketches(df, ["part"]))
    assert {x["part"]: x["n"] for x in by_part.collect()} == {x["part"]: x["count"] for x in df.groupBy("part").count().collect()}
    ranks = M.exact_ranks(df, by_part, ["part"])
    assert ranks.count() == 15 and ranks.where(~M.inside(F.col("low"), F.col("high"), F.col("quantile"))).count() == 0
    assert M.figures(M.merged(M.sketches(df, ["part"]), [])).first()["n"] == 600
    bare = M.figures(M.sketches(df.where("false").unionByName(spark.createDataFrame([("z", None, None, None)], KIND)), ["part"])).first()
    assert (bare["n"], bare["n_accepted"], bare["mean_confidence"], bare["confidence_quantiles"], bare["n_questions"]) == (1, 0, 0.0, [None] * 5, 0)
    assert M.stored(spark, str(tmp_path / "none")).count() == 0
