"""Keyed state across batches: any split into drops and restarts gives the batch result."""

import random
import time

import pytest

from groundmill.functions.text import question_key
from groundmill.operators.judging import accepted_rows, dedupe
from groundmill.streaming.keyed import dedupe_stream, latest, target_stream

ORDER = ["doc_id", "chunk_ord", "pair_idx"]
KIND = "doc_id long, chunk_ord int, pair_idx long, chunk_id string, question string, final_passage string, question_type string, confidence double, token_overlap double, source_verbatim boolean, accepted boolean"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def rows(n, seed):
    rng = random.Random(seed)
    asked = ["What is the lamp?", "what is a LAMP", "Which lamp burns", "is the", "", None, "Où est la lampe ?", *[f"number {i}" for i in range(12)]]
    return [(i // 4, i % 2, i, f"c{i}", rng.choice(asked), f"quote {i} \"with\" ü", rng.choice(["fact", "comparison", None]), rng.choice([None, 0.25, 0.5, 1.0]), rng.choice([None, 0.6, 0.8]), rng.random() < 0.5, rng.random() < 0.8) for i in range(n)]


def write(spark, path, part):
    spark.createDataFrame(part, KIND).coalesce(1).write.mode("append").parquet(str(path))


def run(spark, tmp_path, at, **more):
    q = dedupe_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], KIND).schema, str(tmp_path / f"out{at}"), str(tmp_path / f"state{at}"), ORDER, files_per_batch=1, **more)
    assert q.awaitTermination(120) and q.exception() is None


def shown(df):
    return sorted((tuple(r[c] for c in (*ORDER, "question", "source_passage", "verifier_confidence", "grounding_overlap", "question_type")) for r in df.collect()), key=str)


@pytest.mark.parametrize("cuts", [[60], [3, 41]])
def test_any_split_gives_the_batch_result(spark, tmp_path, cuts):
    all_rows = rows(60, 4)
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, 60])):
        if a < b:
            write(spark, tmp_path / "in" / f"drop{i}", all_rows[a:b])
        if i == 1:
            run(spark, tmp_path, 0)  # stopped and started again between drops
    write(spark, tmp_path / "in" / "again", all_rows[:9])  # rows that come twice
    run(spark, tmp_path, 0)
    out = spark.read.parquet(str(tmp_path / "out0"))
    assert shown(latest(out)) == shown(dedupe(accepted_rows(spark.createDataFrame(all_rows, KIND)), ORDER))
    assert out.groupBy("question_key", "revision").count().where("count > 1").count() == 0
    keys = accepted_rows(spark.createDataFrame(all_rows, KIND)).select(question_key("question")).distinct().count()
    assert out.where("revision = 1").count() == keys
    before = out.count()
    run(spark, tmp_path, 0)
    assert spark.read.parquet(str(tmp_path / "out0")).count() == before


def test_a_key_is_forgotten_after_its_time(spark, tmp_path):
    one = [(1, 0, 1, "c", "one lamp", "q", "fact", 0.5, 0.6, True, True)]
    kind, counts = spark.createDataFrame([], KIND).schema, []
    write(spark, tmp_path / "in" / "a", one)
    streams = [dedupe_stream(spark, str(tmp_path / "in"), kind, str(tmp_path / f"out{ttl}"), str(tmp_path / f"state{ttl}"), ORDER, ttl, every="1 second") for ttl in (1, 3_600_000)]
    try:
        for drop in ("b", "c"):
            until = time.time() + 60
            seen = [0, 0]
            want = [1, 1] if drop == "b" else [2, 1]
            while seen != want and time.time() < until:
                time.sleep(0.5)
                seen = [spark.read.schema("revision long").parquet(str(tmp_path / f"out{ttl}")).count() if (tmp_path / f"out{ttl}" / "_spark_metadata").exists() else 0 for ttl in (1, 3_600_000)]
            counts.append(seen)
            write(spark, tmp_path / "in" / drop, one)
    finally:
        for q in streams:
            q.stop()
    assert counts == [[1, 1], [2, 1]]


def test_targets_hold_over_restarts(spark, tmp_path):
    def go():
        q = target_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], KIND).schema, str(tmp_path / "out"), str(tmp_path / "state"), "question_type", 4, ORDER, files_per_batch=1)
        assert q.awaitTermination(120) and q.exception() is None
        return {r["question_type"]: r["count"] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("question_type").count().collect()}

    part = [(i, 0, i, "c", f"lamp number {i}", "q", t, 0.5, 0.6, True, True) for i, t in enumerate(["fact", "fact", "comparison", None, None])]
    write(spark, tmp_path / "in" / "a", part)
    assert go() == {"fact": 2, "comparison": 1, None: 2}
    more = [(10 + i, 0, i, "c", f"lamp number {i + 3}", "q", "fact", 0.5, 0.6, True, True) for i in range(6)]
    write(spark, tmp_path / "in" / "b", more)  # two of them ask what was asked before
    assert go() == {"fact": 4, "comparison": 1, None: 2}
    got = {(r["doc_id"], r["question"]) for r in spark.read.parquet(str(tmp_path / "out")).where("question_type = 'fact'").collect()}
    assert got == {(0, "lamp number 0"), (1, "lamp number 1"), (12, "lamp number 5"), (13, "lamp number 6")}
