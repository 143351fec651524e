"""Overlapping spans against all pairs; sessions in a table and in a stream with late rows."""

import random
from datetime import datetime, timedelta

import pytest

from groundmill.operators.intervals import covered, line_spans, overlapping, window_spans
from groundmill.streaming.drops import session_stream, sessions

SPAN = "doc string, k long, start long, end long"


def spans(rng, n):
    out = [(rng.choice("ab"), i, s := rng.randrange(200), s + rng.choice([0, 1, 3, 10, 150])) for i, _ in enumerate(range(n))]
    return out + [(None, 900, 0, 50), ("a", 901, None, 5), ("a", 902, 9, 2), ("c", 903, 0, 5)]


@pytest.mark.parametrize("width", [None, 1, 7, 1000])
def test_overlaps_equal_all_pairs(spark, width):
    left, right = spans(random.Random(1), 60), spans(random.Random(2), 50)
    got = sorted((r["doc"], r["l"]["k"], r["r"]["k"], r["start"], r["end"]) for r in overlapping(spark.createDataFrame(left, SPAN), spark.createDataFrame(right, SPAN), ["doc"], width).collect())
    ok = lambda x: x[0] is not None and x[2] is not None and x[2] < x[3]
    want = sorted((a[0], a[1], b[1], max(a[2], b[2]), min(a[3], b[3])) for a in left for b in right if ok(a) and ok(b) and a[0] == b[0] and max(a[2], b[2]) < min(a[3], b[3]))
    assert got == want
    plan = overlapping(spark.createDataFrame(left, SPAN), spark.createDataFrame(right, SPAN), ["doc"], 5)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    if width == 7:
        c = {(r["doc"], r["k"]): (r["n"], r["shared"], r["whole"]) for r in covered(spark.createDataFrame(left, SPAN), spark.createDataFrame(right, SPAN), ["doc"], "k", width).collect()}
        assert len(c) == len(left)
        for a in left:
            own = [w for w in want if (w[0], w[1]) == (a[0], a[1])]
            holds = any(ok(a) and ok(b) and b[0] == a[0] and b[2] <= a[2] and b[3] >= a[3] for b in right)
            assert c[a[0], a[1]] == (len(own), sum(w[4] - w[3] for w in own), holds)


def test_no_side_is_held_whole_by_a_task(spark, tmp_path):
    """Spans in files look small; a broadcast of them grows with the table, in every task."""
    for side, rng in (("l", random.Random(3)), ("r", random.Random(4))):
        spark.createDataFrame(spans(rng, 40), SPAN).write.parquet(str(tmp_path / side))
    left, right = (spark.read.parquet(str(tmp_path / side)) for side in "lr")
    for df in (overlapping(left, right, ["doc"], 5), covered(left, right, ["doc"], "k", 5)):
        df.collect()
        assert "Broadcast" not in df._jdf.queryExecution().toString()
    got = covered(left, right.where("doc = 'none'"), ["doc"], "k", 5).collect()
    assert sorted((str(r["doc"]), r["k"]) for r in got) == sorted((str(r["doc"]), r["k"]) for r in left.collect())
    assert {(r["n"], r["shared"], r["whole"]) for r in got} == {(0, 0, False)}


def test_spans_of_texts(spark):
    texts = [(1, "ab\n\ncdé\n"), (2, ""), (3, None), (4, "x" * 23)]
    d = spark.createDataFrame(texts, "id long, text string")
    by_id = dict(texts)
    lines = sorted(tuple(r) for r in line_spans(d, "id", "text").collect())
    assert [(i, k, by_id[i][s:e]) for i, k, s, e in lines] == [(1, 0, "ab"), (1, 1, ""), (1, 2, "cdé"), (1, 3, ""), (2, 0, ""), (4, 0, "x" * 23)]
    assert sorted(tuple(r) for r in window_spans(d, "id", "text", 10, 2).collect()) == [(1, 0, 0, 8), (4, 0, 0, 10), (4, 1, 8, 18), (4, 2, 16, 23)]


EVENT = "event_id long, ts timestamp, user_id long, event_type string, value double"


def shown(df):
    return sorted((r["user_id"], r["begin"], r["end"], r["n"], float(r["total"]), r["n_errors"]) for r in df.collect())


def test_sessions_of_a_stream_leave_out_late_rows(spark, tmp_path):
    zero = datetime(2024, 1, 1)
    at = lambda i, minute, user, kind="view": (i, zero + timedelta(minutes=minute), user, kind, 1.25)
    first = [at(1, 0, 1), at(2, 29, 1, "error"), at(3, 59, 1), at(4, 5, 2), at(7, 20, 2)]  # just 30 minutes apart is one session
    second = [at(5, 100, 2), at(6, 61, 1)]
    late = [at(8, 2, 2), at(9, 10, 3)]  # more than ten minutes behind what the stream has seen
    last = [at(10, 300, 9)]

    def run():
        q = session_stream(spark, str(tmp_path / "in"), EVENT, str(tmp_path / "out"), str(tmp_path / "state"), files_per_batch=1)
        assert q.awaitTermination(120) and q.exception() is None

    for n, part in enumerate((first, second, late, last)):
        spark.createDataFrame(part, EVENT).coalesce(1).write.parquet(str(tmp_path / "in" / str(n)))
        run()
    want = shown(sessions(spark.createDataFrame(first + second + last, EVENT)).where("user_id <> 9"))
    assert shown(spark.read.parquet(str(tmp_path / "out"))) == want
    assert [(w[0], w[3]) for w in want] == [(1, 4), (2, 2), (2, 1)]
