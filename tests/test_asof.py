"""As-of matches against a loop, with ties, gaps, one very common key and any number of slices."""

import random
from datetime import datetime, timedelta

import pytest

from groundmill.operators.asof import as_of

ZERO = datetime(2024, 1, 1)


def drawn(rng, n, first):
    return [(first + i, rng.choice(["hot"] * 6 + ["a", "b", None]), rng.choice([None, *[ZERO + timedelta(minutes=rng.randrange(90))] * 12])) for i in range(n)]


@pytest.mark.parametrize("slices", [1, 4, 40])
@pytest.mark.parametrize("inclusive", [True, False])
def test_as_of_equals_a_loop(spark, slices, inclusive):
    rng = random.Random(3)
    asked, valid = drawn(rng, 150, 0), drawn(rng, 40, 1000) + [(2000, "only", ZERO)]
    asked += [(500, "only", ZERO + timedelta(days=9)), (501, "nobody", ZERO)]
    left, right = spark.createDataFrame(asked, "n long, k string, t timestamp"), spark.createDataFrame(valid, "rule long, k string, since timestamp")
    got = {r["n"]: r["found"] and r["found"]["rule"] for r in as_of(left, right, ["k"], "t", "since", slices, inclusive).collect()}
    want = {}
    for n, k, t in asked:
        fit = [(s, k, r) for r, key, s in valid if k is not None and key == k and t is not None and s is not None and (s <= t if inclusive else s < t)]
        want[n] = max(fit, key=lambda x: (x[0], x[2]))[2] if fit else None
    assert got == want and len(got) == len(asked)


def test_nothing_to_match(spark):
    left, right = spark.createDataFrame([(1, "a", ZERO)], "n long, k string, t timestamp"), spark.createDataFrame([], "rule long, k string, since timestamp")
    assert [tuple(r) for r in as_of(left, right, ["k"], "t", "since", 3).collect()] == [(1, "a", ZERO, None)]
    assert as_of(left.where("false"), right, ["k"], "t", "since", 3).count() == 0


def test_no_inequality_join(spark):
    left = spark.createDataFrame([(1, "a", ZERO)], "n long, k string, t timestamp")
    plan = as_of(left, left.withColumnsRenamed({"n": "rule", "t": "since"}), ["k"], "t", "since", 3)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
