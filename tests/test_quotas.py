"""Quotas on margins: sums within one of what was asked, never above supply, and the surest of each combination."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from groundmill.operators.quotas import _sums, cell_quotas, draw, fitted, shortfall, whole


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(2, 5), st.integers(2, 4), st.integers(2, 6))
def test_margins_that_can_be_met_are_met_within_one(seed, a, b, c):
    rng = np.random.default_rng(seed)
    inner = rng.gamma(0.7, 3, (a, b, c))  # a table that has the margins asked for, below the supply
    available = np.ceil(inner + rng.gamma(1, 3, inner.shape)).astype(np.int64)
    margins = _sums(inner)
    x = fitted(available, margins)
    assert (x <= available + 1e-9).all() and all(np.abs(h - m).max() < 1e-3 for h, m in zip(_sums(x), margins))
    y = whole(x, available, margins)
    assert (0 <= y).all() and (y <= available).all()
    assert all(np.abs(h - m).max() <= 1 + 1e-9 for h, m in zip(_sums(y), margins))


def test_what_cannot_be_met_stays_below():
    available = np.array([[3, 0], [0, 2]])
    x = fitted(available, [np.array([10.0, 10.0]), np.array([10.0, 10.0])])
    assert (x == available).all() and (whole(x, available, [np.array([10.0, 10.0])] * 2) == available).all()
    assert whole(fitted(np.zeros((2, 2), int), [np.array([1.0, 1.0])] * 2), np.zeros((2, 2), int), [np.array([1.0, 1.0])] * 2).sum() == 0


def test_drawn_pairs_equal_a_loop(spark):
    rng = random.Random(9)
    types, levels, parts = ("fact", "comparison"), ("easy", "hard", None), ("1", "7", "other")
    rows = [(i, rng.choice(types), rng.choice(levels), rng.choice(parts), rng.randrange(9) / 8) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, t string, d string, s string, c double")
    margins = {"t": {"fact": 30, "comparison": 10}, "d": {"easy": 15.5, "hard": 24.5}, "s": {"1": 12, "7": 28}}
    got = draw(df, margins, [df["c"].desc(), df["id"]])
    want = []
    for *cell, n in cell_quotas(df, margins):
        want += sorted((r for r in rows if list(r[1:4]) == cell), key=lambda r: (-r[4], r[0]))[:n]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    table = {(r["dimension"], r["value"]): (r["quota"], r["n"]) for r in shortfall(got, margins).collect()}
    assert len(table) == 6 and all(abs(q - n) <= 1 for q, n in table.values())
    with pytest.raises(ValueError, match="different sums"):
        draw(df, {"t": {"fact": 3}, "d": {"easy": 4}}, ["id"])
    assert draw(df, {"t": {"nowhere": 3}}, ["id"]).count() == 0
