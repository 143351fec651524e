"""Quotas on margins: a set of pairs whose numbers by type, by difficulty and by section each keep to what was asked.

Capping each combination does not do that. The table of combinations is fitted to the margins in turn (iterative
proportional fitting), never above what there is; the fitted table is made whole with its margins kept; and of each
combination the surest so many pairs are drawn. Fitting works on counts alone, of as many combinations as the asked
values make; pairs are ranked by Spark.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUNDS, CLOSE = 2000, 1e-10
#: Combinations of asked values at most.
MOST_CELLS = 1 << 18


def _sums(x: np.ndarray) -> list[np.ndarray]:
    return [x.sum(axis=tuple(a for a in range(x.ndim) if a != k)) for k in range(x.ndim)]


def _along(v: np.ndarray, k: int, ndim: int) -> np.ndarray:
    return v.reshape([-1 if a == k else 1 for a in range(ndim)])


def fitted(available: np.ndarray, margins: list[np.ndarray]) -> np.ndarray:
    """Shares of ``available`` whose sums along each axis are ``margins`` where that can be, with no cell above what there is."""
    x = available.astype(np.float64)
    for _ in range(ROUNDS):
        before = x
        for k, want in enumerate(margins):
            have = _sums(x)[k]
            x = np.minimum(x * _along(np.divide(want, have, out=np.zeros_like(want), where=have > 0), k, x.ndim), available)
        if np.abs(x - before).max(initial=0) < CLOSE:
            break
    return x


def whole(x: np.ndarray, available: np.ndarray, margins: list[np.ndarray]) -> np.ndarray:
    """Whole numbers near ``x`` and not above ``available``, whose sums are as near to ``margins`` as steps of one can bring them.

    A cell is raised, lowered, or raised while another is lowered, as long as the squared distances of all sums
    from their margins fall; of equal steps the one that keeps nearer to ``x``, then the first.
    """
    y = np.minimum(np.floor(x + 1e-9), available).astype(np.int64)
    dims, flat = x.ndim, np.arange(x.size).reshape(x.shape)

    def gains(sign: int) -> np.ndarray:
        """What the squared distances fall by when a cell is changed by ``sign``; impossible steps never pay."""
        off = [want - have for want, have in zip(margins, _sums(y))]
        g = sum((2 * sign * _along(o, k, dims) for k, o in enumerate(off)), np.zeros(x.shape)) - dims
        g = g + 1e-6 * np.clip(sign * (x - y), -1, 1)
        return np.where((y < available) if sign > 0 else (y > 0), g, -np.inf)

    for _ in range(4 * int(sum(margins[0])) + 4 * x.size + 16):
        up, down = gains(1), gains(-1)
        best_up, best_down = int(up.argmax()), int(down.argmax())
        steps = [(up.flat[best_up], ((best_up, 1),)), (down.flat[best_down], ((best_down, -1),))]
        # of two cells that share values of some axes the sums of these do not change
        for a in np.argsort(-up, axis=None, kind="stable")[:8]:
            at = np.unravel_index(a, x.shape)
            both = up.flat[a] + down + 2 * sum((_along((np.arange(x.shape[k]) == at[k]).astype(float), k, dims) for k in range(dims)), np.zeros(x.shape))
            both = np.where(flat == a, -np.inf, both)
            b = int(both.argmax())
            steps.append((both.flat[b], ((int(a), 1), (b, -1))))
        gain, changes = max(steps, key=lambda s: s[0])
        if not gain > 1e-4:
            break
        for cell, sign in changes:
            y.flat[cell] += sign
    return y


def cell_quotas(pairs: DataFrame, margins: Mapping[str, Mapping[str, float]]) -> list[tuple]:
    """[(values..., number)] for each combination of asked values that has pairs to give."""
    names, values = list(margins), [list(m) for m in margins.values()]
    if int(np.prod([len(v) for v in values])) > MOST_CELLS:
        raise ValueError(f"the margins make more than {MOST_CELLS} combinations")
    asked = pairs
    for n, v in zip(names, values):
        asked = asked.where(F.col(n).isin(v))
    available = np.zeros([len(v) for v in values], np.int64)
    place = [{x: i for i, x in enumerate(v)} for v in values]
    for r in asked.groupBy(*names).agg(F.count("*").alias("n")).collect():  # MOST_CELLS rows at most
        available[tuple(p[r[n]] for p, n in zip(place, names))] = r["n"]
    want = [np.array([float(m[x]) for x in v]) for m, v in zip(margins.values(), values)]
    y = whole(fitted(available, want), available, want)
    return [(*c, int(n)) for c, n in zip(itertools.product(*values), y.ravel()) if n]


def draw(pairs: DataFrame, margins: Mapping[str, Mapping[str, float]], order: list[str | Column]) -> DataFrame:
    """Pairs whose numbers by each column of ``margins`` are within one of the numbers asked for, where the pairs allow it.

    ``margins`` has a number for each value of each column, e.g. {"question_type": {"comparison": 40, ...}, ...}; all
    columns' numbers have one sum. Other values, and null, are left out. Of a combination the first by ``order`` are taken.
    Where there are too few pairs the sums stay below; ``shortfall`` tells.
    """
    totals = {round(sum(m.values()), 6) for m in margins.values()}
    if len(totals) != 1:
        raise ValueError(f"the margins have different sums: {sorted(totals)}")
    names, cells = list(margins), cell_quotas(pairs, margins)
    if not cells:
        return pairs.limit(0)
    number = pairs.sparkSession.createDataFrame(cells, ", ".join([*(f"{n} string" for n in names), "_quota long"]))
    most = max(c[-1] for c in cells)
    # a bound that is one number lets each task thin a combination before it meets
    ranked = pairs.withColumn("_n", F.row_number().over(Window.partitionBy(*names).orderBy(*order))).where(F.col("_n") <= most)
    return ranked.join(F.broadcast(number), names).where("_n <= _quota").select(*pairs.columns)


def shortfall(drawn: DataFrame, margins: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """(dimension, value, quota, n) of each asked value; dimension and value are strings."""
    sets = drawn.groupingSets([[n] for n in margins], *margins).agg(F.count("*").alias("n"), *[F.grouping(n).alias(f"g_{n}") for n in margins])
    counted = sets.select(F.coalesce(*[F.when(F.col(f"g_{n}") == 0, n) for n in margins]).alias("dimension"), F.coalesce(*[F.when(F.col(f"g_{n}") == 0, F.col(n).cast("string")) for n in margins]).alias("value"), "n")
    asked = drawn.sparkSession.createDataFrame([(n, str(v), float(q)) for n, m in margins.items() for v, q in m.items()], "dimension string, value string, quota double")
    return asked.join(counted, ["dimension", "value"], "left").select("dimension", "value", "quota", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
