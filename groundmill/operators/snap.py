"""Alignment of a quote to the exact span of its chunk."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundmill.functions.text import fold, norm_punct, strip, tokens

#: Characters of a block, and pairs of equal grams held at a time.
LEAST_BLOCK, PLACES = 4, 1 << 21


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def _runs(chunk: np.ndarray, passage: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, n) of all stretches of ``LEAST_BLOCK`` or more that ``chunk[i : i + n]`` and ``passage[j : j + n]`` share and that no neighbour extends.

    Places of equal grams meet through the sorted grams of the passage, ``PLACES`` at a time; places that follow
    each other on a diagonal are one stretch.
    """
    _, both = np.unique(np.concatenate([chunk, passage]), return_inverse=True)
    for width in (1, 2):  # pairs, then pairs of pairs; numbers of grams stay below the number of places
        key = both[:-width].astype(np.int64) * (len(both) + 1) + both[width:]
        _, both = np.unique(key, return_inverse=True)
    a, b = both[: len(chunk) - LEAST_BLOCK + 1], both[len(chunk) :]
    order = np.argsort(b, kind="stable")
    grams = b[order]
    first = np.searchsorted(grams, a)
    each = np.searchsorted(grams, a, side="right") - first
    upto = np.cumsum(each)
    out, at = [], 0
    while at < len(a):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PLACES, side="right")))
        n = each[at:end]
        i = np.repeat(np.arange(at, end), n)
        j = order[np.repeat(first[at:end] - (np.cumsum(n) - n), n) + np.arange(len(i))]
        out.append(_joined(i, j, np.ones(len(i), np.int64)))
        at = end
    i, j, n = _joined(*(np.concatenate(x) for x in zip(*out, strict=True)))
    return i, j, n + LEAST_BLOCK - 1


def _joined(i: np.ndarray, j: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of which each that begins where another ends, on its diagonal, is part of that one."""
    order = np.lexsort((i, i - j))
    i, j, n = i[order], j[order], n[order]
    new = np.ones(len(i), bool)
    new[1:] = ((i - j)[1:] != (i - j)[:-1]) | (i[1:] != (i + n)[:-1])
    at = np.flatnonzero(new)
    return i[at], j[at], np.add.reduceat(n, at) if len(at) else n[at]


def _blocks(chunk: str, passage: str) -> list[tuple[int, int, int]]:
    """The longest stretch in common, then the longest ones on either side of it in both texts, and so on, in order.

    Of equal lengths the first in the chunk counts, then the first in the passage.
    """
    if min(len(chunk), len(passage)) < LEAST_BLOCK:
        return []
    i, j, n = _runs(_codes(chunk), _codes(passage))
    out, todo = [], [(0, len(chunk), 0, len(passage), i, j, n)]
    while todo:
        a0, a1, b0, b1, i, j, n = todo.pop()
        cut = np.maximum(0, np.maximum(a0 - i, b0 - j))
        n = np.minimum(n, np.minimum(a1 - i, b1 - j)) - cut
        keep = n >= LEAST_BLOCK
        i, j, n = (i + cut)[keep], (j + cut)[keep], n[keep]
        if not len(n):
            continue
        best = np.flatnonzero(n == n.max())
        x, y = min(zip(i[best].tolist(), j[best].tolist(), strict=True))
        size = int(n.max())
        out.append((x, y, size))
        todo += [(a0, x, b0, y, i, j, n), (x + size, a1, y + size, b1, i, j, n)]
    return sorted(out)


def _hull(passage: str | None, chunk: str | None) -> tuple[int, int] | None:
    """Start and end in ``chunk`` of what its blocks in common with ``passage`` enclose.

    Blocks are of four characters at least. Where they are scattered over more than three times the passage
    and 80 characters, the longest one alone is taken.
    """
    blocks = _blocks(chunk or "", passage or "")
    if not blocks:
        return None
    first, last = blocks[0], blocks[-1]
    if last[0] + last[2] - first[0] > 3 * len(passage) + 80:
        first = last = max(blocks, key=lambda b: b[2])
    return first[0], last[0] + last[2]


def _hull_column():
    """The Python function behind the fuzzy leg; made when used, so that the module imports without a session."""

    @F.pandas_udf("array<int>")
    def hull(passage: pd.Series, chunk: pd.Series) -> pd.Series:
        return pd.Series([list(h) if (h := _hull(p, c)) else None for p, c in zip(passage, chunk, strict=True)], dtype=object)

    return hull


def snap(pairs: DataFrame, fuzzy: bool = True) -> DataFrame:
    """Add ``snapped_passage`` and ``snapped`` to pairs with ``source_passage`` and ``chunk_text``.

    Quotes that the chunk holds character for character, after typographic marks are folded one for one, are
    located by built-in functions. Only the others go to the block matcher, in rows of their own, and their
    span counts if it covers six in ten of the quote's words. A quote that cannot be placed stays as it is.
    """
    p, c = F.coalesce(F.col("source_passage"), F.lit("")), F.coalesce(F.col("chunk_text"), F.lit(""))
    located = F.when((F.length(p) >= LEAST_BLOCK) & (strip(p) != ""), F.instr(norm_punct(c), norm_punct(p))).otherwise(0)
    marked = pairs.withColumn("_at", located)
    span = strip(F.substring(c, F.col("_at"), F.length(p)))
    if fuzzy:
        exact = marked.where("_at > 0").withColumn("_span", span)
        rest = marked.where("_at = 0")
        # few rows, each of them slow: adaptive execution would put them into one task
        rest = rest.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        rest = rest.withColumn("_h", F.when(strip(p) != "", _hull_column()(norm_punct(p), norm_punct(c))))
        rest = rest.withColumn("_span", strip(F.substring(c, F.col("_h")[0] + 1, F.col("_h")[1] - F.col("_h")[0]))).drop("_h")
        out = exact.unionByName(rest)
    else:  # in one pass: each part of a union would read and judge all pairs again
        out = marked.withColumn("_span", F.when(F.col("_at") > 0, span))
    words = tokens(p)
    covered = (F.size(words) > 0) & (F.size(F.array_intersect(words, tokens(F.col("_span")))) * 10 >= F.size(words) * 6)
    good = F.when(F.col("_span").isNotNull(), F.coalesce(covered & F.contains(fold(c), fold(F.col("_span"))), F.lit(False))).otherwise(False)
    return out.withColumns({"snapped_passage": F.when(good, F.col("_span")).otherwise(F.col("source_passage")), "snapped": good}).drop("_at", "_span")
