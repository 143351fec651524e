"""Packing into length buckets whose bounds waste the least padding.

Sequences longer than ``max_length`` are cut into pieces of that length. The histogram of all piece lengths,
which has ``max_length`` rows at most, goes to a dynamic program that picks the ``buckets`` upper bounds with
the least padding in total. Inside a bucket, pieces in seeded order form batches of as many rows as a budget
of padded tokens holds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .mixing import token_count
from .ordering import seeded_hash, sums_before
from .shared import cut, documents

MAX_LENGTH = 4096
BUCKETS = 16
BATCH_TOKENS = 65_536
SEED = "29"


def optimal_bounds(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper bounds, ascending, of at most ``buckets`` buckets over ascending ``lengths`` with the least padding.

    Of equally good choices the one with fewer buckets, then smaller bounds from the last split on, is taken.
    """
    n = len(lengths)
    if not n:
        return []
    size = np.array(lengths, np.float64)
    upto = np.concatenate([[0.0], np.cumsum(np.array(counts, np.float64))])
    k = min(buckets, n)
    best = np.full(n + 1, np.inf)
    best[0] = 0
    choice = np.zeros((k + 1, n + 1), np.int64)
    totals = []
    for b in range(1, k + 1):
        new = np.full(n + 1, np.inf)
        for j in range(1, n + 1):
            # padded tokens if the last bucket holds lengths i..j-1; what they hold themselves is the same for all choices
            cost = best[:j] + (upto[j] - upto[:j]) * size[j - 1]
            i = int(np.argmin(cost))
            new[j], choice[b, j] = cost[i], i
        best = new
        totals.append(best[n])
    b, j, out = int(np.argmin(totals)) + 1, n, []
    while j:
        out.append(int(lengths[j - 1]))
        j, b = int(choice[b, j]), b - 1
    return out[::-1]


def pack(docs: DataFrame, key: str, n_tokens: str, max_length: int = MAX_LENGTH, buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS, seed: str = SEED) -> DataFrame:
    """(doc_id, piece, start, length, bucket, batch, slot) for each piece of each row.

    ``bucket`` is the padded length, ``batch`` counts from 0 within it, ``slot`` is the place in the batch. Each
    batch but the last of a bucket is full. Rows of no tokens, or a null count, have no piece. Rows that
    repeat an id, or have none, are packed like others. A batch budget below a bucket's length holds one row.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(n_tokens).cast("long").alias("n")).where("n > 0")
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {max_length}"))))
    pieces = pieces.select("doc_id", "piece", (F.col("piece") * max_length).alias("start"), F.least(F.lit(max_length).cast("long"), F.col("n") - F.col("piece") * max_length).alias("length"))
    pieces = cut(pieces, "pieces")
    histogram = sorted((r["length"], r["count"]) for r in pieces.groupBy("length").count().collect())  # max_length rows at most
    bounds = optimal_bounds([x for x, _ in histogram], [c for _, c in histogram], buckets)
    bucket = F.lit(None).cast("long")
    for b in reversed(bounds):
        bucket = F.when(F.col("length") <= b, F.lit(b).cast("long")).otherwise(bucket)
    placed = pieces.withColumn("bucket", bucket).withColumn("one", F.lit(1).cast("long")).withColumn("_h", seeded_hash(seed, F.col("doc_id"), F.col("piece")))
    placed = sums_before(placed, ["bucket"], ["_h", "doc_id", "piece"], "one", "rank", sum(c for _, c in histogram))
    held = F.greatest(F.lit(1).cast("long"), F.expr(f"{batch_tokens} div bucket"))
    return placed.withColumn("_held", held).select("doc_id", "piece", "start", "length", "bucket", F.expr("rank div _held").alias("batch"), F.expr("rank % _held").alias("slot"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every text of ``documents``, by words, in length buckets and batches."""
    return pack(documents(spark, sf_dir).select("doc_id", token_count(F.col("text")).alias("n_tokens")), "doc_id", "n_tokens")
