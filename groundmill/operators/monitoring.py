"""Figures of a run by batch that add up: sketches of quantiles and of different values are stored, and merged when asked.

A batch leaves one row of a bounded size, whatever its number of pairs; nothing is read again for a total over batches, a
week, or all of them. Quantiles are KLL sketches, counts of different questions HyperLogLog ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from groundmill.functions.text import question_key
from groundmill.sources.scratch import exists

#: Size of the quantile sketch; its rank is off by no more than RANK_ERROR, 99 times of 100 (the published bound for one quantile).
KLL_K = 400
RANK_ERROR = 2.296 / KLL_K**0.9723
#: Registers of the distinct sketch, as a power of two; three standard errors of its count.
HLL_LOG, DISTINCT_ERROR = 12, 3 * 1.04 / 2**6
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
SUMS = ("n", "n_accepted", "n_confidence", "confidence_sum")


def sketches(pairs: DataFrame, by: list[str]) -> DataFrame:
    """A row per ``by``: counts, the sum of confidences, and sketches of confidences and of question keys.

    Null confidences and questions are counted as pairs alone. Sketches are merged before and after the shuffle, so a
    batch of any size is many tasks' work.
    """
    sure = F.col("confidence").cast("double")
    return pairs.groupBy(*by).agg(
        F.count("*").alias("n"), F.count_if(F.coalesce(F.col("accepted"), F.lit(False))).alias("n_accepted"), F.count(sure).alias("n_confidence"), F.coalesce(F.sum(sure), F.lit(0.0)).alias("confidence_sum"),
        F.kll_sketch_agg_double(sure, F.lit(KLL_K)).alias("confidences"), F.hll_sketch_agg(question_key(F.col("question")), F.lit(HLL_LOG)).alias("questions"),
    )


def merged(stored: DataFrame, by: list[str]) -> DataFrame:
    """Rows of ``sketches`` brought together, for fewer columns or none."""
    return stored.groupBy(*by).agg(*[F.sum(c).alias(c) for c in SUMS], F.kll_merge_agg_double("confidences").alias("confidences"), F.hll_union_agg("questions").alias("questions"))


def figures(stored: DataFrame, quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """What the sketches tell: acceptance, mean confidence, its ``quantiles`` (null without any), about how many different questions."""
    of = lambda q: F.when(F.col("n_confidence") > 0, F.kll_sketch_get_quantile_double("confidences", F.lit(float(q))))
    kept = [c for c in stored.columns if c not in (*SUMS, "confidences", "questions")]
    return stored.select(
        *kept, "n", "n_accepted", (F.col("n_accepted") / F.greatest(F.col("n"), F.lit(1))).alias("acceptance_rate"), (F.col("confidence_sum") / F.greatest(F.col("n_confidence"), F.lit(1))).alias("mean_confidence"),
        F.array(*[of(q) for q in quantiles]).alias("confidence_quantiles"), F.hll_sketch_estimate("questions").alias("n_questions"),
    )


def store(pairs: DataFrame, path: str, batch: str) -> dict:
    """Add the sketches of one batch to the table at ``path`` and return its counts, which are observed on the way, without a pass of their own.

    A batch that is stored again takes the place of the row before; the other batches are not touched.
    """
    seen = Observation()
    watched = pairs.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(F.col("accepted"), F.lit(False))).alias("n_accepted"))
    sketches(watched, []).write.mode("overwrite").parquet(f"{path}/batch={batch}")
    return seen.get


def stored(spark: SparkSession, path: str) -> DataFrame:
    """All batches of the table, by ``batch``, whose names are strings."""
    kind = "n long, n_accepted long, n_confidence long, confidence_sum double, confidences binary, questions binary, batch string"
    return spark.read.schema(kind).parquet(path) if exists(spark, path) else spark.createDataFrame([], kind)


def exact_ranks(pairs: DataFrame, found: DataFrame, by: list[str], quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """(by..., quantile, value, low, high): the shares of confidences below ``value``, and not above it, for the quantiles of ``figures``."""
    asked = found.select(*by, F.posexplode("confidence_quantiles").alias("k", "value")).withColumn("quantile", F.element_at(F.array(*[F.lit(float(q)) for q in quantiles]), F.col("k") + 1))
    sure = pairs.select(*by, F.col("confidence").cast("double").alias("c")).where("c IS NOT NULL").groupBy(*by, "c").agg(F.count("*").alias("m"))
    share = lambda when: F.sum(F.when(when, F.col("m")).otherwise(0)) / F.sum("m")
    met = asked.join(sure, by) if by else asked.crossJoin(sure)  # one row of figures
    return met.groupBy(*by, "quantile", "value").agg(share(F.col("c") < F.col("value")).alias("low"), share(F.col("c") <= F.col("value")).alias("high"))


def inside(low: Column, high: Column, quantile: Column) -> Column:
    """Whether a rank interval meets the quantile within the sketch's error."""
    return (low - RANK_ERROR <= quantile) & (high + RANK_ERROR >= quantile)
