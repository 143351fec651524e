"""Captured generations joined with captured verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAD_REASON = "missing verification"


def pad_verdicts(verdicts: Column, pairs: Column) -> Column:
    """As many verdicts as pairs: surplus ones cut, missing ones NOT_SUPPORTED."""
    pad = F.struct(F.lit("NOT_SUPPORTED").alias("verdict"), F.lit(0.0).alias("confidence"), F.lit(PAD_REASON).alias("reasoning"))
    have = F.coalesce(verdicts, F.expr("cast(array() as array<struct<verdict: string, confidence: double, reasoning: string>>)"))
    return F.slice(F.concat(have, F.array_repeat(pad, F.greatest(F.lit(0), F.size(pairs) - F.size(have)))), F.lit(1), F.size(pairs))


def merge_captures(generations: DataFrame, verifications: DataFrame) -> DataFrame:
    """(chunk_id, qa_pairs, verifications, missing) for generations (chunk_id, qa_pairs), with verdicts by position.

    ``missing`` says that there is no verification at all. Verifications without a generation are left out.
    """
    seen = verifications.select("chunk_id", "verifications", F.lit(True).alias("_seen"))
    joined = generations.join(seen, "chunk_id", "left").withColumn("qa_pairs", F.coalesce("qa_pairs", F.array().cast(generations.schema["qa_pairs"].dataType)))
    return joined.select("chunk_id", "qa_pairs", pad_verdicts(F.col("verifications"), F.col("qa_pairs")).alias("verifications"), F.col("_seen").isNull().alias("missing"))


def merge_summary(merged: DataFrame) -> DataFrame:
    total = lambda c: F.coalesce(F.sum(F.size(c)), F.lit(0)).cast("long")
    return merged.agg(F.count("*").alias("chunks_merged"), total("qa_pairs").alias("total_pairs"), total("verifications").alias("total_verifications"), F.coalesce(F.sum(F.col("missing").cast("long")), F.lit(0)).alias("chunks_missing_verification"))
