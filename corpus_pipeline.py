"""Corpus pipeline over ``documents``: filter, deduplicate, sanitise, mix, pack.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet and read again as the
next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundmill.llm.minhash import keep_one
from groundmill.llm.mixing import mix, token_count
from groundmill.llm.packing import pack
from groundmill.llm.pii import sanitise
from groundmill.llm.shared import cut, documents
from groundmill.llm.toxicity import THRESHOLD, fit, score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar does not reject; it is fitted on the labels outside the held-out fold."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(docs.select(*COLUMNS), model, score="_score").where(F.col("_score") < THRESHOLD).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return keep_one(docs.select(*COLUMNS))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and terms that give it away replaced."""
    return sanitise(docs.select(*COLUMNS)).withColumn("text", F.col("sanitised")).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at the target weights of domains, languages and sources, repeated where a leaf reads more than one epoch."""
    return mix(docs.select(*COLUMNS))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in length buckets and batches."""
    return pack(docs.select("doc_id", token_count(F.col("text")).alias("n_tokens")), "doc_id", "n_tokens")


STAGES = [("toxicity", toxicity), ("minhash_near_dedup", near_dedup), ("pii", personal_data), ("mixing", mixing), ("packing", packing)]
#: Training, sketches and the dynamic program are not SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each but the last is written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs, f"pipeline-{name}")
    return docs
