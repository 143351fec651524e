"""Local files: reports, captured runs, JSON and JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PAIR = "struct<question: string, answer: string, source_passage: string, question_type: string, difficulty: string, rationale: string>"
VERDICT = "struct<verdict: string, confidence: double, answer_is_correct: boolean, passage_supports_answer: boolean, reasoning: string>"
CAPTURE = f"chunk_id string, generation struct<qa_pairs: array<{PAIR}>>, verifications array<{VERDICT}>"


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of files, byte for byte."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """(chunk_id, qa_pairs, verifications) of captured runs; of several files of a chunk the last by name counts.

    Files hold one run each, however it is laid out; those that Spark wrote hold one run per line.
    """
    named = lambda r: r.json(path).withColumn("_file", F.col("_metadata.file_name"))
    single = named(spark.read.schema(CAPTURE).option("multiLine", True)).where("NOT startswith(_file, 'part-')")
    raw = single.unionByName(named(spark.read.schema(CAPTURE)).where("startswith(_file, 'part-')"))
    last = raw.withColumn("_n", F.row_number().over(Window.partitionBy("chunk_id").orderBy(F.desc("_file")))).where("_n = 1")
    pairs = F.coalesce("generation.qa_pairs", F.expr(f"cast(array() as array<{PAIR}>)"))
    return last.select("chunk_id", pairs.alias("qa_pairs"), F.coalesce("verifications", F.expr(f"cast(array() as array<{VERDICT}>)")).alias("verifications"))


def read_raw_captures(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(generations, verifications) from files gen_<chunk>.json and verify_<chunk>.json.

    The chunk is the one in the file's name. A generation that cannot be read is left out; a verification that
    cannot be read is there, but empty.
    """
    read = lambda kind, body: (
        spark.read.schema(f"{body}, _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE").option("pathGlobFilter", f"{kind}_*.json").json(path)
        .withColumn("chunk_id", F.regexp_extract(F.col("_metadata.file_name"), rf"^{kind}_(.*)\.json$", 1))
    )
    gen = read("gen", f"generation struct<qa_pairs: array<{PAIR}>>").where("_corrupt_record IS NULL")
    ver = read("verify", "verifications array<struct<verdict: string, confidence: double, reasoning: string>>")
    return gen.select("chunk_id", F.col("generation.qa_pairs").alias("qa_pairs")), ver.select("chunk_id", "verifications")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines; empty lines are skipped, a line that cannot be read ends the run."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
