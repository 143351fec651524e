"""Inputs that the test tables stand in for, built by Spark, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Label of a row by remainders of its numbers; confidences are exact binary fractions.
TYPES = ("fact_extraction", "numeric_calculation", "comparison", "multi_step_reasoning")
LEVELS = ("easy", "medium", "hard")


#: Tables whose rows are long texts, so that a row is dear to work on.
TEXTS = ("documents", "pages", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; texts that come in fewer splits than there are cores are dealt out, since each split is one task's work."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if name in TEXTS and df.rdd.getNumPartitions() < cores else df


def pick(names: tuple[str, ...], n):
    """The name whose place is ``n`` modulo their number."""
    return F.element_at(F.array(*[F.lit(x) for x in names]), (n % len(names) + 1).cast("int"))


def sql_pick(names: tuple[str, ...], n: str) -> str:
    return f"list_extract([{', '.join(repr(x) for x in names)}], CAST(({n}) % {len(names)} + 1 AS INT))"


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question and answer pairs from conversations: a user turn and the assistant's next; the chunk is the whole conversation.

    The quote is the answer's first line, in upper case for every fifth pair and foreign for every seventh. Verdicts
    come from labels; those without one have none. Every third question is asked again by the next pair.
    """
    turns = table(spark, sf_dir, "conversations")
    user = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("asked"))
    answer = turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    chunk = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t")).select("conv_id", F.array_join(F.transform("t", lambda x: x["text"]), "\n").alias("chunk_text"))
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality")).withColumnRenamed("doc_id", "conv_id")
    pairs = user.join(answer, ["conv_id", "turn"]).join(chunk, "conv_id").join(labels, "conv_id", "left")
    n = F.col("conv_id") * 7 + F.col("turn")
    line = F.substring_index("answer", "\n", 1)
    quote = F.when(n % 7 == 3, F.concat(F.lit("Wholly foreign words stand here and "), F.substring(line, 1, 12))).when(n % 5 == 2, F.upper(F.replace(line, F.lit("ß"), F.lit("s")))).otherwise(line)
    verdict = F.when(F.col("toxic") == 1, "NOT_SUPPORTED").when((F.col("quality") == 0) | (n % 11 == 5), "PARTIAL").when(F.col("toxic").isNotNull() | (n % 3 > 0), "SUPPORTED")
    question = F.when(n % 3 == 0, F.concat(F.lit("What is the "), F.substring("asked", 1, 9))).otherwise(F.col("asked"))
    return pairs.select(
        F.col("conv_id").alias("doc_id"), F.lit(0).alias("chunk_ord"), F.col("turn").alias("pair_idx"), question.alias("question"), "answer", quote.alias("source_passage"), "chunk_text",
        pick(TYPES, n).alias("question_type"), pick(LEVELS, n).alias("difficulty"), verdict.alias("verdict"), ((n * 5 % 65) / 64).alias("confidence"), F.concat(F.lit("note "), n.cast("string")).alias("reasoning"),
        F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("chunk_id"), (F.col("conv_id") % 5).cast("string").alias("section_item"), F.concat(F.lit("Section "), (F.col("conv_id") % 5).cast("string")).alias("section_name"),
    )


CANDIDATES = f"""cand0 AS (
  SELECT u.conv_id, u.turn, u.text AS asked, a.text AS answer, u.conv_id * 7 + u.turn AS n, string_split(a.text, chr(10))[1] AS line, c.chunk_text, l.toxic, l.quality
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND u.role = 'user' AND a.role = 'assistant'
  JOIN (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn, text) AS chunk_text FROM conversations GROUP BY conv_id) c ON c.conv_id = u.conv_id
  LEFT JOIN (SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality FROM labels GROUP BY doc_id) l ON l.doc_id = u.conv_id
), cand AS (
  SELECT conv_id AS doc_id, 0 AS chunk_ord, turn AS pair_idx, CASE WHEN n % 3 = 0 THEN 'What is the ' || substr(asked, 1, 9) ELSE asked END AS question, answer,
    CASE WHEN n % 7 = 3 THEN 'Wholly foreign words stand here and ' || substr(line, 1, 12) WHEN n % 5 = 2 THEN upper(replace(line, 'ß', 's')) ELSE line END AS source_passage, chunk_text,
    {sql_pick(TYPES, "n")} AS question_type, {sql_pick(LEVELS, "n")} AS difficulty,
    CASE WHEN toxic = 1 THEN 'NOT_SUPPORTED' WHEN quality = 0 OR n % 11 = 5 THEN 'PARTIAL' WHEN toxic IS NOT NULL OR n % 3 > 0 THEN 'SUPPORTED' END AS verdict,
    (n * 5 % 65) / 64 AS confidence, 'note ' || n AS reasoning, 'c' || conv_id AS chunk_id, (conv_id % 5)::VARCHAR AS section_item, 'Section ' || (conv_id % 5) AS section_name
  FROM cand0
)"""


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports made of seven documents each: contents rows, headings, page footers, empty lines between paragraphs."""
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL").select((F.expr("doc_id div 7")).alias("doc_id"), (F.col("doc_id") % 7).alias("part"), F.col("text"))
    items = ("1", "1A", "4", "7", "9C", "8", "1a")
    name = pick(items, F.col("part"))
    head = F.concat(F.lit("Item "), name, F.when(F.col("part") == 3, ".\n").otherwise(". "), F.lit("Part "), F.col("part").cast("string"), F.lit(" of it\n"))
    foot = F.lit("\nSome Company | 2024 Form 10-K | 12\n\n\n")
    d = d.withColumn("body", F.concat(F.when(F.col("part") == 1, F.lit("")).otherwise(head), F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n")), foot))
    grouped = d.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("part", "body"))).alias("p"))
    return grouped.select("doc_id", F.concat(F.lit("Cover\nItem 1. | Business | 3\nItem 7. | Discussion | 9\n"), F.array_join(F.transform("p", lambda x: x["body"]), "")).alias("text"))


FILINGS = """parts AS (
  SELECT doc_id // 7 AS doc_id, doc_id % 7 AS part, text FROM documents WHERE text IS NOT NULL
), filings AS (
  SELECT doc_id, 'Cover' || chr(10) || 'Item 1. | Business | 3' || chr(10) || 'Item 7. | Discussion | 9' || chr(10) || string_agg(
    CASE WHEN part = 1 THEN '' ELSE 'Item ' || list_extract(['1', '1A', '4', '7', '9C', '8', '1a'], CAST(part + 1 AS INT)) || CASE WHEN part = 3 THEN '.' || chr(10) ELSE '. ' END || 'Part ' || part || ' of it' || chr(10) END
    || replace(text, chr(10), chr(10) || chr(10)) || chr(10) || 'Some Company | 2024 Form 10-K | 12' || chr(10) || chr(10) || chr(10), '' ORDER BY part, text) AS text
  FROM parts GROUP BY doc_id
)"""
