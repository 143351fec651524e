"""How filters of documents interact: what each removes alone, after others, and in every order.

Words are exploded and aggregated, first by (document, word), then by document, which gives totals and distinct
counts. The other flags are outer-joined, and one aggregation counts documents by each of the 32 sets of filters
that a document can fail. Every figure of every order follows from these counts.

Filters fail a document as follows. A: fewer than 100 words. B: less than 80 % of the words are different.
C: more than 10 % of the characters are capital letters A to Z. D: a character of ``#$%&*|``. E: a smaller id has the
same text.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut, documents, mark, release

FILTERS = "ABCDE"
SETS = 1 << len(FILTERS)
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#$%&*|]"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
ORDERS = ["".join(p) for p in permutations(FILTERS)]


def word_totals(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(copy, first_id, n_words, n_distinct) of every different text: ``copy`` is its SHA-256, ``first_id`` the smallest id that has it.

    Texts are parted by digest once, after copies in a task were thinned, and both aggregations use that partitioning:
    words travel nowhere, and a text of very many copies is split once.
    """
    texts = docs.select(F.unhex(F.sha2(text, 256)).alias("copy"), F.col(key).alias("id"), F.col(text).alias("text")).groupBy("copy").agg(F.min("id").alias("first_id"), F.first("text").alias("text"))
    words = texts.select("copy", "first_id", F.explode_outer(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("word"))
    by_word = words.groupBy("copy", "first_id", "word").agg(F.count("word").alias("n"))
    return by_word.groupBy("copy", "first_id").agg(F.sum("n").alias("n_words"), F.count("word").alias("n_distinct"))


def failed_sets(docs: DataFrame, labels: DataFrame, part: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(part, good, toxic, n_0 ... n_31): documents by the set of filters that they fail; bit 0 is A.

    A null text is empty, a null ``part`` the empty string. Rows that repeat an id are documents of their own, and E
    fails none of them for the others' sake; a row without an id fails E nowhere and makes none fail. Labels of an id
    are taken together: good if any has quality 1, toxic if any has toxic 1. Other columns are not read.
    """
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    since = mark()
    totals = cut(word_totals(rows, "id", "text"), "word-totals")
    capitals = F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    flags = rows.select("id", "part", F.unhex(F.sha2("text", 256)).alias("copy"), (100 * capitals > MOST_CAPITALS * F.length("text")).alias("c"), F.col("text").rlike(SYMBOL).alias("d"))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    # copies were thinned before the digest parted them; here they are short rows of a plain join, which can be split
    known = flags.join(marks, "id", "left").join(totals, "copy", "left")
    fails = [F.col("n_words") < LEAST_WORDS, 100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words"), F.col("c"), F.col("d"), F.col("first_id") < F.col("id")]
    failed = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    counted = known.select("part", *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")], failed.alias("failed"))
    out = cut(counted.groupBy("part", "good", "toxic").agg(*[F.count_if(F.col("failed") == m).alias(f"n_{m}") for m in range(SETS)]), "failed-sets")
    release(docs.sparkSession, since, out)
    return out


def _bits(letters: Column) -> Column:
    return sum((F.when(F.contains(letters, F.lit(x)), 1 << i).otherwise(0) for i, x in enumerate(FILTERS)), F.lit(0))


def audit(sets: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the counts of ``failed_sets``: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``shapley`` sums what the step's filter removes, at any step, over all 120 orders: among k filters that a
    document fails each comes first in 120 / k of them. A part has its 600 rows whatever the counts.
    """
    each = [f"n_{m}" for m in range(SETS)]
    total = lambda when: F.array(*[F.sum(F.when(when, F.col(n)).otherwise(0)) for n in each])
    parts = sets.groupBy("part").agg(total(F.lit(True)).alias("n"), total(F.col("good")).alias("good"), total(F.col("toxic")).alias("toxic"))
    steps = parts.withColumn("filter_order", F.explode(F.split(F.lit(",".join(ORDERS)), ","))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    steps = steps.withColumns({"own": _bits(F.expr("substring(filter_order, step, 1)")), "before": _bits(F.expr("substring(filter_order, 1, step - 1)"))})

    def summed(counts: str, want, weight=lambda m: F.lit(1)) -> Column:
        return F.aggregate(F.transform(counts, lambda n, m: F.when(want(m), n * weight(m)).otherwise(0)), F.lit(0).cast("long"), lambda a, b: a + b)

    own, before = F.col("own"), F.col("before")
    fails, gone = lambda m: m.bitwiseAND(own) > 0, lambda m: m.bitwiseAND(before) > 0
    here = lambda m: fails(m) & ~gone(m)
    return steps.select(
        "part", "filter_order", "step", summed("n", lambda m: ~fails(m) & ~gone(m)).alias("kept"), summed("n", here).alias("removed"), summed("n", lambda m: fails(m) & gone(m)).alias("redundant"),
        summed("n", lambda m: m == own).alias("unique_fails"), summed("good", here).alias("good_lost"), summed("toxic", here).alias("toxic_lost"),
        summed("n", fails, lambda m: (F.lit(len(ORDERS)) / F.greatest(F.bit_count(m), F.lit(1))).cast("long")).alias("shapley"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interaction of five filters over all ``documents``, by language, order and step."""
    return audit(failed_sets(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), "lang"))


_SQL_ORDERS = "SELECT a || b || c || d || e AS filter_order FROM " + ", ".join(f"(SELECT unnest(string_split('{FILTERS}', '')) AS {x})" for x in "abcde") + " WHERE len(list_distinct([a, b, c, d, e])) = 5"
OP11_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{WORD}') AS words FROM d),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(words) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(t, '{SYMBOL}') THEN 'D' ELSE '' END
    || CASE WHEN first_id < doc_id THEN 'E' ELSE '' END AS fails
  FROM w LEFT JOIN l USING (doc_id)
),
counts AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails),
steps AS (SELECT filter_order, step, filter_order[step] AS own, substr(filter_order, 1, step - 1) AS before FROM ({_SQL_ORDERS}), (SELECT unnest(range(1, 6))::INT AS step)),
seen AS (SELECT c.*, s.*, contains(fails, own) AS here, len(list_intersect(string_split(fails, ''), string_split(before, ''))) > 0 AND fails <> '' AND before <> '' AS gone FROM counts c, steps s),
out AS (
  SELECT part, filter_order, step, own, sum(CASE WHEN NOT here AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN here AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN here AND gone THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN fails = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN here AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN here AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM seen GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM out
"""
