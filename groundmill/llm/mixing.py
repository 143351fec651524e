"""Mixing of sources to target weights in a domain-language-source tree.

A budget of tokens flows from the root to the leaves. At each node the children share it in proportion to
their weights, and none takes more than its leaves can give in ``max_epochs`` passes. What a short child
leaves goes to its siblings first; only where all of them are full does the parent take less, which its own
siblings then get. Each leaf reads whole epochs, every one in an order of its own seed, and of the last one
the prefix that its share still needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .ordering import seeded_hash, sums_before
from .shared import cut, documents

LEVELS = ("domain", "lang", "source")
WORDS = r"[\x20\x09-\x0D]+"
SEED = "17"
#: Weights of nodes by level and name; all others weigh 1.
WEIGHTS = {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}}
MAX_EPOCHS = 4
PERCENT = 60  # of the tokens at hand


def token_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), WORDS), "")).cast("long")


def domain_of(source: Column) -> Column:
    """The domain that a source belongs to: its number by four."""
    return F.coalesce(F.concat(F.lit("d"), (F.try_element_at(F.regexp_extract_all(source, F.lit("[0-9]+"), F.lit(0)), F.lit(1)).cast("long") % 4).cast("string")), F.lit("d3"))


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    out = F.lit(1)
    for name, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, w).otherwise(out)
    return out.cast("long")


def allocate(leaves: DataFrame, levels: list[str], budget: int, weights: dict[str, dict[str, int]], max_epochs: int) -> DataFrame:
    """Add ``share``, in tokens, to the leaves (levels..., supply)."""
    shared = leaves.withColumn("cap", F.col("supply") * max_epochs).withColumn("share", F.lit(budget).cast("long"))
    for i, level in enumerate(levels):
        above, here = list(levels[:i]), list(levels[: i + 1])
        nodes = shared.groupBy(*here).agg(F.sum("cap").alias("_cap"), F.max("share").alias("_given")).withColumn("_w", _weight(level, weights))
        order = Window.partitionBy(*above).orderBy(F.col("_cap") / F.col("_w"), level)
        nodes = nodes.withColumn("_rest", F.col("_given") - F.sum("_cap").over(order) + F.col("_cap"))
        nodes = nodes.withColumn("_open", F.sum("_w").over(Window.partitionBy(*above)) - F.sum("_w").over(order) + F.col("_w"))
        # full while an even share of what is left reaches the cap; the first node that is not full fixes the rate
        nodes = nodes.withColumn("_full", F.col("_rest") * F.col("_w") >= F.col("_cap") * F.col("_open"))
        first = F.min(F.when(~F.col("_full"), F.struct((F.col("_cap") / F.col("_w")).alias("r"), F.col(level).alias("n"), F.col("_rest").alias("rest"), F.col("_open").alias("open")))).over(Window.partitionBy(*above))
        nodes = nodes.withColumn("_first", first)
        # of the rest each node takes what its weights and those before it come to, less what those before it took, so that no token is lost
        nodes = nodes.withColumn("_upto", F.col("_first.open") - F.col("_open") + F.col("_w"))
        part = F.expr("(_first.rest * _upto) div _first.open - (_first.rest * (_upto - _w)) div _first.open")
        nodes = nodes.withColumn("_share", F.when(F.col("_full"), F.col("_cap")).otherwise(part))
        shared = shared.join(nodes.select(*here, "_share"), here).withColumn("share", F.col("_share")).drop("_share")
    return shared.drop("cap")


def mixing_plan(docs: DataFrame, key: str, text: str, weights: dict[str, dict[str, int]] = WEIGHTS, percent: int = PERCENT, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, repeats, taken) for each row of ``docs`` that is chosen.

    ``repeats`` counts the epochs that a row is in and ``taken`` its tokens in them: the last row of a prefix may
    be in it only in part. Null languages and sources are leaves of their own, named "(none)". Texts without
    words, null ones too, hold nothing to choose and are left out; so is everything if no row has words.
    Rows that repeat an id are rows of their own here.
    """
    source = F.coalesce(F.col("source"), F.lit("(none)"))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), domain_of(source).alias("domain"), F.coalesce(F.col("lang"), F.lit("(none)")).alias("lang"), source.alias("source"), token_count(F.col(text)).alias("n_tokens"))
    rows = cut(rows.where("n_tokens > 0"), "rows")
    levels = list(LEVELS)
    leaves = cut(rows.groupBy(*levels).agg(F.sum("n_tokens").alias("supply"), F.count("*").alias("rows")), "leaves")
    total = leaves.agg(F.coalesce(F.sum("supply"), F.lit(0)).alias("t"), F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()
    shares = allocate(leaves.drop("rows"), levels, total["t"] * percent // 100, weights, max_epochs)
    shares = cut(shares.select(*levels, F.expr("share div supply").alias("full"), (F.col("share") % F.col("supply")).alias("prefix")), "shares")
    ordered = rows.join(shares, levels).withColumn("_h", seeded_hash(seed, F.col("full"), F.col("doc_id")))
    placed = sums_before(cut(ordered, "ordered"), levels, ["_h", "doc_id", "n_tokens"], "n_tokens", "before", total["n"])
    part = F.greatest(F.lit(0), F.least("n_tokens", F.col("prefix") - F.col("before")))
    chosen = placed.select("doc_id", *levels, "n_tokens", (F.col("full") + (F.col("before") < F.col("prefix")).cast("long")).alias("repeats"), (F.col("full") * F.col("n_tokens") + part).alias("taken"))
    return chosen.where("repeats > 0")


def _first_words(text: Column, n: Column) -> Column:
    """The text up to the end of word ``n``."""
    parts = F.regexp_extract_all(text, F.lit(r"^[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    led = text.rlike(r"^[\x20\x09-\x0D]").cast("long")
    return F.regexp_replace(F.array_join(F.slice(parts, F.lit(1), (n + led).cast("int")), ""), r"[\x20\x09-\x0D]+$", "")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with each chosen row as often as its epochs say; columns stay as they are.

    In the last epoch of a leaf its last row holds the prefix that the plan takes of it: ``text`` ends after so many
    words, and a column ``n_chars`` has the prefix's length. Rows that repeat an id, or have none, follow the
    plan of the most repeated one.
    """
    best = F.max(F.struct("repeats", "taken", "n_tokens"))
    plan = cut(mixing_plan(docs, key, text, **options).groupBy("doc_id").agg(best.alias("plan")).select("doc_id", "plan.*"), "plan")
    # a caller's columns travel as one, so that no name of this function can clash with theirs
    rows = docs.select(F.struct("*").alias("row"), F.col(key).cast("long").alias("id"))
    out = rows.join(plan, F.col("id").eqNullSafe(F.col("doc_id"))).withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("repeats"))))
    left = F.col("taken") - (F.col("repeats") - 1) * F.col("n_tokens")
    cut_off = (F.col("epoch") == F.col("repeats")) & (left < F.col("n_tokens"))
    own = F.col("row").getField(text)
    short = F.when(cut_off, _first_words(own, left)).otherwise(own)
    row = F.col("row").withField(f"`{text}`", short)
    if "n_chars" in docs.columns and text != "n_chars":
        row = row.withField("n_chars", F.when(cut_off, F.length(short).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars")))
    return out.select(row.alias("row")).select("row.*")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixing plan over every row of ``documents``."""
    return mixing_plan(documents(spark, sf_dir), "doc_id", "text")


def _sql_level(i: int) -> str:
    """One level of the tree: shares of its nodes from the shares of their parents."""
    level, above, here = LEVELS[i], ", ".join(LEVELS[:i]), ", ".join(LEVELS[: i + 1])
    weight = "CASE " + " ".join(f"WHEN {level} = '{n}' THEN {w}" for n, w in WEIGHTS[level].items()) + " ELSE 1 END" if level in WEIGHTS else "1"
    by = f"PARTITION BY {above} " if above else ""
    parent = f"JOIN l{i - 1} USING ({above})" if above else "CROSS JOIN (SELECT budget AS share FROM total)"
    return f"""
n{i} AS (SELECT {here}, c, {weight} AS w, share AS given FROM (SELECT {here}, sum(supply)::BIGINT * {MAX_EPOCHS} AS c FROM leaves GROUP BY {here}) {parent}),
m{i} AS (SELECT *, given - sum(c) OVER o + c AS rest, sum(w) OVER ({by}) - sum(w) OVER o + w AS open FROM n{i} WINDOW o AS ({by}ORDER BY c / w, {level} ROWS UNBOUNDED PRECEDING)),
f{i} AS (SELECT *, rest * w >= c * open AS is_full FROM m{i}),
g{i} AS (SELECT *, first_value(rest) OVER q AS r0, first_value(open) OVER q AS o0 FROM f{i} WINDOW q AS ({by}ORDER BY is_full, c / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
l{i} AS (SELECT {here}, CASE WHEN is_full THEN c ELSE (r0 * (o0 - open + w)) // o0 - (r0 * (o0 - open)) // o0 END AS share FROM g{i})"""


OP3_SQL = f"""
WITH rows0 AS (
  SELECT doc_id, coalesce('d' || (CAST(nullif(regexp_extract(source, '[0-9]+'), '') AS BIGINT) % 4), 'd3') AS domain, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS n_tokens
  FROM documents
),
rows1 AS (SELECT * FROM rows0 WHERE n_tokens > 0),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS supply FROM rows1 GROUP BY ALL),
total AS (SELECT sum(supply)::BIGINT * {PERCENT} // 100 AS budget FROM leaves),{",".join(_sql_level(i) for i in range(3))},
shares AS (SELECT domain, lang, source, share // supply AS whole, share % supply AS prefix FROM l2 JOIN leaves USING (domain, lang, source)),
ordered AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY CAST('0x' || substr(md5('{SEED}:' || CAST(whole AS BIGINT) || ':' || doc_id), 1, 15) AS BIGINT), doc_id, n_tokens ROWS UNBOUNDED PRECEDING) - n_tokens AS before
  FROM rows1 JOIN shares USING (domain, lang, source)
)
SELECT doc_id, domain, lang, source, n_tokens::BIGINT AS n_tokens, (whole + (before < prefix)::INT)::BIGINT AS repeats,
  (whole * n_tokens + greatest(0, least(n_tokens, prefix - before)))::BIGINT AS taken
FROM ordered WHERE whole + (before < prefix)::INT > 0
"""
