"""Generated pairs: from JSON to rows, malformed ones apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .prompts import DIFFICULTIES, TYPES, VERDICTS

REQUIRED = ("question", "answer", "source_passage", "question_type", "difficulty")


def _text(pair: Column, name: str) -> Column:
    """A member that is a JSON string; anything else, numbers too, is null."""
    value = F.try_variant_get(pair, f"$.{name}", "variant")
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(pair, f"$.{name}", "string"))


def explode_pairs(generations: DataFrame, response: str = "response") -> DataFrame:
    """One row per element of ``qa_pairs`` with its position (``raw_pos``); no such member, no rows. ``valid`` says that it fits the schema."""
    listed = F.try_variant_get(F.try_parse_json(F.col(response)), "$.qa_pairs", "array<variant>")
    out = generations.withColumn("_pairs", listed).select(*[c for c in generations.columns if c != response], F.posexplode("_pairs").alias("raw_pos", "_pair"))
    out = out.withColumns({c: _text(F.col("_pair"), c) for c in (*REQUIRED, "rationale")})
    rationale = F.try_variant_get("_pair", "$.rationale", "variant")
    optional = rationale.isNull() | F.schema_of_variant(rationale).isin("STRING", "VOID")
    return out.withColumn("valid", valid_pair() & F.coalesce(optional, F.lit(True))).drop("_pair")


def valid_pair() -> Column:
    """Required texts are there and the two labels are of their lists."""
    present = F.lit(True)
    for c in REQUIRED:
        present = present & F.col(c).isNotNull()
    return present & F.coalesce(F.col("question_type").isin(*TYPES) & F.col("difficulty").isin(*DIFFICULTIES), F.lit(False))


def index_pairs(pairs: DataFrame, by: list[str], dense: bool = False) -> DataFrame:
    """Valid pairs with ``pair_idx``: their position in the generation, or with ``dense`` among the valid ones."""
    good = pairs.where("valid")
    if dense:
        return good.withColumn("pair_idx", F.row_number().over(Window.partitionBy(*by).orderBy("raw_pos")) - 1)
    return good.withColumn("pair_idx", F.col("raw_pos"))


def valid_verdict() -> Column:
    return F.coalesce(F.col("verdict").isin(*VERDICTS) & F.col("confidence").between(0.0, 1.0) & F.col("reasoning").isNotNull(), F.lit(False))


def checked_verdicts(verdicts: DataFrame, strict: bool = True) -> DataFrame:
    """Verdicts that fit the schema. With ``strict`` a wrong one ends the run, else it is left out."""
    if not strict:
        return verdicts.where(valid_verdict())
    wrong = F.raise_error(F.concat(F.lit("verdict out of range: "), F.coalesce(F.col("verdict"), F.lit("null")))).cast("boolean")
    return verdicts.where(F.when(valid_verdict(), F.lit(True)).otherwise(wrong))
