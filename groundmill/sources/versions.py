"""Versions of captured runs: what is written says which it is, and older ones are lifted, one version at a time, when read.

    1  no ``schema_version``: generation.qa_pairs and verifications, side by side, which their positions join
    2  ``items``: each pair with its verdict, which is null where none was captured
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import PAIR, VERDICT

CURRENT = 2
ITEM = f"struct<pair: {PAIR}, verdict: {VERDICT}>"
ANY = f"chunk_id string, schema_version int, generation struct<qa_pairs: array<{PAIR}>>, verifications array<{VERDICT}>, items array<{ITEM}>"


def _from_1(rows: DataFrame) -> DataFrame:
    """Pairs with the verdicts of their positions; verdicts beyond the last pair belong to none and are left out."""
    pairs = F.coalesce("generation.qa_pairs", F.expr(f"cast(array() as array<{PAIR}>)"))
    item = F.transform(pairs, lambda p, i: F.struct(p.alias("pair"), F.get("verifications", i).alias("verdict")))
    return rows.withColumns({"items": F.when(F.col("schema_version") == 1, item).otherwise(F.col("items")), "schema_version": F.when(F.col("schema_version") == 1, 2).otherwise(F.col("schema_version"))})


#: What lifts a version to the next one, in order; each leaves rows of other versions as they are.
LIFTS = [_from_1]


def write_versioned(runs: DataFrame, path: str) -> None:
    """JSON lines of the current version from (chunk_id, items)."""
    runs.select("chunk_id", F.lit(CURRENT).alias("schema_version"), "items").write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def lifted(rows: DataFrame) -> DataFrame:
    """(chunk_id, items) of runs of any known version, whose rows have the columns of ``ANY``. A version that is not known, such as a later one, ends the run."""
    out = rows.withColumn("schema_version", F.coalesce("schema_version", F.lit(1)))
    for lift in LIFTS:
        out = lift(out)
    known = F.when(F.col("schema_version") == CURRENT, F.coalesce("items", F.expr(f"cast(array() as array<{ITEM}>)"))).otherwise(F.raise_error(F.concat(F.lit("captured run of schema version "), F.col("schema_version").cast("string"))))
    return out.select("chunk_id", known.alias("items"))


def read_versioned(spark: SparkSession, path: str) -> DataFrame:
    """(chunk_id, items) of JSON lines that runs of any version left in ``path``."""
    return lifted(spark.read.schema(ANY).option("mode", "FAILFAST").json(path))


def side_by_side(runs: DataFrame) -> DataFrame:
    """(chunk_id, qa_pairs, verifications) as a replay takes them; a pair without a verdict has a null one."""
    return runs.select("chunk_id", F.transform("items", lambda i: i["pair"]).alias("qa_pairs"), F.transform("items", lambda i: i["verdict"]).alias("verifications"))
