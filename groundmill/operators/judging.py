"""Acceptance, rejects, duplicates and statistics of judged pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundmill.config import Config
from groundmill.functions.text import fold, question_key, stable_id

from .snap import snap

NOT_VERBATIM = "source_passage not a single contiguous verbatim span"
REJECT_COLUMNS = ["chunk_id", "question", "answer", "question_type", "verdict", "passage_in_chunk", "token_overlap", "missing_numbers", "reason"]
DATASET_COLUMNS = ["id", "question", "answer", "source_passage", "question_type", "difficulty", "section", "company", "ticker", "fiscal_year", "accession", "chunk_id", "verdict", "verifier_confidence", "grounding_overlap", "source_verbatim"]


def is_accepted(cfg: Config) -> Column:
    return F.col("passed") & F.coalesce(F.col("verdict").isin(*cfg.accept_verdicts), F.lit(False))


def verbatim(passage: Column, chunk: Column) -> Column:
    """Whether the folded passage is in the folded chunk; an empty one is in any."""
    return F.contains(fold(F.coalesce(chunk, F.lit(""))), fold(F.coalesce(passage, F.lit(""))))


def decide(judged: DataFrame, cfg: Config, fuzzy: bool = True) -> DataFrame:
    """Add accepted, source_verbatim, final_passage and reject_reason to grounded pairs with a verdict.

    Only pairs that pass both gates are aligned to their chunk. Without ``fuzzy`` that is one pass over the pairs.
    """
    gated = judged.withColumn("_ok", is_accepted(cfg))
    if not fuzzy:
        final = F.when(F.col("_ok"), F.col("snapped_passage")).otherwise(F.col("source_passage"))
        out = snap(gated, fuzzy).withColumns({"final_passage": final, "source_verbatim": F.when(F.col("_ok"), verbatim(F.col("snapped_passage"), F.col("chunk_text"))).otherwise(False)}).drop("snapped_passage", "snapped")
        return _reasoned(out, cfg)
    good = snap(gated.where("_ok"), fuzzy).withColumn("source_verbatim", verbatim(F.col("snapped_passage"), F.col("chunk_text"))).withColumnRenamed("snapped_passage", "final_passage").drop("snapped")
    bad = gated.where("NOT _ok").withColumns({"final_passage": F.col("source_passage"), "source_verbatim": F.lit(False)})
    return _reasoned(good.unionByName(bad), cfg)


def _reasoned(aligned: DataFrame, cfg: Config) -> DataFrame:
    out = aligned.withColumn("accepted", F.col("_ok") & (F.col("source_verbatim") | F.lit(not cfg.require_verbatim_source)))
    return out.withColumn("reject_reason", F.when(F.col("accepted"), F.lit(None).cast("string")).when(F.col("_ok"), NOT_VERBATIM).otherwise(F.col("reasoning"))).drop("_ok")


def accepted_rows(decided: DataFrame) -> DataFrame:
    return decided.where("accepted").withColumns({
        "id": stable_id(F.col("chunk_id"), F.col("question")),
        "source_passage": F.col("final_passage"),
        "grounding_overlap": F.when(F.col("source_verbatim"), F.lit(1.0)).otherwise(F.col("token_overlap")),
        "verifier_confidence": F.col("confidence"),
    })


def rejected_rows(decided: DataFrame) -> DataFrame:
    return decided.where("NOT accepted").withColumn("reason", F.col("reject_reason")).select(*REJECT_COLUMNS)


def dataset_rows(accepted: DataFrame) -> DataFrame:
    rounded = {c: F.round(c, 3) for c in ("verifier_confidence", "grounding_overlap")}
    return accepted.withColumns(rounded).withColumn("section", F.col("section_name")).select(*DATASET_COLUMNS)


def ranked_duplicates(pairs: DataFrame, order: list[str], scope: list[str] | None = None) -> DataFrame:
    """Add question_key and ``keep_rank``: 1 is the pair that stays. The surer one wins, then more overlap, then the earlier.

    Candidates for the place are first thinned inside salted parts of a key, so that one very common key (all words
    left out) does not meet in one task.
    """
    by = [*(scope or []), "question_key"]
    best = [F.desc_nulls_last("verifier_confidence"), F.desc_nulls_last("grounding_overlap"), *order]
    keyed = pairs.withColumn("question_key", question_key(F.col("question"))).withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(32)))
    inside = keyed.withColumn("_first", F.row_number().over(Window.partitionBy(*by, "_salt").orderBy(*best)))
    winners = inside.where("_first = 1").withColumn("keep_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*best)))
    losers = inside.where("_first > 1").withColumn("keep_rank", F.lit(2))
    return winners.unionByName(losers).drop("_salt", "_first")


def dedupe(pairs: DataFrame, order: list[str], scope: list[str] | None = None) -> DataFrame:
    return ranked_duplicates(pairs, order, scope).where("keep_rank = 1").drop("keep_rank", "question_key")


def stats(accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row: counts, rates and maps of counts. The rate leaves out duplicates, which are in neither table."""
    return _record(_cells(accepted.withColumns({"kept": F.lit(True), "lost": F.lit(False)})).unionByName(_cells(_bare(rejected).withColumns({"kept": F.lit(False), "lost": F.lit(True)}))))


def stats_of(decided: DataFrame, order: list[str], scope: list[str] | None = None) -> DataFrame:
    """The row of ``stats`` from all decisions at once, so that they are computed once."""
    best = [F.desc_nulls_last("confidence"), F.desc_nulls_last("grounding_overlap"), *order]
    by = [*(scope or []), "question_key"]
    rows = decided.withColumns({
        "grounding_overlap": F.when(F.col("source_verbatim"), F.lit(1.0)).otherwise(F.col("token_overlap")),
        "verifier_confidence": F.col("confidence"), "question_key": question_key(F.col("question")),
        # rejected pairs meet nothing: each is spread by its own hash
        "part": F.when(F.col("accepted"), F.pmod(F.xxhash64(*order), F.lit(32))).otherwise(F.xxhash64(*order)),
    })
    inside = rows.withColumn("first", F.row_number().over(Window.partitionBy(*by, "accepted", "part").orderBy(*best)))
    few = inside.withColumn("spread", F.when(F.col("accepted") & (F.col("first") == 1), F.lit(0)).otherwise(F.xxhash64(*order)))
    ranked = few.withColumn("place", F.row_number().over(Window.partitionBy(*by, "spread", "accepted").orderBy(*best)))
    return _record(_cells(ranked.withColumns({"kept": F.col("accepted") & (F.col("first") == 1) & (F.col("place") == 1), "lost": ~F.col("accepted")})))


def _bare(rejected: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    return rejected.select(none.alias("question_type"), none.alias("difficulty"), none.alias("section_name"), F.lit(0.0).alias("verifier_confidence"), F.lit(False).alias("source_verbatim"))


def _cells(rows: DataFrame) -> DataFrame:
    """Counts of kept and lost pairs by type, difficulty and section: few rows, from which all figures follow."""
    kept = lambda c: F.sum(F.when(F.col("kept"), c))
    return rows.groupBy("question_type", "difficulty", "section_name").agg(
        F.count_if("kept").alias("n"), F.count_if("lost").alias("n_lost"), kept(F.col("verifier_confidence")).alias("m"), kept(F.col("source_verbatim").cast("long")).alias("v")
    )


def _record(cells: DataFrame) -> DataFrame:
    names = ("question_type", "difficulty", "section_name")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    sets = cells.groupingSets([[], *[[n] for n in names]], *names).agg(total("n").alias("n"), total("n_lost").alias("lost"), F.coalesce(F.sum("m"), F.lit(0.0)).alias("m"), total("v").alias("v"), F.grouping_id().alias("g"))
    entry = lambda name: F.when(F.col("n") > 0, F.struct(F.coalesce(name, F.lit("")).alias("name"), "n"))
    maps = [F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("g") == g, entry(F.col(n)))))).alias(a) for g, n, a in ((3, "question_type", "by_question_type"), (5, "difficulty", "by_difficulty"), (6, "section_name", "by_section"))]
    whole = lambda c: F.coalesce(F.max(F.when(F.col("g") == 7, F.col(c))), F.lit(0))
    one = sets.agg(whole("n").alias("n_accepted"), whole("lost").alias("n_rejected"), whole("m").alias("m"), whole("v").alias("v"), *maps)
    rate = F.round(F.col("n_accepted") / F.greatest(F.lit(1), F.col("n_accepted") + F.col("n_rejected")), 3)
    mean = F.round(F.col("m") / F.greatest(F.lit(1), F.col("n_accepted")), 3)
    return one.select("n_accepted", "n_rejected", rate.alias("acceptance_rate"), "by_question_type", "by_difficulty", "by_section", mean.alias("mean_verifier_confidence"), F.round(100 * F.col("v") / F.greatest(F.lit(1), F.col("n_accepted")), 1).alias("pct_exact_passage_match"))
