"""The whole plan: chunks, candidates, grounding, verdicts, decision, duplicates, outputs."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundmill.config import Config
from groundmill.operators.chunks import chunk_documents, first_chunks
from groundmill.operators.completion import Client, Limits, complete_cached, replay
from groundmill.operators.grounding import ground
from groundmill.operators.html import decode, parse_html
from groundmill.operators.judging import accepted_rows, decide, dedupe, rejected_rows
from groundmill.operators.pairs import checked_verdicts, explode_pairs, index_pairs
from groundmill.operators.prompts import GENERATION_SYSTEM, VERIFICATION_SYSTEM, generation_prompt, verification_prompt

#: Member names of the two responses, as JSON schemas.
GENERATION_SCHEMA = {"type": "object", "required": ["qa_pairs"], "properties": {"qa_pairs": {"type": "array", "items": {"type": "object", "required": ["question", "answer", "source_passage", "question_type", "difficulty"], "properties": {k: {"type": "string"} for k in ("question", "answer", "source_passage", "question_type", "difficulty", "rationale")}}}}}
VERIFICATION_SCHEMA = {"type": "object", "required": ["verdict", "confidence", "reasoning"], "properties": {"verdict": {"type": "string"}, "confidence": {"type": "number"}, "reasoning": {"type": "string"}, "answer_is_correct": {"type": "boolean"}, "passage_supports_answer": {"type": "boolean"}}}
#: What is known of a report.
META = ("company", "ticker", "fiscal_year", "accession", "form", "period")
ORDER = ["doc_id", "chunk_ord", "pair_idx"]


class Run(NamedTuple):
    accepted: DataFrame  # without duplicates
    rejected: DataFrame
    decided: DataFrame  # every judged pair


def chunks_from_html(files: DataFrame, cfg: Config, meta: dict | None = None) -> DataFrame:
    """Chunks of reports (doc_id, content): decoded, rendered, split, packed, each with the run's metadata."""
    chunks = chunk_documents(parse_html(decode(files, text="html")).select("doc_id", "text"), cfg)
    return with_meta(first_chunks(chunks, cfg.max_chunks), meta or {})


def with_meta(chunks: DataFrame, meta: dict) -> DataFrame:
    return chunks.withColumns({m: F.lit(meta.get(m)).cast("string") for m in META if m not in chunks.columns})


def judge(pairs: DataFrame, verdicts: DataFrame, cfg: Config) -> DataFrame:
    """Grounded pairs with their verdicts (doc_id, chunk_ord, pair_idx, verdict, confidence, reasoning)."""
    return replay(ground(pairs, cfg), checked_verdicts(verdicts), ORDER)


def finish(judged: DataFrame, cfg: Config, scope: list[str] | None = None) -> Run:
    """Accepted pairs without duplicates, rejects, and all decisions. ``judged`` should be written before: it is read more than once."""
    decided = decide(judged, cfg)
    return Run(dedupe(accepted_rows(decided), ORDER, scope), rejected_rows(decided), decided)


def run_replay(chunks: DataFrame, captured: DataFrame, cfg: Config) -> Run:
    """From chunks and captured runs (chunk_id, qa_pairs, verifications). A chunk or verdict that was not captured ends the run."""
    with_pairs = replay(chunks.select("chunk_id", "doc_id", "chunk_ord"), captured, ["chunk_id"])
    raw = with_pairs.select("doc_id", "chunk_ord", F.to_json(F.struct("qa_pairs")).alias("response"))
    verdicts = with_pairs.select("doc_id", "chunk_ord", F.posexplode("verifications").alias("pair_idx", "v")).select(*ORDER, "v.verdict", "v.confidence", "v.reasoning")
    pairs = index_pairs(explode_pairs(raw), ["doc_id", "chunk_ord"], cfg.dense_index)
    return finish(judge(pairs.join(_texts(chunks), ["doc_id", "chunk_ord"]), verdicts, cfg), cfg)


def _texts(chunks: DataFrame) -> DataFrame:
    return chunks.withColumnRenamed("text", "chunk_text").drop("n_chars", "n_tokens", "part_index", "section_ord")


def run_live(chunks: DataFrame, make_client: Callable[[], Client], cache_path: str, cfg: Config, judged_path: str) -> Run:
    """From chunks and a client. Responses go to cache tables, so a run that was stopped goes on where it was.

    Pairs that fail the grounding check are not sent to the verifier unless ``cfg.verify_all``; they are rejected
    without a verdict.
    """
    spark = chunks.sparkSession
    limits = Limits(cfg.requests_in_flight, cfg.tokens_per_minute, cfg.completion_tasks)
    key = F.concat_ws("::", F.lit("gen"), "doc_id", "chunk_ord")
    prompt = generation_prompt(*[F.col(c) for c in ("company", "ticker", "form", "fiscal_year", "period", "section_item", "section_name", "text")], cfg.questions_per_chunk)
    asked = chunks.select("doc_id", "chunk_ord", key.alias("key"), F.lit(cfg.generation_model).alias("model"), F.lit(GENERATION_SYSTEM).alias("system"), prompt.alias("user"))
    generated = complete_cached(asked, f"{cache_path}/generation", make_client, GENERATION_SCHEMA, limits, cfg.max_output_tokens)
    raw = asked.select("doc_id", "chunk_ord", "key").join(generated, "key").drop("key")
    pairs = index_pairs(explode_pairs(raw), ["doc_id", "chunk_ord"], cfg.dense_index).join(_texts(chunks), ["doc_id", "chunk_ord"])
    grounded = ground(pairs, cfg)
    worth = grounded if cfg.verify_all else grounded.where("passed")
    key = F.concat_ws("::", F.lit("verify"), *ORDER)
    prompt = verification_prompt(*[F.col(c) for c in ("question", "answer", "question_type", "source_passage", "chunk_text")])
    asked = worth.select(*ORDER, key.alias("key"), F.lit(cfg.verification_model).alias("model"), F.lit(VERIFICATION_SYSTEM).alias("system"), prompt.alias("user"))
    answers = complete_cached(asked, f"{cache_path}/verification", make_client, VERIFICATION_SCHEMA, limits, cfg.max_output_tokens)
    verdicts = asked.select(*ORDER, "key").join(answers, "key").select(*ORDER, F.from_json("response", "verdict string, confidence double, reasoning string").alias("v")).select(*ORDER, "v.*")
    judged = grounded.join(checked_verdicts(verdicts), ORDER, "left")
    judged.write.mode("overwrite").parquet(judged_path)
    return finish(spark.read.parquet(judged_path), cfg)


def run_to_target(chunks: DataFrame, make_client: Callable[[], Client], cache_path: str, cfg: Config, judged_path: str) -> Run:
    """As ``run_live``, but over a growing share of the chunks, until ``cfg.target_pairs`` pairs are accepted or all were asked.

    The share is of an order by the chunks' hashes, so that what was asked before is asked again, which the cache
    answers. Each round asks for what is missing at the rate of the rounds before, half as much more, and at least
    doubles the share; so there are few.
    """
    total = chunks.count()
    share = min(1.0, cfg.target_pairs / max(1, total * cfg.questions_per_chunk))
    drawn = F.pmod(F.xxhash64("doc_id", "chunk_ord"), F.lit(1 << 30)) / float(1 << 30)
    while True:
        run = run_live(chunks.where(drawn < share) if share < 1 else chunks, make_client, cache_path, cfg, judged_path)
        found = run.accepted.count()
        if found >= cfg.target_pairs or share >= 1:
            return run
        share = min(1.0, max(2 * share, 1.5 * share * cfg.target_pairs / max(1, found)))
