"""Prompts of the generation and the verification call, filled from columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundmill.functions.text import stable_id

TYPES = ("fact_extraction", "numeric_calculation", "comparison", "multi_step_reasoning")
DIFFICULTIES = ("easy", "medium", "hard")
VERDICTS = ("SUPPORTED", "PARTIAL", "NOT_SUPPORTED")
GENERATION_SYSTEM = (
    "Write question and answer pairs from one excerpt of a company report. Use nothing but the excerpt. Quote the supporting span "
    "exactly as it stands, in one piece. Each question must be clear without the excerpt: name the company and the period. One answer "
    "only may be right. Keep units and scale of numbers. Leave out page furniture and lists of exhibits. "
    f"Question types: {', '.join(TYPES)}. Difficulty: {', '.join(DIFFICULTIES)}."
)
VERIFICATION_SYSTEM = (
    "Check one question and answer pair against the chunk it came from. SUPPORTED: the quote is in the chunk and entails the whole answer; "
    "do calculations again. PARTIAL: imprecise, incomplete, or a slip of unit or arithmetic. NOT_SUPPORTED: wrong, not entailed, or the quote "
    "is made up. In doubt take the lower verdict. Give verdict, confidence from 0 to 1, and reasoning."
)


def generation_prompt(company: Column, ticker: Column, form: Column, fiscal_year: Column, period: Column, item: Column, section: Column, text: Column, n: int) -> Column:
    part = lambda c, default="": F.coalesce(c.cast("string"), F.lit(default))
    return F.concat(
        F.lit("Company: "), part(company, "the company"), F.lit(" ("), part(ticker), F.lit(")\nReport: "), part(form, "10-K"), F.lit(", fiscal year "), part(fiscal_year), F.lit(", period ended "), part(period),
        F.lit("\nSection: Item "), part(item), F.lit(" - "), part(section), F.lit(f"\nPairs wanted: at most {n}, fewer if the excerpt holds little.\nEXCERPT:\n"), part(text),
    )


def verification_prompt(question: Column, answer: Column, question_type: Column, passage: Column, chunk: Column) -> Column:
    part = lambda c: F.coalesce(c, F.lit(""))
    return F.concat(F.lit("QUESTION: "), part(question), F.lit("\nANSWER: "), part(answer), F.lit("\nTYPE: "), part(question_type), F.lit("\nQUOTE: "), part(passage), F.lit("\nCHUNK:\n"), part(chunk))


def cache_key(model: Column, system: Column, user: Column) -> Column:
    """Key of a response: the model and all that it is told."""
    return stable_id(model, system, user, length=24)
