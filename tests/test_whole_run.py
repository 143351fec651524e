"""Decisions with all quotes aligned, over all pairs of the smallest tables, against a loop that uses the standard library's matcher."""

import hashlib
import re
from collections import Counter
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from groundmill import catalog
from groundmill.functions import text as T
from groundmill.operators import judging
from groundmill.plans.inputs import CANDIDATES

from .compare import duck, shown
from .conftest import DATA

PLAIN = str.maketrans(T.CURLY, T.ASCII)


def folded(text):
    return " ".join(text.translate(PLAIN).split()).lower()


def words(text):
    return set(folded(text).split())


def numbers(text):
    found = re.findall(r"-?\$?\s?\d[\d,]*(?:\.\d+)?\s?%?", text)
    return [re.sub(r"[^\d.]", "", x).lstrip("0").rstrip(".") or "0" for x in found]


def aligned(quote, chunk):
    """The stretch of the chunk that the quote's blocks enclose, if it is good; else None."""
    if not quote.strip():
        return None
    match = SequenceMatcher(None, chunk.translate(PLAIN), quote.translate(PLAIN), autojunk=False)
    blocks = [b for b in match.get_matching_blocks() if b.size >= 4]
    if not blocks:
        return None
    first, last = blocks[0], blocks[-1]
    if last.a + last.size - first.a > 3 * len(quote) + 80:
        first = last = max(blocks, key=lambda b: b.size)
    span = chunk[first.a : last.a + last.size].strip()
    own = words(quote)
    return span if own and 10 * len(own & words(span)) >= 6 * len(own) and folded(span) in folded(chunk) else None


def key_of(question):
    left = re.sub(rf"\b({'|'.join(T.QUESTION_WORDS)})\b", " ", re.sub("[^a-z0-9 ]+", " ", question.lower()))
    return re.sub(" +", " ", left).strip()


def bent(quote):
    return re.sub(r"\. ", "; ", quote.replace(" the ", " "))


@pytest.fixture(scope="module")
def decided():
    """All pairs decided by a loop; quotes are bent, here and for the queries, so that alignment has work to do."""
    plain = catalog.candidates

    def changed(spark, sf_dir):
        return plain(spark, sf_dir).withColumn("source_passage", F.regexp_replace(F.replace("source_passage", F.lit(" the "), F.lit(" ")), r"\. ", "; "))

    catalog.candidates = changed
    yield loop()
    catalog.candidates = plain


def loop():
    names = ["doc_id", "chunk_ord", "pair_idx", "question", "answer", "source_passage", "chunk_text", "question_type", "difficulty", "verdict", "confidence", "reasoning", "chunk_id", "section_item", "section_name"]
    rows = [dict(zip(names, r, strict=True)) for r in duck(DATA).sql(f"WITH {CANDIDATES} SELECT {', '.join(names)} FROM cand").fetchall()]
    for r in rows:
        r["source_passage"] = bent(r["source_passage"])
        quote, chunk = r["source_passage"], r["chunk_text"]
        exact = bool(folded(quote)) and folded(quote) in folded(chunk)
        own = words(quote)
        overlap = 1.0 if exact else len(own & words(chunk)) / len(own) if own else 0.0
        known = set(numbers(chunk)) | set(numbers(quote))
        asked = numbers(r["answer"])
        lost = [n for n in asked if n not in known]
        traced = r["question_type"] in ("numeric_calculation", "multi_step_reasoning") or not asked or (len(asked) - len(lost)) * 2 >= len(asked)
        r["near"], r["overlap"], r["lost"] = exact or overlap >= 0.6, round(overlap, 3), lost
        if r["verdict"] is None:
            r["verdict"], r["confidence"], r["reasoning"] = "NOT_SUPPORTED", 0.0, "missing verification"
        r["ok"] = r["near"] and traced and r["verdict"] == "SUPPORTED"
        r["final"] = (aligned(quote, chunk) or quote) if r["ok"] else quote
        r["verbatim"] = r["ok"] and folded(r["final"]) in folded(chunk)
        r["id"] = hashlib.sha256(f"{r['chunk_id']}␟{r['question']}".encode()).hexdigest()[:12]
        r["key"] = key_of(r["question"])
        r["order"] = (-r["confidence"], r["doc_id"], r["chunk_ord"], r["pair_idx"])
    return rows


def best(rows, by):
    out = {}
    for r in sorted((r for r in rows if r["verbatim"]), key=lambda r: r["order"]):
        out.setdefault(by(r), r)
    return list(out.values())


def got(spark, name, *columns):
    return sorted(tuple(shown(r[c]) for c in columns) for r in catalog.QUERIES[name](spark, DATA).collect())


def want(rows):
    return sorted(tuple(shown(v) for v in r) for r in rows)


def test_alignment_equals_the_standard_library(spark):
    """Bent quotes of every pair, where they are placed and what is taken."""
    rows = duck(DATA).sql(f"WITH {CANDIDATES} SELECT doc_id, pair_idx, source_passage, chunk_text FROM cand").fetchall()
    out = []
    for d, i, quote, chunk in rows:
        span = aligned(bent(quote), chunk)
        out.append((d, i, bent(quote) if span is None else span, span is not None))
    assert got(spark, "snap_fuzzy", "doc_id", "pair_idx", "snapped_passage", "snapped") == want(out)


def test_decisions(spark, decided):
    good, bad = [r for r in decided if r["verbatim"]], [r for r in decided if not r["verbatim"]]
    assert good and any(r["final"] != r["source_passage"] for r in good)
    assert got(spark, "verbatim_gate_aligned", "doc_id", "pair_idx", "verbatim") == want([(r["doc_id"], r["pair_idx"], r["verbatim"]) for r in decided if r["ok"]])
    assert got(spark, "accepted_rows_aligned", "id", "doc_id", "pair_idx", "question", "question_type", "grounding_overlap", "verifier_confidence") == want([(r["id"], r["doc_id"], r["pair_idx"], r["question"], r["question_type"], 1.0, r["confidence"]) for r in good])
    assert got(spark, "rejected_rows_aligned", "chunk_id", "question", "answer", "question_type", "verdict", "passage_in_chunk", "token_overlap", "missing_numbers", "reason") == want(
        [(r["chunk_id"], r["question"], r["answer"], r["question_type"], r["verdict"], r["near"], r["overlap"], " ".join(r["lost"]), judging.NOT_VERBATIM if r["ok"] else r["reasoning"]) for r in bad]
    )
    split = Counter((r["verbatim"], r["verdict"]) for r in decided)
    assert got(spark, "accept_reject_split_aligned", "accepted", "verdict", "n") == want([(*k, n) for k, n in split.items()])
    at, running = Counter(), []
    for r in sorted(decided, key=lambda r: r["order"][1:]):
        at[r["section_item"]] += r["verbatim"]
        running.append((r["doc_id"], r["pair_idx"], at[r["section_item"]]))
    assert got(spark, "running_accepted_aligned", "doc_id", "pair_idx", "running") == want(running)


def test_duplicates_and_dataset(spark, decided):
    kept = best(decided, lambda r: r["key"])
    assert got(spark, "dedupe_best_aligned", "doc_id", "pair_idx", "question_key") == want([(r["doc_id"], r["pair_idx"], r["key"]) for r in kept])
    assert got(spark, "dedupe_scoped_aligned", "doc_id", "pair_idx") == want([(r["doc_id"], r["pair_idx"]) for r in best(decided, lambda r: (r["section_item"], r["key"]))])
    rows = [(r["id"], r["question"], r["answer"], r["final"], r["question_type"], r["difficulty"], r["section_name"], "Any Inc.", "ANY", "2024", None, r["chunk_id"], r["verdict"], int(r["confidence"] * 1000 + 0.5) / 1000, 1.0, True) for r in kept]
    assert got(spark, "dataset_row_aligned", *judging.DATASET_COLUMNS) == want(rows)


def test_statistics(spark, decided):
    kept, lost = best(decided, lambda r: r["key"]), [r for r in decided if not r["verbatim"]]
    columns = ("question_type", "difficulty", "section_name")
    counts = {c: Counter(r[c] for r in kept) for c in columns}
    for name, c in zip(("stats_by_type", "stats_by_difficulty", "stats_by_section"), columns, strict=True):
        assert got(spark, f"{name}_aligned", c, "n") == want(counts[c].items())
    sets = [(*[k if x == c else None for x in columns], n) for c in columns for k, n in counts[c].items()]
    assert got(spark, "stats_grouping_sets_aligned", *columns, "n") == want(sets)
    mean = round(sum(r["confidence"] for r in kept) / len(kept), 3)
    rate = round(len(kept) / (len(kept) + len(lost)), 3)
    assert got(spark, "acceptance_rate_aligned", "n_accepted", "n_rejected", "acceptance_rate", "mean_verifier_confidence", "pct_exact_passage_match") == want([(len(kept), len(lost), rate, mean, 100.0)])
    assert got(spark, "mean_confidence_aligned", "mean_verifier_confidence") == want([(mean,)]) and got(spark, "pct_exact_aligned", "pct_exact_passage_match") == want([(100.0,)])
    text = lambda c: ",".join(f"{k}={n}" for k, n in sorted(counts[c].items()))
    assert got(spark, "stats_record_aligned", "by_question_type", "by_difficulty", "by_section") == want([tuple(text(c) for c in columns)])
