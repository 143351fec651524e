import json
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from groundmill.config import Config
from groundmill.operators import completion, grounding, judging, merge, pairs, snap
from groundmill.plans import dataset

CHUNK = "Lamp sales were $1,250 in 2024, up 25% from $1,000 in 2023. We sold lamps | 500 | 400."
CFG = Config()


def grounded(spark, passage, answer, kind="fact_extraction", chunk=CHUNK):
    row = spark.createDataFrame([(passage, answer, kind, chunk)], "source_passage string, answer string, question_type string, chunk_text string")
    return grounding.ground(row, CFG).first()


def test_verbatim_quote(spark):
    r = grounded(spark, "LAMP sales were $1,250", "It was $1,250.")
    assert r["exact"] and r["token_overlap"] == 1.0 and r["passed"] and r["missing_numbers"] == []


def test_made_up_quote(spark):
    assert not grounded(spark, "Chairs were cheaper than ever before", "Yes")["passage_in_chunk"]


def test_number_from_nowhere(spark):
    r = grounded(spark, "Lamp sales were $1,250", "It was $9,999.")
    assert r["passage_in_chunk"] and not r["numbers_supported"] and r["missing_numbers"] == ["9999"]


def test_calculations_may_state_new_numbers(spark):
    assert grounded(spark, "up 25% from $1,000", "It grew by $250.", "numeric_calculation")["passed"]


def test_empty_and_null_quotes(spark):
    for quote in ("", None):
        r = grounded(spark, quote, "none")
        assert not r["exact"] and not r["passage_in_chunk"] and r["token_overlap"] == 0.0


def judged(spark, rows):
    kind = "doc_id long, chunk_ord int, pair_idx int, question string, answer string, source_passage string, question_type string, difficulty string, verdict string, confidence double, reasoning string, chunk_id string, section_name string, chunk_text string"
    return grounding.ground(spark.createDataFrame(rows, kind), CFG)


def row(i, question, passage, verdict="SUPPORTED", confidence=0.9, answer="lamps"):
    return (0, 0, i, question, answer, passage, "fact_extraction", "easy", verdict, confidence, "why", "c", "Business", CHUNK)


def test_both_gates_and_the_rejects(spark):
    d = judging.decide(judged(spark, [
        row(0, "What are lamps?", "We sold lamps | 500"), row(1, "Who?", "We sold lamps", "PARTIAL"), row(2, "Where?", "Nothing of the kind here"),
        row(3, "Scattered?", "alpha beta gamma delta one two three four")[:-1] + ("alpha beta gamma delta " + "filler " * 60 + "one two three four",),
    ]), CFG)
    got = {r["pair_idx"]: (r["accepted"], r["reject_reason"]) for r in d.collect()}
    assert got == {0: (True, None), 1: (False, "why"), 2: (False, "why"), 3: (False, judging.NOT_VERBATIM)}
    assert judging.rejected_rows(d).columns == judging.REJECT_COLUMNS


def snapped(spark, passage, chunk=CHUNK, fuzzy=True):
    r = snap.snap(spark.createDataFrame([(passage, chunk)], "source_passage string, chunk_text string"), fuzzy).first()
    return r["snapped_passage"], r["snapped"]


def test_snapping(spark):
    assert snapped(spark, "We sold lamps | 500") == ("We sold lamps | 500", True)
    assert snapped(spark, "We sold lamps 500 | 400") == ("We sold lamps | 500 | 400", True)
    assert snapped(spark, "it’s fine", "So it's fine.") == ("it's fine", True)
    assert snapped(spark, "abc", "abc abc") == ("abc", False)
    assert snapped(spark, "  ") == ("  ", False)
    assert snapped(spark, "quite another matter") == ("quite another matter", False)


def test_blocks_equal_those_of_the_standard_library(monkeypatch):
    r = random.Random(5)
    for letters in ["ab", "abcd ", "abcdefgh é😀"] * 150:
        chunk, passage = ("".join(r.choices(letters, k=r.randint(0, n))) for n in (70, 40))
        at = r.randint(0, len(chunk))
        passage += chunk[at : at + r.randint(0, 30)]
        monkeypatch.setattr(snap, "PLACES", r.choice([3, 40, 1 << 21]))
        want = [tuple(b) for b in SequenceMatcher(None, chunk, passage, autojunk=False).get_matching_blocks() if b.size >= snap.LEAST_BLOCK]
        assert snap._blocks(chunk, passage) == want


def test_both_legs_of_snapping_agree(spark):
    words = CHUNK.split()
    rows = [(" ".join(words[i:j]), CHUNK) for i in range(0, len(words), 3) for j in range(i + 2, len(words), 4)]
    fast = snap.snap(spark.createDataFrame(rows, "source_passage string, chunk_text string")).collect()
    for r in fast:
        a, b = snap._hull(r["source_passage"], CHUNK)
        assert r["snapped_passage"] == CHUNK[a:b].strip()


def test_duplicates_keep_the_surest_then_the_first(spark):
    rows = [row(0, "What is the price?", "x", confidence=0.5), row(1, "What was the price?", "x", confidence=0.8), row(2, "How much is the price", "x", confidence=0.8), row(3, "what is the", "x"), row(4, "the an of", "x")]
    t = judged(spark, rows).withColumns({"verifier_confidence": F.col("confidence"), "grounding_overlap": F.lit(1.0)})
    assert sorted(r["pair_idx"] for r in judging.dedupe(t, dataset.ORDER).collect()) == [1, 3]


def test_stats_of_nothing(spark):
    none = judged(spark, [row(0, "q", "x")]).where("false").withColumns({"verifier_confidence": F.col("confidence"), "source_verbatim": F.lit(True)})
    s = judging.stats(none, none).first()
    assert (s["n_accepted"], s["acceptance_rate"], s["mean_verifier_confidence"], s["pct_exact_passage_match"]) == (0, 0.0, 0.0, 0.0)


def test_malformed_pairs_are_marked(spark):
    good = {"question": "q", "answer": "a", "source_passage": "s", "question_type": "comparison", "difficulty": "hard"}
    listed = [good | {"answer": 5}, good, {k: v for k, v in good.items() if k != "answer"}, good | {"difficulty": "odd"}, good | {"more": 1, "rationale": None}]
    t = spark.createDataFrame([(0, json.dumps({"qa_pairs": listed})), (1, "{}"), (2, "broken")], "doc_id long, response string")
    rows = pairs.explode_pairs(t).orderBy("raw_pos").collect()
    assert [r["valid"] for r in rows] == [False, True, False, False, True]
    both = [sorted((r["raw_pos"], r["pair_idx"]) for r in pairs.index_pairs(pairs.explode_pairs(t), ["doc_id"], d).collect()) for d in (False, True)]
    assert both == [[(1, 1), (4, 4)], [(1, 0), (4, 1)]]


def test_wrong_verdict_ends_the_run(spark):
    t = spark.createDataFrame([("MAYBE", 0.5, "r")], "verdict string, confidence double, reasoning string")
    with pytest.raises(Exception, match="verdict out of range"):
        pairs.checked_verdicts(t).collect()
    assert pairs.checked_verdicts(t, strict=False).count() == 0


def test_replay_needs_every_key(spark):
    a = spark.createDataFrame([(1,), (2,)], "k long")
    with pytest.raises(completion.CompletionError):
        completion.replay(a, a.where("k = 1"), ["k"])


class Echo:
    def complete_json(self, *, model, system, user, schema, key):
        return {"said": user}


def test_cache_calls_only_what_is_new(spark, tmp_path):
    asked = spark.createDataFrame([("k1", "m", "s", "u1"), ("k2", "m", "s", "u2")], "key string, model string, system string, user string")
    path = str(tmp_path / "cache")
    first = completion.complete_cached(asked.limit(1), path, Echo, {})
    assert first.count() == 1
    again = {r["key"]: json.loads(r["response"]) for r in completion.complete_cached(asked, path, Echo, {}).collect()}
    assert again == {"k1": {"said": "u1"}, "k2": {"said": "u2"}}
    assert spark.read.parquet(path).count() == 2


def test_merge_pads_and_cuts(spark):
    kind = "chunk_id string, qa_pairs array<string>"
    gen = spark.createDataFrame([("a", ["1", "2"]), ("b", ["1"]), ("c", ["1"]), ("d", None)], kind)
    ver = spark.createDataFrame([("a", [("SUPPORTED", 0.9, "x")]), ("b", [("PARTIAL", 0.5, "y"), ("SUPPORTED", 0.9, "z")]), ("e", [])], "chunk_id string, verifications array<struct<verdict: string, confidence: double, reasoning: string>>")
    rows = {r["chunk_id"]: ([v["verdict"] for v in r["verifications"]], r["missing"]) for r in merge.merge_captures(gen, ver).collect()}
    assert rows == {"a": (["SUPPORTED", "NOT_SUPPORTED"], False), "b": (["PARTIAL"], False), "c": (["NOT_SUPPORTED"], True), "d": ([], True)}
    assert merge.merge_summary(merge.merge_captures(gen, ver)).first().asDict() == {"chunks_merged": 4, "total_pairs": 4, "total_verifications": 4, "chunks_missing_verification": 2}


class Writer:
    """Stands in for both models: quotes the excerpt's first sentence, supports everything."""

    def complete_json(self, *, model, system, user, schema, key):
        if key and "verdict" in schema["properties"]:
            return {"verdict": "SUPPORTED", "confidence": 0.75, "reasoning": "fits"}
        text = user.split("EXCERPT:\n")[1]
        quote = text.split(". ")[0]
        base = {"question": f"Which line is {len(text)}?", "answer": quote, "source_passage": quote, "question_type": "comparison", "difficulty": "easy"}
        return {"qa_pairs": [base | {"answer": 3}, base, base | {"question": "Bad quote?", "source_passage": "made up by nobody at all"}]}


def test_live_run_end_to_end(spark, tmp_path):
    text = "<html><head><title>no</title></head><body>" + "".join(f"<p>Item {i}. Part {i}</p><p>{'Lamps burn bright. ' * 40}{i}</p>" for i in (1, 2)) + "</body></html>"
    files = spark.createDataFrame([(0, bytearray(text, "utf-8"))], "doc_id long, content binary")
    chunks = dataset.chunks_from_html(files, CFG, {"company": "Lamp Works", "fiscal_year": "2024"})
    run = dataset.run_live(chunks, Writer, str(tmp_path / "cache"), CFG, str(tmp_path / "judged"))
    assert run.accepted.count() == 1  # both chunks ask the same; the second is a duplicate
    assert run.rejected.count() == 2
    from groundmill.sources.sinks import write_outputs

    paths = write_outputs(run.accepted, run.decided, str(tmp_path / "out"), "r", {"company": "Lamp Works"})
    back = spark.read.csv(paths["dataset.csv"], header=True, multiLine=True, escape='"').first()
    assert back["company"] == "Lamp Works" and back["source_verbatim"] == "True" and back["ticker"] is None
    assert spark.read.json(paths["rejected.jsonl"]).count() == 2


def test_replay_end_to_end(spark):
    chunk = spark.createDataFrame([(0, 0, "c1", "1", "Business", CHUNK)], "doc_id long, chunk_ord int, chunk_id string, section_item string, section_name string, text string")
    pair = ("What was sold?", "lamps", "We sold lamps", "fact_extraction", "easy", None)
    kind = "chunk_id string, qa_pairs array<struct<question: string, answer: string, source_passage: string, question_type: string, difficulty: string, rationale: string>>, verifications array<struct<verdict: string, confidence: double, reasoning: string>>"
    captured = spark.createDataFrame([("c1", [pair, pair], [("SUPPORTED", 0.9, "x"), ("PARTIAL", 0.5, "y")])], kind)
    run = dataset.run_replay(dataset.with_meta(chunk, {"company": "L"}), captured, CFG)
    assert (run.accepted.count(), run.rejected.count()) == (1, 1)
    assert judging.dataset_rows(run.accepted).columns == judging.DATASET_COLUMNS


def test_whole_dataset_keeps_quotes_in_upper_case(spark, tmp_path):
    lines = {0: "The first of the lamps were sold in spring.", 1: "The other lamps were sold in autumn and stored."}
    turns = [(c, t, r, x) for c, line in lines.items() for t, r, x in ((0, "user", f"Which lamps were sold {c}?"), (1, "assistant", line))]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame([(c, 0, 1) for c in lines], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    from groundmill import catalog

    run = lambda name: catalog.QUERIES[name](spark, str(tmp_path)).collect()
    got = {r["chunk_id"]: r for r in run("dataset_row_aligned")}
    assert {c: (r["source_passage"].lower(), r["source_verbatim"]) for c, r in got.items()} == {f"c{c}": (line.lower(), True) for c, line in lines.items()}
    assert [r["chunk_id"] for r in run("dataset_row")] == ["c0"]
    assert len(run("accepted_rows_aligned")) == 2 and run("rejected_rows_aligned") == []


def test_pairs_that_only_alignment_places_are_accepted(spark, monkeypatch, tmp_path):
    from groundmill import catalog

    rows = judged(spark, [row(0, "What are lamps?", "We sold lamps 500 | 400"), row(1, "Where?", "Nothing of the kind here")])
    monkeypatch.setattr(catalog, "judged", lambda spark, sf_dir: rows)
    assert [r["source_passage"] for r in catalog.accepted(spark, "", True).collect()] == ["We sold lamps | 500 | 400"]
    split = lambda name: {(r["accepted"], r["n"]) for r in catalog.QUERIES[name](spark, "").collect()}
    assert split("accept_reject_split_aligned") == {(True, 1), (False, 1)} and split("accept_reject_split") == {(False, 2)}


def test_pairs_are_read_once_where_quotes_are_not_aligned(spark):
    from groundmill import catalog

    from .conftest import DATA

    for name in ("verbatim_gate", "acceptance_rate"):
        plan = catalog.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert "Union" not in plan and plan.count("FileScan") <= 4
