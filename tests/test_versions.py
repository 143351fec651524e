"""Captured runs of every version are read as the current one."""

import json

import pytest

from groundmill.sources.versions import read_versioned, side_by_side, write_versioned

PAIR = {"question": "What?", "answer": "That.", "source_passage": "That", "question_type": "comparison", "difficulty": "easy"}


def pair(n):
    return PAIR | {"question": f"What {n}?"}


def verdict(n):
    return {"verdict": "SUPPORTED", "confidence": n / 4, "reasoning": f"r{n}"}


def written(path, rows):
    path.mkdir(exist_ok=True)
    (path / f"{len(list(path.iterdir()))}.json").write_text("\n".join(json.dumps(r) for r in rows) + "\n")


def shown(df):
    return {r["chunk_id"]: [(i["pair"]["question"], i["verdict"] and i["verdict"]["reasoning"]) for i in r["items"]] for r in df.collect()}


def test_old_and_new_runs_read_alike(spark, tmp_path):
    written(tmp_path / "runs", [
        {"chunk_id": "a", "generation": {"qa_pairs": [pair(0), pair(1), pair(2)]}, "verifications": [verdict(0), verdict(1)]},
        {"chunk_id": "b", "generation": {"qa_pairs": [pair(0)]}, "verifications": [verdict(0), verdict(1)]}, {"chunk_id": "c"}, {"chunk_id": "d", "schema_version": 1, "generation": {"qa_pairs": [pair(4)]}},
    ])
    written(tmp_path / "runs", [{"chunk_id": "e", "schema_version": 2, "items": [{"pair": pair(5), "verdict": verdict(3)}, {"pair": pair(6), "verdict": None}]}, {"chunk_id": "f", "schema_version": 2}])
    want = {"a": [("What 0?", "r0"), ("What 1?", "r1"), ("What 2?", None)], "b": [("What 0?", "r0")], "c": [], "d": [("What 4?", None)], "e": [("What 5?", "r3"), ("What 6?", None)], "f": []}
    runs = read_versioned(spark, str(tmp_path / "runs"))
    assert shown(runs) == want
    write_versioned(runs, str(tmp_path / "again"))
    assert shown(read_versioned(spark, str(tmp_path / "again"))) == want
    both = {r["chunk_id"]: (len(r["qa_pairs"]), len(r["verifications"])) for r in side_by_side(runs).collect()}
    assert both == {k: (len(v), len(v)) for k, v in want.items()}


def test_later_versions_end_the_run(spark, tmp_path):
    written(tmp_path / "runs", [{"chunk_id": "x", "schema_version": 9, "items": []}])
    with pytest.raises(Exception, match="schema version 9"):
        read_versioned(spark, str(tmp_path / "runs")).collect()
