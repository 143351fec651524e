"""The audit against a loop over documents and orders."""

from collections import Counter
from itertools import permutations

import pytest

from groundmill.llm import filters
from groundmill.llm.filters import audit, failed_sets

from ..compare import assert_same
from ..conftest import DATA
from .helpers import ODD_SCHEMA, empty, odd_rows

LABELS = "doc_id long, quality int, toxic int"


def looped(rows, labels) -> dict:
    """{(part, order, step): figures} of rows (id, part, text) by applying the filters one after another."""
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}
    smallest: dict[str, int] = {}
    for i, _, text in rows:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))
    out: dict = {}
    for part in {p or "" for _, p, _ in rows}:
        docs = []
        for i, p, text in rows:
            if (p or "") == part:
                text = text or ""
                words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
                fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), "D": any(c in "#$%&*|" for c in text), "E": i is not None and smallest[text] < i}
                docs.append((i, {f for f, x in fails.items() if x}))
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                lost, left = [d for d in left if f in d[1]], [d for d in left if f not in d[1]]
                shapley[f] += len(lost)
                out[part, order, step] = [len(left), len(lost), sum(f in x for _, x in docs) - len(lost), sum(x == {f} for _, x in docs), sum(i in good for i, _ in lost), sum(i in toxic for i, _ in lost)]
        for (p, order, step), x in out.items():
            if p == part:
                x.append(shapley[order[step - 1]])
    return out


def gathered(df) -> dict:
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in df.collect()}


def test_odd_rows_equal_a_loop(spark):
    crowd = " ".join(f"word{i}" for i in range(120))
    more = [(20, crowd, "en"), (21, crowd + " # sign", "en"), (22, crowd.upper(), "de"), (23, crowd, None), (None, crowd, "en"), (20, crowd, "en"), (19, crowd.replace("word1", "word2") + " é 日本", "de"), (24, " ".join(["again"] * 300) + " $", "de")]
    rows = odd_rows() + [(i, t, p, "s", 0, "x", 1, 2, "y") for i, t, p in more]
    labels = [(20, 1, 0), (21, 0, 1), (20, 0, 1), (None, 1, 1), (24, 1, None), (99, 1, 1), (2, None, 1)]
    got = gathered(audit(failed_sets(spark.createDataFrame(rows, ODD_SCHEMA), spark.createDataFrame(labels, LABELS), "lang")))
    assert got == looped([(r[0], r[2], r[1]) for r in rows], labels)


def test_no_rows(spark):
    labels = spark.createDataFrame([], LABELS)
    assert audit(failed_sets(empty(spark), labels, "lang")).count() == 0
    one = spark.createDataFrame([(1, None, "x")], "doc_id long, text string, lang string")
    assert gathered(audit(failed_sets(one, labels, "lang")))["x", "BACDE", 2] == [0, 1, 0, 1, 0, 0, 120]


@pytest.mark.parametrize("copies", [1, 50])
def test_many_copies(spark, copies):
    text = " ".join(f"w{i}" for i in range(150))
    docs = spark.range(copies).selectExpr("id AS doc_id", f"'{text}' AS text", "'en' AS lang")
    got = gathered(audit(failed_sets(docs, spark.createDataFrame([], LABELS), "lang")))
    assert got["en", "ABCDE", 5] == [1, copies - 1, 0, copies - 1, 0, 0, 120 * (copies - 1)]


def test_words_are_not_shuffled(spark):
    plan = filters.word_totals(spark.read.parquet(f"{DATA}/documents.parquet"), "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_op11_equals_statement(spark):
    assert_same(filters.op11_filter_audit(spark, DATA), filters.OP11_SQL, DATA)
