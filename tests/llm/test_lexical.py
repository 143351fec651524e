"""Ranked search against scoring every document, and the sums against a dictionary."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from groundmill.llm import lexical
from groundmill.llm.lexical import Accumulator, radix_order, search, summed

from ..compare import assert_same
from ..conftest import DATA
from .helpers import empty, odd, odd_rows


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def looped(docs, items, k=10):
    """{item: [(rank, doc, score)]} of docs [(id, text)], with the ids of equal scores in order, null last."""
    counted = [(i, Counter(w), len(w)) for i, t in docs if (w := words(t))]
    total, length, df = len(counted), sum(n for _, _, n in counted), Counter(w for _, c, _ in counted for w in c)
    asked: dict = {}
    for item, text in items:
        asked.setdefault(item, set()).update(words(text))
    out = {}
    for item, terms in asked.items():
        scored = []
        for i, c, n in counted:
            m = 10 + (90 * n * total) // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score:
                scored.append((-score, i is None, i or 0, i))
        if scored:
            out[item] = [(r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return out


def gathered(df):
    out: dict = {}
    for r in df.collect():
        out.setdefault(r["item"], []).append((r["rank"], r["doc"], r["score"]))
    return {i: sorted(v) for i, v in out.items()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**64 - 1) | st.integers(0, 300), st.integers(0, 10**15)), max_size=300))
def test_sums_by_key(pairs):
    keys, values = np.array([p[0] for p in pairs], np.uint64), np.array([p[1] for p in pairs], np.int64)
    assert (radix_order(keys) == np.argsort(keys, kind="stable")).all()
    want: Counter = Counter()
    for k, v in pairs:
        want[k] += v
    got = summed(keys, values)
    assert list(zip(*(x.tolist() for x in got))) == sorted(want.items())


def test_chunks_do_not_change_the_best(monkeypatch):
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 400, 200)
    terms = [np.sort(rng.choice(30, rng.integers(0, 12), replace=False)) for _ in lengths]
    ends, flat = np.concatenate(([0], np.cumsum([len(t) for t in terms]))), np.concatenate(terms)
    starts = np.arange(31) * 4
    items = np.concatenate([np.sort(rng.choice(9, 4, replace=False)) for _ in range(30)])
    got = []
    for entries in (1, 64, 1 << 20):
        monkeypatch.setattr(lexical, "ENTRIES", entries)
        a = Accumulator(np.arange(30) * 7, starts, items, 9, 200, int(lengths.sum()), 5)
        a.add(pa.array(range(200)), lengths, ends, flat, np.ones(len(flat), np.int64))
        got.append([sorted((s, p, d.as_py()) for s, p, d in b) for b in a.best])
    assert got[0] == got[1] == got[2] and all(len(b) == 5 for b in got[0])


ITEMS = [(1, "same short text"), (2, "word"), (3, ""), (4, None), (None, "row without an id"), (1, "HERE again"), (5, "é 10 0"), (6, "nowhere"), (7, "one mail")]


@pytest.mark.parametrize("most", [1 << 18, 3])
def test_odd_rows_equal_a_loop(spark, most):
    docs = odd(spark).unionByName(spark.createDataFrame([(i, "word same word text", None, None, 0, "x", 1, 2, "y") for i in range(30, 60)], odd(spark).schema))
    got = gathered(search(docs, spark.createDataFrame(ITEMS, "item_id long, text string"), most_terms=most))
    rows = [(r[0], r[1]) for r in odd_rows()] + [(i, "word same word text") for i in range(30, 60)]
    assert got == looped(rows, ITEMS)


def test_text_ids_and_empty_tables(spark):
    items = spark.createDataFrame([("q", "blue sky")], "item_id string, text string")
    docs = spark.createDataFrame([(f"a{i % 3}", f"blue {'sky ' * (i % 2)} number {i}") for i in range(12)] + [(None, "blue sky")], "doc_id string, text string")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    scores = lambda x: [(r, s) for r, _, s in x["q"]]
    got = gathered(search(docs, items, k=4))
    assert scores(got) == scores(looped([(None, t) for _, t in rows], [("q", "blue sky")], 4)) and got["q"][0][1] is None
    assert search(empty(spark), items).count() == 0
    assert search(docs, items.where("false")).count() == 0


def test_op13_equals_statement(spark):
    got = lexical.op13_search(spark, DATA)
    assert_same(got, lexical.OP13_SQL, DATA)
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()
    assert gathered(got.withColumnsRenamed({"item_id": "item", "doc_id": "doc"})) == looped([tuple(r) for r in rows], [tuple(i) for i in items])
