"""Joins of passages and chunks, and of vectors, against all pairs."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from groundmill import catalog
from groundmill.functions import text as T
from groundmill.operators.grounding import containing, overlap_join
from groundmill.operators.near import GROUPS, _Join, near_counts, near_links, near_pairs


def passages_and_chunks(rng):
    words = ["the", "a", "of", *[f"w{i}" for i in range(60)], "Lamp", "lamps,", "x"]
    draw = lambda n: " ".join(rng.choices(words, weights=[40, 30, 20, *[1] * (len(words) - 3)], k=n))
    chunks = [(i, draw(rng.randint(0, 60))) for i in range(120)] + [(500, None), (501, ""), (502, "the end of it")]
    parts = []
    for i in range(80):
        text = rng.choice(chunks[:120])[1]
        a = rng.randrange(len(text) + 1)
        parts.append((i, text[a : a + rng.randint(0, 40)]))  # cut anywhere, also inside words
    return parts + [(90, "the"), (91, "th"), (92, "e"), (93, "the a"), (94, "e w1"), (95, " "), (96, None), (97, "nowhere"), (98, "d of it")], chunks


def folded(text):
    return " ".join((text or "").lower().split())


def test_containing_equals_all_pairs(spark):
    passages, chunks = passages_and_chunks(random.Random(2))
    p, c = spark.createDataFrame(passages, "item_id long, text string"), spark.createDataFrame(chunks, "doc_id long, text string")
    got = sorted((r["item_id"], r["doc_id"]) for r in containing(p, c).collect())
    assert got == sorted((i, d) for i, t in passages for d, x in chunks if folded(t) and folded(t) in folded(x))


def test_overlap_join_equals_all_pairs(spark):
    passages, chunks = passages_and_chunks(random.Random(3))
    p, c = spark.createDataFrame(passages, "item_id long, text string"), spark.createDataFrame(chunks, "doc_id long, text string")
    own = {i: set(folded(t).split()) for i, t in passages}
    its = {d: set(folded(t).split()) for d, t in chunks}
    for least in (0.3, 0.6, 1.0):
        got = sorted((r["item_id"], r["doc_id"], r["shared"], r["n_tokens"]) for r in overlap_join(p, c, least).collect())
        assert got == sorted((i, d, len(a & b), len(a)) for i, a in own.items() for d, b in its.items() if a & b and len(a & b) >= least * len(a))


def test_rows_that_repeat_a_key_are_rows_of_their_own(spark):
    p = spark.createDataFrame([(1, "a b c d"), (1, "x y"), (2, None)], "item_id long, text string")
    c = spark.createDataFrame([(5, "a b c q"), (5, "d c b a"), (5, "y"), (6, None)], "doc_id long, text string")
    got = sorted(tuple(r) for r in overlap_join(p, c, 0.5).select("item_id", "doc_id", "shared", "n_tokens").collect())
    assert got == [(1, 5, 1, 2), (1, 5, 3, 4), (1, 5, 4, 4)]
    assert sorted(tuple(r) for r in containing(p.where("text <> 'a b c d'"), c.unionByName(spark.createDataFrame([(7, "ax ys"), (7, "x y x y"), (8, "x  z y")], c.schema))).collect()) == [(1, 7), (1, 7)]


def test_no_join_of_passages_lacks_a_key(spark):
    passages, chunks = passages_and_chunks(random.Random(4))
    p, c = spark.createDataFrame(passages, "item_id long, text string"), spark.createDataFrame(chunks, "doc_id long, text string")
    for df in (containing(p, c), overlap_join(p, c, 0.6)):
        plan = df._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_overlap_join_broadcasts_no_rows_that_grow(spark):
    passages, chunks = passages_and_chunks(random.Random(4))
    p, c = spark.createDataFrame(passages, "item_id long, text string"), spark.createDataFrame(chunks, "doc_id long, text string")
    df = overlap_join(p, c, 0.6)
    assert df.collect() and "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_near_pairs_equal_all_pairs(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 8))
    x[100:150] = x[:50] + 0.05 * rng.normal(size=(50, 8))
    x[150:160] = 3 * x[0]
    x[160] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (None, [1.0] * 8), (901, [None] * 8)]
    t = spark.createDataFrame(rows, "id long, v array<double>")
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    for least, block in ((0.97, 2048), (0.6, 16)):
        got = sorted((r["a"], r["b"]) for r in near_pairs(t, "id", "v", least, block).collect())
        assert got == [(a, b) for a in range(300) for b in range(a + 1, 300) if unit[a] @ unit[b] >= least]


def test_near_pairs_of_clusters_spare_what_is_far(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(40, 32))[np.arange(3000) % 40] + 0.3 * rng.normal(size=(3000, 32))
    x[2990:] = x[5]  # copies of one vector
    t = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    cosines = unit @ unit.T
    met, full = [], []
    for least in (0.6, 0.9, 0.97):
        links = near_links(t, "id", "v", least, block=64)
        want = np.argwhere(np.triu(cosines[:2990, :2990] >= least, 1))
        assert sorted((r["a"], r["b"]) for r in links.pairs.collect()) == [tuple(p) for p in want.tolist()]
        r = links.report.first()
        assert (r["n_rows"], r["n_vectors"], r["n_pairs"]) == (3000, 2990, 2990 * 2989 // 2)
        assert len(want) <= r["n_full"] <= r["n_met"] <= r["n_pairs"] and r["largest_block"] <= 128
        met.append(r["n_met"] / r["n_pairs"])
        full.append(r["n_full"] / r["n_pairs"])
    assert met[0] > met[1] > met[2] and full[0] >= full[1] >= full[2] and met[2] < 0.2
    got = {r["id"]: (r["class"], r["n_same"], r["n_links"]) for r in near_counts(t, "id", "v", 0.9, block=64).collect()}
    assert all(got[i] == (5 if i == 5 or i >= 2990 else i, 10 if i == 5 or i >= 2990 else 0, int((cosines[i] >= 0.9).sum()) - 1) for i in range(3000))


def test_near_links_of_a_crowded_cell_stay_bounded(spark):
    """Very many different vectors in one narrow cone: blocks keep to their size, no link is lost."""
    rng = np.random.default_rng(8)
    x = np.ones(16) + 1e-3 * rng.normal(size=(1500, 16))
    t = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    r = near_links(t, "id", "v", 0.9, block=100)
    assert r.report.first()["largest_block"] <= 200 and r.pairs.count() == 1500 * 1499 // 2


def test_near_rows_are_sent_once_for_each_group_and_not_for_each_block(spark):
    """Vectors without structure, of which all blocks meet; the counts equal all pairs, copies included."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(2000, 16))
    x[1990:] = x[3]
    t = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    j = _Join(t, "id", "v", 0.5, 16)
    sent = j.grouped.join(j.meeting, "grp").groupBy("task").count().collect()
    assert sum(r["count"] for r in sent) <= 1990 * (GROUPS + 2) and max(r["count"] for r in sent) <= 2 * (1990 // GROUPS + 64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.5).sum(axis=1) - 1
    assert {r["id"]: r["n_links"] for r in near_counts(t, "id", "v", 0.5, 16).collect()} == dict(enumerate(want.tolist()))


def test_near_groups_are_written_once_whatever_they_meet(spark):
    """Vectors without structure: what is shuffled before groups meet is a row for each group, not a copy of each vector for each group that it meets."""
    x = np.random.default_rng(10).normal(size=(1000, 8))
    t = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    pairs = near_links(t, "id", "v", 0.7, 16, cosines=False).pairs
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert "CartesianProduct" in plan and exchanges and all("rangepartitioning(grp" in line for line in exchanges)
    packed = _Join(t, "id", "v", 0.7, 16).packed.selectExpr("count(*)", "sum(size(ids))").first()
    assert packed[0] <= GROUPS + 1 and packed[1] == 1000
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert sorted(map(tuple, pairs.collect())) == [tuple(p) for p in np.argwhere(np.triu(unit @ unit.T >= 0.7, 1)).tolist()]


def test_near_links_of_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0]), (3, [-0.0, 1.0]), (4, [0.0, 1.0]), (5, []), (6, None), (7, [0.0, 0.0]), (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (10, [1e200, 0.0]), (11, [1e-200, 1e-203]), (None, [1.0, 0.0])]
    t = spark.createDataFrame(rows, "id long, v array<double>")
    links = near_links(t, "id", "v", 0.99)
    assert sorted((r["id"], r["class"]) for r in links.members.collect()) == [(1, 1), (2, 2), (3, 3), (4, 3), (10, 10), (11, 11)]
    assert sorted((r["a"], r["b"]) for r in links.pairs.collect()) == [(1, 2), (1, 10), (1, 11), (2, 10), (2, 11), (10, 11)]
    none = near_links(t.where("false"), "id", "v", 0.9)
    assert none.pairs.count() == 0 and none.members.count() == 0 and none.report.first()["n_pairs"] == 0
    words = t.selectExpr("CAST(id AS STRING) AS id", "v").where("id IS NOT NULL")
    assert near_pairs(words, "id", "v", 0.99).where("a < b").count() == 7


def test_document_vectors_search_a_text_once_and_keep_the_words_of_its_key(spark):
    odd = ["What is the a an of", "the, The;THE an-other a1 _a_ to_day", "İs the ſ K thé x", "", None, " \n\t", "how many much manyfold", "été the in 9the the9", "a" * 3000 + " a " * 50]
    rows = spark.createDataFrame(list(enumerate(odd)), "id long, text string")
    words = F.filter(T.key_words(F.col("text")), lambda w: ~w.isin("", *T.QUESTION_WORDS))
    for r in rows.select("text", words.alias("words"), T.question_key(F.col("text")).alias("key")).collect():
        assert r["words"] == (None if r["text"] is None else [w for w in r["key"].split(" ") if w])
    vectors = catalog._hashed(rows)
    assert "regexp_replace" not in vectors._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["id"] for r in vectors.collect()) == [i for i, t in enumerate(odd) if t and set(re.findall("[a-z0-9]+", t.lower())) - set(T.QUESTION_WORDS)]
