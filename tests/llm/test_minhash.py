import random

import numpy as np
import pytest

from groundmill.llm import minhash
from groundmill.llm.components import connected_components
from groundmill.llm.queries import ORACLE_SQL, QUERIES

from ..compare import assert_same
from ..conftest import DATA
from .helpers import empty, odd


def brute(rows, width, percent):
    """(n_shingles, component) per id by comparing all pairs."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def family(rng, n, size, edits):
    base = [f"w{rng.randrange(400)}" for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(size)] = f"x{rng.randrange(10_000)}"
        out.append(" ".join(w))
    return out


def test_op6_equals_statement(spark):
    assert_same(QUERIES["op6_minhash"](spark, DATA), ORACLE_SQL["op6_minhash"], DATA)


@pytest.mark.parametrize(("width", "seed"), [(2, 1), (5, 2)])
def test_families_equal_all_pairs(spark, width, seed):
    """Copies with few and many edits, so that some link only through others, and chains of small steps."""
    rng = random.Random(seed)
    texts = family(rng, 60, 60, 9) + family(rng, 30, 40, 14) + family(rng, 15, 8, 2) + ["only one", "only one", "a", "", None]
    chain = [f"c{i}" for i in range(60)]
    for i in range(30):
        texts.append(" ".join([f"d{k}" for k in range(i)] + chain[i:]))
    rng.shuffle(texts)
    rows = list(enumerate(texts, 100))
    assert found(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=width)) == brute(rows, width, 80)


def test_block_comparison_finds_what_hubs_miss(spark):
    """With every member still its own component, blocks alone give all links of a family."""
    rng = random.Random(5)
    rows = list(enumerate(family(rng, 40, 50, 8)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sketch = minhash.sketches(docs, "doc_id", "text", 2)
    bands = sketch.selectExpr("doc_id", "explode(bands) AS bucket")
    crowd = bands.join(bands.groupBy("bucket").count().where("count > 1").drop("count"), "bucket")
    left = minhash._apart(crowd, spark.createDataFrame([], "id long, component long"))
    links = {tuple(r) for r in minhash.verified(minhash._block_pairs(left, sketch, 80), docs, 2, 80).collect()}
    sets = dict(zip([i for i, _ in rows], minhash.shingle_sets([t for _, t in rows], 2), strict=True))
    want = {(a, b) for a in sets for b in sets if a < b and 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))}
    distinct = {a for a in sets if not any(b < a and np.array_equal(sets[a], sets[b]) for b in sets)}
    assert {p for p in want if set(p) <= distinct} <= {tuple(sorted(p)) for p in links} | {p for p in want if len(sets[p[0]]) == len(sets[p[1]]) and np.array_equal(sets[p[0]], sets[p[1]])}


def test_a_bucket_of_many_that_differ(spark, monkeypatch):
    """Three thousand members of one bucket, all apart but for a few links: fingerprints leave hardly more pairs than links."""
    monkeypatch.setattr(minhash, "BLOCK", 300)
    rng = random.Random(11)
    texts = [" ".join(f"u{rng.randrange(5000)}" for _ in range(rng.randint(30, 90))) for _ in range(3000)]
    for i in range(0, 60, 3):
        texts[i + 1] = texts[i] + " more"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    sketch = minhash.sketches(docs, "doc_id", "text", 2)
    left = minhash._apart(docs.selectExpr("cast(1 AS long) AS bucket", "doc_id"), spark.createDataFrame([], "id long, component long"))
    pairs = minhash._block_pairs(left, sketch, 80)
    links = {tuple(r) for r in minhash.verified(pairs, docs, 2, 80).collect()}
    assert links == {(i, i + 1) for i in range(0, 60, 3)} and pairs.count() < 5 * len(links)


def test_parity_maps_bound_what_differs():
    rng = np.random.default_rng(3)
    pool = np.unique(rng.integers(0, 2**64 - 1, 4000, dtype=np.uint64))
    for _ in range(300):
        a, b = (np.sort(rng.choice(pool, rng.integers(0, 1500), replace=False)) for _ in range(2))
        x, y = (np.frombuffer(minhash.parity_map(s), np.uint64) for s in (a, b))
        assert int(np.bitwise_count(x ^ y).sum()) <= len(np.setxor1d(a, b))


def test_keep_one_with_clashing_names_and_repeated_ids(spark):
    rows = [(1, "a b c d e f", 7, 8, "k"), (1, "quite another text it is", 7, 8, "k"), (1, "a b c d e f", 7, 8, "k"), (2, "a b c d e f", 7, 8, "k"), (None, "a b c d e f", 7, 8, "k")]
    docs = spark.createDataFrame(rows, "_key long, body string, row int, place int, doc_id string")
    got = minhash.keep_one(docs, "_key", "body")
    assert got.columns == docs.columns
    assert sorted(tuple(r) for r in got.collect()) == [rows[0], rows[1]]


def test_odd_rows(spark):
    rows = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(odd(spark)).collect()}
    assert {(1, 3, 1, True), (2, 3, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (7, 1, 7, True), (None, 3, None, True)} <= rows
    assert minhash.near_duplicates(empty(spark)).count() == 0
    kept = minhash.keep_one(odd(spark))
    assert kept.columns == odd(spark).columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 3, 4, 5, 6, 7, 8, 9]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 2**63, 200, dtype=np.uint64)])
    same = (minhash.signature(np.sort(a)) == minhash.signature(np.sort(b))).mean()
    assert abs(same - 800 / 1200) < 0.12


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(200)] + [(500, 501), (502, 501), (600, 600), (None, 3)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500, 502: 500, 600: 600}
