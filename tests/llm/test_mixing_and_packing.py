import hashlib
import itertools
import random

from pyspark.sql import functions as F

from groundmill.llm import mixing, packing
from groundmill.llm.ordering import sums_before
from groundmill.llm.queries import ORACLE_SQL, QUERIES

from ..compare import assert_same
from ..conftest import DATA
from .helpers import empty, odd


def test_op3_equals_statement(spark):
    assert_same(QUERIES["op3_mixing"](spark, DATA), ORACLE_SQL["op3_mixing"], DATA)


def share(budget, nodes):
    """{name: tokens} of siblings (name, weight, cap), by filling the shortest in turn."""
    left, open_, out = budget, list(nodes), {}
    while open_:
        total = sum(w for _, w, _ in open_)
        short = [n for n in open_ if left * n[1] >= n[2] * total]
        if not short:
            upto = 0
            for n, w, _ in sorted(open_, key=lambda n: (n[2] / n[1], n[0])):
                out[n], upto = left * (upto + w) // total - left * upto // total, upto + w
            return out
        name, _, cap = min(short, key=lambda n: (n[2] / n[1], n[0]))
        out[name] = cap
        left -= cap
        open_ = [n for n in open_ if n[0] != name]
    return out


def test_shortages_go_to_siblings_first(spark):
    rng = random.Random(3)
    for budget in (0, 100, 1500, 4000, 10**6):
        leaves = [(f"d{a}", b, f"s{c}", rng.choice([0, 1, 10, 100, 500]) + 1) for a in range(3) for b in ("en", "de") for c in range(3)]
        got = {tuple(r)[:3]: r["share"] for r in mixing.allocate(spark.createDataFrame(leaves, "domain string, lang string, source string, supply long"), list(mixing.LEVELS), budget, mixing.WEIGHTS, 2).collect()}
        want = {}
        weight = lambda level, n: mixing.WEIGHTS.get(level, {}).get(n, 1)
        cap = lambda f: sum(2 * s for *k, s in leaves if k[: len(f)] == list(f))
        tops = sorted({k[0] for k in leaves})
        for d, t in share(budget, [(d, weight("domain", d), cap((d,))) for d in tops]).items():
            for lang, u in share(t, [(x, weight("lang", x), cap((d, x))) for x in ("de", "en")]).items():
                for s, v in share(u, [(x, 1, cap((d, lang, x))) for x in ("s0", "s1", "s2")]).items():
                    want[d, lang, s] = v
        assert got == want


def test_no_token_of_the_budget_is_lost(spark):
    rng = random.Random(9)
    leaves = [(f"d{a}", b, f"s{c}", rng.randint(500, 900)) for a in range(4) for b in ("en", "de", "fr") for c in range(5)]
    t = spark.createDataFrame(leaves, "domain string, lang string, source string, supply long")
    for budget in (997, 12_345, 30_001):
        assert mixing.allocate(t, list(mixing.LEVELS), budget, mixing.WEIGHTS, 2).agg(F.sum("share")).first()[0] == budget


def test_sums_before_in_several_levels(spark, monkeypatch):
    from groundmill.llm import ordering

    monkeypatch.setattr(ordering, "LEVEL", 2)
    monkeypatch.setattr(ordering, "SLICE_ROWS", 4)
    test_sums_before_equal_a_loop(spark)


def test_sums_before_equal_a_loop(spark):
    rng = random.Random(4)
    rows = [(rng.choice("aab"), rng.getrandbits(60), i, rng.randint(1, 9)) for i in range(3000)]
    rows += rows[:5]
    t = spark.createDataFrame(rows, "g string, h long, i long, v long")
    for claimed in (1, 3000, 10**6):  # one slice, a few, more than there are rows
        got = sorted((r["g"], r["h"], r["i"], r["before"], r["v"]) for r in sums_before(t, ["g"], ["h", "i"], "v", "before", claimed).collect())
        want = []
        for g, part in itertools.groupby(sorted(rows), key=lambda r: r[0]):
            at = 0
            for _, h, i, v in part:
                want.append((g, h, i, at, v))
                at += v
        assert got == sorted(want)


def test_mix_keeps_columns_and_repeats(spark):
    t = odd(spark)
    m = mixing.mix(t, percent=250)
    assert m.columns == t.columns and m.where("text IS NULL OR trim(text) = ''").count() == 0
    assert mixing.mix(t.where("doc_id = 7"), percent=300).count() == 3
    assert mixing.mix(empty(spark)).count() == 0
    plan = mixing.mixing_plan(t, "doc_id", "text", percent=100)
    assert plan.agg(F.sum("taken")).first()[0] <= plan.agg(F.sum("n_tokens")).first()[0] * 4


def test_mix_takes_the_prefix_of_its_plan(spark):
    """Rows come in full but for the last one of a leaf, which ends where the plan says; the text before that stays as it is."""
    rng = random.Random(2)
    names = ["id", "plan", "epoch", "repeats", "taken"]
    rows = [(i, "".join(rng.choice([" ", "\n", "\t "]) + f"w{rng.randrange(99)}" for _ in range(rng.randint(1, 30))), rng.choice(["en", "de"]), f"src{i % 6}", i % 5, *names) for i in range(200)]
    t = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string, plan string, epoch string, repeats string, taken string")
    plan = {r["doc_id"]: r["taken"] for r in mixing.mixing_plan(t, "doc_id", "text", percent=130).collect()}
    out, whole = {}, {r[0]: r[1] for r in rows}
    for r in mixing.mix(t, percent=130).collect():
        out.setdefault(r["doc_id"], []).append(r)
    assert set(out) == set(plan)
    short = 0
    for i, found in out.items():
        assert sum(len(r["text"].split()) for r in found) == plan[i]
        for r in found:
            assert [r[n] for n in names] == names
            if r["text"] != whole[i]:
                short += 1
                assert whole[i].startswith(r["text"]) and r["n_chars"] == len(r["text"]) and not r["text"][-1].isspace()
            else:
                assert r["n_chars"] == i % 5
    assert 0 < short <= 12


def test_prefix_is_of_a_seeded_order(spark):
    rows = [(i, "w " * 10, "en", "src1") for i in range(50)]
    plan = mixing.mixing_plan(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), "doc_id", "text", percent=45)
    want = sorted(range(50), key=lambda i: hashlib.md5(f"17:0:{i}".encode()).hexdigest()[:15])[:23]
    assert {r["doc_id"]: r["taken"] for r in plan.collect()} == {i: 10 if k < 22 else 5 for k, i in enumerate(want)}


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts, strict=True))


def test_bounds_are_optimal():
    rng = random.Random(5)
    for _ in range(40):
        lengths = sorted(rng.sample(range(1, 40), rng.randint(1, 9)))
        counts = [rng.randint(1, 30) for _ in lengths]
        for k in (1, 2, 3, 12):
            got = packing.optimal_bounds(lengths, counts, k)
            best = min(padding(lengths, counts, [*some, lengths[-1]]) for n in range(min(k, len(lengths))) for some in itertools.combinations(lengths[:-1], n))
            assert len(got) <= k and got[-1] == lengths[-1] and padding(lengths, counts, got) == best
    assert packing.optimal_bounds([], [], 3) == []


def check_packing(rows, pieces, max_length, batch_tokens):
    by_id = {}
    for p in pieces:
        by_id.setdefault((p["doc_id"], p["piece"]), []).append(p)
        assert p["length"] <= p["bucket"] and p["start"] == p["piece"] * max_length
    total = sum(n or 0 for _, n in rows)
    assert sum(p["length"] for p in pieces) == total
    batches = {}
    for p in pieces:
        batches.setdefault((p["bucket"], p["batch"]), []).append(p["slot"])
    for (bucket, batch), slots in batches.items():
        held = max(1, batch_tokens // bucket)
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= held
        if (bucket, batch + 1) in batches:
            assert len(slots) == held


def test_packing_covers_all_tokens(spark):
    rng = random.Random(6)
    rows = [(i % 180, rng.choice([0, 1, 3, 7, 20, 21, 64, 65, 300, None])) for i in range(200)] + [(None, 5)]
    t = spark.createDataFrame(rows, "doc_id long, n long")
    check_packing(rows, packing.pack(t, "doc_id", "n", max_length=64, buckets=4, batch_tokens=130).collect(), 64, 130)
    assert packing.pack(t.where("false"), "doc_id", "n").count() == 0


def test_op10_on_all_documents(spark):
    texts = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r["doc_id"], len(r["text"].split())) for r in texts]
    got = QUERIES["op10_packing"](spark, DATA).collect()
    check_packing(rows, got, packing.MAX_LENGTH, packing.BATCH_TOKENS)
    lengths, counts = zip(*sorted({n: sum(p["length"] == n for p in got) for n in {p["length"] for p in got}}.items()), strict=True)
    assert sum(p["bucket"] - p["length"] for p in got) == padding(lengths, counts, packing.optimal_bounds(list(lengths), list(counts), packing.BUCKETS))
