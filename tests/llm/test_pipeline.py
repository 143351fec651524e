import hashlib
import json
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from groundmill.llm import mixing, toxicity
from groundmill.llm.queries import QUERIES
from groundmill.llm.shared import cut

from ..conftest import DATA
from .test_minhash import brute
from .test_mixing_and_packing import check_packing, share
from .test_pii import PATTERNS, secrets
from .test_pii import brute as entities


@pytest.fixture(scope="module")
def stages(spark):
    """Input and result of each stage over the smallest tables."""
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), []
    for name, f in pipeline.STAGES:
        result = cut(f(spark, docs, DATA), f"test-{name}")
        out.append((docs, result))
        docs = result
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_columns(stages):
    assert all(after.columns == pipeline.COLUMNS for _, after in stages[:-1])


def test_toxicity_drops_what_the_grammar_rejects(spark, stages):
    before, after = stages[0]
    model = toxicity.Grammar(json.loads(toxicity.fit(before, spark.read.parquet(f"{DATA}/labels.parquet"))))
    assert ids(after) == sorted(r["doc_id"] for r in before.collect() if model.score(r["text"]) < toxicity.THRESHOLD)


def test_one_of_each_group_stays(stages):
    before, after = stages[1]
    groups = brute([(r["doc_id"], r["text"]) for r in before.collect()], 5, 80)
    assert ids(after) == sorted(i for i, (_, c) in groups.items() if i == c)


def test_all_documents_are_sanitised(stages):
    before, after = stages[2]
    assert ids(before) == ids(after)
    old = {r["doc_id"]: r["text"] for r in before.collect()}
    for r in after.collect():
        assert r["n_chars"] == len(r["text"]) and "@" not in r["text"]
        if "[" not in r["text"]:
            assert r["text"] == old[r["doc_id"]]


def sanitised(texts):
    """{text: what the second kind of reading makes of it} for all different texts, by loops over counts."""
    spans = {t: [(int(a), int(b), k) for k, a, b in (x.split(":") for x in entities(t) + secrets(t))] for t in texts}
    found = {t: {f"{k}:{t[a:b].lower()}" for a, b, k in spans[t]} for t in texts}
    words = {t: set(re.findall(r"[^\W_]+", re.sub(PATTERNS["email"], " ", t).lower())) for t in texts}
    n_t, n_k, n_c, n_ct, n_ck, n = Counter(), Counter(), Counter(), Counter(), Counter(), len(texts)
    for t in texts:
        n_t.update(words[t])
        n_k.update(w[:3] for w in words[t])
        n_c.update(found[t])
        n_ct.update((e, w) for e in found[t] for w in words[t])
        n_ck.update((e, w[:3]) for e in found[t] for w in words[t])
    ic = lambda e: math.log(n / (n_c[e] + 0.5))
    tells = lambda e, both, own: ic(e) > 0 and math.log(both * n / ((n_c[e] + 0.5) * (own + 0.5))) >= 0.9 * ic(e)
    out = {}
    for t in texts:
        marks = list(spans[t])
        for m in re.finditer(r"[^\W_]+", t):
            w = m.group().lower()
            by = [e for e in found[t] if n_ct[e, w] and tells(e, n_ct[e, w], n_t[w])]
            if by and not any(a < m.end() and m.start() < b for a, b, _ in spans[t]):
                safe = all(not tells(e, n_ck[e, w[:3]], n_k[w[:3]]) for e in by)
                marks.append((m.start(), m.end(), f"{w[:3]}*" if safe and len(w) > 3 else "[TERM]"))
        at, text = 0, ""
        for a, b, k in sorted(marks, key=lambda x: (x[0], [*PATTERNS, "secret"].index(x[2]) if x[2] in [*PATTERNS, "secret"] else 9)):
            if a >= at:
                text += t[at:a] + (k if k[-1] in "*]" else f"[{k.upper()}]")
            at = max(at, b)
        out[t] = text + t[at:]
    return out


def test_personal_data_equals_a_loop(stages):
    before, after = stages[2]
    old = {r["doc_id"]: r["text"] for r in before.collect()}
    want = sanitised(set(old.values()))
    got = {r["doc_id"]: r["text"] for r in after.collect()}
    assert got == {i: want[t] for i, t in old.items()} and any("*" in t for t in got.values())


def mixed(rows):
    """Counter of (doc_id, text) that the tree of budgets chooses from ``rows`` (doc_id, text, lang, source)."""
    leaves = {}
    for i, text, lang, source in rows:
        n = len(text.split())
        if n:
            number = re.search("[0-9]+", source or "")
            leaf = (f"d{int(number[0]) % 4}" if number else "d3", lang or "(none)", source or "(none)")
            leaves.setdefault(leaf, []).append((i, text, n))
    supply = {leaf: sum(n for _, _, n in rs) for leaf, rs in leaves.items()}
    given = {(): sum(supply.values()) * 60 // 100}
    for depth in (1, 2, 3):
        for above in sorted({leaf[: depth - 1] for leaf in supply}):
            nodes = sorted({leaf[:depth] for leaf in supply if leaf[: depth - 1] == above})
            weight = lambda node, level=mixing.LEVELS[depth - 1]: mixing.WEIGHTS.get(level, {}).get(node[-1], 1)
            cap = lambda node: sum(4 * n for leaf, n in supply.items() if leaf[: len(node)] == node)
            for name, n in share(given[above], [(node[-1], weight(node), cap(node)) for node in nodes]).items():
                given[(*above, name)] = n
    out = Counter()
    for leaf, rs in leaves.items():
        full, prefix = divmod(given[leaf], supply[leaf])
        before = 0
        for i, text, n in sorted(rs, key=lambda r: (hashlib.md5(f"17:{full}:{r[0]}".encode()).hexdigest()[:15], r[0], r[2])):
            if full:
                out[i, text] += full
            part = min(n, prefix - before)
            if part > 0:
                out[i, text if part == n else re.match(rf"\s*(?:\S+\s+){{{part - 1}}}\S+", text)[0]] += 1
            before += n
    return out


def test_mixing_equals_a_loop(stages):
    before, after = stages[3]
    assert Counter((r["doc_id"], r["text"]) for r in after.collect()) == mixed([(r["doc_id"], r["text"], r["lang"], r["source"]) for r in before.collect()])
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_mixing_and_packing(stages):
    before, after = stages[3]
    assert set(ids(after)) <= set(ids(before))
    check_packing([(r["doc_id"], len(r["text"].split())) for r in stages[4][0].collect()], stages[4][1].collect(), 4096, 65_536)


def test_run_gives_the_last_stage(spark, stages):
    want = sorted(tuple(r) for r in stages[-1][1].collect())
    assert sorted(tuple(r) for r in pipeline.run(spark, DATA).collect()) == want
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is pipeline.run and set(QUERIES) <= set(entry.queries())


def test_odd_documents_pass(spark):
    from .helpers import empty, odd

    for docs in (odd(spark), empty(spark)):
        for name, f in pipeline.STAGES:
            docs = cut(f(spark, docs, DATA), f"odd-{name}")
        assert docs.where(F.col("length") > F.col("bucket")).count() == 0
