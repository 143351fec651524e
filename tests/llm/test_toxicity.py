import json
import math
import random
import re
import zlib

from groundmill.llm import toxicity
from groundmill.llm.queries import QUERIES

from ..conftest import DATA
from .helpers import empty, odd, odd_rows


def model(**more):
    return {"words": {"zog": 4.0}, "families": {"brak": 3.0}, "factors": dict(toxicity.FACTORS), "absent": -2.0, "prior": -2.0} | more


def contexts(text):
    return [(k, c) for k, c, _ in toxicity.Grammar(model()).matches(text)]


def test_contexts_come_from_the_composition():
    assert contexts("that zog") == [("ins", "")]
    assert contexts("you zog") == [("ins", "t")]
    assert contexts("not a zog") == [("ins", "n")]
    assert contexts("he said you are no zog") == [("ins", "nrt")]
    assert contexts("he said so. that zog!") == [("ins", "")]
    assert contexts("never ever was anyone such a zog") == [("ins", "")]
    assert contexts("brakest zogs, brak") == [("ins", "")]  # a family needs more than its beginning; a word must be whole
    assert contexts("I will kill you") == [("thr", "t")]
    assert contexts("I will not kill you") == [("thr", "nt")]
    assert contexts("you kill time") == []


def test_scores_follow_weights():
    g = toxicity.Grammar(model())
    assert g.score("you zog") > g.score("a zog") > g.score("no zog") > g.score("peace") == g.score(None) == g.score("")
    assert 0 <= g.score("") < toxicity.THRESHOLD < g.score("a zog") <= 1
    assert g.score("zog " * 5000) <= 1


def planted(n=400):
    """Toxic rows hold one of three new words, or a word of a new family; others none. A third is in the held-out fold or unlabelled."""
    rng, docs, labels = random.Random(9), [], []
    common = [a + b for a in "bcdfglm" for b in ("an", "et", "io", "ulo", "arn", "esk")]
    for i in range(n):
        toxic = i % 4 == 0
        word = ["snarg", "plob", "vrek"][i % 3] if i % 8 else f"gruntl{'abcdefghijkmnop'[i % 15]}x"
        other = [rng.choice(common) for _ in range(12)]
        docs.append((i, " ".join([*other[:6], word if toxic else "peace", *other[6:]])))
        if i % 5:
            labels.append((i, 1, int(toxic)))
    return docs, labels


def test_words_are_learned_and_held_out_rows_found(spark):
    docs, labels = planted()
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    fitted = toxicity.fit(d, lab)
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(d, fitted).collect()}
    assert all((got[i] >= toxicity.THRESHOLD) == (i % 4 == 0) for i, _ in docs)
    # labels of the held-out fold change nothing
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    assert json.loads(toxicity.fit(d, spark.createDataFrame(flipped, "doc_id long, quality int, toxic int"))) == json.loads(fitted)


def test_without_labels_the_fixed_lists_remain(spark):
    docs, _ = planted(20)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    m = json.loads(toxicity.fit(d, none))
    assert set(m["words"]) == set(toxicity.INSULTS) and not m["families"]
    assert toxicity.Grammar(m).score("you idiot") > 0.3 > toxicity.Grammar(m).score("you friend")


def by_clauses(m, text):
    """A score by reading each clause's words from left to right by the rules themselves, without transducers or an index of words."""
    total, found = 0.0, False
    for clause in re.split(r"[.;:!?\n]", (text or "").lower()):
        marks = []  # (kind, negated, reported, place) of insults and threats, and places of targets
        words = re.findall(r"[^\W\d_]+", clause)
        negations = [i for i, w in enumerate(words) if w in toxicity.NEGATIONS]
        said = next((i for i, w in enumerate(words) if w in toxicity.REPORTS), None)
        insults = {}
        for i, w in enumerate(words):
            weight = m["words"].get(w)
            if weight is None:
                weight = next((m["families"][w[:n]] for n in sorted({len(f) for f in m["families"]}, reverse=True) if len(w) > n and w[:n] in m["families"]), None)
            if weight is not None:
                insults[i] = weight
        kind = lambda i: "ins" if i in insults else "thr" if words[i] in toxicity.THREATS else "tgt" if words[i] in toxicity.TARGETS else "neg" if words[i] in toxicity.NEGATIONS else "rep" if words[i] in toxicity.REPORTS else ""  # noqa: E731, B023
        negated = lambda i: any(kind(j) == "neg" and 1 <= i - j <= 3 for j in negations)  # noqa: E731, B023
        reported = lambda i: any(kind(j) == "rep" for j in range(i))  # noqa: E731, B023
        pending = None
        for i in range(len(words)):
            k = kind(i)
            if k == "thr":
                pending = i
            elif k == "tgt":
                if pending is not None and i - pending <= 4:
                    marks.append(("thr", ("n" if negated(pending) else "") + ("r" if reported(pending) else "") + "t", toxicity.SEED_WEIGHT))
                pending = None
            elif k == "ins":
                aimed = any(kind(j) == "tgt" for j in range(max(0, i - 4), i))
                marks.append(("ins", ("n" if negated(i) else "") + ("r" if reported(i) else "") + ("t" if aimed else ""), insults[i]))
        total += sum(w * m["factors"][c] for _, c, w in marks)
        found |= bool(marks)
    z = m["prior"] + (total if found else m["absent"])
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def test_scores_equal_reading_by_the_rules(spark):
    """Every document of the smallest tables with the fitted grammar, and random clauses of all kinds of words."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    fitted = toxicity.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    m, g = json.loads(fitted), toxicity.grammar(fitted)
    got = {r["doc_id"]: r["score"] for r in QUERIES["op7_toxicity"](spark, DATA).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(abs(got[i] - by_clauses(m, t)) < 1e-9 for i, t in texts.items())
    rng, m, g = random.Random(6), model(), toxicity.Grammar(model())
    pool = ["zog", "brakka", "brak", "kill", "you", "not", "said", "idiot", "peace", "a", "the", ".", "!", "über", "zogs", "x1y"]
    for _ in range(3000):
        text = " ".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))
        assert abs(g.score(text) - by_clauses(m, text)) < 1e-9, text


def test_near_copies_of_the_sample_are_one_and_the_smallest_id_stays(spark):
    base = "one two three four five six seven eight nine ten"
    docs = [(5, base), (3, base), (9, base + " eleven"), (7, "one two three but quite another text than those that stand above here"), (4, base)]
    labels = [(i, 1, 0 if i == 4 else 1) for i, _ in docs]
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([x for x in labels if zlib.crc32(str(x[0]).encode()) % 4 != 2], "doc_id long, quality int, toxic int")
    held = {i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2}
    got = sorted(tuple(r) for r in toxicity.labelled_sample(d, lab, "doc_id", "text", 100)[0].collect())
    want, kept = [], {0: [], 1: []}
    shingles = lambda t: {tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)}
    for i, t in sorted(docs):
        k = 0 if i == 4 else 1
        if i not in held and all(len(shingles(t) & shingles(x)) < 0.5 * len(shingles(t) | shingles(x)) for x in kept[k]):
            kept[k].append(t)
            want.append((k, t))
    assert got == sorted(want)


def test_odd_rows(spark):
    fitted = json.dumps(model())
    t = toxicity.score_toxicity(odd(spark), fitted)
    assert t.count() == len(odd_rows()) and dict(t.dtypes)["score"] == "double" and len(t.columns) == len(odd(spark).columns)
    assert t.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert toxicity.score_toxicity(empty(spark), fitted).count() == 0
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (None, 1, 1), (3, None, None), (4, 0, 7)], "doc_id long, quality int, toxic int")
    assert "words" in json.loads(toxicity.fit(odd(spark), labels))


def test_op7_on_held_out_labels(spark):
    """Accuracy on labelled rows of the held-out fold of the smallest tables; the check sizes are far better."""
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    rows = QUERIES["op7_toxicity"](spark, DATA).collect()
    assert len(rows) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and r["predicted"] == int(r["score"] >= 0.3)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.8 * len(held)
