import hashlib
import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from groundmill.llm import pii
from groundmill.llm.queries import ORACLE_SQL, QUERIES

from ..compare import assert_same
from ..conftest import DATA
from .helpers import empty, odd, odd_rows

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(d) * 2, 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    out = []
    for rank, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), rank, kind, m.end()))
    return [f"{k}:{s}:{e}" for s, _, k, e in sorted(out)]


def secrets(text):
    base = [(int(a), int(b)) for _, a, b in (x.split(":") for x in brute(text))]
    out = []
    for m in re.finditer("[A-Za-z0-9]{20,}", text or ""):
        n = sum(c.isdigit() for c in m.group())
        if n >= 2 and len(m.group()) - n >= 2 and len(set(m.group())) >= 10 and not any(a < m.end() and m.start() < b for a, b in base):
            out.append(f"secret:{m.start()}:{m.end()}")
    return out


def spans(spark, *texts):
    t = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [[f"{s['kind']}:{s['start']}:{s['end']}" for s in r["base"]] for r in pii.find_entities(t, "text").orderBy("doc_id").collect()]


def test_op8_equals_statement(spark):
    assert_same(QUERIES["op8_pii"](spark, DATA), ORACLE_SQL["op8_pii"], DATA)


def test_entities_equal_a_loop(spark):
    texts = [
        "a@b.c_d@e.f x@y", "a.b@c-d.e.f.", "é😀 mail x+y%z@mail.example.org!", "a@b", "a" * 3000 + "@" + "b" * 10, "@a.b", "p@q.r.s@t.u",
        "1.2.3.4 256.1.1.1 01.002.255.0 1.2.3 1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "x4111111111111111x 12", "4111  1111", "1" * 5000,
        "+1 (239) 555-8522", "+49 30 123456", "+1", "+12345678", "+1234567890123456", "++1 23 4567890", "", None,
    ]
    assert spans(spark, *texts) == [brute(t) for t in texts]


def test_labels_leave_the_rest_alone(spark):
    t = spark.createDataFrame([(1, "é: write to a@b.de or +49 30 1234567, not 300.1.1.1.")], "doc_id long, text string")
    assert pii.sanitise(t).first()["sanitised"] == "é: write to [EMAIL] or [PHONE], not 300.1.1.1."


def corpus():
    """An address in three texts that share a word no other text has, and one that many have; and copies of one text."""
    rows = [(i, f"Zorvex met tower{i} and common people at ann@b.org number {i}") for i in range(3)]
    rows += [(10 + i, f"common people met about matter{i}") for i in range(30)]
    rows += [(50 + i, "quillon alone at copy@b.org") for i in range(5)]
    return rows


def test_disclosing_terms(spark):
    rows = corpus()
    got = {r["doc_id"]: r for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    n, n_c = len(rows), 3
    assert math.log(3 * n / (n_c * 3)) >= pii.DISCLOSURE * math.log(n / n_c)  # zorvex
    assert math.log(3 * n / (n_c * 33)) < pii.DISCLOSURE * math.log(n / n_c)  # common
    assert got[0]["sanitised"] == "[TERM] met tower0 [TERM] common people at [EMAIL] [TERM] 0"  # zorvex, and, number; "at" is in a fourth text
    assert [s["kind"] for s in got[0]["spans"]][:1] == ["term"] and len(got[0]["base"]) == 1
    assert got[50]["sanitised"] == "quillon alone at [EMAIL]"  # copies of one text are one observation
    assert got[10]["sanitised"] == rows[3][1]


def test_terms_are_generalised_where_their_class_is_common(spark):
    rows = [(i, f"The mar{'ketzors' if i < 3 else ('gins', 'bles', 'ches')[i % 3]} wrote {'to ann@b.org' if i < 3 else 'again'} on day {'abcdefghijklmnopqrstuvwxyz'[i % 26]}{i}") for i in range(40)]
    got = {r["doc_id"]: r["sanitised"] for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "mar*" in got[0] and "[EMAIL]" in got[0] and got[20] == rows[20][1]


def test_entities_of_one_text_have_terms(spark):
    rows = [(i, f"Zorvex alone wrote with Ono to ann{i}@b.org" if i < 1 else f"people wrote with matter to nobody {i}") for i in range(400)]
    rows += [(1000 + i, "quillon met people by bob@b.org") for i in range(5)] + [(2000 + i, f"vexilla {'abc'[i] * 5} by two@b.org wrote") for i in range(2)]
    got = {r["doc_id"]: r["sanitised"] for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == "[TERM] [TERM] wrote with [TERM] to [EMAIL]"
    assert {got[1000 + i] for i in range(5)} == {"[TERM] [TERM] people by [EMAIL]"}  # copies count once
    assert [got[2000 + i] for i in range(2)] == ["[TERM] [TERM] by [EMAIL] wrote"] * 2
    assert all(got[i] == rows[i][1] for i in range(1, 400))


def test_terms_equal_a_loop(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    texts = {t or "" for _, t in docs}
    found = {t: {f"{k}:{t[int(a):int(b)].lower()}" for k, a, b in (x.split(":") for x in brute(t) + secrets(t))} for t in texts}
    own = {t: set(re.findall(r"[^\W_]+", re.sub(PATTERNS["email"], " ", t).lower())) for t in texts}
    n_t, n_c, n = {}, {}, len(texts)
    for t in texts:
        for w in own[t]:
            n_t[w] = n_t.get(w, 0) + 1
        for e in found[t]:
            n_c[e] = n_c.get(e, 0) + 1
    tells = {}
    for t in texts:
        for e in found[t]:
            for w in own[t]:
                n_ct = sum(e in found[x] and w in own[x] for x in texts if found[x])
                if n_ct / (n_t[w] + 0.5) >= ((n_c[e] + 0.5) / n) ** (1 - pii.DISCLOSURE):
                    tells.setdefault(t, set()).add(w)
    got = {r["doc_id"]: {r["text"][s["start"] : s["end"]].lower() for s in r["spans"] if s["kind"] == "term"} for r in pii.sanitise(spark.createDataFrame(docs, "doc_id long, text string")).where("text IS NOT NULL").collect()}
    assert sum(map(len, got.values())) > 0
    for i, t in docs:
        if t:
            assert got[i] <= tells.get(t, set()) and all(w in got[i] or any(w in e for e in found[t]) for w in tells.get(t, ()))


def test_secrets(spark):
    key = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    texts = [f'x token = "{key}" y', f"{key}@mail.org", "internationalisierungen20 of the thing", "a" * 30 + "12", "1" * 25, "", None, f"é{key} {key}"]
    got = pii.sanitise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [[f"{s['kind']}:{s['start']}:{s['end']}" for s in r["spans"] if s["kind"] == "secret"] for r in got] == [secrets(t) for t in texts]
    assert got[0]["sanitised"] == 'x token = "[SECRET]" y' and got[1]["sanitised"] == "[EMAIL]" and got[6]["sanitised"] is None
    assert [r["base"] for r in got][0] == []


def test_terms_are_found_and_clean_documents_stay(spark):
    """On the test documents: every secret and entity goes, terms stand beside them, and texts without any are as they were."""
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    terms = 0
    for r in pii.sanitise(spark.read.parquet(f"{DATA}/documents.parquet")).collect():
        text = texts[r["doc_id"]] or ""
        if brute(text) or secrets(text):
            terms += sum(s["kind"] == "term" for s in r["spans"])
            assert not brute(r["sanitised"]) and not secrets(r["sanitised"])
        else:
            assert r["spans"] == [] and r["sanitised"] == texts[r["doc_id"]]
    assert terms > 0


def test_clashing_names(spark):
    names = ["row", "lost", "copy", "entities", "secrets", "terms", "word", "entity", "n", "base", "spans"]
    t = spark.createDataFrame([(1, "mail a@b.de now", *names), (2, None, *names), (None, "none here", *names)], "doc_id long, body string, " + ", ".join(f"{n} string" for n in names))
    got = pii.sanitise(t, "body").collect()
    assert all(r[n] == n for r in got for n in names[:-2]) and sorted(str(r["sanitised"]) for r in got) == ["None", "mail [EMAIL] now", "none here"]


def test_odd_rows(spark):
    t = pii.sanitise(odd(spark))
    assert set(t.columns) == {*odd(spark).columns, "base", "spans", "sanitised"} and t.count() == len(odd_rows())
    r = t.where("doc_id = 8").first()
    assert [s["kind"] for s in r["base"]] == ["email", "ip"] and r["sanitised"] == "mail [EMAIL] and [IP] é"
    assert t.where("doc_id = 3").first()["sanitised"] is None
    assert pii.sanitise(empty(spark)).count() == 0


def relabelled(text, found):
    """The text with a label for each span, left to right, none for one that begins before the ones before end."""
    out, at = [], 0
    for s in found:
        if s["start"] >= at:
            short = text[s["start"] : s["end"]]
            term = short[: pii.STEM].lower() + "*" if s["rank"] == pii.SAFE and len(short) > pii.STEM else "[TERM]"
            out += [text[at : s["start"]], term if s["kind"] == "term" else f"[{s['kind'].upper()}]"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def test_very_long_texts_with_entities(spark):
    """200,000 words, 50 entities of each of three kinds, and as many texts without any: equal to a loop, and in time that a square would not meet."""
    rng = random.Random(5)
    words = [rng.choice(("é😀", "mar", "w")) + str(rng.randrange(10**7)) for _ in range(200_000)]
    for k in range(50):
        words[k * 4000 + 7], words[k * 4000 + 900], words[k * 4000 + 3999] = f"a{k}@b.org", f"+49 30 12345{k:03}", f"24be64439e3e49cf46b2d7c9{k:03}"
    long = " ".join(words)
    many = " ".join(f"10.0.{k // 250}.{k % 250} x{k}" for k in range(20_000))
    t = spark.createDataFrame([(i, f"people met about matter {i}") for i in range(200)] + [(1000, long), (1001, many)], "doc_id long, text string")
    since = time.monotonic()
    got = {r["doc_id"]: r for r in pii.sanitise(t).collect()}
    assert time.monotonic() - since < 120  # the square of the length takes more than half an hour here
    for i, text in ((1000, long), (1001, many)):
        assert [f"{s['kind']}:{s['start']}:{s['end']}" for s in got[i]["base"]] == brute(text)
        others = [s for s in got[i]["spans"] if s["kind"] != "term"]
        assert sorted(f"{s['kind']}:{s['start']}:{s['end']}" for s in others) == sorted(brute(text) + secrets(text))
        assert got[i]["sanitised"] == relabelled(text, got[i]["spans"])
        assert sum(s["kind"] == "term" for s in got[i]["spans"]) > 19_000
    assert all(got[i]["sanitised"] == f"people met about matter {i}" for i in range(200))


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 128, 1000])
def test_running_folds_equal_a_loop(spark, n):
    from itertools import accumulate

    rng = random.Random(n)
    numbers = [rng.randrange(50) for _ in range(n)]
    t = spark.createDataFrame([(numbers,)], "x array<int>")
    r = t.select(pii._running(F.col("x"), lambda a, b: a + b).alias("sums"), pii._running(F.col("x"), F.greatest).alias("most")).first()
    assert r["sums"] == list(accumulate(numbers)) and r["most"] == list(accumulate(numbers, max))


def test_apart_equals_a_loop(spark):
    rng = random.Random(9)
    rows, kind = [], pii.SPAN
    for i in range(300):
        main = [(a := rng.randrange(60), rng.randrange(4), "email", a + rng.randrange(1, 9), "") for _ in range(rng.randrange(6))]
        at, others = 0, []
        while (at := at + rng.randrange(1, 8)) < 60:
            others.append((at, pii.RANK["term"], "term", at := at + rng.randrange(1, 5), ""))
        rows.append((i, sorted(main), others))
    t = spark.createDataFrame(rows, f"i int, main {kind}, others {kind}")
    for r in t.withColumn("got", pii._apart(F.col("main"), F.col("others"), "term")).collect():
        want = [*r["main"], *[o for o in r["others"] if not any(m["start"] < o["end"] and o["start"] < m["end"] for m in r["main"])]]
        assert r["got"] == sorted(want)


def test_digest_is_of_the_listed_spans(spark):
    for r in QUERIES["op8_pii"](spark, DATA).where("n_email + n_ip + n_card + n_phone > 0").collect():
        base = ",".join(s for s in r["spans"].split(",") if s.split(":")[0] in PATTERNS)
        assert hashlib.sha256(base.encode()).hexdigest() == r["base_sha256"]


def test_main_path_is_native(spark):
    plan = QUERIES["op8_pii"](spark, DATA)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("digits", ["4111111111111111", "79927398713", "0", "18"])
def test_luhn(spark, digits):
    assert spark.range(1).select(pii._luhn(F.lit(digits))).first()[0] == luhn(digits)
