"""Toxicity by a weighted grammar of finite-state transducers over clauses.

Tokens of a clause become symbols (insult, threat, target, negation, reporting verb, other). Three
transducers mark what follows a negation, what stands in reported speech and what meets a target; their
composition reads a clause once. Each marked insult or threat adds its own weight times a factor of its
context, and a document's score is the logistic of its prior and the sum over matched clauses.

Which words insult, and how much, is learned: besides a short fixed list, words and families of words with a
common beginning are picked by sequential covering of toxic documents in a bounded, labelled sample.
"""

from __future__ import annotations

import bisect
import functools
import json
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut, documents, map_column

#: Rows of each label that the grammar is fitted on, at most; the ones with the smallest hashes of their ids.
SAMPLE = 6_000
#: Labelled texts of one label that share so much of their three-word shingles are one observation.
NEAR = 0.5
THRESHOLD = 0.3
#: A family is all words that begin so.
FAMILY = (4, 5, 6)
#: Toxic documents, counted by what earlier picks left of them, that a pick needs.
LEAST, SHARE = 4, 0.004
PURE, SURE = 3.0, 5.0  # least log-likelihood ratio of a pick, and of one that some other document holds
DECAY = 0.75  # weight that a document keeps at each pick it holds
#: Fixed lists.
INSULTS = "idiot idiots moron morons stupid scum trash loser losers pathetic worthless disgusting clown imbecile dumb filthy vermin".split()
THREATS = "kill hurt destroy beat stab shoot burn hang crush".split()
TARGETS = "you your yours he him his she her they them their people du dich ihr euch er sie tu vous toi il elle ils usted tú él ella ellos".split()
NEGATIONS = "not no never neither nor without nicht kein keine nie ne pas jamais sin nunca jamás".split()
REPORTS = "said says say wrote writes claimed claims called calls quoted reported sagte schrieb dit écrit dijo escribió".split()
#: Factors that a context starts from before the sample is seen: n negated, r reported, t aimed at a target.
FACTORS = {"": 1.0, "t": 1.2, "n": 0.5, "r": 0.7, "nr": 0.4, "nt": 0.6, "rt": 0.8, "nrt": 0.5}
SEED_WEIGHT = 3.0
_CLAUSE_END = re.compile(r"[.;:!?\n]")
_TOKEN = re.compile(r"[^\W\d_]+")


class Transducer:
    """Deterministic: ``step(state, symbol)`` gives the next state and the symbol that is written."""

    def __init__(self, start, step) -> None:
        self.start, self.step = start, step

    def compose(self, after: Transducer) -> Transducer:
        """What this one writes is read by ``after``."""

        def step(state, symbol):
            a, middle = self.step(state[0], symbol)
            b, out = after.step(state[1], middle)
            return (a, b), out

        return Transducer((self.start, after.start), step)

    def table(self, symbols: list) -> tuple[list[list[tuple[int, object]]], int]:
        """Reachable states as rows of (next row, output) per symbol."""
        states, rows = {self.start: 0}, []
        todo = [self.start]
        while todo:
            state = todo.pop(0)
            row = []
            for s in symbols:
                new, out = self.step(state, s)
                if new not in states:
                    states[new] = len(states)
                    todo.append(new)
                row.append((states[new], out))
            rows.append(row)
        return rows, 0


def _negation(reach: int = 3) -> Transducer:
    def step(left: int, symbol: tuple):
        if symbol[0] == "neg":
            return reach, symbol
        marked = (symbol[0], symbol[1] + "n") if left and symbol[0] in ("ins", "thr") else symbol
        return max(0, left - 1), marked

    return Transducer(0, step)


def _reported() -> Transducer:
    def step(on: bool, symbol: tuple):
        if symbol[0] == "rep":
            return True, symbol
        return on, (symbol[0], symbol[1] + "r") if on and symbol[0] in ("ins", "thr") else symbol

    return Transducer(False, step)


def _target(reach: int = 4) -> Transducer:
    """An insult near a target before it is marked; a threat counts only if a target follows, and is written there."""

    def step(state: tuple, symbol: tuple):
        left, pending, context = state
        if symbol[0] == "tgt":
            return (reach, 0, ""), ("thr", context + "t") if pending else symbol
        later = (max(0, left - 1), max(0, pending - 1), context if pending > 1 else "")
        if symbol[0] == "thr":
            return (later[0], reach, symbol[1]), ("oth", "")
        if symbol[0] == "ins" and left:
            return later, ("ins", symbol[1] + "t")
        return later, symbol

    return Transducer((0, 0, ""), step)


SYMBOLS = [("oth", ""), ("ins", ""), ("thr", ""), ("tgt", ""), ("neg", ""), ("rep", "")]


class Grammar:
    """A fitted grammar: ``model`` has words, families, factors, prior and what the absence of matches tells."""

    def __init__(self, model: dict) -> None:
        import ahocorasick

        self.model = model
        self.words: dict[str, float] = model["words"]
        self.families: dict[str, float] = model["families"]
        self.sizes = sorted({len(f) for f in self.families}, reverse=True)
        self.kinds = {w: k for k, ws in ((3, TARGETS), (4, NEGATIONS), (5, REPORTS)) for w in ws} | {w: 2 for w in THREATS}
        self.rows, self.start = _negation().compose(_reported()).compose(_target()).table(SYMBOLS)
        self.finder = ahocorasick.Automaton()
        for w in {*self.words, *THREATS}:
            self.finder.add_word(w, len(w))
        for f in self.families:
            self.finder.add_word(f, -len(f))
        self.finder.make_automaton()

    def weight(self, token: str) -> float | None:
        w = self.words.get(token)
        if w is None:
            for n in self.sizes:
                w = self.families.get(token[:n]) if len(token) > n else None
                if w is not None:
                    break
        return w

    def clauses(self, text: str) -> Iterator[list[str]]:
        """Tokens of the clauses in which a listed word or family stands."""
        hits = set()
        n = len(text)
        for end, size in self.finder.iter(text):
            start = end + 1 - abs(size)
            if (not start or not text[start - 1].isalpha()) and (size < 0 or end + 1 == n or not text[end + 1].isalpha()):
                hits.add(start)
        if hits:
            ends = [m.start() for m in _CLAUSE_END.finditer(text)]
            for k in sorted({bisect.bisect_left(ends, h) for h in hits}):
                yield _TOKEN.findall(text, ends[k - 1] + 1 if k else 0, ends[k] if k < len(ends) else n)

    def matches(self, text: str) -> Iterator[tuple[str, str, float]]:
        """(kind, context, weight) of each marked insult or threat."""
        for tokens in self.clauses(text.lower()):
            state = self.start
            for token in tokens:
                w = self.weight(token)
                symbol = 1 if w is not None else self.kinds.get(token, 0)
                state, (kind, context) = self.rows[state][symbol]
                if kind == "ins" or (kind == "thr" and "t" in context):
                    yield kind, "".join(c for c in "nrt" if c in context), w if kind == "ins" else SEED_WEIGHT

    def score(self, text: str | None) -> float:
        m, total, found = self.model, 0.0, False
        for _, context, w in self.matches(text or ""):
            total, found = total + w * m["factors"][context], True
        z = m["prior"] + (total if found else m["absent"])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


@functools.lru_cache(maxsize=2)
def grammar(model: str) -> Grammar:
    return Grammar(json.loads(model))


def _features(text: str) -> set[str]:
    words = {w for w in _TOKEN.findall(text.lower()) if len(w) > 2}
    return words | {w[:n] + "*" for w in words for n in FAMILY if len(w) > n}


def _shingles(text: str) -> set[int]:
    w = text.lower().split()
    return {xxhash.xxh3_64_intdigest(" ".join(w[i : i + 3])) >> 1 for i in range(max(1, len(w) - 2))}


def _thinned(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows by ascending id without those that share ``NEAR`` of their shingles with one that stays."""
    kept, held = [], []
    for i, text in zip(rows.index, rows["text"], strict=True):
        own = _shingles(text)
        if all(len(own & x) < NEAR * len(own | x) for x in held):
            kept.append(i)
            held.append(own)
    return rows.loc[kept, ["toxic", "text"]]


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, sample: int) -> tuple[DataFrame, float]:
    """(toxic, text) of at most ``sample`` rows a label, one for each set of near copies; and the share of toxic rows.

    Texts whose smallest shingle is the same are compared, and of near copies the one with the smallest id (then
    the smaller text) stays. Rows that repeat an id are rows of their own here.
    """
    train = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1) AND crc32(cast(doc_id AS string)) % 4 <> 2").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    train = cut(train, "train")
    counts = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    some = [train.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for t in (0, 1)]
    chosen = some[0].unionByName(some[1]).select(F.col("doc_id").alias("_id"), "toxic")
    # at most 2 * sample rows of two numbers are broadcast
    rows = docs.select(F.col(key).cast("long").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), "_id").select("_id", "toxic", "text")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([min(_shingles(t)) for t in b.column(2).to_pylist()], pa.int64())], ["id", "toxic", "text", "near"])

    rows = rows.mapInArrow(keyed, "id long, toxic int, text string, near long")
    # the sample bounds each of these groups
    rows = rows.groupBy("toxic", "near").applyInPandas(lambda g: _thinned(g.sort_values(["id", "text"])), "toxic int, text string")
    return cut(rows, "sample"), counts.get(1, 0) / max(1, sum(counts.values()))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> str:
    """Fit the grammar and return it as JSON.

    Rows whose id has a crc32 of remainder 2 by 4 are never learned from. Without labelled rows the fixed
    lists and a prior of one in ten remain. What is learned from, and what reaches the driver of it, is bounded by
    ``sample`` alone.
    """
    rows, share = labelled_sample(docs, labels, key, text, sample)
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    need = max(LEAST, math.ceil(SHARE * n1))

    def ratio(a: float, b: float) -> float:
        return math.log((a + 0.5) / (n1 + 1)) - math.log((b + 0.5) / (n0 + 1))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            names = [*both[0], *(f for f in both[1] if f not in both[0])]
            out = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([both[1][f] for f in names], pa.int64()), pa.array([both[0][f] for f in names], pa.int64())], ["feature", "n1", "n0"])
            both[0].clear()
            both[1].clear()
            return out

        for b in batches:
            for t, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                both[t].update(_features(x))
                if len(both[0]) + len(both[1]) > 500_000:
                    yield flush()
        yield flush()

    counts = rows.mapInArrow(counted, "feature string, n1 long, n0 long").groupBy("feature").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    odds = F.log((F.col("n1") + 0.5) / (n1 + 1)) - F.log((F.col("n0") + 0.5) / (n0 + 1))
    good = counts.where((F.col("n1") >= need) & (odds >= PURE) & ((F.col("n0") == 0) | (odds >= SURE)))
    stats = {r["feature"]: (r["n1"], r["n0"]) for r in sorted(good.collect(), key=lambda r: (-r["n1"], r["feature"]))}
    index = {f: i for i, f in enumerate(stats)}

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([[index[f] for f in sorted(_features(x)) if f in index] for x in b.column(1).to_pylist()], pa.list_(pa.int32()))], ["features"])

    held = [r["features"] for r in rows.where("toxic = 1").mapInArrow(present, "features array<int>").collect()]
    picks = _cover(held, list(stats), np.array([ratio(*stats[f]) for f in stats]), need)
    words = {w: SEED_WEIGHT for w in INSULTS} | {f: ratio(*stats[f]) for f in picks if f[-1] != "*"}
    model = {"words": words, "families": {f[:-1]: ratio(*stats[f]) for f in picks if f[-1] == "*"}, "factors": dict(FACTORS), "absent": 0.0}
    share = min(0.5, max(0.01, share)) if n1 and n0 else 0.1
    model["prior"] = math.log(share / (1 - share))
    first = json.dumps(model)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = grammar(first)
        for b in batches:
            found = [sorted({c for _, c, _ in g.matches(x)}) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c or ["absent"] for c in found], pa.list_(pa.string()))], ["toxic", "context"])

    seen = rows.mapInArrow(contexts, "toxic int, context array<string>").select("toxic", F.explode("context").alias("context")).groupBy("toxic", "context").count()
    by = {(r["toxic"], r["context"]): r["count"] for r in seen.collect()}
    model["absent"] = min(0.0, ratio(by.get((1, "absent"), 0), by.get((0, "absent"), 0)))
    plain = ratio(by.get((1, ""), 0), by.get((0, ""), 0))
    for c in FACTORS:
        a, b = by.get((1, c), 0), by.get((0, c), 0)
        if c and plain > 0 and a + b:
            # the sample's own ratio, against ten documents' worth of the starting factor
            model["factors"][c] = ((a + b) * max(0.0, min(1.3, ratio(a, b) / plain)) + 10 * FACTORS[c]) / (a + b + 10)
    return json.dumps(model)


def _cover(held: list[list[int]], names: list[str], odds: np.ndarray, need: int) -> list[str]:
    """Features in order of the toxic documents they explain; each pick lowers the weight of the documents it is in.

    A pick needs ``need`` documents, and half as much weight left: what only repeats earlier picks drops out.
    Of equals the longer name wins.
    """
    if not names or not held:
        return []
    doc = np.repeat(np.arange(len(held)), [len(h) for h in held])
    feature = np.array([f for h in held for f in h], np.int64)
    order = np.argsort(feature, kind="stable")
    doc, begins = doc[order], np.searchsorted(feature[order], np.arange(len(names) + 1))
    weight = np.ones(len(held))
    longer = np.array([len(n) for n in names]) * 0.03
    mass = np.bincount(feature, weights=weight[np.repeat(np.arange(len(held)), [len(h) for h in held])], minlength=len(names))
    picked: list[str] = []
    while True:
        best = int(np.argmax(mass * odds * (1 + longer)))
        if mass[best] < need / 2:
            break
        picked.append(names[best])
        ds = doc[begins[best] : begins[best + 1]]
        for d in ds:
            loss = weight[d] * (1 - DECAY)
            weight[d] -= loss
            mass[held[d]] -= loss
        mass[best] = -1e9
    return picked


def score_toxicity(docs: DataFrame, model: str, text: str = "text", score: str = "score") -> DataFrame:
    """Add ``score`` (0 to 1) to every row; null and empty texts get the score of a text without matches. A column of that name is replaced."""
    def make(texts: pa.Array) -> pa.Array:
        g = grammar(model)
        return pa.array([g.score(t) for t in texts.to_pylist()], pa.float64())

    return map_column(docs, text, score, "double", make)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every text of ``documents``, learned from labels outside the held-out fold."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
