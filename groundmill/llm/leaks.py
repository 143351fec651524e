"""Passages of benchmark items in documents, found by one Aho-Corasick automaton over words.

Texts are words in lower case; a window is ``WINDOW`` consecutive words of an item, or the whole item where it has
fewer. The automaton holds every window as a sequence of word numbers, so that a text is read once, whatever the
number of items, and each hit is mapped back to code points of the original text. Items are cut into pieces of a
bounded length that overlap by a window less a word; where all of them together exceed ``MOST_WORDS``, pieces are
dealt into several automata of that size, which read the texts in turn.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from .shared import cut, discard, documents
from .terms import WORD, as_bytes, sql_words, words_column, words_of

WINDOW = 10
#: Words of items that one automaton holds at most, on average (about 0.5 KB each), and of a piece of an item.
MOST_WORDS, PIECE = 1 << 17, 1 << 12
HITS = "struct<n_words: long, runs: array<struct<first: int, last: int>>, items: array<string>, spans: array<struct<start: int, end: int>>>"
_WORDS = regex.compile(WORD.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60"))  # of texts whose capitals stand as they are


class Windows:
    """The automaton of some pieces [(item, words)]."""

    def __init__(self, pieces: list[tuple[str | None, list[bytes]]], width: int) -> None:
        self.number: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, words in pieces:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words]
            for i in range(max(1, len(ids) - width + 1)):
                found = owners.setdefault(tuple(ids[i : i + width]), set())
                if item is not None:
                    found.add(item)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, items in owners.items():
            self.machine.add_word(window, (len(window), tuple(items)))
        if owners:  # an automaton of nothing can't be asked
            self.machine.make_automaton()

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs (first, last) of hit words in order, which do not touch or overlap, and the items met."""
        runs: list[list[int]] = []
        items: set[str] = set()
        if not self.number:
            return [], items
        ids = tuple(map(self.number.get, words, repeat(0)))
        for last, (n, own) in self.machine.iter(ids):
            first = last - n + 1
            # ends come in order; a longer window may begin before runs that shorter ones have left
            while runs and runs[-1][0] >= first:
                runs.pop()
            if runs and runs[-1][1] >= first - 1:
                runs[-1][1] = last
            else:
                runs.append([first, last])
            items.update(own)
        return [(a, b) for a, b in runs], items


def _merged(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(a + b):
        if out and first <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(last, out[-1][1])
        else:
            out.append((first, last))
    return out


def _spans(text: str, runs: list[tuple[int, int]]) -> list[dict]:
    """Code points from each run's first word to its last, end exclusive."""
    at = [m.span() for m in _WORDS.finditer(text)]
    return [{"start": at[a][0], "end": at[b][1]} for a, b in runs]


def pieces_of(items: DataFrame, key: str, text: str, width: int, piece: int = PIECE) -> DataFrame:
    """(item, words) of all items with words, cut into pieces of ``piece`` windows at most."""
    words = items.select(F.col(key).cast("string").alias("item"), words_column(F.col(text)).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (width - 1)), F.lit(piece))
    return words.select("item", "words", F.explode(starts).alias("start")).select("item", F.slice("words", F.col("start"), F.lit(piece + width - 1)).alias("words"))


def _scan(docs: DataFrame, text: str, out: str, pieces: list[tuple[str | None, list[bytes]]], width: int) -> DataFrame:
    """``docs`` with hits of these pieces in ``out``, together with those that it holds."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(pieces)  # MOST_WORDS words or so
    schema = StructType([*docs.schema.fields, *([] if out in docs.columns else [StructField(out, DataType.fromDDL(HITS))])])

    def one(windows: Windows, data: bytes, old: dict | None) -> dict:
        words = words_of(data)
        runs, items = windows.find(words)
        if old is not None:
            if not runs:
                return old
            runs, items = _merged([(r["first"], r["last"]) for r in old["runs"]], runs), items.union(old["items"])
        spans = _spans(data.decode("utf-8", "replace"), runs) if runs else []
        return {"n_words": len(words), "runs": [{"first": a, "last": b} for a, b in runs], "items": sorted(items), "spans": spans}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = None
        for batch in batches:
            windows = windows or Windows(shared.value, width)
            data = batch.column(batch.schema.get_field_index(text))
            step = max(1, min(1024, int(len(batch) * (16 << 20) / max(1, data.nbytes))))
            for i in range(0, len(batch), step):
                part = batch.slice(i, step)
                old = part.column(part.schema.get_field_index(out)) if out in part.schema.names else repeat(None)
                found = [one(windows, x.as_py(), o and o.as_py()) for x, o in zip(as_bytes(data.slice(i, step)), old)]
                keep = [n for n in part.schema.names if n != out]
                yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(n)) for n in keep], pa.array(found, kind)], [*keep, out])

    kind = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
    return docs.mapInArrow(run, schema)


def find_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", width: int = WINDOW, most_words: int = MOST_WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items``, ``spans`` and ``contaminated``; columns of these names are replaced.

    ``n_hit`` are words inside an occurrence of a window, ``items`` the ids, as strings and sorted, whose windows occur,
    ``spans`` the runs of such words as code points of the text. A null text has no words; an item without words
    has no window. An item that repeats an id adds to its windows; one without an id hits words, but is no item to list.
    """
    names = ["n_words", "n_hit", "items", "spans", "contaminated"]
    rows = docs.select(F.struct(*[c for c in docs.columns if c not in names]).alias("row"), F.col(text).alias("text"))
    pieces = pieces_of(items, item_key, item_text, width)
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    groups = max(1, math.ceil(total / most_words))
    dealt = pieces if groups == 1 else pieces.withColumn("group", F.pmod(F.xxhash64("item", "words"), F.lit(groups)))
    if groups > 1:
        dealt = cut(dealt, "item-pieces")
    for g in range(groups):
        own = dealt.collect() if groups == 1 else dealt.where(F.col("group") == g).collect()
        found = _scan(rows, "text", "hits", [(r["item"], [w.encode() for w in r["words"]]) for r in own], width)
        if g + 1 < groups:
            found = cut(found, "hits")  # one automaton in a worker at a time
            if g:
                discard(rows)
            rows = found
    if groups > 1:
        discard(dealt)
    n_hit = F.aggregate("hits.runs", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    values = {"n_words": F.col("hits.n_words"), "n_hit": n_hit, "items": F.col("hits.items"), "spans": F.col("hits.spans"), "contaminated": F.size("hits.runs") > 0}
    return found.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in names], *[v.alias(n) for n, v in values.items()])


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every text of ``documents``: words, words hit, items and their digest."""
    found = find_leaks(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


#: Windows by their number of words; each is looked for as text at every place of every document.
OP12_SQL = f"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item, {sql_words("text")} AS w FROM benchmark),
windows AS (SELECT DISTINCT item, least(len(w), {WINDOW}) AS n, array_to_string(w[k:k + least(len(w), {WINDOW}) - 1], ' ') AS t FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - {WINDOW - 1}) + 1)) AS k FROM i WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS row, doc_id, coalesce({sql_words("text")}, []) AS w FROM documents),
places AS (SELECT row, unnest(range(1, len(w) + 1)) AS k, w FROM d),
grams AS (SELECT row, k, n, array_to_string(w[k:k + n - 1], ' ') AS t FROM places, (SELECT DISTINCT n FROM windows) WHERE k + n - 1 <= len(w)),
met AS (SELECT DISTINCT row, k, windows.n, item FROM grams JOIN windows ON grams.n = windows.n AND grams.t = windows.t),
hit AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT row, k, n FROM met)) GROUP BY row),
named AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT row, item FROM met) WHERE item IS NOT NULL GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (row) LEFT JOIN named USING (row)
"""
