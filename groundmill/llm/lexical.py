"""Ranked lexical search by sorting: every item against all documents.

Words of items are numbered; one pass over the documents keeps, per document, its length and the numbers and counts
of the items' words that it holds. Corpus counts come from these. Documents are then parted into ranges of their
ids; a task turns its postings into (item, document, impact) arrays, brings equal (item, document) keys together by a
radix sort of packed integers, sums their impacts with ``reduceat`` and keeps the best of each item in a heap. Only
those few meet the other tasks' by item.

The score is integral: a word's weight is w = floor(1000 ln((2N + 2) / (2df + 1))), its impact in a document
w * (10^9 tf div (1000 tf + 8 m)) with m = 10 + (90 n N div L), for N documents with words, L words in all of them and n
in this one.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, LongType, StructField, StructType

from .shared import cut, documents, mark, parallelism, release
from .terms import as_bytes, sql_words, words_column, words_of

K = 10
#: Different (item, word) pairs that are searched for in one pass over the documents.
MOST_TERMS = 1 << 18
#: Entries of the arrays that are sorted at once, about.
ENTRIES = 1 << 20
#: Tasks whose best rows meet in one group before those of all meet.
FAN_IN = 64


def radix_order(keys: np.ndarray) -> np.ndarray:
    """The stable order of unsigned 64-bit ``keys``: numpy sorts 16-bit digits by counting, from the lowest up."""
    order = np.argsort((keys & np.uint64(0xFFFF)).astype(np.uint16), kind="stable")
    top, shift = int(keys.max(initial=0)), 16
    while top >> shift:
        digit = ((keys[order] >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
        order = order[np.argsort(digit, kind="stable")]
        shift += 16
    return order


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and the sums of their values."""
    if not len(keys):
        return keys, values
    order = radix_order(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(values[order], first)


def _postings(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, tfs) of documents (id, text) with words: how many they have, and numbers and counts of those in ``number``."""
    shared = docs.sparkSession.sparkContext.broadcast(number)  # MOST_TERMS words at most
    kind = [pa.list_(pa.int32()), pa.list_(pa.int32())]

    def some(ids: pa.Array, texts: pa.Array, of: dict[bytes, int]) -> pa.RecordBatch:
        lengths, parts, rows = [], [], []
        for i, x in enumerate(texts):
            words = words_of(x.as_py())
            lengths.append(len(words))
            own = np.fromiter(map(of.get, words, repeat(-1)), np.int64, len(words))
            parts.append(own[own >= 0])
            rows.append(np.full(len(parts[-1]), i, np.int64))
        keys = (np.concatenate(rows) << 32 | np.concatenate(parts)).astype(np.uint64)
        keys, tfs = summed(keys, np.ones(len(keys), np.int32))
        ends = np.searchsorted(keys >> np.uint64(32), np.arange(len(lengths) + 1, dtype=np.uint64)).astype(np.int32)
        terms = (keys & np.uint64(0xFFFFFFFF)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v, pa.int32())).cast(k) for v, k in zip((terms, tfs), kind)]
        out = pa.RecordBatch.from_arrays([ids, pa.array(lengths, pa.int64()), *lists], ["id", "n", "terms", "tfs"])
        return out.filter(pa.array(np.array(lengths) > 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            step = max(1, min(1024, int(len(batch) * (4 << 20) / max(1, texts.nbytes))))
            for i in range(0, len(batch), step):
                yield some(batch.column("id").slice(i, step), texts.slice(i, step), of)

    id_type = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(run, f"id {id_type}, n long, terms array<int>, tfs array<int>")


def _frequencies(postings: DataFrame, size: int) -> DataFrame:
    """(term, df): each task counts its documents in one array, so that few rows meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(held[at])], ["term", "n"])

    return postings.select("terms").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("df"))


class Accumulator:
    """Best ``k`` rows of each item over postings that come in the order in which equal scores rank."""

    def __init__(self, weights: np.ndarray, starts: np.ndarray, items: np.ndarray, n_items: int, n_docs: int, n_words: int, k: int) -> None:
        """Word t has ``weights[t]`` and stands in ``items[starts[t]:starts[t + 1]]``."""
        self.weights, self.starts, self.items, self.n_docs, self.n_words, self.k = weights, starts, items, n_docs, n_words, k
        self.least = np.zeros(n_items, np.int64)
        self.best: list[list[tuple[int, int, object]]] = [[] for _ in range(n_items)]
        self.seen = 0

    def add(self, ids: pa.Array, lengths: np.ndarray, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> None:
        """Documents with their lengths; document i has the postings from ``ends[i]`` to ``ends[i + 1]``."""
        spread = self.starts[terms + 1] - self.starts[terms]
        entries = np.concatenate(([0], np.cumsum(spread)))[ends]
        i = 0
        while i < len(lengths):
            # some documents at a time, one at least
            j = max(i + 1, int(np.searchsorted(entries, entries[i] + ENTRIES, "right")) - 1)
            at = slice(ends[i], ends[j])
            self._some(ids, i, lengths[i:j], np.diff(ends[i : j + 1]), terms[at], tfs[at].astype(np.int64), spread[at])
            i = j

    def _some(self, ids: pa.Array, offset: int, lengths: np.ndarray, held: np.ndarray, terms: np.ndarray, tfs: np.ndarray, spread: np.ndarray) -> None:
        doc = np.repeat(np.arange(len(lengths)), held)
        m = 10 + (90 * lengths * self.n_docs) // self.n_words
        impact = self.weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m[doc]))
        # the items of a posting's word, side by side
        within = np.arange(spread.sum()) - np.repeat(np.cumsum(spread) - spread, spread)
        item = self.items[np.repeat(self.starts[terms], spread) + within]
        keys = item.astype(np.uint64) * np.uint64(len(lengths)) + np.repeat(doc, spread).astype(np.uint64)
        keys, scores = summed(keys, np.repeat(impact, spread))
        item, row = (keys // np.uint64(len(lengths))).astype(np.int64), (keys % np.uint64(len(lengths))).astype(np.int64)
        for x in np.flatnonzero(scores > self.least[item]):
            self._offer(int(item[x]), int(scores[x]), self.seen + int(row[x]), ids[offset + int(row[x])])
        self.seen += len(lengths)

    def _offer(self, item: int, score: int, place: int, doc: object) -> None:
        heap = self.best[item]
        if len(heap) < self.k:
            heapq.heappush(heap, (score, -place, doc))
        elif score > heap[0][0]:  # later rows lose a tie
            heapq.heapreplace(heap, (score, -place, doc))
        if len(heap) == self.k:
            self.least[item] = heap[0][0]


def _search_block(docs: DataFrame, block: dict[object, list[bytes]], item_type: DataType, k: int) -> DataFrame:
    """(item, id, score): each task's best rows for items with their words over documents (id, text)."""
    spark, id_type = docs.sparkSession, docs.schema["id"].dataType
    number: dict[bytes, int] = {}
    pairs = sorted({(number.setdefault(w, len(number)), i) for i, words in enumerate(block.values()) for w in words})
    starts = np.searchsorted(np.array([t for t, _ in pairs]), np.arange(len(number) + 1))
    items, names = np.array([i for _, i in pairs], np.int64), list(block)
    postings = cut(_postings(docs, number), "postings")
    n_docs, n_words = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = np.zeros(len(number), np.int64)
    for r in _frequencies(postings, len(number)).select("term", weight.alias("w")).collect():  # a row per word of the block at most
        weights[r["term"]] = r["w"]
    shared = spark.sparkContext.broadcast((weights, starts, items, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, starts, items, names = shared.value
        best = Accumulator(weights, starts, items, len(names), n_docs, n_words, k)
        for batch in batches:
            lists = [batch.column(c) for c in ("terms", "tfs")]
            ends = lists[0].offsets.to_numpy() - lists[0].offsets[0].as_py()
            best.add(batch.column("id"), batch.column("n").to_numpy(), ends, *[v.flatten().to_numpy() for v in lists])
        for i, heap in enumerate(best.best):
            if heap:
                ids = pa.array([d.as_py() for _, _, d in heap], arrow[1])
                yield pa.RecordBatch.from_arrays([pa.array([names[i]] * len(heap), arrow[0]), ids, pa.array([s for s, _, _ in heap], pa.int64())], ["item", "id", "score"])

    arrow = [to_arrow_type(item_type), to_arrow_type(id_type)]
    order = F.asc_nulls_last("id")
    # ids that repeat are spread by what the rows hold
    ranges = postings.where(F.size("terms") > 0).repartitionByRange(parallelism(spark), order, F.xxhash64("n", "terms", "tfs")).sortWithinPartitions(order)
    return ranges.mapInArrow(run, _found_type(item_type, id_type))


def _found_type(item: DataType, key: DataType) -> StructType:
    return StructType([StructField("item", item), StructField("id", key), StructField("score", LongType())])


def _top(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    best = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", k: int = K, most_terms: int = MOST_TERMS) -> DataFrame:
    """(item, rank, doc, score): the ``k`` best rows of ``docs`` for each of ``items``, scores above 0, equal ones by ascending id.

    Null texts have no words. Rows that repeat an id are documents of their own; a row without an id ranks behind
    equal scores. Items that repeat an id, null too, are one with the words of all. Items are taken in blocks of ``most_terms`` different words or so, each in a pass of its own; no document
    is left out of any.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    asked = items.select(F.col(item_key).alias("item"), F.explode(F.array_distinct(words_column(F.col(item_text)))).alias("word")).distinct()
    since = mark()
    asked = cut(asked, "item-words")
    total = asked.count()
    blocks = max(1, math.ceil(total / most_terms))
    # an item's words are in one block; blocks are bounded unless one item alone has more different words
    grouped = asked.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    found = []
    for b in range(blocks):
        words: dict[object, list[bytes]] = {}
        for r in grouped.where(F.col("block") == b).select("item", "word").toLocalIterator():
            words.setdefault(r["item"], []).append(r["word"].encode())
        if words:
            found.append(cut(_search_block(rows, words, asked.schema["item"].dataType, k), "best-of-tasks"))
    each = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], _found_type(asked.schema["item"].dataType, rows.schema["id"].dataType))
    parts = parallelism(spark) // FAN_IN
    if parts > 1:  # very many tasks' rows are thinned in groups before all of an item's meet
        each = _top(each.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts))), ["item", "part"], k).drop("rank", "part")
    out = cut(_top(each, ["item"], k), "ranked")
    release(spark, since, out)
    return out.select("item", "rank", F.col("id").alias("doc"), "score")


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all ``documents`` for each ``benchmark`` item."""
    found = search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


OP13_SQL = f"""
WITH i AS (SELECT DISTINCT item_id, unnest({sql_words("text")}) AS term FROM benchmark),
d AS (SELECT row_number() OVER () AS row, doc_id, {sql_words("text")} AS words FROM documents),
n AS (SELECT row, doc_id, len(words)::BIGINT AS n FROM d WHERE len(words) > 0),
size AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM n),
tf AS (SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(words) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY row, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, size GROUP BY term),
scored AS (
  SELECT item_id, row, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))))::BIGINT AS score
  FROM i JOIN tf USING (term) JOIN w USING (term) JOIN n USING (row), size GROUP BY item_id, row
),
ranked AS (SELECT item_id, doc_id, score, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank FROM scored JOIN n USING (row) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {K}
"""
