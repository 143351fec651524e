"""Near-duplicate groups by circulant MinHash, banding and exact verification.

A document is its set of word shingles. One permutation scatters the set over a circle of slots, a second
one ranks the slots, and turning the second by k slots gives coordinate k of the signature: two
permutations serve all coordinates. Bands of coordinates name candidate links; every link is confirmed on
the full sets. The work is linear in the documents, however large a group of copies is:

* equal sets are one node, so exact copies make no pairs;
* in a band's bucket each member meets only a few hubs, chosen by minima that are summed before the shuffle;
* members outside the largest component of their bucket meet hubs of that component;
* those that are still apart are compared with all members of the bucket, blocks of the ones with blocks of the
  others, by fingerprints of fixed size. Fingerprints give a bound that no link breaks, so that none that joins
  components is lost to the choice of hubs; only pairs within the bound leave a block and meet with their texts.
"""

from __future__ import annotations

import functools
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .components import connected_components
from .shared import cut, documents, mark, release

SLOTS = 1 << 20
#: A pair at similarity 0.8 misses all bands with a chance of 1.2e-7.
BANDS, ROWS = 40, 5
COORDINATES = BANDS * ROWS
SEED = 20_240_501
#: Bits of a set's parity map, and members of a block.
PARITY = 1024
BLOCK = 2048
SKETCH_SCHEMA = "doc_id long, n_shingles long, f1 long, f2 long, bands array<bigint>, parity binary"
_GOLD, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    """(slot of a hash, windows of ranks: row v holds the ranks of slots v, v+1, ... around the circle)."""
    rng = np.random.default_rng(SEED)
    scatter = rng.permutation(SLOTS).astype(np.int32)
    rank = rng.permutation(SLOTS).astype(np.uint32)
    return scatter, np.lib.stride_tricks.sliding_window_view(np.concatenate([rank, rank[:COORDINATES]]), COORDINATES)


class _Words(dict):
    """Hash of a word, remembered while few are held."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Words()


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes per text: words are runs of non-space in ASCII's sense, A-Z lowered.

    Fewer words than ``width`` make one shingle; no words, an empty set.
    """
    split = [t.encode("utf-8", "surrogatepass").lower().split() if t else [] for t in texts]
    counts = np.array([len(w) for w in split], np.int64)
    flat = np.fromiter((h for w in split for h in map(_words.__getitem__, w)), np.uint64, int(counts.sum()))
    full = np.full(max(0, len(flat) - width + 1), width, np.uint64)
    for j in range(width):
        if len(full):
            full = _mix((full + _GOLD) ^ flat[j : j + len(full)])
    out, at = [], 0
    for n in counts.tolist():
        if n >= width:
            h = np.sort(full[at : at + n - width + 1])
            out.append(h[np.concatenate([[True], h[1:] != h[:-1]])])
        elif n:
            h = np.array([n], np.uint64)
            for j in range(n):
                h = _mix((h + _GOLD) ^ flat[at + j : at + j + 1])
            out.append(h)
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """All coordinates of a non-empty set."""
    scatter, windows = _permutations()
    slots = scatter[(shingles % np.uint64(SLOTS)).astype(np.int64)]
    best = windows[slots[:512]].min(axis=0)
    for i in range(512, len(slots), 512):  # long texts in bounded memory
        np.minimum(best, windows[slots[i : i + 512]].min(axis=0), out=best)
    return best


def parity_map(shingles: np.ndarray) -> bytes:
    """For each residue of the hashes whether an odd number of the set's members has it.

    The maps of two sets differ in no more bits than the sets have members that are not shared, which bounds
    their similarity from above.
    """
    odd = np.bincount(((shingles >> np.uint64(40)) % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per signature and band; keys of different bands differ."""
    s = signatures.astype(np.uint64).reshape(len(signatures), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), s.shape[:2]).copy()
    for j in range(ROWS):
        key = _mix((key + _GOLD) ^ s[:, :, j])
    return key.view(np.int64)


def sketches(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """Set size, 128-bit fingerprint of the set, band keys and parity map of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 512):
                part = batch.slice(i, 512)
                sets = shingle_sets(part.column(1).to_pylist(), width)
                prints = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                full = [k for k, s in enumerate(sets) if len(s)]
                keys: list = [None] * len(sets)
                if full:
                    for k, row in zip(full, band_keys(np.stack([signature(sets[k]) for k in full])), strict=True):
                        keys[k] = row
                two = np.frombuffer(b"".join(prints), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(two[:, 0]), pa.array(two[:, 1]), pa.array(keys, pa.list_(pa.int64())), pa.array([parity_map(s) for s in sets], pa.binary())],
                    ["doc_id", "n_shingles", "f1", "f2", "bands", "parity"],
                )

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SKETCH_SCHEMA)


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets share at least ``percent`` of their union.

    ``texts`` (doc_id, text) has one row per id. Rows leave the first join with the member's text, and adaptive
    execution splits the second where one hub has very many members.
    """
    both = (
        pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: OrderedDict[int, np.ndarray] = OrderedDict()  # sets of recent hubs

        def get(ids: list[int], column: pa.Array) -> list[np.ndarray]:
            new = {i: k for k, i in enumerate(ids) if i not in held}
            sets = dict(zip(new, shingle_sets([column[k].as_py() for k in new.values()], width), strict=True))
            out = [sets[i] if i in sets else held[i] for i in ids]
            held.update(sets)
            while len(held) > 256:
                held.popitem(last=False)
            return out

        for batch in batches:
            for i in range(0, len(batch), 128):
                part = batch.slice(i, 128)
                a, b = part.column(0).to_pylist(), part.column(1).to_pylist()
                left, right = get(a, part.column(2)), get(b, part.column(3))
                keep = []
                for x, y in zip(left, right, strict=True):
                    shared = int(np.isin(x, y, assume_unique=True).sum()) if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)) else 0
                    keep.append(bool(shared) and 100 * shared >= percent * (len(x) + len(y) - shared))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _merged(components: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` (id, component) after ``links`` between ids; components are the nodes, so this is small."""
    if links.isEmpty():
        return components
    joined = links.join(components.select(F.col("id").alias("a"), F.col("component").alias("ca")), "a", "left").join(components.select(F.col("id").alias("b"), F.col("component").alias("cb")), "b", "left")
    merged = connected_components(joined.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    merged = cut(merged.select(F.col("id").alias("component"), F.col("component").alias("merged")), "merged")
    alone = merged.join(components.select("id"), F.col("component") == F.col("id"), "left_anti").select(F.col("component").alias("id"), F.col("merged").alias("component"))
    return cut(components.join(merged, "component", "left").select("id", F.coalesce("merged", "component").alias("component")).unionByName(alone), "components")


def _apart(crowded: DataFrame, components: DataFrame) -> DataFrame:
    """(bucket, doc_id, component) of buckets with several components; ``top`` is the largest, h1 to h4 some of its members."""
    placed = crowded.select("bucket", "doc_id").join(components.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("bucket", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    placed = cut(placed, "placed")
    hubs = [F.min_by("doc_id", F.xxhash64("doc_id", F.lit(i))).alias(f"h{i}") for i in range(1, 5)]
    parts = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"), *hubs)
    tops = parts.groupBy("bucket").agg(F.count("*").alias("parts"), F.sum("n").alias("members"), F.max_by(F.struct("component", "h1", "h2", "h3", "h4"), "n").alias("t")).where("parts > 1")
    tops = cut(tops.select("bucket", "members", F.col("t.component").alias("top"), "t.h1", "t.h2", "t.h3", "t.h4"), "tops")
    return cut(placed.join(tops, "bucket"), "apart")


def _block_pairs(left: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members of one bucket that lie in different components and may be links.

    Members of a bucket are dealt into blocks, and those outside the largest component into blocks of their own;
    each of these meets each of those. A row carries fingerprints, no text, and a group has one block of either
    kind. A pair that shares several buckets comes out of the first of its bands only.
    """
    blocks = lambda n: F.expr(f"cast(ceil({n} / {BLOCK}) as int)")
    outside = left.where("component <> top").groupBy("bucket").agg(F.count("*").alias("outsiders"))
    base = left.join(outside, "bucket").select("bucket", "doc_id", "component", (F.col("component") == F.col("top")).alias("inside"), blocks("members").alias("blocks"), blocks("outsiders").alias("calls"))
    own = lambda n: F.expr(f"pmod(xxhash64(doc_id), {n})").cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    targets = base.select("bucket", "doc_id", "component", own("blocks").alias("block"), every("calls").alias("call"), F.lit(False).alias("asks"))
    queries = base.where("NOT inside").select("bucket", "doc_id", "component", every("blocks").alias("block"), own("calls").alias("call"), F.lit(True).alias("asks"))
    known = sketch.join(left.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("parity").alias("parity"))
    rows = targets.unionByName(queries).join(cut(known, "known"), "doc_id")

    rows = rows.select("bucket", "block", "call", "asks", "doc_id", "component", "n", "bands", "parity")
    rows = rows.repartition("bucket", "block", "call").sortWithinPartitions("bucket", "block", "call")

    def compare(bucket: int, asks: np.ndarray, ids: np.ndarray, part: np.ndarray, n: np.ndarray, bands: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        q, t = np.flatnonzero(asks), np.flatnonzero(~asks)
        out = [(ids[:0], ids[:0])]
        if len(q) and len(t):
            band = int(np.argmax(bands[t[0]] == bucket))
            for i in q.tolist():
                pick = t[(np.minimum(n[t], n[i]) * 100 >= percent * np.maximum(n[t], n[i])) & (part[t] != part[i])]
                apart = np.bitwise_count(bits[pick] ^ bits[i]).sum(axis=1, dtype=np.int64)
                both = n[pick] + n[i]
                # shared members are half of what is left of both sizes, so a link has (both - apart) / (both + apart) in reach
                pick = pick[100 * (both - apart) >= percent * (both + apart)]
                pick = pick[(bands[pick, :band] != bands[i, :band]).all(axis=1)]
                out.append((np.minimum(ids[pick], ids[i]), np.maximum(ids[pick], ids[i])))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # what the last batch had of a group that may go on

        def found(columns: list[np.ndarray], edges: list[int]) -> pa.RecordBatch:
            pairs = [compare(columns[0][i], *[c[i:j] for c in columns[3:]]) for i, j in zip(edges, edges[1:], strict=False)]
            a, b = (np.concatenate([p[k] for p in pairs] or [np.empty(0, np.int64)]) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            if not len(batch):
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
            columns += [batch.column(7).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1), np.frombuffer(b"".join(batch.column(8).to_pylist()), np.uint64).reshape(len(batch), -1)]
            columns = columns if held is None else [np.concatenate(x) for x in zip(held, columns, strict=True)]
            new = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1]) | (columns[2][1:] != columns[2][:-1])
            edges = [0, *(np.flatnonzero(new) + 1).tolist()]
            yield found(columns, edges)
            held = [c[edges[-1] :] for c in columns]
        if held is not None:
            yield found(held, [0, len(held[0])])

    return rows.mapInArrow(run, "a long, b long").where("a < b").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``.

    ``component_id`` is the smallest id that confirmed links reach, the row's own included; ``kept`` says that it
    is the row's own. Texts without words, and null texts, have an empty set and link with nothing. Rows that
    repeat an id are one document. A null id links like any other row but names no component; where all ids of
    a group are null, ``component_id`` is null and ``kept`` true. Other columns of ``docs`` are not read.
    """
    since = mark()
    sketch = cut(sketches(docs, key, text, width), "sketches")
    nodes = cut(sketch.where("n_shingles > 0").groupBy("f1", "f2").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies")), "nodes")
    # the node's own row gives its bands; repeated rows of an id give the same node
    own = sketch.where("n_shingles > 0").join(nodes.where("node IS NOT NULL").select(F.col("node").alias("doc_id"), "f1", "f2", "copies"), ["doc_id", "f1", "f2"])
    bands = cut(own.select("doc_id", "copies", F.explode("bands").alias("bucket")), "bands")
    turned = F.xxhash64("doc_id")
    hubs = bands.groupBy("bucket").agg(F.min("doc_id").alias("h1"), F.max("doc_id").alias("h2"), F.min_by("doc_id", turned).alias("h3"), F.max_by("doc_id", "copies").alias("h4")).where("h1 < h2")
    crowded = cut(bands.select("bucket", "doc_id").join(cut(hubs, "hubs"), "bucket"), "crowded")
    first = crowded.select("doc_id", F.explode(F.array_distinct(F.array("h1", "h2", "h3", "h4"))).alias("hub")).where("doc_id <> hub")
    first = cut(first.select(F.least("doc_id", "hub").alias("a"), F.greatest("doc_id", "hub").alias("b")).distinct(), "pairs")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    texts = rows.join(crowded.select("doc_id").distinct(), "doc_id", "left_semi")
    texts = cut(texts.groupBy("doc_id").agg(F.max("text").alias("text")), "texts")
    components = cut(connected_components(cut(verified(first, texts, width, percent), "links")), "components")

    left = _apart(crowded, components)
    second = left.where("component <> top").select("doc_id", F.explode(F.array_distinct(F.array("h1", "h2", "h3", "h4"))).alias("hub"))
    second = second.select(F.least("doc_id", "hub").alias("a"), F.greatest("doc_id", "hub").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    second = cut(second, "pairs")
    components = _merged(components, cut(verified(second, texts, width, percent), "links"))
    left = _apart(crowded, components)
    third = _block_pairs(left, sketch, percent).join(first.unionByName(second), ["a", "b"], "left_anti")
    components = _merged(components, cut(verified(cut(third, "pairs"), texts, width, percent), "links"))

    groups = cut(nodes.join(components.withColumnRenamed("id", "node"), "node", "left").select("f1", "f2", F.coalesce("component", "node").alias("component_id")), "groups")
    release(docs.sparkSession, since, sketch, groups)
    found = sketch.where("n_shingles > 0").select("doc_id", "n_shingles", "f1", "f2").join(groups, ["f1", "f2"], "left").select("doc_id", "n_shingles", "component_id")
    found = found.unionByName(sketch.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, the one with the smallest id; columns stay as they are.

    Rows without words are kept, each once per id. Rows of one id are one document: with it, each of their
    different texts stays once, and which of the rows equal in both stays is not fixed. Rows without an id get one
    from their text that is larger than all others (ids of 2^62 and more are taken for such), so they stay only
    where their group has no id.
    """
    made = F.lit(1 << 62) + F.pmod(F.xxhash64(text), F.lit(1 << 62))
    # a caller's columns travel as one, so that no name of this function can clash with theirs
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(key).cast("long"), made).alias("doc_id"), F.col(text).alias("text"))
    kept = near_duplicates(rows, "doc_id", "text", width, percent).where("kept").select("doc_id").distinct()
    one = Window.partitionBy("doc_id", "text").orderBy("doc_id")
    return rows.join(kept, "doc_id", "left_semi").withColumn("place", F.row_number().over(one)).where("place = 1").select("row.*")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups over the two-word shingles of ``documents``."""
    return near_duplicates(documents(spark, sf_dir), width=2, percent=80)


#: Exact sets, links and components over the words and shingles that op6 fixes.
OP6_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * k >= 80 * (p.n + q.n - k)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS id, doc_id AS r FROM documents
  UNION
  SELECT b.b, r.r FROM reach r JOIN both_ways b ON r.id = b.a
), least AS (
  SELECT id, min(r) AS component_id FROM reach GROUP BY id
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d JOIN least l ON l.id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""
