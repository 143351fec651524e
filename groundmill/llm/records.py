"""Token-id output as length-delimited binary records with an offset index.

A shard is a plain sequence of records::

    uint64  length of the payload             little-endian throughout
    uint32  masked CRC-32C of those 8 bytes
    bytes   payload
    uint32  masked CRC-32C of the payload

and a payload is ``int64 key, uint8 key present, uint8 width, ids``; ids take 2 bytes each while all of
them fit, else 4. Shards are numbered along the ascending key and records ascend within a shard. The
index is a Parquet table of its own (shard, ordinal, key, offset, bytes, n_tokens), so that a shuffled
reader can seek to any record without scanning.
"""

from __future__ import annotations

import functools
import io
import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .checksums import crc32c_many, masked
from .shared import documents, fresh_path, parallelism

INDEX_SCHEMA = "shard_no int, shard string, ordinal long, key long, offset long, bytes long, n_tokens long"
READ_SCHEMA = "shard_no int, ordinal long, key long, local_start long, n_tokens long, ids_crc32 long"
#: Characters that the tokenizer's pattern counts as white space.
SPACE = "\t-\r \x85\xa0  -     　"
_PIECE = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: Texts that must not be split at each space: white space before a space, at the start or at the end.
_UNSAFE = "[\\s\\x0b\\x{85}\\p{Z}] |^[\\s\\x0b\\x{85}\\p{Z}]|[\\s\\x0b\\x{85}\\p{Z}]$"
_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
#: Pieces of letters, digits, ASCII marks but the apostrophe and single line feeds, and their parts by class.
_SIMPLE = re.compile(f" [{_LETTERS}0-9!-&(-/:-@\\[-`{{-~](?:[{_LETTERS}0-9!-&(-/:-@\\[-`{{-~]|\n(?=[^\n]))*\\Z")
_PARTS = re.compile(f" ?[{_LETTERS}]+| ?[0-9]+| ?[!-&(-/:-@\\[-`{{-~]+|\n")
#: Pieces that one Python worker remembers, and bytes of records that are framed at a time.
REMEMBERED = 600_000
FRAMED = 8 << 20
#: Bytes of text for each shard.
SHARD = 256 << 20


class PieceTokenizer:
    """Byte-level BPE by the tokenizers library, called once for each distinct piece of text.

    A piece ends where a character that is no white space meets white space. The tokenizer's own pattern
    always splits there, so ids of pieces joined are the ids of the text. Texts are split and their
    pieces numbered by Arrow; frequent pieces are remembered. Pieces that are new are parted further into
    words and marks and encoded many at a time by a copy of the tokenizer without its pattern, wherever
    the parts are of one character class, which no token leaves; byte lengths of tokens tell whose they
    are. All other pieces go through the tokenizer as it is, and so do whole texts that hold the string of one of its
    added tokens, which it finds before it looks for words.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.exact = Tokenizer.from_file(path)
        self.width = 2 if self.exact.get_vocab_size() <= 65536 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.plain = Tokenizer.from_file(path)
        self.plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        added = [re.escape(t.content) for t in self.exact.get_added_tokens_decoder().values()]
        self.added = "|".join(added) or None
        vocab = self.plain.get_vocab()
        self.lengths = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.lengths[i] = len(token)  # one character of the byte alphabet a byte
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _words(self, words: list[str]) -> None:
        """Encode words or runs of marks of one class each, all beginning with a space or none."""
        for i in range(0, len(words), 200):
            some = words[i : i + 200]
            ids = np.array(self.plain.encode_batch_fast(["".join(some)], add_special_tokens=False)[0].ids, np.int64)
            ends = np.cumsum(self.lengths[ids])
            want = np.cumsum([len(w.encode()) for w in some])
            cut = np.searchsorted(ends, want)
            if not np.array_equal(ends[np.minimum(cut, len(ends) - 1)], want):
                for w, e in zip(some, self.exact.encode_batch_fast(some, add_special_tokens=False), strict=True):
                    self.words[w] = np.array(e.ids, self.dtype).tobytes()
                continue
            packed, cut = ids.astype(self.dtype).tobytes(), ((cut + 1) * self.width).tolist()
            for w, a, b in zip(some, [0, *cut[:-1]], cut, strict=True):
                self.words[w] = packed[a:b]

    def _encode(self, pieces: list[str]) -> list[bytes]:
        parted = [_PARTS.findall(p) if _SIMPLE.match(p) else None for p in pieces]
        new = {w for x in parted if x for w in x}.difference(self.words)
        self._words([w for w in new if w[0] == " "])
        for w in new:
            if w[0] != " ":
                self.words[w] = np.array(self.exact.encode(w, add_special_tokens=False).ids, self.dtype).tobytes()
        rest = [p for p, x in zip(pieces, parted, strict=True) if x is None]
        whole = iter(self.exact.encode_batch_fast(rest, add_special_tokens=False))
        out = [np.array(next(whole).ids, self.dtype).tobytes() if x is None else b"".join(map(self.words.__getitem__, x)) for x in parted]
        if len(self.words) > REMEMBERED:
            self.words.clear()
        return out

    def _ids(self, pieces: list[str]) -> list[bytes]:
        found = list(map(self.known.get, pieces))
        missing = [i for i, x in enumerate(found) if x is None]
        if missing:
            names = [pieces[i] for i in missing]
            new = self._encode(names)
            for i, x in zip(missing, new, strict=True):
                found[i] = x
            if len(self.known) < REMEMBERED:
                self.known.update(zip(names, new, strict=True))
        return found

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each). No text may be null."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        odd = np.array(pc.match_substring_regex(texts, _UNSAFE).to_pylist(), bool)
        whole = np.array(pc.match_substring_regex(texts, self.added).to_pylist(), bool) if self.added else np.zeros(len(texts), bool)
        odd |= whole
        split = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.dictionary_encode()
        code, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        # the first piece of a text has no space before it; of an odd text it stands for the whole
        firsts = coded.dictionary.take(coded.indices.take(pa.array(offsets[:-1]))).to_pylist() if len(texts) else []
        pool = [x if n else b"" for n, x in zip(names, self._ids([" " + n for n in names]), strict=True)]
        head = self._ids(firsts)
        for i in np.flatnonzero(odd).tolist():
            text = texts[i].as_py()
            head[i] = np.array(self.exact.encode(text, add_special_tokens=False).ids, self.dtype).tobytes() if whole[i] else b"".join(self._ids(_PIECE.findall(text)))
        code[offsets[:-1]] = len(pool) + np.arange(len(firsts))
        pool += head
        sizes = np.array([len(x) for x in pool], np.int64) // self.width
        begins = np.cumsum(sizes) - sizes
        n = sizes[code]
        ends = np.cumsum(n)
        where = np.repeat(begins[code] - (ends - n), n)
        where += np.arange(len(where))
        per_text = np.diff(np.concatenate([[0], ends])[offsets])
        return np.frombuffer(b"".join(pool), self.dtype)[where], per_text


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> PieceTokenizer:
    return PieceTokenizer(path)


def frame(payloads: list[bytes]) -> list[bytes]:
    heads = [struct.pack("<Q", len(p)) for p in payloads]
    head_crc, body_crc = masked(crc32c_many(heads)), masked(crc32c_many(payloads))
    return [b"".join((h, struct.pack("<I", a), p, struct.pack("<I", b))) for h, a, p, b in zip(heads, head_crc.tolist(), payloads, body_crc.tolist(), strict=True)]


def unframe(read: Callable[[int], bytes]) -> Iterator[list[bytes]]:
    """Payloads of the records that ``read`` gives, some MB at a time; raises ValueError where a length or checksum is wrong.

    ``read`` takes a number of bytes, as a file's method does. A record's length is checked before so much is read,
    and never more than ``FRAMED`` bytes and the longest record are held.
    """
    at, heads, bodies, sums, held, data, ended = 0, [], [], [], 0, b"", False

    def more(want: int) -> bool:
        nonlocal data, ended
        parts, n = [data], len(data)
        while n < want and not ended:
            new = read(max(FRAMED, want - n))
            ended = not new
            parts.append(new)
            n += len(new)
        data = b"".join(parts)
        return n >= want

    def checked() -> list[bytes]:
        for kind, crcs, k in (("length", masked(crc32c_many(heads)), 0), ("payload", masked(crc32c_many(bodies)), 1)):
            for crc, x in zip(crcs.tolist(), sums, strict=True):
                if crc != x[k]:
                    raise ValueError(f"the {kind} of the record at byte {x[2]} does not match its checksum")
        return bodies

    place = 0  # of the next record in ``data``
    while more(1) and (place < len(data) or not ended):
        if place + 12 > len(data):
            data, place = data[place:], 0
            if not more(1):
                break
            if not more(12):
                raise ValueError(f"a record is cut off at byte {at}")
        (n, head_crc) = struct.unpack_from("<QI", data, place)
        if place + 16 + n > len(data):
            # a damaged length must be told from a short file, and must not ask for memory
            if int(masked(crc32c_many([data[place : place + 8]]))[0]) != head_crc:
                raise ValueError(f"the length at byte {at} does not match its checksum")
            data, place = data[place:], 0
            if not more(16 + n):
                raise ValueError(f"a record is cut off at byte {at}")
        heads.append(data[place : place + 8])
        bodies.append(data[place + 12 : place + 12 + n])
        sums.append((head_crc, struct.unpack_from("<I", data, place + 12 + n)[0], at))
        place, at, held = place + 16 + n, at + 16 + n, held + n
        if held >= FRAMED:
            yield checked()
            heads, bodies, sums, held = [], [], [], 0
    if heads:
        yield checked()


def read_at(path: str, offset: int, size: int) -> tuple[int | None, np.ndarray]:
    """(key, ids) of one record that the index names."""
    fs, name = pafs.FileSystem.from_uri(path)
    with fs.open_input_file(name) as f:
        (payload,) = next(unframe(io.BytesIO(f.read_at(size, offset)).read))
    return parse(payload)


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    key, present, width = struct.unpack_from("<qBB", payload)
    return (key if present else None), np.frombuffer(payload, f"<u{width}", offset=10)


def write_records(df: DataFrame, key: str, text: str, out_dir: str, tokenizer_path: str, end_id: int | None = None, shards: int | None = None) -> DataFrame:
    """Tokenize ``text``, write shards below ``out_dir`` in ascending ``key`` order, return the index.

    Null texts count as empty; with ``end_id`` every sequence ends with it, so none is empty. Null keys
    come first and stay null. Rows of equal keys stay rows of their own, in the order of their texts. Other
    columns are not read. An empty table makes an empty index and no shard. Without ``shards`` there are so many
    that none takes more than ``SHARD`` bytes of text on average, and as many as shuffles have partitions at least.

    Each attempt of a task writes a file of its own and only those of committed tasks enter the index,
    so a lost executor or a second attempt leaves no wrong record behind.
    """
    spark = df.sparkSession
    base = out_dir if "://" in out_dir or out_dir.startswith("file:") else f"file://{out_dir}"
    part = df.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if shards is None:
        size = part.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        shards = max(parallelism(spark), -(-size // SHARD))
    part = part.repartitionByRange(shards, "key").sortWithinPartitions("key", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, n = tokenizer(tokenizer_path), TaskContext.get().partitionId()
        end = b"" if end_id is None else np.array([end_id], tok.dtype).tobytes()
        fs, root = pafs.FileSystem.from_uri(base)
        name, out, at, ordinal = f"shard-{n:06d}-{uuid.uuid4().hex}.rec", None, 0, 0
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            i = 0
            while i < len(keys):  # some MB of text at a time
                j, size = i, 0
                while j < len(keys) and size < FRAMED:
                    size += len(texts[j].as_py())
                    j += 1
                ids, counts = tok.encode(texts[i:j])
                packed, cuts = ids.tobytes(), (np.cumsum(counts) * tok.width).tolist()
                records = frame([struct.pack("<qBB", k or 0, k is not None, tok.width) + packed[a:b] + end for k, a, b in zip(keys[i:j], [0, *cuts], cuts, strict=False)])
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/{name}")
                out.write(b"".join(records))
                sizes = np.array([len(r) for r in records], np.int64)
                offsets = at + np.cumsum(sizes) - sizes
                at += int(sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(j - i, n, np.int32)), pa.array([f"{base}/{name}"] * (j - i)), pa.array(np.arange(ordinal, ordinal + j - i)),
                        pa.array(keys[i:j], pa.int64()), pa.array(offsets), pa.array(sizes), pa.array(counts + (end_id is not None)),
                    ],
                    ["shard_no", "shard", "ordinal", "key", "offset", "bytes", "n_tokens"],
                )
                ordinal += j - i
                i = j
        if out is not None:
            out.close()

    index = f"{base}/index"
    part.mapInArrow(write, INDEX_SCHEMA).write.parquet(index)
    return spark.read.schema(INDEX_SCHEMA).parquet(index)


def read_records(spark: SparkSession, index: DataFrame) -> DataFrame:
    """One row per record, from the shards' own bytes; every checksum is verified.

    Columns: shard_no, ordinal, key, local_start (tokens before it in its shard), n_tokens, ids_crc32.
    """
    shards = index.groupBy("shard_no", "shard").agg(F.count("*").alias("n")).repartitionByRange(parallelism(spark), "shard_no")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, name = pafs.FileSystem.from_uri(row["shard"])
                start, ordinal = 0, 0
                with fs.open_input_stream(name) as f:
                    for payloads in unframe(f.read):
                        keys, sizes, crcs = [], [], []
                        for p in payloads:
                            key, ids = parse(p)
                            keys.append(key)
                            sizes.append(len(ids))
                            crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                        n = np.array(sizes, np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(n), row["shard_no"], np.int32)), pa.array(np.arange(ordinal, ordinal + len(n))), pa.array(keys, pa.int64()),
                                pa.array(start + np.cumsum(n) - n), pa.array(n), pa.array(crcs, pa.int64()),
                            ],
                            ["shard_no", "ordinal", "key", "local_start", "n_tokens", "ids_crc32"],
                        )
                        start, ordinal = start + int(n.sum()), ordinal + len(n)
                if ordinal != row["n"]:
                    raise ValueError(f"{row['shard']} holds {ordinal} records, its index {row['n']}")

    return shards.mapInArrow(read, READ_SCHEMA)


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` as token-id records, read back from the shards."""
    import public_tokenizers

    index = write_records(documents(spark, sf_dir), "doc_id", "text", fresh_path(spark, "records"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    totals = index.groupBy("shard_no").agg(F.sum("n_tokens").alias("tokens"))
    # one row per shard, so this window stays small
    starts = totals.select("shard_no", (F.sum("tokens").over(Window.orderBy("shard_no")) - F.col("tokens")).alias("shard_start"))
    return (
        read_records(spark, index)
        .join(F.broadcast(starts), "shard_no")
        .select(F.col("key").alias("doc_id"), (F.col("shard_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32", "shard_no", "ordinal")
    )
