import io
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from groundmill.llm import checksums, ogg, records  # noqa: E402
from groundmill.llm.queries import QUERIES  # noqa: E402

from ..conftest import DATA  # noqa: E402
from .helpers import empty, odd, odd_rows  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def slow_crc(data, poly, reflected):
    crc = 0xFFFFFFFF if reflected else 0
    for b in data:
        if reflected:
            crc ^= b
            for _ in range(8):
                crc = (crc >> 1) ^ (poly if crc & 1 else 0)
        else:
            crc ^= b << 24
            for _ in range(8):
                crc = ((crc << 1) ^ (poly if crc & 0x80000000 else 0)) & 0xFFFFFFFF
    return crc ^ 0xFFFFFFFF if reflected else crc


def test_checksums_equal_the_bitwise_ones():
    rng = random.Random(0)
    data = [rng.randbytes(n) for n in (4, 9, 511, 512, 513, 1500, 5000)]
    assert checksums.crc32c_many(data).tolist() == [slow_crc(d, checksums.CASTAGNOLI, True) for d in data]
    assert checksums.ogg_crc_many([b"", *data]).tolist() == [slow_crc(d, checksums.OGG, False) for d in [b"", *data]]
    assert checksums.crc32c_many([b"123456789"])[0] == 0xE3069283


def test_pieces_encode_like_whole_texts():
    rng = random.Random(1)
    texts = ["", " ", "a", " a b  c\n\nd ", "don't stop'll", "x\x1cy", "<|endoftext|> z", "a  <|endoftext|>  b<|endoftext|>c \n<|endoftext|>", "<| endoftext |>", "日本 語　x", "foo. bar,\nBaz 12 3a", "²³ e× y", "ﬁ ǅ"]
    texts += ["".join(rng.choice("ab é.,'1 \n\t²日\x1c\x85!×_\x0b\xa0") for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    tok, plain = records.PieceTokenizer(PATH), plain_tokenizer()
    for _ in range(2):  # fresh and remembered
        ids, n = tok.encode(texts)
        ends = np.cumsum(n)
        assert [ids[e - k : e].tolist() for e, k in zip(ends, n, strict=True)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_op1_equals_a_loop(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect())
    plain, want, at = plain_tokenizer(), [], 0
    for i, t in rows:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(r)[:4] for r in QUERIES["op1_token_records"](spark, DATA).collect()) == want


def test_odd_rows_and_seeking(spark, tmp_path):
    index = records.write_records(odd(spark), "doc_id", "text", str(tmp_path / "a"), PATH, end_id=2, shards=3)
    back = records.read_records(spark, index).collect()
    assert sorted(r["key"] or -1 for r in back) == sorted(r[0] or -1 for r in odd_rows())
    plain = plain_tokenizer()
    for r in index.where("key IN (6, 8)").collect():
        key, ids = records.read_at(r["shard"], r["offset"], r["bytes"])
        text = next(x[1] for x in odd_rows() if x[0] == key)
        assert ids.tolist() == [*plain.encode(text, add_special_tokens=False).ids, 2]
    assert records.read_records(spark, records.write_records(empty(spark), "doc_id", "text", str(tmp_path / "b"), PATH)).count() == 0


def test_damage_is_found(spark, tmp_path):
    index = records.write_records(odd(spark), "doc_id", "text", str(tmp_path / "a"), PATH, shards=1)
    path = index.first()["shard"].removeprefix("file://")
    whole = open(path, "rb").read()
    for at in (3, 9, 60, len(whole) - 1):
        bad = bytearray(whole)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            list(records.unframe(io.BytesIO(bytes(bad)).read))
    for n in (1, 5, 20, len(whole) - 4):
        with pytest.raises(ValueError):
            list(records.unframe(io.BytesIO(whole[:-n]).read))


def test_records_are_read_in_bounded_parts(monkeypatch):
    """A stream that gives a few bytes at a time, records longer than a part, and no more held than a part and a record."""
    rng = random.Random(8)
    payloads = [rng.randbytes(n) for n in (10, 0, 5000, 3, 700, 20_000, 1)] * 3
    whole = b"".join(records.frame(payloads))
    monkeypatch.setattr(records, "FRAMED", 1000)
    for most in (7, 999, 10**6):
        asked = []

        def read(n, stream=io.BytesIO(whole), most=most, asked=asked):
            asked.append(n)
            return stream.read(min(n, most))

        assert [p for some in records.unframe(read) for p in some] == payloads and max(asked) <= 20_016
    assert list(records.unframe(io.BytesIO(b"").read)) == []


def test_shards_follow_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "SHARD", 100)
    t = spark.createDataFrame([(i, "word " * 20) for i in range(60)], "doc_id long, text string")
    assert records.write_records(t, "doc_id", "text", str(tmp_path / "a"), PATH).select("shard_no").distinct().count() >= 40


def test_ogg_round_trips():
    rng = random.Random(2)
    payloads = [rng.randbytes(n) for n in (64, 128, 4096, 4096 * 15, 4096 * 16 + 64, 255 * 300, 255 * 255, 200_000)]
    for p, streams in zip(payloads, ogg.demux(ogg.mux(payloads, [1] * len(payloads))), strict=True):
        assert b"".join(streams[0].packets[1:]) == p and streams[0].row()["end_s"] == len(p) / 8000 and streams[1].codec == "note"
        assert not any(s.bad_pages or s.lost_packets for s in streams)


def test_ogg_damage_and_spanning_packets():
    big = os.urandom(70_000)  # one packet over two pages
    pages = ogg._pages(7, [(ogg.SAMPLES + b"\x40\x1f\0\0\x01", 0), (big, len(big)), (b"tail", len(big) + 4)])
    for p in pages:
        p[22:26] = int(checksums.ogg_crc_many([bytes(p)])[0]).to_bytes(4, "little")
    assert len(pages) == 3 and pages[1][6:14] == b"\xff" * 8 and pages[2][5] & ogg.CONTINUED
    (whole,) = ogg.demux([b"junk" + b"".join(pages)])[0]
    assert whole.packets[1:] == [big, b"tail"] and whole.granules[-1] == len(big) + 4
    (cut,) = ogg.demux([bytes(pages[0] + pages[2])])[0]
    assert cut.packets[1:] == [b"tail"] and cut.lost_packets == 0 and cut.sequence == 2
    pages[1][500] ^= 1
    (bad,) = ogg.demux([b"".join(map(bytes, pages))])[0]
    assert bad.bad_pages == 1 and bad.packets[1:] == [b"tail"]


def sealed(pages):
    for p in pages:
        p[22:26] = bytes(4)
        p[22:26] = int(checksums.ogg_crc_many([bytes(p)])[0]).to_bytes(4, "little")
    return b"".join(map(bytes, pages))


def test_every_packet_has_a_time():
    (main, _) = ogg.demux(ogg.mux([bytes(4096 * 40 + 64)], [1]))[0]
    assert main.granules == [0, *[4096 * (k + 1) for k in range(40)], 4096 * 40 + 64]
    assert main.row()["start_s"] == 0.0 and main.begins and main.ends and not main.late
    # a stream that is cut from a longer one begins at the first packet's start
    pages = ogg._pages(3, [(ogg.SAMPLES + b"\x40\x1f\0\0\x01", 0), (bytes(800), 8800), (bytes(400), 9200)])
    (late,) = ogg.demux([sealed(pages)])[0]
    assert late.granules[1:] == [8800, 9200] and late.row()["start_s"] == 1.0 and late.row()["packet_end_s"][1:] == [1.1, 1.15]


def test_times_of_opus_and_flac():
    head, tags = b"OpusHead\x01\x02" + (312).to_bytes(2, "little") + bytes(7), b"OpusTags"
    data = [bytes([0b11111_0_00]) + b"x"] * 3 + [bytes([0b11111_0_01]) + b"xy", bytes([0b00001_0_11, 3]) + b"xyz"]  # 20 ms, twice 20 ms, three times 20 ms
    pages = ogg._pages(5, [(head, 0), (tags, 0)])
    pages += ogg._pages(5, [(b"", 0), *[(d, 7000) for d in data]])[1:]
    for n, p in enumerate(pages):
        p[5], p[18:22] = (ogg.FIRST if n == 0 else 0) | (ogg.LAST if n + 1 == len(pages) else 0), n.to_bytes(4, "little")
    (s,) = ogg.demux([sealed(pages)])[0]
    assert s.codec == "opus" and s.granules == [0, 0, 280, 1240, 2200, 4120, 7000]
    assert s.row()["end_s"] == (7000 - 312) / 48000 and s.row()["payload"] == b"".join(data)
    flac = ogg.Stream(1, "flac", 44100)
    assert [ogg.duration(flac, b"\xff\xf8" + bytes([c << 4]) + b"\x00" + n) for c, n in ((1, b"\x05\0"), (4, b"\x05\0"), (12, b"\x05\0"), (6, b"\x05\x0f"), (7, b"\xc2\x80\x01\x00"))] == [192, 2304, 4096, 16, 257]


def cut_pages(data):
    """Bounds of the pages of undamaged bytes, by their lengths alone."""
    at, out = 0, []
    while at < len(data):
        n = data[at + 26]
        end = at + 27 + n + sum(data[at + 27 : at + 27 + n])
        out.append((at, end))
        at = end
    return out


def long_stream():
    payload = random.Random(6).randbytes(4096 * 124 + 64)
    (data,) = ogg.mux([payload], [1])
    return payload, data, cut_pages(data), ogg.demux([data])[0][0].packets


def test_any_damage_costs_one_page_alone():
    """Each byte of the head, the first and last lacing value and a byte of the body of every page in the middle, one at a time."""
    payload, data, pages, packets = long_stream()
    serial = int.from_bytes(data[14:18], "little")
    middle = [i for i, (a, _) in enumerate(pages) if data[a + 14 : a + 18] == data[14:18]][1:-1]
    assert len(middle) >= 7
    for i in middle:
        a, b = pages[i]
        hurt = [(a + x, None) for x in range(27)] + [(a + 27, 255), (a + 27 + data[a + 26] - 1, 255), (a + 27 + data[a + 26] - 1, 0), (b - 9, None), (a + 26, 254), (a + 26, 0)]
        for at, value in hurt:
            bad = bytearray(data)
            bad[at] = bad[at] ^ 0x55 if value is None else value
            if bad == data:
                continue
            streams = ogg.demux([bytes(bad)])[0]
            assert len(streams) == 2  # no stream of a damaged number
            s = next(s for s in streams if s.serial == serial)
            first = 1 + 15 * middle.index(i)
            assert s.packets == packets[:first] + packets[first + 15 :], (i, at - a)
            assert s.lost_pages == 1 and s.lost == 15 * 4096 and s.lost_packets == 0 and s.ends
            assert s.granules[-1] == len(payload)


def test_pages_that_are_missing_are_counted():
    payload, data, pages, packets = long_stream()
    middle = [i for i, (a, _) in enumerate(pages) if data[a + 14 : a + 18] == data[14:18]][1:-1]
    for gone in ([0], [2, 3], [0, 1, 5], [1, 3, 5]):
        drop = {middle[g] for g in gone}
        s = ogg.demux([b"".join(data[a:b] for i, (a, b) in enumerate(pages) if i not in drop)])[0][0]
        assert s.lost_pages == len(gone) and s.lost == len(gone) * 15 * 4096 and s.bad_pages == 0
        assert s.packets == [p for k, p in enumerate(packets) if k == 0 or (k - 1) // 15 not in gone]
        assert s.row()["lost_s"] == len(gone) * 15 * 4096 / 8000


def test_capture_patterns_inside_damaged_pages_are_read_in_linear_time():
    fake = b"OggS" + bytes(22) + b"\x01\xff"
    assert ogg.demux([fake * 4000 + bytes(300)])[0] == []
    inner = b"".join(ogg.mux([b"OggS" * 300], [1]))
    (main, _) = ogg.demux(ogg.mux([inner], [1]))[0]
    assert main.row()["payload"] == inner and main.bad_pages == 0


def test_chained_streams_and_flags():
    one, two = ogg.mux([b"a" * 64, b"a" * 128], [1, 1])
    pages = ogg._pages(9, [(ogg.SAMPLES + b"\x40\x1f\0\0\x01", 0), (b"x" * 64, 64)])
    again = ogg._pages(9, [(ogg.SAMPLES + b"\x40\x1f\0\0\x01", 0), (b"y" * 64, 64)])
    chained = ogg.demux([sealed(pages) + sealed(again)])[0]
    assert [s.row()["payload"] for s in chained] == [b"x" * 64, b"y" * 64] and [s.serial for s in chained] == [9, 9]
    assert len(ogg.demux([one + two])[0]) == 4
    for p in pages:
        p[5] &= ~(ogg.FIRST | ogg.LAST)
    (bare,) = ogg.demux([sealed(pages)])[0]
    assert not bare.begins and not bare.ends
    pages[0][5] |= ogg.LAST
    (after,) = ogg.demux([sealed(pages)])[0]
    assert after.ends and after.late == 1


def test_op2_equals_a_loop(spark):
    import hashlib

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for r in QUERIES["op2_ogg_media"](spark, DATA).collect():
        raw = (texts[r["doc_id"]] or "").encode()
        payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        (media,) = ogg.mux([payload], [len(raw)])
        assert (r["media_bytes"], r["media_sha256"]) == (len(media), hashlib.sha256(media).hexdigest())
        assert f"end_s={len(payload) / 8000}" in r["feature"] and r["bad_pages"] == r["lost_packets"] == 0


def test_ogg_columns_on_odd_rows(spark):
    t = ogg.demux_column(ogg.mux_column(odd(spark), "text"), "media")
    assert t.columns[-2:] == ["media", "streams"] and t.count() == len(odd_rows())
    assert {r["n"] for r in t.select(F.size("streams").alias("n")).collect()} == {2}
    assert t.where("text IS NULL").first()["streams"][0]["payload"] == bytes(64)
    assert ogg.demux_column(ogg.mux_column(empty(spark), "text"), "media").count() == 0
    none = spark.createDataFrame([(None,), (bytearray(b"no page"),)], "media binary")
    assert [r["streams"] for r in ogg.demux_column(none, "media").collect()] == [[], []]
