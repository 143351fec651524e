"""Media columns in the Ogg container.

``mux_column`` stores byte payloads as 8-bit mono samples in a physical stream of two logical ones: the
samples, and a side stream that notes the unpadded length. ``demux_column`` reads any Ogg bytes: it
verifies each page's checksum, reassembles packets from lacing values across pages, parts the logical
streams by serial number and by the flags of their first pages, and turns granule positions into seconds. A
position holds for the last packet that ends on its page; the others follow from the packets' own durations.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .checksums import ogg_crc_many
from .shared import documents, map_column

#: Header packet of the sample stream: magic, sample rate, channels; of the side stream: magic, length.
SAMPLES, NOTE = b"GMPCM8\x00\x01", b"GMNOTE\x00\x01"
RATE = 8000
PACKET = 4096
PAGE_HEAD = struct.Struct("<4sBBqIIIB")
CONTINUED, FIRST, LAST = 1, 2, 4
#: Bytes of pages whose checksums are computed together.
TOGETHER = 16 << 20
DEMUX_SCHEMA = (
    "array<struct<serial: bigint, codec: string, rate: int, begins: boolean, ends: boolean, late_pages: int, pages: int, bad_pages: int, packets: int,"
    " lost_packets: int, lost_pages: int, lost_s: double, start_s: double, end_s: double, packet_end_s: array<double>, payload: binary>>"
)


def _pages(serial: int, packets: list[tuple[bytes, int]]) -> list[bytearray]:
    """Pages of one logical stream, checksums still zero. The first packet has a page to itself; packets may span pages."""
    out: list[bytearray] = []
    for group in (packets[:1], packets[1:]):
        lacing: list[int] = []
        body = bytearray()
        ends: list[tuple[int, int]] = []  # (number of lacing values so far, granule) where a packet ends
        for data, granule in group:
            lacing += [255] * (len(data) // 255) + [len(data) % 255]
            body += data
            ends.append((len(lacing), granule))
        at = 0
        for i in range(0, len(lacing), 255):
            part = lacing[i : i + 255]
            done = [g for n, g in ends if i < n <= i + len(part)]
            kind = (CONTINUED if i and lacing[i - 1] == 255 else 0) | (0 if out else FIRST)
            size = sum(part)
            out.append(bytearray(PAGE_HEAD.pack(b"OggS", 0, kind, done[-1] if done else -1, serial, len(out), 0, len(part)) + bytes(part) + body[at : at + size]))
            at += size
    out[-1][5] |= LAST
    return out


def mux(payloads: list[bytes], lengths: list[int]) -> list[bytes]:
    """An Ogg physical stream per payload; all checksums are computed together."""
    pages: list[bytearray] = []
    counts = []
    for payload, n in zip(payloads, lengths, strict=True):
        serial = zlib.crc32(payload)
        packets = [(SAMPLES + struct.pack("<IB", RATE, 1), 0)]
        packets += [(payload[i : i + PACKET], min(i + PACKET, len(payload))) for i in range(0, len(payload), PACKET)]
        note = [(NOTE, 0), (struct.pack("<Q", n), len(payload))]
        main, side = _pages(serial, packets), _pages(serial ^ 0xFFFFFFFF, note)
        ordered = [main[0], side[0], *main[1:], *side[1:]]  # all first pages stand before the others
        counts.append(len(ordered))
        pages += ordered
    for page, crc in zip(pages, ogg_crc_many([bytes(p) for p in pages]).tolist(), strict=True):
        struct.pack_into("<I", page, 22, crc)
    out, at = [], 0
    for n in counts:
        out.append(b"".join(pages[at : at + n]))
        at += n
    return out


@dataclass
class Stream:
    """One logical stream: ``begins`` and ``ends`` say that pages with the flags of a first and a last one were seen, ``late`` counts pages after the last."""

    serial: int
    codec: str = "unknown"
    rate: int = 0
    channels: int = 1
    headers: int = 1
    skip: int = 0
    begins: bool = False
    ends: bool = False
    late: int = 0
    pages: int = 0
    bad_pages: int = 0
    lost_packets: int = 0
    lost_pages: int = 0
    lost: int = 0
    gap: bool = False
    first: int | None = None
    last: int | None = None
    sequence: int = -1
    open: list[bytes] | None = None
    packets: list[bytes] = field(default_factory=list)
    granules: list[int | None] = field(default_factory=list)

    def row(self) -> dict:
        """Seconds are null where the codec's rate is unknown; ``payload`` joins the packets after the header packets."""
        at = (lambda g: max(0, g - self.skip) / self.rate if self.rate and g is not None else None)
        return {
            "serial": self.serial, "codec": self.codec, "rate": self.rate, "begins": self.begins, "ends": self.ends, "late_pages": self.late, "pages": self.pages, "bad_pages": self.bad_pages, "packets": len(self.packets),
            "lost_packets": self.lost_packets, "lost_pages": self.lost_pages, "lost_s": self.lost / self.rate if self.rate else None, "start_s": at(self.first), "end_s": at(self.last), "packet_end_s": [at(g) for g in self.granules], "payload": b"".join(self.packets[self.headers :]),
        }


def _header(s: Stream, packet: bytes) -> None:
    """Codec, rate and number of header packets from the first packet, for the codecs whose granule positions count samples."""
    if packet.startswith(SAMPLES) and len(packet) >= 13:
        s.codec, s.rate, s.channels = "pcm8", struct.unpack_from("<I", packet, 8)[0], max(1, packet[12])
    elif packet.startswith(NOTE):
        s.codec, s.rate = "note", RATE
    elif packet.startswith(b"OpusHead") and len(packet) >= 12:
        s.codec, s.rate, s.headers, s.skip = "opus", 48000, 2, struct.unpack_from("<H", packet, 10)[0]
    elif packet.startswith(b"\x01vorbis") and len(packet) >= 16:
        s.codec, s.rate, s.headers = "vorbis", struct.unpack_from("<I", packet, 12)[0], 3
    elif packet.startswith(b"\x7fFLAC") and len(packet) >= 30:
        s.codec, s.rate, s.headers = "flac", int.from_bytes(packet[27:30], "big") >> 4, 1 + int.from_bytes(packet[7:9], "big")


def duration(s: Stream, packet: bytes) -> int | None:
    """Samples that a data packet holds; None where its codec does not tell without its setup."""
    if s.codec == "pcm8":
        return len(packet) // s.channels
    if s.codec == "note":
        return 0
    if s.codec == "opus" and packet:
        mode = packet[0] >> 3
        # frame lengths in samples at 48 kHz, by the groups of the configuration number
        frame = (480, 960, 1920, 2880)[mode & 3] if mode < 12 else (480, 960)[mode & 1] if mode < 16 else (120, 240, 480, 960)[mode & 3]
        count = (1, 2, 2)[packet[0] & 3] if packet[0] & 3 < 3 else packet[1] & 63 if len(packet) > 1 else 0
        return frame * count
    if s.codec == "flac" and len(packet) > 5:
        code = packet[2] >> 4
        if code in (6, 7):  # the length stands behind the frame number, which is as long as its first byte's leading ones say
            lead = 8 - (packet[4] ^ 0xFF).bit_length()
            at = 4 + max(1, lead)
            return int.from_bytes(packet[at : at + code - 5], "big") + 1
        return 192 if code == 1 else 576 << (code - 2) if 2 <= code <= 5 else 256 << (code - 8) if code >= 8 else None
    return None


def _place(s: Stream, new: range, granule: int, last: bool) -> None:
    """Positions of the packets that end on one page, from the position of the last of them.

    On the last page of a stream positions go forward from the page before and stop at the page's own, which may cut
    the end of a packet off. Where durations are unknown, packets share evenly what the page adds.
    """
    data = [i for i in new if i >= s.headers]
    for i in new:
        s.granules[i] = granule if i >= s.headers else 0
    if not data:
        return
    long = [duration(s, s.packets[i]) for i in data]
    if None in long:
        step = (granule - s.last) / len(data) if s.last is not None and granule >= s.last else None
        ends = [granule if k + 1 == len(data) else None if step is None else granule - round(step * (len(data) - 1 - k)) for k in range(len(data))]
        start = s.last if s.last is not None else None if ends[0] is None or len(data) > 1 else 0
    else:
        before = granule - sum(long)
        if last and s.last is not None and before < s.last:
            before = s.last
        ends = [min(granule, before + sum(long[: k + 1])) for k in range(len(data))]
        start = before
    for i, end in zip(data, ends, strict=True):
        s.granules[i] = end
    behind = s.last if s.last is not None else 0 if s.begins else None
    if s.gap and None not in long and behind is not None:
        s.lost += max(0, start - behind)
    s.gap = False
    if s.first is None:
        s.first = start if start is None else max(0, start)
    s.last = granule


def _found(media: list[bytes]) -> list[tuple[int, tuple, bytes, bytes, bool]]:
    """Pages in order: number of the physical stream, header, lacing, body, and whether the checksum fits.

    Behind a page whose checksum does not fit the search goes on at its fifth byte, since its own lengths may be what is
    damaged; what such a search finds inside a page that fits is none. Checksums are computed for many pages at once.
    """
    seen: list[dict[int, tuple]] = [{} for _ in media]
    fits: list[dict[int, bool]] = [{} for _ in media]
    starts = [(k, 0) for k in range(len(media))]
    while starts:
        asked: list[tuple[int, int]] = []
        whole: list[bytes] = []
        held, later = 0, []

        def verify() -> None:
            for (k, at), crc in zip(asked, ogg_crc_many(whole).tolist() if whole else [], strict=True):
                fits[k][at] = crc == seen[k][at][0][6]
                if not fits[k][at]:
                    later.append((k, at + 4))
            asked.clear()
            whole.clear()

        for k, at in starts:
            data = media[k]
            at = data.find(b"OggS", at)
            while 0 <= at and at + 27 <= len(data) and at not in seen[k]:
                head = PAGE_HEAD.unpack_from(data, at)
                lacing = data[at + 27 : at + 27 + head[7]]
                end = at + 27 + head[7] + sum(lacing)
                if head[1] or len(lacing) < head[7] or end > len(data):
                    at = data.find(b"OggS", at + 4)
                    continue
                seen[k][at] = head, lacing, end
                asked.append((k, at))
                whole.append(data[at : at + 22] + bytes(4) + data[at + 26 : end])
                held += end - at
                if held > TOGETHER:
                    verify()
                    held = 0
                at = data.find(b"OggS", end)
        verify()
        starts = later
    out = []
    for k, pages in enumerate(seen):
        free = 0
        for at in sorted(pages):
            if at >= free:
                head, lacing, end = pages[at]
                out.append((k, head, lacing, media[k][at + 27 + head[7] : end], fits[k][at]))
                free = end if fits[k][at] else free
    return out


def demux(media: list[bytes]) -> list[list[Stream]]:
    """Logical streams of each physical stream, in order of appearance.

    Bytes between pages are skipped. A page with a wrong checksum is left out, and counted with the stream that its
    serial number names if there is one; no page behind or inside it is lost by that. Pages that are missing between
    others are counted by their numbers (``lost_pages``), the time that they held by positions where the codec tells
    durations (``lost``). ``lost_packets`` are packets of which some but not all parts are there. A page flagged as a
    first one begins a new stream, though an earlier one had the same serial number (chained streams).
    """
    streams: list[list[Stream]] = [[] for _ in media]
    current: dict[tuple[int, int], Stream] = {}
    for k, head, lacing, body, fit in _found(media):
        _, _, kind, granule, serial, sequence, _, _ = head
        s = current.get((k, serial))
        if not fit:
            if s is not None:
                s.bad_pages += 1
            continue
        if s is None or (kind & FIRST and s.pages):  # a stream that begins again is another one
            if s is not None:
                s.lost_packets, s.open = s.lost_packets + (s.open is not None), None
            s = current[k, serial] = Stream(serial)
            streams[k].append(s)
        s.pages += 1
        s.late += s.ends
        s.begins |= bool(kind & FIRST)
        s.ends |= bool(kind & LAST)
        gap = s.sequence >= 0 and sequence != s.sequence + 1
        if gap:
            s.gap = True
            s.lost_pages += max(0, sequence - s.sequence - 1)
        s.sequence = sequence
        if s.open is not None and (gap or not kind & CONTINUED):
            s.open, s.lost_packets = None, s.lost_packets + 1
        skip = bool(kind & CONTINUED) and s.open is None  # the rest of a packet whose start is missing
        at = 0
        part = s.open or []
        pending = bool(kind & CONTINUED)
        size, before = 0, len(s.packets)
        for n in lacing:
            size += n
            pending = True
            if n < 255:
                part.append(body[at : at + size])
                if skip:
                    skip, s.lost_packets = False, s.lost_packets + (not gap)
                else:
                    s.packets.append(b"".join(part))
                    s.granules.append(None)
                at, size, part, pending = at + size, 0, [], False
        s.open = None
        if pending and not skip:
            part.append(body[at : at + size])
            s.open = part
        if s.codec == "unknown" and not before and s.packets:
            _header(s, s.packets[0])
        if len(s.packets) > before and granule >= 0:
            _place(s, range(before, len(s.packets)), granule, bool(kind & LAST))
    for group in streams:
        for s in group:
            s.lost_packets += s.open is not None
    return streams


def mux_column(df: DataFrame, text: str, media: str = "media") -> DataFrame:
    """Add ``media``: the UTF-8 bytes of ``text``, padded with zeros to a positive multiple of 64, as an Ogg stream.

    A null text counts as empty and gives 64 zeros. Equal texts give equal bytes. A column already called
    ``media`` is replaced; all others stay.
    """

    def make(texts: pa.Array) -> pa.Array:
        raw = [x.encode() if isinstance(x, str) else x or b"" for x in texts.to_pylist()]
        return pa.array(mux([x.ljust(max(64, -(-len(x) // 64) * 64), b"\0") for x in raw], [len(x) for x in raw]), pa.binary())

    return map_column(df, text, media, "binary", make)


def demux_column(df: DataFrame, media: str, streams: str = "streams") -> DataFrame:
    """Add ``streams``: the logical streams in ``media`` with packets joined, counts and times.

    Null or empty media, or bytes that hold no page, give an empty array.
    """
    kind = pa.list_(pa.struct([
        ("serial", pa.int64()), ("codec", pa.string()), ("rate", pa.int32()), ("begins", pa.bool_()), ("ends", pa.bool_()), ("late_pages", pa.int32()), ("pages", pa.int32()), ("bad_pages", pa.int32()),
        ("packets", pa.int32()), ("lost_packets", pa.int32()), ("lost_pages", pa.int32()), ("lost_s", pa.float64()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("packet_end_s", pa.list_(pa.float64())), ("payload", pa.binary()),
    ]))

    def make(data: pa.Array) -> pa.Array:
        return pa.array([[s.row() for s in x] for x in demux([b or b"" for b in data.to_pylist()])], kind)

    return map_column(df, media, streams, DEMUX_SCHEMA, make)


def sample_features(df: DataFrame, payload: str, feature: str = "feature") -> DataFrame:
    """Add ``feature``: level, peak and sign changes of 8-bit samples around their middle, as text."""

    def make(data: pa.Array) -> pa.Array:
        out = []
        for b in data.to_pylist():
            x = np.frombuffer(b or b"", np.uint8).astype(np.int16) - 128
            if not len(x):
                out.append("rms=0;peak=0;crossings=0")
                continue
            level = float(np.sqrt(np.mean(np.square(x, dtype=np.int64))))
            out.append(f"rms={level:.4f};peak={int(np.abs(x).max())};crossings={int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))}")
        return pa.array(out, pa.string())

    return map_column(df, payload, feature, "string", make)


def op2_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` stored as Ogg samples, read back, with digests of payload and stored form."""
    stored = mux_column(documents(spark, sf_dir).select("doc_id", "text"), "text").select("doc_id", "media")
    read = demux_column(stored, "media").select(
        "doc_id",
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.filter("streams", lambda s: s["codec"] == "pcm8")[0].alias("main"),
        F.filter("streams", lambda s: s["codec"] == "note")[0]["payload"].alias("note"),
    )
    read = read.select("doc_id", "media_bytes", "media_sha256", "note", "main.*")
    little = F.concat(*[F.substring("note", i, 1) for i in range(8, 0, -1)])
    return sample_features(read, "payload").select(
        "doc_id",
        F.conv(F.hex(little), 16, 10).cast("long").alias("n_bytes"),
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -64, 64)).alias("tail_crc32"),
        "media_bytes",
        "media_sha256",
        F.concat_ws(";", F.concat(F.lit("codec="), "codec"), F.concat(F.lit("rate="), "rate"), F.concat(F.lit("pages="), "pages"), F.concat(F.lit("packets="), "packets"), F.concat(F.lit("end_s="), "end_s"), "feature").alias("feature"),
        "bad_pages",
        "lost_packets",
    )
