"""Checksums over many byte strings at once.

A CRC is linear: the remainder of a message is the XOR of what each byte contributes given its
distance from the end. With one table row per distance, a block is a gather and an XOR, and blocks are
chained by the linear map that shifts a remainder past one block.
"""

from __future__ import annotations

import functools

import numpy as np

BLOCK = 512
STEP = 64  # blocks at a time, so that the working set stays in cache
CASTAGNOLI = 0x82F63B78  # reflected polynomial of CRC-32C
OGG = 0x04C11DB7  # forward polynomial of the page checksum


def _byte_table(poly: int, reflected: bool) -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    if reflected:
        for _ in range(8):
            t = np.where(t & 1, (t >> 1) ^ np.uint32(poly), t >> 1).astype(np.uint32)
    else:
        t = t << np.uint32(24)
        for _ in range(8):
            t = np.where(t & np.uint32(0x80000000), (t << np.uint32(1)) ^ np.uint32(poly), t << np.uint32(1)).astype(np.uint32)
    return t


@functools.lru_cache(maxsize=4)
def _tables(poly: int, reflected: bool) -> tuple[np.ndarray, np.ndarray]:
    """(position table of BLOCK x 256, shift tables of 4 x 256 that move a remainder past one block)."""
    t = _byte_table(poly, reflected)

    def zero(crc: np.ndarray) -> np.ndarray:
        if reflected:
            return (crc >> np.uint32(8)) ^ t[crc & np.uint32(255)]
        return (crc << np.uint32(8)) ^ t[crc >> np.uint32(24)]

    rows = np.empty((BLOCK, 256), np.uint32)
    rows[BLOCK - 1] = t
    for i in range(BLOCK - 2, -1, -1):
        rows[i] = zero(rows[i + 1])
    shift = np.empty((4, 256), np.uint32)
    for b in range(4):
        crc = np.arange(256, dtype=np.uint32) << np.uint32(8 * b)
        for _ in range(BLOCK):
            crc = zero(crc)
        shift[b] = crc
    return rows, shift


def crc_many(messages: list[bytes], poly: int, reflected: bool, invert: bool) -> np.ndarray:
    """CRC of each message as uint32. ``invert``: start from all ones and flip the result.

    With ``invert`` messages need four bytes at least.
    """
    rows, shift = _tables(poly, reflected)
    sizes = np.array([len(m) for m in messages], np.int64)
    blocks = -(-sizes // BLOCK)
    out = np.zeros(len(messages), np.uint32)
    if not len(messages) or not blocks.sum():
        return out
    ends = np.cumsum(blocks)
    data = np.zeros((int(ends[-1]), BLOCK), np.uint8)
    flat = data.reshape(-1)
    for m, end, n in zip(messages, ends.tolist(), sizes.tolist(), strict=True):
        if n:
            flat[end * BLOCK - n : end * BLOCK] = np.frombuffer(m, np.uint8)
            if invert:
                flat[end * BLOCK - n : end * BLOCK - n + 4] ^= 255
    at = np.arange(BLOCK, dtype=np.intp) * 256
    table = rows.reshape(-1)
    sums = np.empty(len(data), np.uint32)
    where, got = np.empty((STEP, BLOCK), np.intp), np.empty((STEP, BLOCK), np.uint32)
    for i in range(0, len(data), STEP):
        n = min(STEP, len(data) - i)
        np.add(data[i : i + n], at, out=where[:n])
        np.take(table, where[:n], out=got[:n], mode="wrap")
        np.bitwise_xor.reduce(got[:n], axis=1, out=sums[i : i + n])
    order = np.argsort(-blocks, kind="stable")
    most, first = blocks[order], (ends - blocks)[order]
    crc = np.zeros(len(messages), np.uint32)
    for k in range(int(most[0])):
        n = int(np.searchsorted(-most, -k, side="left"))  # messages with more than k blocks
        c = crc[:n]
        c = shift[0][c & 255] ^ shift[1][(c >> 8) & 255] ^ shift[2][(c >> 16) & 255] ^ shift[3][c >> 24]
        crc[:n] = c ^ sums[first[:n] + k]
    out[order] = crc
    return ~out if invert else out


def crc32c_many(messages: list[bytes]) -> np.ndarray:
    return crc_many(messages, CASTAGNOLI, True, True)


def masked(crc: np.ndarray) -> np.ndarray:
    """Rotate right by 15 bits and add a constant, so that a checksum of checksums stays sound."""
    crc = crc.astype(np.uint32)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)


def ogg_crc_many(messages: list[bytes]) -> np.ndarray:
    return crc_many(messages, OGG, False, False)
