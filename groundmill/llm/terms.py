"""Words of a text as its UTF-8 bytes: runs of digits, letters and all characters beyond ASCII, A to Z lower-cased."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: All signs of words; whatever else ASCII has parts them. A character beyond ASCII has only bytes of 128 and more.
_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
TABLE = bytes(b if b in _KEPT else b + 32 if b in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" else 32 for b in range(256))
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def words_column(text: Column) -> Column:
    """The same words as an array; null stays null."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def as_bytes(column: pa.Array) -> pa.Array:
    """A text column as bytes, null as empty."""
    return column.cast(pa.binary()).fill_null(b"")


def sql_words(text: str) -> str:
    return f"regexp_extract_all(translate({text}, '{UPPER}', '{LOWER}'), '{WORD}')"
