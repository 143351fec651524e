"""Text functions as Spark columns. White space, digits and letters are Unicode's, as the data model asks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Character class of white space, for Java's and RE2's syntax alike; INLINE is all of it but the line feed.
SPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
INLINE = r"[\t\x0b-\r\x1c-\x20\x{85}\p{Z}]"
#: Punctuation that stands for an ASCII character of its own, one for one.
CURLY, ASCII = "‘’‛“”„–—−   ", "'''\"\"\"---   "
#: Words that a question's key leaves out.
QUESTION_WORDS = "what is the a an of in for to s was were did how much many".split()
NUMBER = rf"-?\$?{SPACE}?\p{{Nd}}[\p{{Nd}},]*(?:\.\p{{Nd}}+)?{SPACE}?%?"
SEPARATOR = "␟"


def strip(c: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(c, rf"\A{SPACE}+|{SPACE}+\z", "")


def strip_made(c: Column) -> Column:
    """As ``strip``, for a text at hand, such as a column or a lambda's variable: it is read more than once, but not searched unless white space is at an end."""
    ends = F.concat(F.left(c, F.lit(1)), F.right(c, F.lit(1)))
    return F.when(ends.rlike(SPACE), strip(c)).otherwise(c)


def squash(c: Column) -> Column:
    """Every run of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def normalize_ws(c: Column) -> Column:
    """Line feeds only, runs of blanks as one, at most one empty line in a row, lines stripped.

    Lines that hold only blanks become empty after empty lines were collapsed, so more than one can remain.
    """
    c = F.regexp_replace(c, "\r\n?", "\n")
    c = F.regexp_replace(c, "[ \t ]+", " ")
    c = F.regexp_replace(c, "\n{3,}", "\n\n")
    return strip(F.regexp_replace(c, f"{INLINE}*\n{INLINE}*", "\n"))


def norm_punct(c: Column) -> Column:
    """Typographic quotes, dashes and blanks as ASCII; the length stays."""
    return F.translate(c, CURLY, ASCII)


def fold(c: Column) -> Column:
    """For comparison: ASCII punctuation, squashed, lower case."""
    return F.lower(squash(norm_punct(c)))


def tokens(c: Column) -> Column:
    """Distinct words of the folded text."""
    return F.array_remove(F.array_distinct(F.split(fold(c), " ")), "")


def numbers(c: Column) -> Column:
    """Numbers in order, as digits and point without sign, unit or leading zeros."""
    found = F.regexp_extract_all(c, F.lit(NUMBER), F.lit(0))
    bare = F.transform(found, lambda x: F.regexp_replace(F.regexp_replace(x, r"[^\p{Nd}.]", ""), r"\A0+|\.+\z", ""))
    return F.transform(bare, lambda x: F.when(x == "", "0").otherwise(x))


def stable_id(*parts: Column, length: int = 12) -> Column:
    """First hex digits of the SHA-256 of the parts."""
    return F.substring(F.sha2(F.concat_ws(SEPARATOR, *parts), 256), 1, length)


def token_estimate(c: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(c) / 4).cast("int"))


def key_words(c: Column) -> Column:
    """The words of ``question_key``, among them the common ones and empty ones: one search of a text, not one for each alternative at each place."""
    return F.split(F.lower(c), "[^a-z0-9]+")


def question_key(c: Column) -> Column:
    """Loose key of a question: ASCII words without the common ones."""
    c = F.regexp_replace(F.lower(c), "[^a-z0-9 ]+", " ")
    c = F.regexp_replace(c, rf"\b({'|'.join(QUESTION_WORDS)})\b", " ")
    return F.trim(F.regexp_replace(c, " +", " "))
