"""Sections of a report, found by their headings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundmill.config import FORMS, LOW_SIGNAL_BY_FORM, Config
from groundmill.functions.text import SPACE, strip

#: A heading stands on its own line: item number, full stop, a title without a table's bar. The title may be on the next line.
HEADING = rf"(?im)^Item{SPACE}+(\p{{Nd}}{{1,2}}[A-Z]?){SPACE}*\.{SPACE}+([^\n|]{{2,120}})$"
FOOTER = rf"(?im)^.*\|{SPACE}*\p{{Nd}}{{4}}{SPACE}+Form{SPACE}+10-K{SPACE}*\|{SPACE}*\p{{Nd}}+{SPACE}*$"
VOID = r"(?i)\A(?:none|not applicable|\[reserved\])\.?\z"
#: The same in a text that was not stripped; it is decided at the text's first characters.
VOID_INSIDE = VOID.replace(r"\A", rf"\A{SPACE}*+").replace(r"\z", rf"{SPACE}*\z")
#: Java ends lines at more characters than the line feed unless told not to.
UNIX_LINES = "(?d)"


def clean_body(c: Column) -> Column:
    """Without page footers, at most one empty line in a row, stripped."""
    return strip(F.regexp_replace(F.regexp_replace(c, UNIX_LINES + FOOTER, ""), "\n{3,}", "\n\n"))


def split_sections(docs: DataFrame, key: str = "doc_id", text: str = "text", form: str = "10-K") -> DataFrame:
    """(key, section_ord, item, name, body), one row per section in document order.

    Items that the report's form names go by that name, others by their title.

    What stands before the first heading is dropped. A text without headings is one section "Full Document" with
    an empty item, as it is. A null text has no section.
    """
    heads = F.regexp_extract_all(text, F.lit(UNIX_LINES + HEADING), F.lit(0))
    bodies = F.split(text, UNIX_LINES + HEADING, -1)
    known = F.create_map(*[F.lit(x) for kv in FORMS.get(form, {"": ""}).items() for x in kv])
    # one read of each text: a union of texts with and without headings would search all of them several times
    split = docs.select(key, F.col(text).alias("_text"), heads.alias("_heads"), bodies.alias("_bodies")).where("_text IS NOT NULL")
    none = F.array(F.struct(F.lit(None).cast("string").alias("_heads"), F.col("_text").alias("_after")))
    zipped = F.arrays_zip("_heads", F.slice("_bodies", 2, F.size("_heads")).alias("_after"))
    found = split.select(key, F.posexplode(F.when(F.size("_heads") > 0, zipped).otherwise(none)).alias("section_ord", "s"))
    head, after = F.col("s._heads"), F.col("s._after")
    item = F.upper(F.regexp_extract(head, UNIX_LINES + HEADING, 1))
    title = strip(F.regexp_extract(head, UNIX_LINES + HEADING, 2))
    name = F.coalesce(F.try_element_at(known, item), title, F.lit("Full Document"))
    return found.select(key, "section_ord", F.coalesce(item, F.lit("")).alias("item"), name.alias("name"), F.when(head.isNull(), after).otherwise(clean_body(after)).alias("body"))


def useful(cfg: Config, drop_low_signal: bool = True) -> Column:
    """Whether a section (item, body) is not low-signal, short or one that only says that there is nothing."""
    keep = (F.length("body") >= cfg.min_chunk_chars) & ~F.col("body").rlike(VOID_INSIDE)
    low = LOW_SIGNAL_BY_FORM.get(cfg.form, ())
    return ~F.col("item").isin(*low) & keep if drop_low_signal and low else keep


def useful_sections(sections: DataFrame, cfg: Config, drop_low_signal: bool = True) -> DataFrame:
    """Without low-signal items, short bodies and bodies that only say that there is nothing."""
    return sections.where(useful(cfg, drop_low_signal))
