"""Chunks: greedy packing of paragraphs into overlapping windows, short tails folded, stable ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundmill.config import Config
from groundmill.functions.text import stable_id, token_estimate
from groundmill.functions.text import strip_made as strip

from .sections import split_sections, useful

EMPTY = "cast(array() as array<string>)"


def paragraphs(c: Column) -> Column:
    """Parts between empty lines, stripped, none empty."""
    return F.filter(F.transform(F.split(c, "\n{2,}"), strip), lambda p: p != "")


def pack_lines(c: Column, limit: int) -> Column:
    """Lines of a block packed greedily into pieces of at most ``limit`` characters; a longer line stays whole."""
    start = F.struct(F.lit("").alias("cur"), F.lit(0).alias("n"), F.expr(EMPTY).alias("out"))

    def step(acc: Column, line: Column) -> Column:
        cur, n, out = acc["cur"], acc["n"], acc["out"]  # ``n`` is the length of ``cur``, which is dear to count
        full = (cur != "") & (n + F.length(line) + 1 > limit)
        begins = (cur == "") | full
        return F.struct(
            F.when(begins, line).otherwise(F.concat(cur, F.lit("\n"), line)).alias("cur"),
            F.when(begins, F.length(line)).otherwise(n + F.length(line) + 1).alias("n"),
            F.when(full, F.array_append(out, strip(cur))).otherwise(out).alias("out"),
        )

    last = lambda acc: F.when(strip(acc["cur"]) != "", F.array_append(acc["out"], strip(acc["cur"]))).otherwise(acc["out"])
    return F.aggregate(F.split(c, "\n"), start, step, last)


def pack_paragraphs(c: Column, max_chars: int, overlap: int) -> Column:
    """Windows of whole paragraphs of at most ``max_chars`` characters before the overlap is put in front.

    A window that is full is closed and the next one begins with its last ``overlap`` characters. A paragraph
    beyond the limit closes the window and is packed by lines, without overlap. An overlap of 0 repeats the
    whole window; callers that do not want this keep the overlap positive.
    """
    start = F.struct(F.lit("").alias("cur"), F.expr(EMPTY).alias("out"))
    tail = (lambda s: F.right(s, F.lit(overlap))) if overlap else (lambda s: s)

    def step(acc: Column, p: Column) -> Column:
        cur, out = acc["cur"], acc["out"]
        closed = F.when(cur == "", out).otherwise(F.array_append(out, strip(cur)))
        over = F.length(p) > max_chars
        full = (F.length(cur) + F.length(p) + 2 > max_chars) & (cur != "")
        following = F.when(full, strip(F.concat(tail(cur), F.lit("\n\n"), p))).when(cur == "", p).otherwise(F.concat(cur, F.lit("\n\n"), p))
        return F.struct(
            F.when(over, F.lit("")).otherwise(following).alias("cur"),
            F.when(over, F.concat(closed, pack_lines(p, max_chars))).when(full, closed).otherwise(out).alias("out"),
        )

    last = lambda acc: F.when(strip(acc["cur"]) != "", F.array_append(acc["out"], strip(acc["cur"]))).otherwise(acc["out"])
    return F.filter(F.aggregate(paragraphs(c), start, step, last), lambda x: x != "")


def fold_tails(pieces: Column, min_chars: int) -> Column:
    """(part, head, text) per piece; one below ``min_chars`` that is not the first joins the piece before it."""
    kind = "array<struct<part: int, head: string, text: string>>"
    numbered = F.transform(pieces, lambda x, i: F.struct(i.alias("part"), x.alias("head"), x.alias("text")))

    def step(out: Column, p: Column) -> Column:
        last = F.element_at(out, -1)
        joined = F.struct(last["part"].alias("part"), last["head"].alias("head"), strip(F.concat(last["text"], F.lit("\n\n"), p["text"])).alias("text"))
        short = (F.length(p["text"]) < min_chars) & (p["part"] > 0) & (F.size(out) > 0)
        return F.when(short, F.concat(F.slice(out, F.lit(1), F.greatest(F.lit(0), F.size(out) - 1)), F.array(joined))).otherwise(F.array_append(out, p))

    return F.aggregate(numbered, F.expr(f"cast(array() as {kind})"), step)


def chunk_sections(sections: DataFrame, cfg: Config, key: str = "doc_id", keep: Column | None = None) -> DataFrame:
    """Chunks of sections (key, section_ord, item, name, body), of those alone that ``keep`` holds for, numbered by ``chunk_ord`` along each document.

    ``chunk_id`` depends on item, part and the first 120 characters only, so equal boilerplate of two documents
    has equal ids: join on (key, chunk_ord).
    """
    pieces = fold_tails(pack_paragraphs(F.col("body"), cfg.max_chunk_chars, cfg.chunk_overlap_chars), cfg.min_chunk_chars)
    # null explodes to no rows; a filter would be moved before the body is made and make it once more for each of its terms
    packed = sections.withColumn("_p", F.explode(pieces if keep is None else F.when(keep, pieces)))
    chunk_id = stable_id(F.col("item"), F.col("_p.part").cast("string"), F.substring("_p.head", 1, 120))
    rows = packed.select(key, "section_ord", chunk_id.alias("chunk_id"), F.col("item").alias("section_item"), F.col("name").alias("section_name"), F.col("_p.part").alias("part_index"), F.col("_p.text").alias("text"))
    rows = rows.withColumns({"n_chars": F.length("text"), "n_tokens": token_estimate(F.col("text"))})
    return rows.withColumn("chunk_ord", F.row_number().over(Window.partitionBy(key).orderBy("section_ord", "part_index")) - 1)


def chunk_documents(docs: DataFrame, cfg: Config, key: str = "doc_id", text: str = "text", drop_low_signal: bool = True) -> DataFrame:
    """Texts to chunks: sections, the useful ones, windows."""
    return chunk_sections(split_sections(docs, key, text, cfg.form), cfg, key, useful(cfg, drop_low_signal))


def first_chunks(chunks: DataFrame, most: int | None, key: str | None = "doc_id") -> DataFrame:
    """The first ``most`` chunks: of each document by ``key``, or of all documents in order where it is null."""
    if most is None:
        return chunks
    return chunks.where(F.col("chunk_ord") < most) if key else chunks.orderBy("doc_id", "chunk_ord").limit(most)


def chunk_metrics(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.count("*").alias("n_chunks"), F.countDistinct("section_item").alias("n_sections"), F.sum("n_tokens").alias("n_tokens"))
