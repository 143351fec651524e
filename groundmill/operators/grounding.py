"""Deterministic grounding: is the quote in its chunk, are the answer's numbers in the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundmill.config import Config
from groundmill.functions.text import fold, numbers, tokens
from groundmill.sources.scratch import cut

#: Question types that may state a number of their own making.
LENIENT = ("numeric_calculation", "multi_step_reasoning")


def contained(passage: Column, chunk: Column) -> Column:
    """Whether the folded passage is in the folded chunk; an empty one is not."""
    return (fold(passage) != "") & F.contains(fold(chunk), fold(passage))


def token_overlap(passage: Column, chunk: Column) -> Column:
    """Share of the passage's distinct words that the chunk has; 0 without words."""
    p = tokens(passage)
    return F.when(F.size(p) == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(p, tokens(chunk))) / F.greatest(F.lit(1), F.size(p)))


def missing_numbers(answer: Column, chunk: Column, passage: Column) -> Column:
    """Numbers of the answer that neither chunk nor passage has, repeated ones too, in order."""
    source = F.concat(numbers(chunk), numbers(passage))
    return F.filter(numbers(answer), lambda x: ~F.array_contains(source, x))


def ground(pairs: DataFrame, cfg: Config) -> DataFrame:
    """Add exact, overlap, passage_in_chunk, missing_numbers, numbers_supported and passed to pairs with their chunk's text (``chunk_text``)."""
    filled = {c: F.coalesce(F.col(c), F.lit("")) for c in ("source_passage", "chunk_text", "answer")}
    out = pairs.withColumn("exact", contained(filled["source_passage"], filled["chunk_text"]))
    out = out.withColumn("overlap", F.when(F.col("exact"), F.lit(1.0)).otherwise(token_overlap(filled["source_passage"], filled["chunk_text"])))
    out = out.withColumns({"_answer_numbers": numbers(filled["answer"]), "missing_numbers": missing_numbers(filled["answer"], filled["chunk_text"], filled["source_passage"])})
    traced = (F.size("_answer_numbers") - F.size("missing_numbers")) * 2 >= F.size("_answer_numbers")
    out = out.withColumn("passage_in_chunk", F.col("exact") | (F.col("overlap") >= cfg.min_passage_overlap))
    out = out.withColumn("numbers_supported", F.coalesce(F.col("question_type").isin(*LENIENT), F.lit(False)) | (F.size("_answer_numbers") == 0) | traced)
    return out.withColumns({"token_overlap": F.round("overlap", 3), "passed": F.col("passage_in_chunk") & F.col("numbers_supported")}).drop("_answer_numbers", "overlap")


def _rarest(words: DataFrame, chunk_words: DataFrame, key: str, most: Column) -> DataFrame:
    """Rows of ``words`` (key, word, ...) for the ``most`` words of each key that the fewest chunks have; ``chunk_words`` is (word).

    Words that no chunk has count as the rarest, though they meet nothing.
    """
    seen = chunk_words.join(words.select("word").distinct(), "word", "left_semi").groupBy("word").agg(F.count("*").alias("df"))
    order = Window.partitionBy(key).orderBy(F.coalesce("df", F.lit(0)), "word")
    return words.join(seen, "word", "left").withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).drop("df", "place")


def overlap_join(passages: DataFrame, chunks: DataFrame, least: float, passage_key: str = "item_id", chunk_key: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """(passage_key, chunk_key, shared, n_tokens, keep...) of all passages and chunks (key, text) whose overlap is ``least`` or more.

    Of a passage's n words k must be shared, so of its n - k + m rarest at least m are, for any m. Each passage takes the
    m whose words bring the fewest rows together, by their measured frequencies, and pairs that share so many are counted
    by all words. Chunks are split once, into written rows (chunk, word) of the passages' words only, which frequencies,
    meeting and count all read. Columns of ``chunks`` named in ``keep`` come along; rows that repeat a key are
    passages or chunks of their own.
    """
    p = cut(passages.select(F.monotonically_increasing_id().alias("_p"), F.col(passage_key).alias("_key"), tokens(F.col("text")).alias("own")), "passages").withColumn("n_tokens", F.size("own")).where("n_tokens > 0")
    own = p.select("_p", "n_tokens", F.explode("own").alias("word"))
    split = chunks.select(F.monotonically_increasing_id().alias("_c"), chunk_key, *keep, tokens(F.col("text")).alias("its")).select("_c", chunk_key, *keep, F.explode("its").alias("word"))
    held = cut(split.join(own.select("word").distinct(), "word", "left_semi"), "chunk-words")
    seen = held.groupBy("word").agg(F.count("*").alias("df"))
    by = Window.partitionBy("_p").orderBy(F.coalesce("df", F.lit(0)), "word")
    needed = F.greatest(F.lit(1), F.ceil(F.lit(least) * F.col("n_tokens")))
    # m of the first ``place`` words: rows that meet, and what counting the pairs that can come of them adds
    ranked = own.join(seen.hint("merge"), "word", "left").select("_p", "n_tokens", "word", F.row_number().over(by).alias("place"), F.sum(F.coalesce("df", F.lit(0))).over(by.rowsBetween(Window.unboundedPreceding, 0)).alias("rows"))
    ranked = ranked.withColumn("m", F.col("place") - F.col("n_tokens") + needed)
    cost = F.when(F.col("m") >= 1, F.col("rows") * (1 + F.col("n_tokens") / F.col("m")))
    best = ranked.groupBy("_p").agg(F.min_by(F.struct(F.col("place").alias("last"), F.col("m").alias("least_shared")), cost).alias("b")).select("_p", "b.*")
    first = ranked.join(best.hint("merge"), "_p").where("place <= last").select("_p", "word", "least_shared")
    # files and shuffled blocks of numbers and repeated words are far smaller than the rows that a broadcast would hold in the driver
    met = held.select("_c", "word").join(first.hint("merge"), "word").groupBy("_p", "_c", "least_shared").agg(F.count("*").alias("n")).where("n >= least_shared").select("_p", "_c")
    words = met.join(own.hint("merge"), "_p")
    counted = words.join(held.hint("merge"), ["_c", "word"]).groupBy("_p", "_c", "n_tokens", chunk_key, *keep).agg(F.count("*").alias("shared")).where(F.col("shared") >= least * F.col("n_tokens"))
    return counted.join(p.select("_p", F.col("_key").alias(passage_key)).hint("merge"), "_p").select(passage_key, chunk_key, "n_tokens", "shared", *keep)


def containing(passages: DataFrame, chunks: DataFrame, passage_key: str = "item_id", chunk_key: str = "doc_id") -> DataFrame:
    """(passage_key, chunk_key) of all passages (key, text) whose folded text is in a chunk's.

    A chunk holds all words of its passages but the first and the last, which may be parts of its words. The
    rarest of those is what they meet on. Passages of one or two words have none; their last word is part of a
    word of the chunk, which is found among the different words of all chunks by its first three characters.
    Passages without words are in no chunk. Chunks are folded once, and written; their texts are never broadcast.
    """
    p = passages.select(passage_key, fold(F.col("text")).alias("own")).where("own <> ''").withColumn("listed", F.split("own", " "))
    inner = p.select(passage_key, F.explode(F.array_distinct(F.slice("listed", F.lit(2), F.greatest(F.lit(0), F.size("listed") - 2)))).alias("word"))
    c = cut(chunks.select(F.monotonically_increasing_id().alias("_c"), chunk_key, fold(F.col("text")).alias("its")), "folded")
    words = c.select("_c", F.explode(F.array_distinct(F.split("its", " "))).alias("word"))
    asked = words.join(inner.select("word").distinct(), "word", "left_semi")
    held = cut(asked, "inner-words")
    met = held.join(_rarest(inner, held.select("word"), passage_key, F.lit(1)), "word").select(passage_key, "_c")
    short = p.where(F.size("listed") <= 2).select(passage_key, F.element_at("listed", -1).alias("part"))
    if not short.isEmpty():  # a look at the passages alone
        short = short.withColumn("gram", F.substring("part", 1, 3))
        grams = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(3)), lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("word") - n + 1)), lambda i: F.substring("word", i, n))))
        listed = words.select("word").distinct().where("word <> ''").select("word", F.explode(F.array_distinct(grams)).alias("gram"))
        holding = short.join(listed, "gram").where(F.contains("word", F.col("part"))).select(passage_key, "word")
        met = met.unionByName(words.join(holding, "word").select(passage_key, "_c").distinct())
    return met.join(p.select(passage_key, "own"), passage_key).join(c.hint("merge"), "_c").where(F.contains("its", F.col("own"))).select(passage_key, chunk_key)
