from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from groundmill.config import Config
from groundmill.functions import text as T
from groundmill.operators import chunks as C
from groundmill.operators import sections as S

REPORT = "\n".join([
    "Cover line", "Item 1. | Business | 1", "Item 1A. | Risks | 5", "Item 7. | Discussion | 20",
    "Item 1. Business", "We make lamps.", "Lamp Works | 2024 Form 10-K | 3", "More on lamps.",
    "Item 1A. Risk Factors", "Bulbs may break.", "item 7 .", "Our own discussion", "Sales rose.",
])


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_normalize_keeps_blank_lines_that_held_blanks(spark):
    assert one(spark, T.normalize_ws(F.lit("a\r\nb \t\xa0 c\n\n\n\nd\n \n \ne  "))) == "a\nb c\n\nd\n\n\ne"


def test_fold_and_numbers(spark):
    assert one(spark, T.fold(F.lit(" “It’s”\xa0A–B ")) ) == "\"it's\" a-b"
    assert one(spark, T.numbers(F.lit("$391,035 and -0.50% then 007. or 0"))) == ["391035", ".50", "7", "0"]


def test_question_key_of_common_words_is_empty(spark):
    assert one(spark, T.question_key(F.lit("What is the?"))) == ""
    assert one(spark, T.question_key(F.lit("What was the Net-Sales of 2024?"))) == "net sales 2024"


def test_sections_skip_contents_and_footers(spark):
    rows = S.split_sections(docs(spark, REPORT)).orderBy("section_ord").collect()
    assert [r["item"] for r in rows] == ["1", "1A", "7"]
    assert rows[0]["body"] == "We make lamps.\n\nMore on lamps."
    assert rows[2]["name"].startswith("Management") and rows[2]["body"] == "Sales rose."


def test_text_without_headings_is_one_section(spark):
    rows = S.split_sections(docs(spark, " plain ", None)).collect()
    assert [(r["doc_id"], r["name"], r["body"]) for r in rows] == [(0, "Full Document", " plain ")]


def test_useful_sections(spark):
    text = "Item 2. Properties\nNone.\nItem 3. Legal\nLong enough text here\nItem 4. Mine\nLong enough text here\n"
    cfg = Config(min_chunk_chars=3)
    assert [r["item"] for r in S.useful_sections(S.split_sections(docs(spark, text)), cfg).collect()] == ["3"]


def test_windows_overlap_and_keep_their_bound(spark):
    text = "\n\n".join(f"Paragraph {i} has a few words." for i in range(40))
    got = one(spark, C.pack_paragraphs(F.lit(text), 200, 20))
    assert len(got) > 1 and all(len(p) <= 200 + 20 + 2 for p in got)
    assert got[1].startswith(got[0][-20:].strip())


def test_over_long_paragraph_is_packed_by_lines(spark):
    got = one(spark, C.pack_paragraphs(F.lit("short\n\n" + "\n".join(["x" * 30] * 5) + "\n\nend"), 70, 10))
    assert got == ["short", "x" * 30 + "\n" + "x" * 30, "x" * 30 + "\n" + "x" * 30, "x" * 30, "end"]


def test_short_tails_fold_into_the_piece_before(spark):
    got = one(spark, C.fold_tails(F.array(F.lit("tiny"), F.lit("a" * 20), F.lit("b"), F.lit("c")), 10))
    assert [(p["part"], p["text"]) for p in got] == [(0, "tiny"), (1, "a" * 20 + "\n\nb\n\nc")]


def test_chunk_ids_repeat_but_places_do_not(spark):
    body = "Item 1. Business\n" + "Same words here. " * 10
    rows = C.chunk_documents(docs(spark, body, body), Config(min_chunk_chars=10)).collect()
    assert len({r["chunk_id"] for r in rows}) == 1 and len({(r["doc_id"], r["chunk_ord"]) for r in rows}) == 2


def python_pack(block, limit):
    out, held = [], ""
    for line in block.split("\n"):
        if held and len(held) + len(line) + 1 > limit:
            out.append(held.strip())
            held = line
        else:
            held = held + "\n" + line if held else line
    return out + [held.strip()] if held.strip() else out


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("ab \n", max_size=60), min_size=1, max_size=8))
def test_line_packing_equals_a_loop(spark, texts):
    rows = docs(spark, *texts).select("doc_id", C.pack_lines(F.col("text"), 12).alias("p")).orderBy("doc_id").collect()
    assert [r["p"] for r in rows] == [python_pack(t, 12) for t in texts]


def test_config_reads_the_environment_when_asked():
    cfg = Config.from_env({"QA_MAX_CHUNK_CHARS": "123", "QA_MIN_PASSAGE_OVERLAP": "bad"}, max_chunks=2)
    assert (cfg.max_chunk_chars, cfg.min_passage_overlap, cfg.max_chunks) == (123, 0.6, 2)


def test_texts_are_searched_once_for_sections(spark, tmp_path):
    """Headings and footers were searched several times: in each half of a union, and in filters that were moved before the search."""
    docs(spark, REPORT, " plain ", None).write.parquet(str(tmp_path / "d"))
    chunks = C.chunk_documents(spark.read.parquet(str(tmp_path / "d")), Config(min_chunk_chars=1))
    chunks.collect()
    plan = chunks._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1 and plan.count("Form[") == 1 and "Union" not in plan


def test_short_sections_and_void_ones_with_space_around(spark):
    bodies = ["None.", " \u2003none\n", "[Reserved]\x85", "not applicable. ", "none of it", "x none", "", "\n \n", None]
    rows = spark.createDataFrame([(i, "1", b) for i, b in enumerate(bodies)], "k long, item string, body string")
    assert [r["k"] for r in S.useful_sections(rows, Config(min_chunk_chars=1)).orderBy("k").collect()] == [4, 5, 7]


def test_strip_of_a_text_at_hand_equals_strip(spark):
    texts = ["", " ", "a", " a", "a\u3000", "\x85a b\x1c", "\x1f\u2028", "\u180ea", "\u200ba\n\n", "\U0001f600 \U0001f600", "\U0001f600\xa0", "a\n", None]
    t = spark.createDataFrame([(x,) for x in texts], "x string")
    assert [r[0] for r in t.select(T.strip_made(F.col("x"))).collect()] == [r[0] for r in t.select(T.strip(F.col("x"))).collect()]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("ab \n \U0001f600", max_size=12), min_size=1, max_size=12))
def test_packing_of_lines_equals_a_loop(spark, parts):
    def loop(text, limit=9):
        cur, out = "", []
        for line in text.split("\n"):
            if len(cur) + len(line) + 1 > limit and cur:
                out, cur = [*out, cur.strip()], line
            else:
                cur = f"{cur}\n{line}" if cur else line
        return [*out, cur.strip()] if cur.strip() else out

    text = "\n".join(parts)
    packed = C.pack_lines(F.lit(text), 9)
    assert one(spark, packed) == loop(text)
    plan = spark.range(1).select(F.concat(F.col("id").cast("string"), F.lit(text)).alias("t")).select(C.pack_lines(F.col("t"), 9))._jdf.queryExecution().analyzed().toString()
    assert "length(lambda" in plan and ".cur) + length" not in plan  # the piece so far is not counted anew at each line
