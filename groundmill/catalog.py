"""All queries of the core by name, each with the DuckDB statement that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from groundmill.config import LOW_SIGNAL, SECTION_NAMES, Config
from groundmill.functions import text as T
from groundmill.operators import chunks as C
from groundmill.operators import asof, completion, extensions, grounding, intervals, jobs, judging, merge, monitoring, near, pairs, prompts, quotas, running, snap
from groundmill.operators import html as H
from groundmill.operators import sections as S
from groundmill.plans import dataset
from groundmill.plans.inputs import CANDIDATES, FILINGS, LEVELS, TYPES, candidates, filings, table
from groundmill.sources import fetching, files, registry, scratch, sinks, versions
from groundmill.streaming import drops, keyed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
CFG = Config()
SMALL = Config(max_chunk_chars=1000, min_chunk_chars=200, chunk_overlap_chars=50)


def query(sql: str | None = None):
    """Register a function under its name, with its statement if SQL can express it."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# --- SQL for the text functions -------------------------------------------------------------------------------
SP, IN = T.SPACE, T.INLINE


def sq_strip(x: str) -> str:
    return f"regexp_replace({x}, '\\A{SP}+|{SP}+\\z', '', 'g')"


def sq_squash(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SP}+', ' ', 'g'))"


def sq_fold(x: str) -> str:
    quoted = T.ASCII.replace("'", "''")
    return f"lower({sq_squash(f'translate({x}, {chr(39)}{T.CURLY}{chr(39)}, {chr(39)}{quoted}{chr(39)})')})"


def sq_tokens(x: str) -> str:
    return f"list_distinct(list_filter(string_split({sq_fold(x)}, ' '), lambda w: w <> ''))"


def sq_numbers(x: str) -> str:
    return f"list_transform(regexp_extract_all({x}, '{T.NUMBER}'), lambda v: coalesce(nullif(regexp_replace(regexp_replace(v, '[^\\p{{Nd}}.]', '', 'g'), '\\A0+|\\.+\\z', '', 'g'), ''), '0'))"


def sq_key(x: str) -> str:
    words = "|".join(T.QUESTION_WORDS)
    return f"trim(regexp_replace(regexp_replace(regexp_replace(lower({x}), '[^a-z0-9 ]+', ' ', 'g'), '\\b({words})\\b', ' ', 'g'), ' +', ' ', 'g'))"


def sq_normalize(x: str) -> str:
    one = f"regexp_replace(regexp_replace(regexp_replace({x}, '\\r\\n?', chr(10), 'g'), '[ \\t\\x{{a0}}]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return sq_strip(f"regexp_replace({one}, '{IN}*\\n{IN}*', chr(10), 'g')")


def sq_clean(x: str) -> str:
    return sq_strip(f"regexp_replace(regexp_replace({x}, '{S.FOOTER}', '', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')")


def sq_pack_lines(x: str, limit: int) -> str:
    """The fold over lines; a list of structs with the state so far."""
    return f"""list_reduce(list_prepend({{'cur': '', 'out': []::VARCHAR[]}}, list_transform(string_split({x}, chr(10)), lambda l: {{'cur': l, 'out': []::VARCHAR[]}})),
    lambda a, b: CASE WHEN length(a.cur) + length(b.cur) + 1 > {limit} AND a.cur <> '' THEN {{'cur': b.cur, 'out': list_append(a.out, {sq_strip("a.cur")})}}
      ELSE {{'cur': CASE WHEN a.cur = '' THEN b.cur ELSE a.cur || chr(10) || b.cur END, 'out': a.out}} END)"""


def sq_pack(x: str, limit: int, overlap: int) -> str:
    """The fold over paragraphs that hold no line feed, so that one beyond the limit is a piece of its own."""
    paras = f"list_filter(list_transform(regexp_split_to_array({x}, '\\n{{2,}}'), lambda p: {sq_strip('p')}), lambda p: p <> '')"
    return f"""list_reduce(list_prepend({{'cur': '', 'out': []::VARCHAR[]}}, list_transform({paras}, lambda l: {{'cur': l, 'out': []::VARCHAR[]}})),
    lambda a, b: CASE WHEN length(b.cur) > {limit} THEN {{'cur': '', 'out': list_append(CASE WHEN a.cur = '' THEN a.out ELSE list_append(a.out, {sq_strip("a.cur")}) END, b.cur)}}
      WHEN length(a.cur) + length(b.cur) + 2 > {limit} AND a.cur <> '' THEN {{'cur': {sq_strip(f"right(a.cur, {overlap}) || chr(10) || chr(10) || b.cur")}, 'out': list_append(a.out, {sq_strip("a.cur")})}}
      ELSE {{'cur': CASE WHEN a.cur = '' THEN b.cur ELSE a.cur || chr(10) || chr(10) || b.cur END, 'out': a.out}} END)"""


SECTIONS = f"""heads AS (
  SELECT doc_id, text, regexp_extract_all(text, '{S.HEADING}') AS h, regexp_split_to_array(text, '{S.HEADING}') AS b FROM filings
), sections0 AS (
  SELECT doc_id, unnest(range(1, len(h) + 1)) AS k, h, b FROM heads WHERE len(h) > 0
), sections AS (
  SELECT doc_id, (k - 1)::INT AS section_ord, upper(regexp_extract(h[k], '{S.HEADING}', 1)) AS item,
    coalesce((MAP {{{", ".join(f"'{k}': '{v.replace(chr(39), chr(39) * 2)}'" for k, v in SECTION_NAMES.items())}}})[upper(regexp_extract(h[k], '{S.HEADING}', 1))], {sq_strip(f"regexp_extract(h[k], '{S.HEADING}', 2)")}) AS name,
    {sq_clean("b[k + 1]")} AS body FROM sections0
)"""
LOW = ", ".join(f"'{x}'" for x in LOW_SIGNAL)
USEFUL = f"""useful AS (
  SELECT * FROM sections WHERE length(body) >= {SMALL.min_chunk_chars} AND NOT regexp_matches({sq_strip("body")}, '{S.VOID}') AND item NOT IN ({LOW})
)"""
WINDOWS = f"""windows AS (
  SELECT doc_id, section_ord, item, name, CASE WHEN {sq_strip("r.cur")} <> '' THEN list_append(r.out, {sq_strip("r.cur")}) ELSE r.out END AS pieces
  FROM (SELECT *, {sq_pack("body", SMALL.max_chunk_chars, SMALL.chunk_overlap_chars)} AS r FROM useful)
), pieces AS (
  SELECT doc_id, section_ord, item, name, unnest(range(0, len(pieces))) AS part, unnest(pieces) AS piece FROM windows
), tagged AS (
  SELECT *, sum(CASE WHEN length(piece) >= {SMALL.min_chunk_chars} OR part = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, section_ord ORDER BY part) AS g FROM pieces
), chunks0 AS (
  SELECT doc_id, section_ord, item AS section_item, name AS section_name, min(part)::INT AS part_index, arg_min(piece, part) AS head, string_agg(piece, chr(10) || chr(10) ORDER BY part) AS text
  FROM tagged GROUP BY doc_id, section_ord, item, name, g
), chunks AS (
  SELECT *, substr(sha256(section_item || '␟' || part_index || '␟' || substr(head, 1, 120)), 1, 12) AS chunk_id, length(text) AS n_chars, greatest(1, length(text) // 4) AS n_tokens,
    row_number() OVER (PARTITION BY doc_id ORDER BY section_ord, part_index) - 1 AS chunk_ord FROM chunks0
)"""
GROUNDED = f"""folded AS (
  SELECT *, {sq_fold("source_passage")} AS fp, {sq_fold("chunk_text")} AS fc, {sq_tokens("source_passage")} AS tp, {sq_tokens("chunk_text")} AS tc,
    {sq_numbers("answer")} AS na, list_concat({sq_numbers("chunk_text")}, {sq_numbers("source_passage")}) AS ns FROM cand
), grounded0 AS (
  SELECT *, fp <> '' AND contains(fc, fp) AS exact, list_filter(na, lambda v: NOT list_contains(ns, v)) AS missing_numbers,
    CASE WHEN fp <> '' AND contains(fc, fp) THEN 1.0::DOUBLE WHEN len(tp) = 0 THEN 0.0 ELSE len(list_intersect(tp, tc)) / len(tp) END AS overlap FROM folded
), grounded AS (
  SELECT *, exact OR overlap >= {CFG.min_passage_overlap} AS passage_in_chunk, round(overlap, 3) AS token_overlap,
    question_type IN ('numeric_calculation', 'multi_step_reasoning') OR len(na) = 0 OR (len(na) - len(missing_numbers)) * 2 >= len(na) AS numbers_supported FROM grounded0
), judged AS (
  SELECT * EXCLUDE (verdict, confidence, reasoning), passage_in_chunk AND numbers_supported AS passed, coalesce(verdict, 'NOT_SUPPORTED') AS verdict,
    CASE WHEN verdict IS NULL THEN 0.0::DOUBLE ELSE confidence END AS confidence, CASE WHEN verdict IS NULL THEN 'missing verification' ELSE reasoning END AS reasoning FROM grounded
), decided AS (
  SELECT *, passed AND verdict = 'SUPPORTED' AS ok, passed AND verdict = 'SUPPORTED' AND contains(fc, fp) AS accepted FROM judged
), accepted AS (
  SELECT *, substr(sha256(chunk_id || '␟' || question), 1, 12) AS id, confidence AS verifier_confidence, 1.0::DOUBLE AS grounding_overlap, {sq_key("question")} AS question_key FROM decided WHERE accepted
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY question_key ORDER BY verifier_confidence DESC, grounding_overlap DESC, doc_id, chunk_ord, pair_idx) AS keep_rank FROM accepted
), kept AS (SELECT * FROM ranked WHERE keep_rank = 1
), rejected AS (
  SELECT *, CASE WHEN ok THEN '{judging.NOT_VERBATIM}' ELSE reasoning END AS reason FROM decided WHERE NOT accepted
)"""


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grounded candidates; a verdict that is missing is padded as in a merge of captures."""
    g = grounding.ground(candidates(spark, sf_dir), CFG)
    lost = F.col("verdict").isNull()
    return g.withColumns({"confidence": F.when(lost, 0.0).otherwise(F.col("confidence")), "reasoning": F.when(lost, merge.PAD_REASON).otherwise(F.col("reasoning")), "verdict": F.coalesce("verdict", F.lit("NOT_SUPPORTED"))})


def decided(spark: SparkSession, sf_dir: str, fuzzy: bool = False) -> DataFrame:
    """Decisions of pairs; without ``fuzzy`` of those only whose quote is found by folding, as the statements have it."""
    return judging.decide(judged(spark, sf_dir), CFG, fuzzy=fuzzy)


def accepted(spark: SparkSession, sf_dir: str, fuzzy: bool = False) -> DataFrame:
    return judging.accepted_rows(decided(spark, sf_dir, fuzzy))


# --- sources ---------------------------------------------------------------------------------------------------
@query("SELECT 'n' || upper(n_name) AS ticker, lpad(n_nationkey::VARCHAR, 10, '0') AS cik FROM nation")
def entity_lookup(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    index = n.select(F.concat(F.lit("N"), F.upper("n_name")).alias("ticker"), F.col("n_nationkey").alias("cik"), F.col("n_nationkey").alias("pos"))
    wanted = n.select(F.concat(F.lit(" n"), F.lower("n_name"), F.lit(" ")).alias("ticker"))
    return registry.resolve(index, wanted).select(F.concat(F.lit("n"), F.upper(F.substring(F.trim("ticker"), 2, 99))).alias("ticker"), "cik")


@query("SELECT 'x' || s_suppkey AS ticker FROM supplier WHERE s_suppkey % 10 = 0")
def entity_missing(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    index = s.select(F.concat(F.lit("S"), F.col("s_suppkey")).alias("ticker"), F.col("s_suppkey").alias("cik"), F.col("s_suppkey").alias("pos"))
    wanted = s.select(F.concat(F.when(F.col("s_suppkey") % 10 == 0, "x").otherwise("s"), F.col("s_suppkey")).alias("ticker"))
    return registry.unresolved(index, wanted)


@query("""SELECT cik, pos, accession FROM (SELECT o_custkey AS cik, o_orderkey AS pos, o_orderstatus AS form, 'A-' || o_orderkey AS accession,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders WHERE o_orderstatus = 'F') WHERE n = 2""")
def nth_latest(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cik"), F.col("o_orderkey").alias("pos"), F.col("o_orderstatus").alias("form"), F.concat(F.lit("A-"), "o_orderkey").alias("accession"))
    return registry.nth_latest(o, "F", 1).select("cik", "pos", "accession")


@query("SELECT o_orderkey, 'https://www.sec.gov/Archives/edgar/data/' || o_custkey || '/' || replace(o_orderkey || '-24-' || o_custkey, '-', '') || '/doc.htm' AS url, substr(strftime(o_orderdate, '%Y-%m-%d'), 1, 4) AS fiscal_year FROM orders")
def archive_url(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    key = F.concat_ws("-", F.col("o_orderkey").cast("string"), F.lit("24"), F.col("o_custkey").cast("string"))
    url = registry.archive_url(F.lpad(F.col("o_custkey").cast("string"), 10, "0"), key, F.lit("doc.htm"))
    return o.select("o_orderkey", url.alias("url"), F.substring(F.date_format("o_orderdate", "yyyy-MM-dd"), 1, 4).alias("fiscal_year"))


@query("""SELECT o_orderkey, url, length('body of ' || url) AS n_bytes, sha256('body of ' || url) AS digest FROM (
  SELECT o_orderkey, 'https://www.sec.gov/Archives/edgar/data/' || o_custkey || '/' || replace(o_orderkey || '-24-' || o_custkey, '-', '') || '/doc.htm' AS url FROM orders)""")
def fetched_reports(spark, sf_dir):
    """The addresses of ``archive_url`` through the data source for paced fetching, from a stand-in for the archive."""
    urls = archive_url(spark, sf_dir)
    path = scratch.cut(urls.select("url").distinct(), "addresses").written
    fetching.register(spark)
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    got = spark.read.format("paced_fetch").options(addresses=path, get="groundmill.sources.fetching:echo", rate="10000000", tasks=tasks).load()
    return urls.join(got, "url").select("o_orderkey", "url", F.octet_length("content").cast("long").alias("n_bytes"), F.sha2("content", 256).alias("digest"))


@query("SELECT doc_id, text FROM documents")
def decode_fallback(spark, sf_dir):
    """Bytes as UTF-8, or as Windows-1252 where the text has such characters only, for every second document."""
    d = table(spark, sf_dir, "documents")
    western = (F.col("doc_id") % 2 == 1) & ~F.col("text").rlike(r"[^\x00-\x7f\x{a0}-\x{ff}]")
    return H.decode(d.select("doc_id", F.when(western, F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8")).alias("content"))).select("doc_id", "text")


@query("SELECT conv_id AS doc_id, turn AS pair_idx, role AS verdict FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY turn) AS n FROM conversations) WHERE n = 1")
def replay_join(spark, sf_dir):
    """Requests meet captured responses by their keys; every key has one."""
    c = table(spark, sf_dir, "conversations")
    asked = c.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("pair_idx"))
    held = c.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("pair_idx"), F.col("role").alias("verdict")).dropDuplicates(["doc_id", "pair_idx"])
    return completion.replay(asked, held, ["doc_id", "pair_idx"])


_ASKED = "SELECT conv_id || ':' || turn AS key, length(text)::BIGINT AS asked FROM (SELECT conv_id, turn, min(text) AS text FROM conversations WHERE role = 'user' GROUP BY ALL)"


def _turn_requests(spark, sf_dir) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").where("role = 'user'").groupBy("conv_id", "turn").agg(F.min("text").alias("user"))
    return turns.select(F.concat_ws(":", "conv_id", "turn").alias("key"), F.lit("m").alias("model"), F.lit("s").alias("system"), "user")


@query(_ASKED)
def answers_in_flight(spark, sf_dir):
    """Answers of a stand-in to all user turns, several requests under way in each task, under a budget of tokens."""
    limits = completion.Limits(in_flight=8, tokens_per_minute=1 << 50, tasks=int(spark.conf.get("spark.sql.shuffle.partitions")))
    got = completion.complete(_turn_requests(spark, sf_dir), completion.EchoClient, {}, limits)
    return got.select("key", F.get_json_object("response", "$.asked").cast("long").alias("asked"))


@query(_ASKED)
def answers_by_jobs(spark, sf_dir):
    """The same by jobs of a hundred requests that are submitted, asked after and collected."""
    got = jobs.complete_by_jobs(_turn_requests(spark, sf_dir), scratch.fresh_path(spark, "jobs"), jobs.EchoJobs, {}, size=100, wait=0)
    return got.select("key", F.get_json_object("response", "$.asked").cast("long").alias("asked"))


# --- HTML ------------------------------------------------------------------------------------------------------
# The test pages hold no tables, a few entities, parts cut off at a page's end, and paragraphs without an end that hold
# one bold line; with these ended, dropping, marking and stripping by expressions gives what the parser gives.
_SEEN = "html"
for _tag in ("head", "script", "style", "noscript"):
    _SEEN = f"regexp_replace({_SEEN}, '(?is)<{_tag}\\b[^>]*>.*?(</{_tag}\\s*>|\\z)', '', 'g')"
_SEEN = f"regexp_replace(regexp_replace({_SEEN}, '(?s)<!--.*?(-->|\\z)', '', 'g'), '<p><b>([^<]*)<br>([^<]*)', '<p>\\1<br>\\2</p>', 'g')"
_SEEN = f"regexp_replace(regexp_replace(regexp_replace({_SEEN}, '(?i)</(h[1-6])\\s*>', chr(10) || chr(10), 'g'), '(?i)</({'|'.join(sorted(H.LINES))})\\s*>', chr(10), 'g'), '(?i)<br\\s*/?>', chr(10), 'g')"
_SEEN = f"regexp_replace({_SEEN}, '<[^>]*>', '', 'g')"
for _name, _sign in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
    _SEEN = f"regexp_replace({_SEEN}, '&{_name}(;|\\z)', '{_sign}', 'g')"


@query(f"SELECT page_id, t AS text, 0 AS n_tables, length(t) AS n_chars FROM (SELECT page_id, {sq_normalize(_SEEN)} AS t FROM pages)")
def html_parse(spark, sf_dir):
    return H.parse_html(table(spark, sf_dir, "pages")).select("page_id", "text", "n_tables", "n_chars")


_DROP = "html"
for _tag in H.DROPPED:
    _DROP = f"regexp_replace({_DROP}, '(?is)<{_tag}\\b[^>]*>.*?</{_tag}\\s*>', '', 'g')"


@query(f"SELECT page_id, {_DROP} AS html FROM pages")
def html_drop(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", H.drop_hidden(F.col("html")).alias("html"))


_MARKED = f"regexp_replace(regexp_replace(regexp_replace(html, '(?i)</(h[1-6])\\s*>', chr(10) || chr(10), 'g'), '(?i)</({'|'.join(sorted(H.LINES))})\\s*>', chr(10), 'g'), '(?i)<br\\s*/?>', chr(10), 'g')"


@query(f"SELECT page_id, {_MARKED} AS html FROM pages")
def html_blocks(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", H.mark_blocks(F.col("html")).alias("html"))


@query("""SELECT l_orderkey, string_agg(CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE l_linenumber || ' | ' END || '$' || l_partkey || CASE WHEN l_returnflag = 'R' THEN '' ELSE ' | ' || l_returnflag END, chr(10) ORDER BY l_linenumber, '$' || l_partkey || chr(10), CASE WHEN l_returnflag = 'R' THEN ' ' ELSE l_returnflag END) AS text
  FROM lineitem GROUP BY l_orderkey""")
def table_render(spark, sf_dir):
    """Tables made from order lines; empty cells vanish."""
    li = table(spark, sf_dir, "lineitem")
    cells = [F.when(F.col("l_linenumber") % 3 == 0, "").otherwise(F.col("l_linenumber").cast("string")), F.concat(F.lit("$"), "l_partkey"), F.when(F.col("l_returnflag") == "R", " ").otherwise(F.col("l_returnflag"))]
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td class='n'> "), c, F.lit("\n</td>")) for c in cells], F.lit("</tr>"))
    made = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", row.alias("row")))).alias("r"))
    html = F.concat(F.lit("<table>"), F.array_join(F.transform("r", lambda x: x["row"]), ""), F.lit("</table>"))
    return H.parse_html(made.select("l_orderkey", html.alias("html"))).select("l_orderkey", "text")


# --- text functions --------------------------------------------------------------------------------------------
_BLANKS = "chr(160) || replace(replace(text, ',', chr(13) || chr(10) || chr(9) || ' '), '. ', '.' || chr(10) || chr(10) || chr(10) || '  ') || ' '"


@query(f"SELECT doc_id, {sq_normalize(_BLANKS)} AS text FROM documents")
def normalize_ws(spark, sf_dir):
    made = F.concat(F.lit("\xa0"), F.replace(F.replace("text", F.lit(","), F.lit("\r\n\t ")), F.lit(". "), F.lit(".\n\n\n  ")), F.lit(" "))
    return table(spark, sf_dir, "documents").select("doc_id", T.normalize_ws(made).alias("text"))


@query(f"SELECT doc_id, {sq_squash('text')} AS text, {sq_fold('text')} AS folded, length(text) AS n_chars, greatest(1, length(text) // 4) AS n_tokens FROM documents")
def text_folds(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", T.squash(F.col("text")).alias("text"), T.fold(F.col("text")).alias("folded"), F.length("text").alias("n_chars"), T.token_estimate(F.col("text")).alias("n_tokens"))


@query(f"SELECT doc_id, {sq_squash('text')} AS text FROM documents")
def squash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.squash(F.col("text")).alias("text"))


@query(f"SELECT doc_id, {sq_fold(chr(39) + '  “' + chr(39) + ' || text')} AS folded FROM documents")
def fold(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.fold(F.concat(F.lit("  “"), "text")).alias("folded"))


@query("SELECT doc_id, greatest(1, length(text) // 4) AS n_tokens FROM documents")
def token_estimate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.token_estimate(F.col("text")).alias("n_tokens"))


_CURLED = "replace(replace(replace(text, 'th', '’“'), 'en', '—'), ' a', chr(160) || '„')"


@query(f"SELECT doc_id, translate({_CURLED}, '{T.CURLY}', '{T.ASCII.replace(chr(39), chr(39) * 2)}') AS plain, {sq_fold(_CURLED)} AS folded FROM documents")
def norm_punct(spark, sf_dir):
    c = F.replace(F.replace(F.replace("text", F.lit("th"), F.lit("’“")), F.lit("en"), F.lit("—")), F.lit(" a"), F.lit("\xa0„"))
    return table(spark, sf_dir, "documents").select("doc_id", T.norm_punct(c).alias("plain"), T.fold(c).alias("folded"))


_PRICED = "'total $' || o_totalprice || ' on 0' || o_orderkey || '. -5% ' || o_orderpriority"


@query(f"SELECT 'd' || doc_id AS id, array_to_string({sq_numbers('text')}, ' ') AS numbers FROM documents UNION ALL SELECT 'o' || o_orderkey, array_to_string({sq_numbers(_PRICED)}, ' ') FROM orders")
def extract_numbers(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), "text")
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("o"), "o_orderkey").alias("id"), F.concat(F.lit("total $"), F.col("o_totalprice").cast("string"), F.lit(" on 0"), "o_orderkey", F.lit(". -5% "), "o_orderpriority").alias("text"))
    return d.unionByName(o).select("id", F.array_join(T.numbers(F.col("text")), " ").alias("numbers"))


@query("SELECT doc_id, substr(sha256(lang || '␟' || source || '␟' || substr(text, 1, 120)), 1, 12) AS id FROM documents")
def stable_id(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.stable_id(F.col("lang"), F.col("source"), F.substring("text", 1, 120)).alias("id"))


@query(f"SELECT conv_id, turn, {sq_key('text')} AS question_key FROM conversations")
def question_key(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.question_key(F.col("text")).alias("question_key"))


# --- sections and chunks ---------------------------------------------------------------------------------------
@query(f"WITH {FILINGS}, {SECTIONS} SELECT doc_id, section_ord, item, name, body FROM sections")
def section_split(spark, sf_dir):
    return S.split_sections(filings(spark, sf_dir))


@query(f"WITH {FILINGS}, {SECTIONS} SELECT item, name, count(*) AS n FROM sections GROUP BY item, name")
def section_names(spark, sf_dir):
    return S.split_sections(filings(spark, sf_dir)).groupBy("item", "name").agg(F.count("*").alias("n"))


@query("SELECT doc_id, 0 AS section_ord, '' AS item, 'Full Document' AS name, text AS body FROM documents")
def full_document(spark, sf_dir):
    return S.split_sections(table(spark, sf_dir, "documents"))


_FOOTED = "replace(text, chr(10), chr(10) || 'Any Name | 2025  Form 10-K | 7 ' || chr(10) || chr(10) || chr(10))"


@query(f"SELECT doc_id, {sq_clean(_FOOTED)} AS body FROM documents")
def footer_strip(spark, sf_dir):
    made = F.replace("text", F.lit("\n"), F.lit("\nAny Name | 2025  Form 10-K | 7 \n\n\n"))
    return table(spark, sf_dir, "documents").select("doc_id", S.clean_body(made).alias("body"))


@query(f"WITH {FILINGS}, {SECTIONS}, {USEFUL} SELECT doc_id, section_ord, item FROM useful")
def section_filter(spark, sf_dir):
    return S.useful_sections(S.split_sections(filings(spark, sf_dir)), SMALL).select("doc_id", "section_ord", "item")


@query(f"WITH {FILINGS}, {SECTIONS} SELECT doc_id, section_ord, item FROM sections WHERE item IN ({LOW})")
def low_signal(spark, sf_dir):
    return S.split_sections(filings(spark, sf_dir)).where(F.col("item").isin(*LOW_SIGNAL)).select("doc_id", "section_ord", "item")


_PARAS = "replace(text, '. ', '.' || chr(10) || ' ' || chr(10) || chr(10))"


@query(f"SELECT doc_id, array_to_string(list_filter(list_transform(regexp_split_to_array({_PARAS}, '\\n{{2,}}'), lambda p: {sq_strip('p')}), lambda p: p <> ''), '¶') AS paragraphs FROM documents")
def paragraphs(spark, sf_dir):
    made = F.replace("text", F.lit(". "), F.lit(".\n \n\n"))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(C.paragraphs(made), "¶").alias("paragraphs"))


@query(f"""WITH p AS (SELECT doc_id, CASE WHEN {sq_strip("r.cur")} <> '' THEN list_append(r.out, {sq_strip("r.cur")}) ELSE r.out END AS o FROM (SELECT doc_id, {sq_pack_lines("text", 1000)} AS r FROM documents))
  SELECT doc_id, unnest(range(0, len(o)))::INT AS part, unnest(o) AS piece FROM p""")
def line_pack(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(C.pack_lines(F.col("text"), 1000)).alias("part", "piece"))


_SPACED = "replace(text, chr(10), chr(10) || chr(10))"


@query(f"""WITH p AS (SELECT doc_id, CASE WHEN {sq_strip("r.cur")} <> '' THEN list_append(r.out, {sq_strip("r.cur")}) ELSE r.out END AS o FROM (SELECT doc_id, {sq_pack(_SPACED, 1000, 50)} AS r FROM documents))
  SELECT doc_id, unnest(range(0, len(o)))::INT AS part, unnest(o) AS piece FROM p""")
def chunk_pack(spark, sf_dir):
    made = F.replace("text", F.lit("\n"), F.lit("\n\n"))
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(C.pack_paragraphs(made, 1000, 50)).alias("part", "piece"))


@query(f"WITH {FILINGS}, {SECTIONS}, {USEFUL}, {WINDOWS} SELECT doc_id, section_ord, part_index, text FROM chunks")
def tail_fold(spark, sf_dir):
    return C.chunk_documents(filings(spark, sf_dir), SMALL).select("doc_id", "section_ord", "part_index", "text")


@query(f"WITH {FILINGS}, {SECTIONS}, {USEFUL}, {WINDOWS} SELECT doc_id, chunk_ord, chunk_id, section_item, section_name, part_index, n_chars, n_tokens FROM chunks")
def chunk_document(spark, sf_dir):
    return C.chunk_documents(filings(spark, sf_dir), SMALL).select("doc_id", "chunk_ord", "chunk_id", "section_item", "section_name", "part_index", "n_chars", "n_tokens")


@query(f"WITH {FILINGS}, {SECTIONS}, {USEFUL}, {WINDOWS} SELECT count(*) AS n_chunks, count(DISTINCT section_item) AS n_sections, sum(n_tokens)::BIGINT AS n_tokens FROM chunks")
def chunk_metrics(spark, sf_dir):
    return C.chunk_metrics(C.chunk_documents(filings(spark, sf_dir), SMALL))


@query(f"WITH {FILINGS}, {SECTIONS}, {USEFUL}, {WINDOWS} SELECT doc_id, chunk_ord, chunk_id FROM chunks WHERE chunk_ord < 3")
def chunk_limit(spark, sf_dir):
    """The first three chunks of each document: the limit is the feature."""
    return C.first_chunks(C.chunk_documents(filings(spark, sf_dir), SMALL), 3).select("doc_id", "chunk_ord", "chunk_id")


# --- generation and completion ---------------------------------------------------------------------------------
_PROMPT = "'Company: ' || coalesce(NULL, 'the company') || ' (' || lang || ')' || chr(10) || 'Report: 10-K, fiscal year ' || (2000 + doc_id % 25) || ', period ended ' || chr(10) || 'Section: Item 1 - ' || source || chr(10) || 'Pairs wanted: at most 5, fewer if the excerpt holds little.' || chr(10) || 'EXCERPT:' || chr(10) || text"
_SYSTEM = prompts.GENERATION_SYSTEM.replace("'", "''")


def _requests(spark, sf_dir) -> DataFrame:
    none = F.lit(None).cast("string")
    user = prompts.generation_prompt(none, F.col("lang"), none, 2000 + F.col("doc_id") % 25, none, F.lit("1"), F.col("source"), F.col("text"), 5)
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("gen::"), "doc_id").alias("key"), F.lit("generator").alias("model"), F.lit(prompts.GENERATION_SYSTEM).alias("system"), user.alias("user"))


@query(f"SELECT doc_id, {_PROMPT} AS prompt FROM documents")
def render_prompt(spark, sf_dir):
    return _requests(spark, sf_dir).select("doc_id", F.col("user").alias("prompt"))


@query(f"WITH {CANDIDATES} SELECT doc_id, pair_idx, 'QUESTION: ' || question || chr(10) || 'ANSWER: ' || answer || chr(10) || 'TYPE: ' || question_type || chr(10) || 'QUOTE: ' || source_passage || chr(10) || 'CHUNK:' || chr(10) || chunk_text AS prompt FROM cand")
def render_verification(spark, sf_dir):
    c = candidates(spark, sf_dir)
    return c.select("doc_id", "pair_idx", prompts.verification_prompt(*[F.col(x) for x in ("question", "answer", "question_type", "source_passage", "chunk_text")]).alias("prompt"))


_HASH = f"substr(sha256('generator' || '␟' || '{_SYSTEM}' || '␟' || user_text), 1, 24)"


@query(f"WITH r AS (SELECT doc_id, {_PROMPT} AS user_text FROM documents) SELECT DISTINCT {_HASH} AS hash FROM r WHERE {_HASH} NOT IN (SELECT {_HASH} FROM r WHERE doc_id % 3 = 0)")
def cache_antijoin(spark, sf_dir):
    r = _requests(spark, sf_dir)
    cache = completion.with_hash(r.where("doc_id % 3 = 0")).select("hash", F.lit("{}").alias("response"))
    return completion.cache_misses(r, cache).select("hash")


def _generations(spark, sf_dir) -> DataFrame:
    """A response per conversation; some pairs lack an answer, have a number for one, or a label that is not listed."""
    c = candidates(spark, sf_dir)
    n = F.col("doc_id") + F.col("pair_idx")
    kind = F.when(n % 9 == 4, "guess").otherwise(F.col("question_type"))
    whole = F.to_json(F.struct("question", F.when(n % 8 == 3, F.lit(None).cast("string")).otherwise(F.col("answer")).alias("answer"), "source_passage", kind.alias("question_type"), "difficulty"))
    number = F.to_json(F.struct("question", F.col("pair_idx").alias("answer"), "source_passage", "question_type", "difficulty"))
    one = F.when(n % 10 == 6, number).otherwise(whole)
    rows = c.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pair_idx", one.alias("j")))).alias("p"))
    body = F.concat(F.lit('{"qa_pairs": ['), F.array_join(F.transform("p", lambda x: x["j"]), ", "), F.lit("]}"))
    return rows.select("doc_id", F.when(F.col("doc_id") % 13 == 1, F.lit("{}")).otherwise(body).alias("response"))


_GENERATED = f"""{CANDIDATES}, raw AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pair_idx) - 1 AS raw_pos, doc_id + pair_idx AS n FROM cand WHERE doc_id % 13 <> 1
), checked AS (SELECT *, NOT (n % 10 = 6 OR n % 8 = 3 OR n % 9 = 4) AS valid FROM raw)"""


@query(f"WITH {_GENERATED} SELECT doc_id, raw_pos::INT AS raw_pos, question FROM checked")
def explode_pairs(spark, sf_dir):
    return pairs.explode_pairs(_generations(spark, sf_dir)).select("doc_id", "raw_pos", "question")


@query(f"WITH {_GENERATED} SELECT doc_id, raw_pos::INT AS raw_pos, valid FROM checked")
def validate_pairs(spark, sf_dir):
    return pairs.explode_pairs(_generations(spark, sf_dir)).select("doc_id", "raw_pos", "valid")


@query(f"WITH {_GENERATED} SELECT doc_id, raw_pos::INT AS raw_pos, (row_number() OVER (PARTITION BY doc_id ORDER BY raw_pos) - 1)::INT AS pair_idx FROM checked WHERE valid")
def dense_reindex(spark, sf_dir):
    return pairs.index_pairs(pairs.explode_pairs(_generations(spark, sf_dir)), ["doc_id"], dense=True).select("doc_id", "raw_pos", "pair_idx")


# --- grounding -------------------------------------------------------------------------------------------------
@query(f"SELECT b.item_id, d.doc_id FROM (SELECT item_id, {sq_fold('text')} AS f FROM benchmark) b JOIN (SELECT doc_id, {sq_fold('text')} AS f FROM documents) d ON b.f <> '' AND contains(d.f, b.f)")
def grounding_exact(spark, sf_dir):
    """Passages in documents: their rarest word narrows the pairs, then the folded texts decide."""
    return grounding.containing(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


@query(f"""WITH b AS (SELECT item_id, unnest(w) AS word, len(w) AS n_tokens FROM (SELECT item_id, {sq_tokens("text")} AS w FROM benchmark)), d AS (SELECT doc_id, unnest({sq_tokens("text")}) AS word FROM documents)
  SELECT item_id, doc_id, n_tokens::INT AS n_tokens, count(*) AS shared FROM b JOIN d USING (word) GROUP BY item_id, doc_id, n_tokens HAVING count(*) >= 0.6 * n_tokens""")
def token_overlap(spark, sf_dir):
    return grounding.overlap_join(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), 0.6)


@query(f"WITH {CANDIDATES}, {GROUNDED} SELECT doc_id, pair_idx, exact, token_overlap, passage_in_chunk, numbers_supported, array_to_string(missing_numbers, ' ') AS missing_numbers, passed FROM judged")
def grounding_pairs(spark, sf_dir):
    g = grounding.ground(candidates(spark, sf_dir), CFG)
    return g.select("doc_id", "pair_idx", "exact", "token_overlap", "passage_in_chunk", "numbers_supported", F.array_join("missing_numbers", " ").alias("missing_numbers"), "passed")


@query(f"WITH {CANDIDATES}, {GROUNDED} SELECT doc_id, pair_idx, token_overlap, passage_in_chunk FROM grounded")
def passage_gate(spark, sf_dir):
    return grounding.ground(candidates(spark, sf_dir), CFG).select("doc_id", "pair_idx", "token_overlap", "passage_in_chunk")


_COUNTED = "(SELECT * REPLACE (answer || ' of ' || length(answer) || ' and $' || doc_id AS answer) FROM cand)"


@query(f"WITH {CANDIDATES.replace('cand AS (', 'cand1 AS (')}, cand AS {_COUNTED.replace('FROM cand', 'FROM cand1')}, {GROUNDED} SELECT doc_id, pair_idx, array_to_string(missing_numbers, ' ') AS missing_numbers FROM grounded WHERE len(missing_numbers) > 0")
def missing_numbers(spark, sf_dir):
    """Answers that end with their own length and the conversation's number, which hardly any chunk has."""
    answer = F.concat(F.coalesce("answer", F.lit("")), F.lit(" of "), F.length("answer"), F.lit(" and $"), "doc_id")
    found = grounding.missing_numbers(answer, *[F.coalesce(c, F.lit("")) for c in ("chunk_text", "source_passage")])
    c = candidates(spark, sf_dir).select("doc_id", "pair_idx", found.alias("missing_numbers"))
    return c.where(F.size("missing_numbers") > 0).withColumn("missing_numbers", F.array_join("missing_numbers", " "))


_ORDERED = "SELECT o_orderkey AS doc_id, 0 AS chunk_ord, 0 AS pair_idx, 'q' AS question, '$' || o_totalprice || ' and ' || (o_orderkey * 3) AS answer, 'paid ' || o_totalprice AS source_passage, 'Order ' || o_orderkey || ' paid ' || o_totalprice || ' by ' || o_custkey AS chunk_text, CASE WHEN o_orderkey % 4 = 1 THEN 'numeric_calculation' ELSE 'comparison' END AS question_type, 'easy' AS difficulty, 'SUPPORTED' AS verdict, 0.5 AS confidence, 'r' AS reasoning, 'c' AS chunk_id FROM orders"


@query(f"WITH cand AS ({_ORDERED}), {GROUNDED} SELECT doc_id, array_to_string(missing_numbers, ' ') AS missing_numbers, numbers_supported FROM grounded")
def number_gate(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    total = F.col("o_totalprice").cast("string")
    made = o.select(F.col("o_orderkey").alias("doc_id"), F.concat(F.lit("$"), total, F.lit(" and "), (F.col("o_orderkey") * 3).cast("string")).alias("answer"), F.concat(F.lit("paid "), total).alias("source_passage"),
                    F.concat(F.lit("Order "), "o_orderkey", F.lit(" paid "), total, F.lit(" by "), "o_custkey").alias("chunk_text"), F.when(F.col("o_orderkey") % 4 == 1, "numeric_calculation").otherwise("comparison").alias("question_type"))
    return grounding.ground(made, CFG).select("doc_id", F.array_join("missing_numbers", " ").alias("missing_numbers"), "numbers_supported")


# --- verdicts, decisions, duplicates ---------------------------------------------------------------------------
@query(f"WITH {CANDIDATES} SELECT doc_id, pair_idx, verdict, confidence FROM cand WHERE verdict IS NOT NULL")
def verdict_join(spark, sf_dir):
    c = candidates(spark, sf_dir)
    held = c.where("verdict IS NOT NULL").select(*dataset.ORDER, "verdict", "confidence", "reasoning")
    asked = c.drop("verdict", "confidence", "reasoning").join(held.select(*dataset.ORDER), dataset.ORDER, "left_semi")
    return completion.replay(asked, pairs.checked_verdicts(held), dataset.ORDER).select("doc_id", "pair_idx", "verdict", "confidence")


@query(f"WITH {CANDIDATES} SELECT doc_id, pair_idx FROM cand WHERE verdict IS NOT NULL AND (doc_id % 6 <> 2) AND (doc_id % 10 <> 3)")
def verdict_validate(spark, sf_dir):
    """Lenient check: verdicts of other names and confidences above 1 are left out."""
    c = candidates(spark, sf_dir).withColumns({"verdict": F.when(F.col("doc_id") % 6 == 2, "MAYBE").otherwise(F.col("verdict")), "confidence": F.when(F.col("doc_id") % 10 == 3, F.lit(1.5)).otherwise(F.col("confidence"))})
    return pairs.checked_verdicts(c, strict=False).select("doc_id", "pair_idx")


@query(f"WITH {CANDIDATES}, {GROUNDED} SELECT doc_id, pair_idx, ok FROM decided")
def acceptance(spark, sf_dir):
    return judged(spark, sf_dir).select("doc_id", "pair_idx", judging.is_accepted(CFG).alias("ok"))


_AT = "strpos(translate(chunk_text, '{0}', '{1}'), translate(source_passage, '{0}', '{1}'))".format(T.CURLY, T.ASCII.replace("'", "''"))


@query(f"""WITH {CANDIDATES}, s AS (SELECT *, CASE WHEN length(source_passage) >= 4 AND {sq_strip("source_passage")} <> '' THEN {_AT} ELSE 0 END AS place FROM cand)
  SELECT doc_id, pair_idx, CASE WHEN place > 0 THEN {sq_strip("substr(chunk_text, place, length(source_passage))")} ELSE source_passage END AS snapped_passage, place > 0 AS snapped FROM s""")
def snap_exact(spark, sf_dir):
    return snap.snap(candidates(spark, sf_dir), fuzzy=False).select("doc_id", "pair_idx", "snapped_passage", "snapped")


@query()
def snap_fuzzy(spark, sf_dir):
    """Quotes with words left out, marks changed or bars dropped, aligned by the block matcher."""
    c = candidates(spark, sf_dir)
    bent = F.regexp_replace(F.replace("source_passage", F.lit(" the "), F.lit(" ")), r"\. ", "; ")
    return snap.snap(c.withColumn("source_passage", bent)).select("doc_id", "pair_idx", "snapped_passage", "snapped")


@query(f"WITH {CANDIDATES}, {GROUNDED} SELECT doc_id, pair_idx, contains(fc, fp) AS verbatim FROM decided WHERE ok")
def verbatim_gate(spark, sf_dir, fuzzy=False):
    return decided(spark, sf_dir, fuzzy).where(judging.is_accepted(CFG)).select("doc_id", "pair_idx", F.col("source_verbatim").alias("verbatim"))


@query(f"WITH {CANDIDATES}, {GROUNDED} SELECT id, doc_id, pair_idx, question, question_type, grounding_overlap, verifier_confidence FROM accepted")
def accepted_rows(spark, sf_dir, fuzzy=False):
    return accepted(spark, sf_dir, fuzzy).select("id", "doc_id", "pair_idx", "question", "question_type", "grounding_overlap", "verifier_confidence")


@query(f"WITH {CANDIDATES}, {GROUNDED} SELECT chunk_id, question, answer, question_type, verdict, passage_in_chunk, token_overlap, array_to_string(missing_numbers, ' ') AS missing_numbers, reason FROM rejected")
def rejected_rows(spark, sf_dir, fuzzy=False):
    return judging.rejected_rows(decided(spark, sf_dir, fuzzy)).withColumn("missing_numbers", F.array_join("missing_numbers", " "))


@query(f"WITH {CANDIDATES}, {GROUNDED} SELECT accepted, verdict, count(*) AS n FROM decided GROUP BY accepted, verdict")
def accept_reject_split(spark, sf_dir, fuzzy=False):
    return decided(spark, sf_dir, fuzzy).groupBy("accepted", "verdict").agg(F.count("*").alias("n"))


@query(f"WITH {CANDIDATES}, {GROUNDED} SELECT doc_id, pair_idx, question_key FROM kept")
def dedupe_best(spark, sf_dir, fuzzy=False):
    return judging.ranked_duplicates(accepted(spark, sf_dir, fuzzy), dataset.ORDER).where("keep_rank = 1").select("doc_id", "pair_idx", "question_key")


@query(f"WITH {CANDIDATES}, {GROUNDED} SELECT doc_id, pair_idx, question_key, verifier_confidence FROM kept")
def stream_dedupe(spark, sf_dir):
    """Decisions that arrive in two drops, deduplicated by state that the stream keeps between batches."""
    rows = decided(spark, sf_dir).select(*dataset.ORDER, "chunk_id", "question", "final_passage", "question_type", "confidence", "token_overlap", "source_verbatim", "accepted")
    home = scratch.fresh_path(spark, "decision-drops")
    for drop in (0, 1):
        rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == drop).write.parquet(f"{home}/in/drop={drop}")
    parts = len(spark.read.option("recursiveFileLookup", "true").parquet(f"{home}/in").inputFiles())
    keyed.dedupe_stream(spark, f"{home}/in", rows.schema, f"{home}/out", f"{home}/state", dataset.ORDER, files_per_batch=max(1, parts // 2)).awaitTermination()
    return keyed.latest(spark.read.parquet(f"{home}/out")).select("doc_id", "pair_idx", "question_key", "verifier_confidence")


@query(f"WITH {CANDIDATES}, {GROUNDED}, r AS (SELECT *, row_number() OVER (PARTITION BY section_item, question_key ORDER BY verifier_confidence DESC, grounding_overlap DESC, doc_id, chunk_ord, pair_idx) AS k FROM accepted) SELECT doc_id, pair_idx FROM r WHERE k = 1")
def dedupe_scoped(spark, sf_dir, fuzzy=False):
    return judging.dedupe(accepted(spark, sf_dir, fuzzy), dataset.ORDER, ["section_item"]).select("doc_id", "pair_idx")


@query(f"""WITH {CANDIDATES}, {GROUNDED} SELECT id, question, answer, source_passage, question_type, difficulty, section_name AS section, 'Any Inc.' AS company, 'ANY' AS ticker, '2024' AS fiscal_year, NULL::VARCHAR AS accession, chunk_id, verdict,
  round(verifier_confidence, 3) AS verifier_confidence, round(grounding_overlap, 3) AS grounding_overlap, true AS source_verbatim FROM kept WHERE contains(chunk_text, source_passage) AND {sq_strip("source_passage")} = source_passage""")
def dataset_row(spark, sf_dir, fuzzy=False):
    """The rows that leave the pipeline; without ``fuzzy`` for quotes only that stand in the chunk as they are, as the statement has it."""
    best = judging.dedupe(accepted(spark, sf_dir, fuzzy), dataset.ORDER)
    plain = best if fuzzy else best.where(F.contains("chunk_text", F.col("source_passage")) & (T.strip(F.col("source_passage")) == F.col("source_passage")))
    return judging.dataset_rows(dataset.with_meta(plain, {"company": "Any Inc.", "ticker": "ANY", "fiscal_year": "2024"}))


# --- statistics ------------------------------------------------------------------------------------------------
for _name, _column in (("stats_by_type", "question_type"), ("stats_by_difficulty", "difficulty"), ("stats_by_section", "section_name")):

    def _count(spark, sf_dir, fuzzy=False, column=_column):
        return judging.dedupe(accepted(spark, sf_dir, fuzzy), dataset.ORDER).groupBy(column).agg(F.count("*").alias("n"))

    _count.__name__ = _name
    query(f"WITH {CANDIDATES}, {GROUNDED} SELECT {_column}, count(*) AS n FROM kept GROUP BY 1")(_count)


@query(f"WITH {CANDIDATES}, {GROUNDED} SELECT question_type, difficulty, section_name, count(*) AS n FROM kept GROUP BY GROUPING SETS ((question_type), (difficulty), (section_name))")
def stats_grouping_sets(spark, sf_dir, fuzzy=False):
    best = judging.dedupe(accepted(spark, sf_dir, fuzzy), dataset.ORDER)
    return best.groupingSets([["question_type"], ["difficulty"], ["section_name"]], "question_type", "difficulty", "section_name").agg(F.count("*").alias("n"))


_RATES = "SELECT (SELECT count(*) FROM kept) AS n_accepted, (SELECT count(*) FROM rejected) AS n_rejected, round((SELECT count(*) FROM kept) / greatest(1, (SELECT count(*) FROM kept) + (SELECT count(*) FROM rejected)), 3) AS acceptance_rate, round((SELECT coalesce(avg(verifier_confidence), 0) FROM kept), 3) AS mean_verifier_confidence, round(100 * (SELECT count(*) FROM kept) / greatest(1, (SELECT count(*) FROM kept)), 1)::DOUBLE AS pct_exact_passage_match"


@query(f"WITH {CANDIDATES}, {GROUNDED} {_RATES}")
def acceptance_rate(spark, sf_dir, fuzzy=False):
    d = decided(spark, sf_dir, fuzzy)
    s = judging.stats_of(d, dataset.ORDER)
    return s.select("n_accepted", "n_rejected", "acceptance_rate", "mean_verifier_confidence", "pct_exact_passage_match")


@query(f"WITH {CANDIDATES}, {GROUNDED} SELECT round(coalesce(avg(verifier_confidence), 0), 3) AS mean_verifier_confidence FROM kept")
def mean_confidence(spark, sf_dir, fuzzy=False):
    return judging.dedupe(accepted(spark, sf_dir, fuzzy), dataset.ORDER).agg(F.round(F.coalesce(F.avg("verifier_confidence"), F.lit(0.0)), 3).alias("mean_verifier_confidence"))


@query(f"WITH {CANDIDATES}, {GROUNDED} SELECT round(100 * coalesce(avg(contains(fc, fp)::INT), 0), 1)::DOUBLE AS pct_exact_passage_match FROM kept")
def pct_exact(spark, sf_dir, fuzzy=False):
    return judging.dedupe(accepted(spark, sf_dir, fuzzy), dataset.ORDER).agg(F.round(100 * F.coalesce(F.avg(F.col("source_verbatim").cast("int")), F.lit(0.0)), 1).alias("pct_exact_passage_match"))


def _map_of(column: str) -> str:
    return f"(SELECT string_agg({column} || '=' || n, ',' ORDER BY {column}) FROM (SELECT {column}, count(*) AS n FROM kept GROUP BY 1))"


@query(f"WITH {CANDIDATES}, {GROUNDED} SELECT {_map_of('question_type')} AS by_question_type, {_map_of('difficulty')} AS by_difficulty, {_map_of('section_name')} AS by_section")
def stats_record(spark, sf_dir, fuzzy=False):
    d = decided(spark, sf_dir, fuzzy)
    s = judging.stats_of(d, dataset.ORDER)
    text = lambda c: F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return s.select(*[text(c).alias(c) for c in ("by_question_type", "by_difficulty", "by_section")])


@query(f"WITH {CANDIDATES}, {GROUNDED} SELECT doc_id, pair_idx, sum(accepted::INT) OVER (PARTITION BY section_item ORDER BY doc_id, chunk_ord, pair_idx ROWS UNBOUNDED PRECEDING)::BIGINT AS running FROM decided")
def running_accepted(spark, sf_dir, fuzzy=False):
    rows = scratch.cut(decided(spark, sf_dir, fuzzy).select("section_item", *dataset.ORDER, F.col("accepted").cast("long").alias("one")), "decided")
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return running.running_sum(rows, ["section_item"], dataset.ORDER, "one", "running", slices).select("doc_id", "pair_idx", "running")


# The same with all quotes aligned and none filtered; SQL cannot express that, so these have no statement.
for _name in ("verbatim_gate", "accepted_rows", "rejected_rows", "accept_reject_split", "dedupe_best", "dedupe_scoped", "dataset_row", "stats_by_type", "stats_by_difficulty", "stats_by_section", "stats_grouping_sets", "acceptance_rate", "mean_confidence", "pct_exact", "stats_record", "running_accepted"):

    def _aligned(spark, sf_dir, whole=QUERIES[_name]):
        return whole(spark, sf_dir, fuzzy=True)

    _aligned.__name__ = f"{_name}_aligned"
    query()(_aligned)


# --- merge -----------------------------------------------------------------------------------------------------
def _captures(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Generations of user turns and verifications of assistant turns, by conversation; they differ in number."""
    c = table(spark, sf_dir, "conversations")
    gen = c.where("role = 'user'").groupBy(F.concat(F.lit("c"), "conv_id").alias("chunk_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]).alias("qa_pairs"))
    ver = c.where("role = 'assistant' AND conv_id % 6 <> 2").groupBy(F.concat(F.lit("c"), "conv_id").alias("chunk_id")).agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("v"))
    more = ver.withColumn("v", F.when(F.col("chunk_id").endswith("7"), F.concat("v", "v")).otherwise(F.col("v")))
    return gen, more.select("chunk_id", F.transform("v", lambda x: F.struct(F.lit("SUPPORTED").alias("verdict"), (x["turn"] / 16).alias("confidence"), x["role"].alias("reasoning"))).alias("verifications"))


_MERGED = """gen AS (SELECT 'c' || conv_id AS chunk_id, count(*) AS n FROM conversations WHERE role = 'user' GROUP BY conv_id),
ver0 AS (SELECT 'c' || conv_id AS chunk_id, list(turn ORDER BY turn, role) AS t FROM conversations WHERE role = 'assistant' AND conv_id % 6 <> 2 GROUP BY conv_id),
ver AS (SELECT chunk_id, CASE WHEN chunk_id LIKE '%7' THEN list_concat(t, t) ELSE t END AS t FROM ver0),
joined AS (SELECT chunk_id, n, coalesce(t, []) AS t, t IS NULL AS missing FROM gen LEFT JOIN ver USING (chunk_id)),
rows1 AS (SELECT chunk_id, n, t, missing, unnest(range(0, n)) AS i FROM joined)"""


@query(f"WITH {_MERGED} SELECT chunk_id, n::INT AS n_pairs, n::INT AS n_verdicts, missing FROM joined")
def merge_left_join(spark, sf_dir):
    return merge.merge_captures(*_captures(spark, sf_dir)).select("chunk_id", F.size("qa_pairs").alias("n_pairs"), F.size("verifications").alias("n_verdicts"), "missing")


@query(f"WITH {_MERGED} SELECT chunk_id, i::INT AS pair_idx, CASE WHEN i < len(t) THEN 'SUPPORTED' ELSE 'NOT_SUPPORTED' END AS verdict, CASE WHEN i < len(t) THEN t[i + 1] / 16 ELSE 0.0 END::DOUBLE AS confidence FROM rows1")
def merge_pad(spark, sf_dir):
    m = merge.merge_captures(*_captures(spark, sf_dir)).select("chunk_id", F.posexplode("verifications").alias("pair_idx", "v"))
    return m.select("chunk_id", "pair_idx", "v.verdict", "v.confidence")


@query(f"WITH {_MERGED} SELECT chunk_id, len(t)::INT AS given, n::INT AS kept FROM joined WHERE len(t) > n")
def merge_truncate(spark, sf_dir):
    gen, ver = _captures(spark, sf_dir)
    m = merge.merge_captures(gen, ver).join(ver.select("chunk_id", F.size("verifications").alias("given")), "chunk_id")
    return m.where(F.col("given") > F.size("qa_pairs")).select("chunk_id", "given", F.size("verifications").alias("kept"))


@query(f"WITH {_MERGED} SELECT count(*) AS chunks_merged, sum(n)::BIGINT AS total_pairs, sum(n)::BIGINT AS total_verifications, sum(missing::INT)::BIGINT AS chunks_missing_verification FROM joined")
def merge_summary(spark, sf_dir):
    return merge.merge_summary(merge.merge_captures(*_captures(spark, sf_dir)))


# --- written and read back -------------------------------------------------------------------------------------
@query(f"WITH {_MERGED} SELECT chunk_id, n::INT AS n_pairs, n::INT AS n_verdicts, len(list_filter(range(0, n), lambda i: i < len(t)))::INT AS supported FROM joined")
def replay_scan(spark, sf_dir):
    """Merged captures written as JSON lines and read as captured runs."""
    path = scratch.fresh_path(spark, "captures")
    gen, ver = _captures(spark, sf_dir)
    pair = F.transform("qa_pairs", lambda q: F.struct(q.alias("question"), F.lit("a").alias("answer"), F.lit("s").alias("source_passage"), F.lit("comparison").alias("question_type"), F.lit("easy").alias("difficulty")))
    sinks.write_captures(merge.merge_captures(gen.withColumn("qa_pairs", pair), ver), path)
    back = files.read_captures(spark, path)
    return back.select("chunk_id", F.size("qa_pairs").alias("n_pairs"), F.size("verifications").alias("n_verdicts"), F.size(F.filter("verifications", lambda v: v["verdict"] == "SUPPORTED")).alias("supported"))


@query(f"WITH {_MERGED} SELECT chunk_id, i::INT AS pair_idx, i < len(t) AS judged FROM rows1")
def captures_lifted(spark, sf_dir):
    """Captured runs, some of them in the first layout and some in the current one, read as pairs with their verdicts."""
    gen, ver = _captures(spark, sf_dir)
    pair = F.transform("qa_pairs", lambda q: F.struct(q.alias("question"), F.lit("a").alias("answer"), F.lit("s").alias("source_passage"), F.lit("comparison").alias("question_type"), F.lit("easy").alias("difficulty")))
    runs = gen.withColumn("generation", F.struct(pair.alias("qa_pairs"))).join(ver, "chunk_id", "left").select("chunk_id", "generation", "verifications")
    home = scratch.fresh_path(spark, "captures-of-versions")
    old = F.pmod(F.xxhash64("chunk_id"), F.lit(2)) == 0
    runs.where(old).write.json(f"{home}/old")
    runs.where(~old).write.json(f"{home}/lifted")
    versions.write_versioned(versions.read_versioned(spark, f"{home}/lifted"), f"{home}/new")
    back = versions.read_versioned(spark, f"{home}/{{old,new}}")
    return back.select("chunk_id", F.posexplode("items").alias("pair_idx", "i")).select("chunk_id", "pair_idx", F.col("i.verdict").isNotNull().alias("judged"))


def _rows(spark, sf_dir) -> DataFrame:
    c = candidates(spark, sf_dir)
    return c.select("doc_id", "pair_idx", "question", "source_passage", "verdict", (F.col("pair_idx") % 4 == 0).alias("flag"))


_ROWS = f"WITH {CANDIDATES} SELECT doc_id, pair_idx, question, source_passage, verdict, pair_idx % 4 = 0 AS flag FROM cand"


@query(_ROWS)
def csv_readback(spark, sf_dir):
    path = scratch.fresh_path(spark, "rows-csv")
    sinks.write_csv(_rows(spark, sf_dir), path)
    kind = "doc_id long, pair_idx long, question string, source_passage string, verdict string, flag boolean"
    back = spark.read.schema(kind).csv(path, header=True, multiLine=True, lineSep="\r\n", escape='"')
    return back.withColumns({c: F.replace(c, F.lit("\r\n"), F.lit("\n")) for c in ("question", "source_passage")})


@query(_ROWS)
def jsonl_readback(spark, sf_dir):
    path = scratch.fresh_path(spark, "rows-jsonl")
    sinks.write_jsonl(_rows(spark, sf_dir), path)
    return files.read_jsonl(spark, path, "doc_id long, pair_idx long, question string, source_passage string, verdict string, flag boolean")


@query(f"WITH {CANDIDATES}, {GROUNDED}, one AS ({_RATES}) SELECT n_accepted, n_rejected, acceptance_rate, mean_verifier_confidence, pct_exact_passage_match, 'Any Inc.' AS company FROM one")
def stats_readback(spark, sf_dir):
    """The statistics as the JSON document that a run writes, read again."""
    path = scratch.fresh_path(spark, "stats")
    sinks.write_record(judging.stats_of(decided(spark, sf_dir), dataset.ORDER), path, {"source": {"company": "Any Inc."}})
    kind = "source struct<company: string>, n_accepted long, n_rejected long, acceptance_rate double, mean_verifier_confidence double, pct_exact_passage_match double"
    return spark.read.schema(kind).json(path, multiLine=True).select("n_accepted", "n_rejected", "acceptance_rate", "mean_verifier_confidence", "pct_exact_passage_match", "source.company")


# --- beside the core -------------------------------------------------------------------------------------------
@query(f"WITH {CANDIDATES}, {GROUNDED}, r AS (SELECT *, row_number() OVER (PARTITION BY question_type, difficulty ORDER BY verifier_confidence DESC, doc_id, chunk_ord, pair_idx) AS k FROM kept) SELECT doc_id, pair_idx, question_type, difficulty FROM r WHERE k <= 5")
def ext_balance(spark, sf_dir):
    best = judging.dedupe(accepted(spark, sf_dir), dataset.ORDER)
    return extensions.balance(best, ["question_type", "difficulty"], 5, dataset.ORDER).select("doc_id", "pair_idx", "question_type", "difficulty")


_MARGINS = {"question_type": TYPES, "difficulty": LEVELS, "section_item": tuple("01234")}


@query(f"""WITH {CANDIDATES}, {GROUNDED}, v AS ({" UNION ALL ".join(f"SELECT '{n}' AS dimension, unnest({list(v)}) AS value, {len(v)} AS k" for n, v in _MARGINS.items())})
  SELECT dimension, value, (SELECT count(*) // 4 FROM kept) / k AS quota, true AS within_one FROM v""")
def quota_margins(spark, sf_dir):
    """A quarter of the pairs, as many of each type, of each difficulty and of each section: whether the sums are within one of that."""
    best = scratch.cut(judging.dedupe(accepted(spark, sf_dir), dataset.ORDER), "kept")
    total = best.count() // 4
    margins = {n: {x: total / len(v) for x in v} for n, v in _MARGINS.items()}
    got = quotas.shortfall(quotas.draw(best, margins, [F.desc("verifier_confidence"), *dataset.ORDER]), margins)
    return got.select("dimension", "value", "quota", (F.abs(F.col("n") - F.col("quota")) <= 1).alias("within_one"))


@query("SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY md5('s' || doc_id), doc_id) AS k FROM documents) WHERE k <= 4")
def ext_stratified(spark, sf_dir):
    return extensions.stratified(table(spark, sf_dir, "documents"), ["lang", "source"], 4, "doc_id").select("doc_id", "lang", "source")


@query("SELECT doc_id, count(*) FILTER (v = 'SUPPORTED') AS votes, count(*) AS n, count(*) FILTER (v = 'SUPPORTED') = count(*) AS agreed FROM (SELECT doc_id, CASE WHEN (doc_id + k) % 4 = 0 OR toxic = 1 THEN 'PARTIAL' ELSE 'SUPPORTED' END AS v FROM labels, range(1, 4) t(k)) GROUP BY doc_id")
def ext_unanimous(spark, sf_dir):
    three = table(spark, sf_dir, "labels").withColumn("k", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    return extensions.agreed(three.select("doc_id", F.when(((F.col("doc_id") + F.col("k")) % 4 == 0) | (F.col("toxic") == 1), "PARTIAL").otherwise("SUPPORTED").alias("verdict")), ["doc_id"])


@query(f"WITH {CANDIDATES}, {GROUNDED} SELECT section_item AS batch, count(*) AS n, count(*) FILTER (accepted) AS n_accepted, avg(confidence) AS mean_confidence, quantile_cont(confidence, 0.25) AS confidence_p25, quantile_cont(confidence, 0.5) AS confidence_p50, quantile_cont(confidence, 0.75) AS confidence_p75, count(DISTINCT question_type) AS n_types FROM decided GROUP BY 1")
def ext_monitor(spark, sf_dir):
    return extensions.monitor(decided(spark, sf_dir).withColumn("batch", F.col("section_item")), "batch")


@query(f"""WITH {CANDIDATES}, {GROUNDED}, q AS (SELECT unnest([{", ".join(map(str, monitoring.QUANTILES))}])::DOUBLE AS quantile),
  b AS (SELECT section_item AS batch, count(*) AS n, count(*) FILTER (accepted) AS n_accepted FROM decided GROUP BY 1 UNION ALL SELECT 'all', count(*), count(*) FILTER (accepted) FROM decided)
  SELECT batch, n, n_accepted, quantile, true AS rank_inside, true AS distinct_inside FROM b, q""")
def monitor_sketches(spark, sf_dir):
    """Confidence quantiles by batch and in total from stored sketches, and whether their exact ranks and the number of different questions lie within the stated errors."""
    pairs = scratch.cut(decided(spark, sf_dir).select(F.col("section_item").alias("batch"), "confidence", "accepted", "question"), "monitored")
    kept = scratch.cut(monitoring.sketches(pairs, ["batch"]), "sketches")
    both = monitoring.figures(kept).unionByName(monitoring.figures(monitoring.merged(kept, [])).withColumn("batch", F.lit("all")))
    every = pairs.unionByName(pairs.withColumn("batch", F.lit("all")))
    ranks = monitoring.exact_ranks(every, both, ["batch"])
    exact = every.groupBy("batch").agg(F.countDistinct(T.question_key(F.col("question"))).alias("different"))
    near_enough = F.abs(F.col("n_questions") - F.col("different")) <= monitoring.DISTINCT_ERROR * F.col("different")
    return both.join(exact, "batch").join(ranks, "batch").select("batch", "n", "n_accepted", "quantile", monitoring.inside(F.col("low"), F.col("high"), F.col("quantile")).alias("rank_inside"), near_enough.alias("distinct_inside"))


@query("SELECT l_orderkey, l_linenumber, l_quantity AS value, p_size::DOUBLE AS registered, l_quantity = p_size AS agrees FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size < 30) ON l_partkey = p_partkey")
def ext_cross_check(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("k"), F.col("l_quantity").alias("value"))
    facts = table(spark, sf_dir, "part").where("p_size < 30").select(F.col("p_partkey").alias("k"), F.col("p_size").cast("double").alias("value"))
    return extensions.cross_checked(n, facts, ["k"]).drop("k")


@query("""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), n AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS e FROM v)
  SELECT a.vec_id AS a, b.vec_id AS b, round(list_inner_product(a.e, b.e), 6) AS cosine FROM n a JOIN n b ON a.vec_id < b.vec_id WHERE list_inner_product(a.e, b.e) >= 0.5""")
def ext_near_questions(spark, sf_dir):
    """Pairs of questions whose embeddings are close."""
    return near.near_pairs(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.5).select("a", "b", F.round("cosine", 6).alias("cosine"))


def _sql_links(texts: str) -> str:
    """Links at 0.9 between vectors of hashed words of ``texts`` (id, t), by all pairs that share a component."""
    return f"""q AS ({texts}),
  w AS (SELECT id, word, ('0x' || substr(md5(word), 1, 4))::INT AS h FROM (SELECT id, unnest(string_split({sq_key("t")}, ' ')) AS word FROM q) WHERE word <> ''),
  x AS (SELECT id, h % 64 AS d, sum(CASE WHEN h // 64 % 2 = 0 THEN 1 ELSE -1 END * (1000 + 37 * length(word)))::BIGINT AS x FROM w GROUP BY ALL HAVING x <> 0),
  n AS (SELECT id, sum(x * x)::DOUBLE AS n, string_agg(d || ':' || x, ',' ORDER BY d) AS v FROM x GROUP BY id),
  links AS (SELECT a.id AS a, b.id AS b FROM x a JOIN x b ON a.d = b.d AND a.id <> b.id JOIN n na ON na.id = a.id JOIN n nb ON nb.id = b.id GROUP BY a.id, b.id HAVING sum(a.x * b.x)::DOUBLE / sqrt(any_value(na.n) * any_value(nb.n)) >= 0.9)"""


_COUNTED = "SELECT n.id, min(n.id) OVER (PARTITION BY v) AS class, (count(*) OVER (PARTITION BY v) - 1)::BIGINT AS n_same, coalesce(k, 0)::BIGINT AS n_links FROM n LEFT JOIN (SELECT a, count(*) AS k FROM links GROUP BY a) ON a = n.id"


def _hashed(rows: DataFrame) -> DataFrame:
    return extensions.hashed_vectors(rows.withColumn("words", T.key_words(F.col("text"))), "id", "words", T.QUESTION_WORDS)


@query(f"WITH {_sql_links("SELECT conv_id * 1000 + turn AS id, min(text) AS t FROM conversations WHERE role = 'user' GROUP BY 1")} {_COUNTED}")
def near_question_links(spark, sf_dir):
    """How many other questions stand within a cosine of 0.9 of each, by vectors of hashed words; equal vectors are one class."""
    asked = table(spark, sf_dir, "conversations").where("role = 'user'").groupBy((F.col("conv_id") * 1000 + F.col("turn")).alias("id")).agg(F.min("text").alias("text"))
    return near.near_counts(_hashed(asked), "id", "v", 0.9)


_DOCUMENT_LINKS = _sql_links("SELECT doc_id AS id, min(text) AS t FROM documents GROUP BY 1")


def _documents_once(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy(F.col("doc_id").alias("id")).agg(F.min("text").alias("text"))


@query(f"WITH {_DOCUMENT_LINKS} {_COUNTED}")
def near_document_links(spark, sf_dir):
    """The same of whole documents, many of which are near copies."""
    return near.near_counts(_hashed(_documents_once(spark, sf_dir)), "id", "v", 0.9)


@query(f"WITH {_DOCUMENT_LINKS}, first AS (SELECT n.id, min(n.id) OVER (PARTITION BY v) AS class FROM n) SELECT a, b FROM links JOIN first fa ON fa.id = a AND fa.class = a JOIN first fb ON fb.id = b AND fb.class = b WHERE a < b")
def near_document_pairs(spark, sf_dir):
    """Pairs of different document vectors with a cosine of 0.9 or more, by the smallest id of each."""
    return near.near_links(_hashed(_documents_once(spark, sf_dir)), "id", "v", 0.9, cosines=False).pairs


@query("""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), n AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS e FROM v)
  SELECT a.vec_id AS a, b.vec_id AS b, round(list_inner_product(a.e, b.e), 6) AS cosine FROM n a JOIN n b ON a.vec_id < b.vec_id WHERE list_inner_product(a.e, b.e) >= 0.9""")
def near_embeddings(spark, sf_dir):
    """The survey's threshold over the embeddings, of which few or none are so close."""
    return near.near_pairs(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.9).select("a", "b", F.round("cosine", 6).alias("cosine"))


_SPANS = """lines AS (SELECT doc_id, (i - 1)::INT AS line, length(l[i]) AS n, coalesce(list_sum(list_transform(l[1:i - 1], lambda x: length(x) + 1)), 0)::BIGINT AS s FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))),
  pieces AS (SELECT doc_id, k AS piece, k * 450 AS s, least(k * 450 + 500, n) AS e FROM (SELECT doc_id, length(text) AS n, unnest(range(0, greatest(0, length(text) - 51) // 450 + 1)) AS k FROM documents WHERE length(text) > 0)),
  met AS (SELECT a.doc_id, line, piece, greatest(a.s, b.s) AS s, least(a.s + a.n, b.e) AS e, b.s <= a.s AND b.e >= a.s + a.n AS whole FROM lines a JOIN pieces b ON a.doc_id = b.doc_id AND a.s < b.e AND b.s < a.s + a.n)"""


def _spans(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scratch.cut(intervals.line_spans(d, "doc_id", "text"), "lines"), scratch.cut(intervals.window_spans(d, "doc_id", "text", 500, 50), "pieces")


@query(f"WITH {_SPANS} SELECT doc_id, line, piece, s AS start, e AS \"end\" FROM met")
def span_overlaps(spark, sf_dir):
    """Lines and overlapping pieces of every document that share a place, and the place."""
    return intervals.overlapping(*_spans(spark, sf_dir), ["doc_id"]).select("doc_id", "l.line", "r.piece", "start", "end")


@query(f"WITH {_SPANS} SELECT doc_id, line, coalesce(k, 0)::BIGINT AS n, coalesce(m, 0)::BIGINT AS shared, coalesce(w, false) AS whole FROM lines LEFT JOIN (SELECT doc_id, line, count(*) AS k, sum(e - s) AS m, max(whole) AS w FROM met GROUP BY ALL) USING (doc_id, line)")
def span_coverage(spark, sf_dir):
    """Of each line, the pieces that overlap it and whether one holds all of it."""
    return intervals.covered(*_spans(spark, sf_dir), ["doc_id"], "line")


@query("""WITH e AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events WHERE ts IS NOT NULL), s AS (SELECT *, sum(CASE WHEN before IS NULL OR ts > before + INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
  SELECT user_id, min(ts) AS begin, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n, sum(value::DECIMAL(18, 2))::DECIMAL(28, 2) AS total, count(*) FILTER (event_type = 'error') AS n_errors FROM s GROUP BY user_id, k""")
def event_sessions(spark, sf_dir):
    """Runs of each user's events with no more than half an hour between them."""
    return drops.sessions(table(spark, sf_dir, "events"))


@query("""WITH r AS (SELECT o_custkey % 50 AS user_id, TIMESTAMP '2024-01-01' + (o_orderkey * 7919 % 43200) * INTERVAL 1 MINUTE AS since, max(o_orderkey) AS rule FROM orders GROUP BY ALL)
  SELECT event_id, rule, CASE WHEN since IS NOT NULL THEN value * 100 >= rule % 1000 END AS ok FROM events ASOF LEFT JOIN r ON events.user_id % 50 = r.user_id AND events.ts >= r.since""")
def verdicts_as_of(spark, sf_dir):
    """Events judged by the rule that was valid at their time; rules are made of orders, for one of fifty groups of users each."""
    o = table(spark, sf_dir, "orders")
    since = F.timestamp_micros(F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp")) + (F.col("o_orderkey") * 7919 % 43200) * 60_000_000)
    rules = o.select((F.col("o_custkey") % 50).alias("k"), since.alias("since"), F.col("o_orderkey").alias("rule"))
    events = table(spark, sf_dir, "events").select("event_id", "value", F.col("ts").cast("timestamp").alias("ts"), (F.col("user_id") % 50).alias("k"))
    met = asof.as_of(events, rules, ["k"], "ts", "since", int(spark.conf.get("spark.sql.shuffle.partitions")))
    return met.select("event_id", F.col("found.rule").alias("rule"), (F.col("value") * 100 >= F.col("found.rule") % 1000).alias("ok"))


# --- flagship --------------------------------------------------------------------------------------------------
@query(f"""WITH p AS (SELECT doc_id, CASE WHEN {sq_strip("r.cur")} <> '' THEN list_append(r.out, {sq_strip("r.cur")}) ELSE r.out END AS o FROM (SELECT doc_id, {sq_pack_lines("text", 1000)} AS r FROM documents)),
c AS (SELECT doc_id, unnest(range(0, len(o)))::INT AS chunk_ord, unnest(o) AS t FROM p),
b AS (SELECT item_id, unnest(w) AS word, len(w) AS n_tokens FROM (SELECT item_id, {sq_tokens("text")} AS w FROM benchmark)), w AS (SELECT doc_id, chunk_ord, t, unnest({sq_tokens("t")}) AS word FROM c),
m AS (SELECT item_id, doc_id, chunk_ord, any_value(t) AS t, n_tokens, count(*) AS shared FROM b JOIN w USING (word) GROUP BY item_id, doc_id, chunk_ord, n_tokens HAVING count(*) >= 0.6 * n_tokens),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY shared DESC, doc_id, chunk_ord) AS r FROM m)
SELECT item_id, doc_id, chunk_ord, substr(sha256(chunk_ord || '␟' || substr(t, 1, 120)), 1, 12) AS chunk_id, shared, n_tokens::INT AS n_tokens FROM k WHERE r = 1""")
def best_chunk(spark, sf_dir):
    """The chunk that grounds each benchmark passage best: documents to chunks to words to passages."""
    packed = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(C.pack_lines(F.col("text"), 1000)).alias("chunk_ord", "text"))
    chunk_id = T.stable_id(F.col("chunk_ord").cast("string"), F.substring("text", 1, 120))
    chunks = packed.select(F.struct("doc_id", "chunk_ord").alias("at"), "text", chunk_id.alias("chunk_id"))
    hits = grounding.overlap_join(table(spark, sf_dir, "benchmark"), chunks, 0.6, chunk_key="at", keep=("chunk_id",))
    best = hits.withColumn("r", F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("shared"), "at"))).where("r = 1")
    return best.select("item_id", "at.doc_id", "at.chunk_ord", "chunk_id", "shared", "n_tokens")


flagship = best_chunk
