"""Information-theoretic sanitisation of personal data, with DataFrame functions only.

Protected entities are found by patterns: mail addresses, IPv4 addresses, card numbers, phone numbers (the base
kinds), and secrets, which are long runs of letters and digits with many different characters. Corpus
co-occurrence then tells which other terms of a text give an entity away. With counts of different texts over the
whole corpus, a term t tells about entity c the pointwise mutual information

    PMI(c; t) = ln(n_ct * N / (n_c * n_t)),    at most IC(c) = ln(N / n_c).

Where PMI reaches ``disclosure`` of IC, whoever sees t knows most of what c itself would tell, so t is
generalised to its first letters if that class of terms stays below the threshold, else removed. ``SMOOTHING`` is
added to n_c and n_t, so that little evidence needs a larger corpus to count: an entity of one text has terms from
87 different texts on. Copies of a text are one observation. Terms are all words, short ones and ones with digits
too; a word that many texts have tells little about any of them, so that no list of common words is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut, documents, mark, release

#: Fixed patterns. A possessive repeat stops where the greedy one would; the look-behind starts a run at its
#: first character or where the match before ended, so that long runs are read once.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
#: A secret: a whole run of letters and digits, two of each at least, with ten different characters at least, so that
#: it can carry 66 bits.
SECRET = "[A-Za-z0-9]{20,}"
SECRET_SIGNS = 10
RANK = {k: i for i, k in enumerate([*KINDS, "secret", "term"])}
#: The rank of a term whose class may stay.
SAFE = RANK["term"] + 1
WORD = r"[\p{L}\p{M}\p{N}]+"
STEM = 3
SMOOTHING = 0.5
DISCLOSURE = 0.9
ITEM = "struct<start: int, rank: int, kind: string, end: int, value: string>"
SPAN = f"array<{ITEM}>"
#: Numbers that a running fold takes at a time: a fold copies its state at each step, so lists in it must stay short.
PART = 64
#: Code points, as a power of two, of the blocks that a text is cut into, so that a piece of it is reached without reading from its start.
BLOCK = 10


def _luhn(digits: Column) -> Column:
    """Whether the check digit fits: every second digit from the right is doubled and its digits summed."""
    return (
        F.aggregate(
            F.sequence(F.lit(1), F.length(digits)),
            F.lit(0),
            lambda acc, i: acc
            + F.when((F.length(digits) - i) % 2 == 0, F.substring(digits, i, F.lit(1)).cast("int")).otherwise(
                F.substring(digits, i, F.lit(1)).cast("int") * 2 - F.when(F.substring(digits, i, F.lit(1)).cast("int") > 4, 9).otherwise(0)
            ),
        )
        % 10
        == 0
    )


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        return F.length(digits).between(12, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "secret":
        n = F.length(digits)
        return (n >= 2) & (F.length(value) - n >= 2) & (F.size(F.array_distinct(F.split(value, ""))) >= SECRET_SIGNS)
    return F.lit(True)


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once however often and in whatever lambda it is read."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(numbers: Column, fold) -> Column:
    """What ``fold``, for which 0 changes nothing, makes of an array's numbers up to each of them; parts first, then the parts' totals."""
    none = F.expr("cast(array() as array<int>)")

    def along(values: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), none.alias("out"))
        step = lambda acc, x: _let(fold(acc["at"], x), lambda y: F.struct(y.alias("at"), F.array_append(acc["out"], y).alias("out")))
        return F.aggregate(values, start, step)

    def joined(parts: Column) -> Column:
        ends = along(F.transform(parts, lambda p: p["at"]))["out"]
        before = F.concat(F.array(F.lit(0)), ends)
        return F.flatten(F.zip_with(parts, F.slice(before, F.lit(1), F.size(parts)), lambda p, b: F.transform(p["out"], lambda x: fold(b, x))))

    whole = lambda v: _let(F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / PART).cast("int")), lambda k: along(F.slice(v, k * PART + 1, F.lit(PART)))), joined)
    return F.when(F.size(numbers) == 0, none).otherwise(_let(numbers, whole))


def _located(kind: str, gaps: Column, values: Column, keep=None) -> Column:
    """Spans of ``values`` in a text that they part into ``gaps``; only those that ``keep`` wants."""
    ends = _running(F.zip_with(gaps, values, lambda g, v: F.length(g) + F.length(v)), lambda x, y: x + y)
    span = lambda v, e: F.struct((e - F.length(v)).alias("start"), F.lit(RANK[kind]).alias("rank"), F.lit(kind).alias("kind"), e.alias("end"), v.alias("value"))
    spans = F.zip_with(values, ends, span)
    return F.when(F.size(values) == 0, F.expr(f"cast(array() as {SPAN})")).otherwise(spans if keep is None else F.filter(spans, lambda s: keep(s["value"])))


def _reach(spans: Column) -> Column:
    """The furthest end of the spans before each, and of all, as one array."""
    return F.concat(F.array(F.lit(0)), _running(F.transform(spans, lambda s: s["end"]), F.greatest))


def _apart(spans: Column, others: Column, kind: str) -> Column:
    """``spans`` and those of ``others`` that overlap none of them, by start, then kind.

    ``others`` are of one ``kind``, ranked behind those of ``spans``, and lie apart from each other. So one of them
    overlaps a span only if an earlier span ends behind its start, or if the next of all is a span that starts before its end.
    """

    def merged(every: Column) -> Column:
        main = lambda x: x["kind"] != kind
        ends = F.concat(F.array(F.lit(0)), _running(F.transform(every, lambda x: F.when(main(x), x["end"]).otherwise(0)), F.greatest))

        def free(reach: Column) -> Column:
            follows = lambda x, i: F.coalesce(main(F.get(every, i + 1)) & (F.get(every, i + 1)["start"] < x["end"]), F.lit(False))
            return F.filter(every, lambda x, i: main(x) | ((F.get(reach, i) <= x["start"]) & ~follows(x, i)))

        return _let(ends, free)

    return F.when(F.size(others) == 0, spans).when(F.size(spans) == 0, others).otherwise(_let(F.array_sort(F.concat(spans, others)), merged))


def _with_spans(rows: DataFrame, kinds: dict[str, str], spans: str) -> DataFrame:
    """Add ``spans``: valid matches of all kinds in ``text``, which is not null, by start, then kind.

    Matches and what stands between them are columns first, so that each pattern is run once for either.
    """
    text, none = F.col("text"), F.expr("cast(array() as array<string>)")
    needs = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    out = rows.withColumns({f"m_{k}": F.when(needs.get(k, text.rlike("[0-9]")), F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(none) for k, p in kinds.items()})
    # a text has one more gap than matches; the last one is cut off
    out = out.withColumns({f"g_{k}": F.when(F.size(f"m_{k}") > 0, F.slice(F.split(text, p, -1), 1, F.size(f"m_{k}"))).otherwise(none) for k, p in kinds.items()})
    found = F.flatten(F.array(*[_located(k, F.col(f"g_{k}"), F.col(f"m_{k}"), lambda v, k=k: _valid(k, v)) for k in kinds]))
    return out.withColumn(spans, F.array_sort(found)).drop(*[f"{x}_{k}" for k in kinds for x in "mg"])


def _packed(docs: DataFrame, text: str) -> DataFrame:
    """(row, text, lost): a caller's columns travel as one, so that no name of this module can clash with theirs; a null text is empty and ``lost``."""
    return docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(text).isNull().alias("lost"))


def find_entities(docs: DataFrame, text: str, spans: str = "base") -> DataFrame:
    """Add ``spans``: the entities of the base kinds in ``text`` with code point offsets, by start, then kind. A null text has none. A column of that name is replaced."""
    names = [c for c in docs.columns if c != spans]
    return _with_spans(_packed(docs, text), KINDS, "base").select(*[F.col("row").getField(c).alias(c) for c in names], F.col("base").alias(spans))


def _words(text: Column) -> Column:
    """Distinct words outside mail addresses, in lower case."""
    plain = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, EMAIL, " ")).otherwise(text)
    return F.array_distinct(F.regexp_extract_all(F.lower(plain), F.lit(WORD), F.lit(0)))


def disclosing_terms(texts: DataFrame, holders: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """(copy, term, safe) for words that give an entity of their text away: the hash of the word, and whether its class is safe.

    ``texts`` (copy, text) are all texts of the corpus, once each; ``holders`` (copy, text, entities) those with
    entities. The class of a word is all words with its first letters, and its counts are the sums of theirs.
    """
    hashed = [F.xxhash64("word").alias("term"), F.xxhash64(F.substring("word", 1, STEM)).alias("class")]
    corpus = texts.select(F.explode(_words(F.col("text"))).alias("word")).select(*hashed).groupBy("term", "class").agg(F.count("*").alias("n_t"))
    corpus = cut(corpus, "words")
    size = texts.agg(F.count("*").cast("double").alias("n"))
    entities = cut(holders.select("copy", F.explode("entities").alias("entity")).select("copy", F.xxhash64("entity").alias("entity")), "entities")
    # entities of the same texts have the same counts with all words, so that one digest of these texts stands for them
    known = entities.groupBy("entity").agg(F.count("*").alias("n_c"), F.bit_xor("copy").alias("a"), F.bit_xor(F.xxhash64("copy")).alias("b"))
    held = entities.join(known, "entity").select("copy", "n_c", F.xxhash64("n_c", "a", "b").alias("entity")).distinct()
    told = held.join(holders.select("copy", _words(F.col("text")).alias("words")), "copy").select("copy", "entity", "n_c", F.explode("words").alias("word"))
    told = cut(told.select("copy", "entity", "n_c", *hashed), "told")
    pairs = told.groupBy("entity", "n_c", "term", "class").agg(F.count("*").alias("n_ct"))
    size = F.broadcast(size)  # one row
    n_c = F.col("n_c") + SMOOTHING
    ic = F.log(F.col("n") / n_c)
    tells = lambda both, own: (ic > 0) & (F.log(F.col(both) * F.col("n") / (n_c * (F.col(own) + SMOOTHING))) >= disclosure * ic)
    risky = cut(pairs.join(corpus.select("term", "n_t"), "term").join(size).where(tells("n_ct", "n_t")).select("entity", "n_c", "term", "class"), "risky")
    # only classes of terms that tell are looked at
    asked = risky.select("entity", "class").distinct()
    classes = pairs.join(asked, ["entity", "class"], "left_semi").groupBy("entity", "n_c", "class").agg(F.sum("n_ct").alias("n_ck"))
    classes = classes.join(corpus.groupBy("class").agg(F.sum("n_t").alias("n_k")), "class").join(size).select("entity", "class", (~tells("n_ck", "n_k")).alias("safe"))
    labelled = risky.join(classes, ["entity", "class"]).select("entity", "term", "safe")
    return cut(told.select("copy", "entity", "term").join(labelled, ["entity", "term"]).groupBy("copy", "term").agg(F.min("safe").alias("safe")), "terms")


def _replaced(spans: Column, blocks: Column, size: Column) -> Column:
    """The text of ``size`` code points in ``blocks`` with a label for each of ``spans``, which are in order.

    Spans that overlap the ones before leave no label. Time grows with the text, and with a block for each span.
    """

    def piece(a: Column, b: Column) -> Column:
        first = F.shiftright(a, BLOCK)
        near = F.array_join(F.slice(blocks, first + 1, F.shiftright(b - 1, BLOCK) - first + 1), "")
        return F.when(a < b, F.substring(near, F.pmod(a, F.lit(1 << BLOCK)) + 1, b - a)).otherwise("")

    def made(reach: Column) -> Column:
        def labelled(s: Column, i: Column) -> Column:
            general = F.when((s["rank"] == SAFE) & (F.length(s["value"]) > STEM), F.concat(F.substring(F.lower(s["value"]), 1, STEM), F.lit("*"))).otherwise("[TERM]")
            label = F.when(s["kind"] == "term", general).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
            return F.when(s["start"] >= F.get(reach, i), F.concat(piece(F.get(reach, i), s["start"]), label)).otherwise("")

        return F.concat(F.array_join(F.transform(spans, labelled), ""), piece(F.element_at(reach, -1), size))

    return _let(_reach(spans), made)


def sanitise(docs: DataFrame, text: str = "text", disclosure: float = DISCLOSURE) -> DataFrame:
    """``docs`` with ``base``, ``spans`` and ``sanitised``.

    ``base`` are the entities of the base kinds; ``spans`` those, secrets, and the disclosing terms, the latter two
    only where they overlap no entity; ``sanitised`` is the text with each span replaced by its kind in brackets or
    by what generalises the term. Spans that overlap leave one label. A null text has no spans and stays null;
    it counts as an empty one. Rows of equal texts have equal spans; ids are not read.
    Terms that are generalised have the rank ``SAFE``. Time grows linearly with a text's length and its spans; what the
    counts of co-occurrence take grows with its entities of different sets of texts, times its words.
    Columns of the three names are replaced.
    """
    rows = _packed(docs.drop("base", "spans", "sanitised"), text).withColumn("copy", F.xxhash64("text"))
    found = _with_spans(_with_spans(rows, KINDS, "base"), {"secret": SECRET}, "secrets")
    found = found.withColumn("entities", _apart(F.col("base"), F.col("secrets"), "secret")).drop("secrets")
    since = mark()
    holders = cut(found.where(F.size("entities") > 0), "holders")
    # texts are parted by their hash and thinned before that, so that a text of very many copies meets as few rows
    texts = rows.groupBy("copy").agg(F.first("text").alias("text"))
    named = F.array_distinct(F.transform("entities", lambda s: F.concat(s["kind"], F.lit(":"), F.lower(s["value"]))))
    once = holders.select("copy", "text", named.alias("entities")).groupBy("copy").agg(F.first("text").alias("text"), F.first("entities").alias("entities"))
    once = cut(once, "once")
    terms = disclosing_terms(texts, once, disclosure)
    # words with their places are rows, so that terms are met by a join, whatever the number of either in a text
    words = once.select("copy", "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
    words = words.select("copy", F.slice(F.split("text", WORD, -1), 1, F.size("words")).alias("gaps"), "words")
    words = words.select("copy", F.explode(_located("term", F.col("gaps"), F.col("words"))).alias("s")).withColumn("term", F.xxhash64(F.lower("s.value")))
    hit = F.struct("s.start", F.when(F.col("safe"), SAFE).otherwise(F.col("s.rank")).alias("rank"), "s.kind", "s.end", "s.value")
    told = cut(words.join(terms, ["copy", "term"]).groupBy("copy").agg(F.array_sort(F.collect_list(hit)).alias("told")), "told")
    release(docs.sparkSession, since, holders, told)

    told = holders.join(told, "copy", "left").withColumn("told", F.coalesce("told", F.expr(f"cast(array() as {SPAN})")))
    told = told.withColumns({"spans": _apart(F.col("entities"), F.col("told"), "term"), "blocks": F.regexp_extract_all("text", F.lit(f"(?s).{{1,{1 << BLOCK}}}"), F.lit(0))})
    told = told.withColumn("sanitised", _replaced(F.col("spans"), F.col("blocks"), F.length("text")))
    rest = found.where(F.size("entities") == 0).withColumns({"spans": F.col("entities"), "sanitised": F.when(~F.col("lost"), F.col("text"))})
    return told.select("row.*", "base", "spans", "sanitised").unionByName(rest.select("row.*", "base", "spans", "sanitised"))


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text of ``documents``: counts by kind, digest of the base entities, all spans with secrets and disclosing terms."""
    found = sanitise(documents(spark, sf_dir).select("doc_id", "text"))
    count = lambda column, kind: F.expr(f"cast(size(filter({column}, s -> s.kind = '{kind}')) as long)").alias(f"n_{kind}")
    return found.select("doc_id", *[count("base", k) for k in KINDS], F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"),
                        count("spans", "secret"), count("spans", "term"), F.size("spans").cast("long").alias("n_spans"))


def op8_pii_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pipeline writes for every text with spans: code points before and after, and the digest of the sanitised text."""
    found = sanitise(documents(spark, sf_dir).select("doc_id", "text")).where(F.size("spans") > 0)
    return found.select("doc_id", _listed("spans").alias("spans"), F.length("text").cast("long").alias("n_chars"), F.length("sanitised").cast("long").alias("n_chars_after"), F.sha2("sanitised", 256).alias("sanitised_sha256"))


def _sql_spans(kind: str, pattern: str, test: str) -> str:
    """Matches of one kind with offsets: what stands before a match is what the pattern leaves of the text."""
    return f"""
  SELECT doc_id, list_filter(list_transform(range(1, len(m) + 1), lambda i: {{
    's': list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
    'r': {RANK[kind]}, 'k': '{kind}', 'n': length(m[i]), 'v': m[i]}}), lambda x: {test}) AS spans
  FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, regexp_split_to_array(t, '{pattern}') AS g FROM d)"""


_DIGITS = "regexp_replace(x.v, '[^0-9]', '', 'g')"
_SQL_LUHN = (
    f"list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN (length({_DIGITS}) - i) % 2 = 0 THEN CAST({_DIGITS}[i] AS INT)"
    f" ELSE CAST({_DIGITS}[i] AS INT) * 2 - CASE WHEN CAST({_DIGITS}[i] AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0"
)
_SQL_WORDS = "list_distinct(regexp_extract_all(lower(regexp_replace(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+', ' ', 'g')), '[\\p{L}\\p{M}\\p{N}]+'))"
_SQL_APART = "len(list_filter({}, lambda b: b.s < x.s + x.n AND x.s < b.s + b.n)) = 0"
_SQL_SECRET = f"length({_DIGITS}) >= 2 AND length(x.v) - length({_DIGITS}) >= 2 AND len(list_distinct(string_split(x.v, ''))) >= {SECRET_SIGNS}"
#: Spans by exact counts over different texts; ``d`` has each once.
OP8_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS doc_id, t FROM (SELECT DISTINCT coalesce(text, '') AS t FROM documents)),
email AS ({_sql_spans("email", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+", "true")}),
ip AS ({_sql_spans("ip", "[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+", "len(list_filter(string_split(x.v, '.'), lambda p: CAST(p AS HUGEINT) > 255)) = 0")}),
card AS ({_sql_spans("card", "[0-9](?:[\\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 12 AND 19 AND {_SQL_LUHN}")}),
phone AS ({_sql_spans("phone", "\\+[0-9][\\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15")}),
secret AS ({_sql_spans("secret", SECRET, _SQL_SECRET)}),
base AS (
  SELECT d.doc_id, t, len(e.spans) AS n_email, len(i.spans) AS n_ip, len(c.spans) AS n_card, len(p.spans) AS n_phone,
    list_sort(list_concat(list_concat(e.spans, i.spans), list_concat(c.spans, p.spans))) AS spans, s.spans AS secrets
  FROM d JOIN email e USING (doc_id) JOIN ip i USING (doc_id) JOIN card c USING (doc_id) JOIN phone p USING (doc_id) JOIN secret s USING (doc_id)
),
entities AS (SELECT *, list_sort(list_concat(spans, list_filter(secrets, lambda x: {_SQL_APART.format("spans")}))) AS entities FROM base),
holders AS (SELECT DISTINCT doc_id, x.k || ':' || lower(x.v) AS entity FROM (SELECT doc_id, unnest(entities) AS x FROM entities)),
known AS (SELECT entity, count(*) AS n_c FROM holders GROUP BY entity),
words AS (SELECT doc_id, unnest({_SQL_WORDS}) AS term FROM d),
n_t AS (SELECT term, count(*) AS n_t FROM words GROUP BY term),
pairs AS (SELECT h.entity, k.n_c, w.term, count(*) AS n_ct FROM holders h JOIN known k USING (entity) JOIN words w USING (doc_id) GROUP BY ALL),
risky AS (
  SELECT entity, term FROM pairs JOIN n_t USING (term), (SELECT count(*)::DOUBLE AS n FROM d)
  WHERE n > n_c + {SMOOTHING} AND ln(n_ct * n / ((n_c + {SMOOTHING}) * (n_t + {SMOOTHING}))) >= {DISCLOSURE} * ln(n / (n_c + {SMOOTHING}))
),
terms AS (SELECT h.doc_id, list(DISTINCT r.term) AS terms FROM holders h JOIN words w USING (doc_id) JOIN risky r ON r.entity = h.entity AND r.term = w.term GROUP BY h.doc_id),
told AS (
  SELECT doc_id, list_filter(list_transform(range(1, len(m) + 1), lambda i: {{
    's': list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
    'r': {RANK["term"]}, 'k': 'term', 'n': length(m[i]), 'v': m[i]}}), lambda x: list_contains(terms, lower(x.v)) AND {_SQL_APART.format("entities")}) AS told
  FROM (SELECT doc_id, terms, entities, regexp_extract_all(t, '[\\p{{L}}\\p{{M}}\\p{{N}}]+') AS m, regexp_split_to_array(t, '[\\p{{L}}\\p{{M}}\\p{{N}}]+') AS g FROM entities JOIN terms USING (doc_id))
),
by_text AS (SELECT t, n_email, n_ip, n_card, n_phone, spans AS base, list_sort(list_concat(entities, coalesce(told, []))) AS spans FROM entities LEFT JOIN told USING (doc_id))
SELECT documents.doc_id, n_email, n_ip, n_card, n_phone,
  sha256(array_to_string(list_transform(base, lambda x: x.k || ':' || CAST(x.s AS BIGINT) || ':' || CAST(x.s + x.n AS BIGINT)), ',')) AS base_sha256,
  array_to_string(list_transform(spans, lambda x: x.k || ':' || CAST(x.s AS BIGINT) || ':' || CAST(x.s + x.n AS BIGINT)), ',') AS spans,
  len(list_filter(spans, lambda x: x.k = 'secret')) AS n_secret, len(list_filter(spans, lambda x: x.k = 'term')) AS n_term, len(spans) AS n_spans
FROM documents JOIN by_text ON by_text.t = coalesce(documents.text, '')
"""
