"""Tables that hold what the operators must bear: nulls, empty and very long texts, repeated rows, clashing names."""

ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, media int, base int, spans string"


def odd_rows():
    long = "word " * 40_000
    rows = [(1, "The same short text here today again", "en", "src1"), (2, "The same short text here today again", "en", "src1"), (3, None, None, None), (4, "", "en", "src2"), (5, "  \n\t ", "de", ""), (6, long, "en", "src0"),
            (7, "one", "fr", "src3"), (1, "The same short text here today again", "en", "src1"), (None, "a row without an id stands here", "en", "src9"), (8, "mail a.b@c.de and 10.0.0.1 é", "es", "src5"),
            (9, " ".join(f"say {k} to p{k % 90}@q.org at 10.1.2.{k % 256}," for k in range(2_000)), "en", "src0")]
    return [(*r, None if r[1] is None else len(r[1]), "x", 1, 2, "y") for r in rows]


def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD_SCHEMA)


def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
