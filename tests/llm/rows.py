"""Documents with awkward rows, shared by the tests."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, keep_id string"

AWKWARD = [
    (1, "Alpha beta gamma", "en", "a", 1, "x"),
    (2, "ALPHA BETA gamma", "en", "a", 1, "x"),
    (3, "", "en", None, 1, "x"),
    (4, None, None, "b", 1, "x"),
    (5, "Alpha beta gamma delta", "en", "b", 1, None),
    (5, "Alpha beta gamma delta", "en", "b", 1, None),
    (6, "été ÉTÉ \U0001f600 x", "fr", "b", None, "x"),
    (7, " ", "fr", "b", 1, "x"),
    (None, "Alpha beta gamma", "en", "b", 1, "x"),
    (8, "word " * 20000, "en", "a", 1, "x"),
    (9, "alpha", "en", "a", 1, "x"),
    (10, "1234 !!! ???", "en", "a", 1, "x"),
]


def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
