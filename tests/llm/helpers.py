"""Rows that every corpus operator must take: NULLs, empty and long texts, repeated rows, odd ids, clashing columns."""

DOCS = "doc_id long, text string, lang string, source string, n_chars int, size string, row string, taken string"

ODD_TEXTS = [None, "", " \n\t ", "one", "a b c", "é ü ß", "line\n\nline\n", "x" * 5000, "word " * 3000, "A.B! C? D\n" * 200]


def documents(spark, texts, ids=None, sources=None, langs=None):
    """A documents table with extra columns whose names operators use inside."""
    n = len(texts)
    ids = list(range(n)) if ids is None else ids
    sources = ["s"] * n if sources is None else sources
    langs = ["en"] * n if langs is None else langs
    rows = [(i, t, g, s, 0, "x", "y", "z") for i, t, g, s in zip(ids, texts, langs, sources, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def odd_documents(spark):
    texts = ODD_TEXTS + ODD_TEXTS[3:8]
    ids = [None, *range(1, len(ODD_TEXTS)), None, 4, 4, 5, 5]
    return documents(spark, texts, ids, [None if i % 3 == 0 else f"s{i % 2}" for i in range(len(texts))])
