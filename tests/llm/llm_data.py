"""Rows that operators must survive: nulls, empty and long texts, ties, repeats and clashing names."""

from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use themselves.
        T.StructField("label", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("chunk", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("shard", T.StringType()),
    ]
)


def words(n, first=0):
    return " ".join(f"w{first + k}" for k in range(n))


def edge_rows():
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    texts = [
        (0, words(40)), (1, words(40)), (1, words(40)), (2, None), (3, ""), (4, " \t\n "), (5, "one"), (6, "One"),
        (7, words(60_000)), (8, "x " * 30_000), (None, words(20)), (None, words(20)), (None, None),
        (9, "é ö̈ 日本語 \x1c a\x85b  c"), (10, words(40) + " end"), (11, words(26, 7)), (12, "The\nend.\n\nof  it"),
    ]
    sources = ["a", None, "b", "", "a"]
    rows = []
    for k, (doc_id, text) in enumerate(texts):
        row = (doc_id, text, "en", sources[k % 5], len(text or ""), "l", "s", "c", "k", None)
        rows.append(row if doc_id != 1 else (1, text, None, "a", None, None, None, None, None, None))
    return rows
