"""Rows that every operator has to take: nulls, empty and long texts, repeats, clashing names."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "Der Bericht über die lange Reise und das alte Haus am See. " * 4000
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog near the old river bank", "en", "a", 1),
    (2, "the quick  brown fox jumps over the lazy dog near the old river bank ", "en", "a", 2),
    (2, "the quick  brown fox jumps over the lazy dog near the old river bank ", "en", "a", 2),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \t\n\x0b\x0c\r ", "en", "b", 7),
    (None, "a text without an id that stands alone here", "en", "a", 3),
    (None, "a text without an id that stands alone here", "en", "a", 3),
    (6, LONG, "de", "c", len(LONG)),
    (7, "12345 --- !!! 67", "en", None, 5),
    (8, "naïve café Ünïcode 😀 words\nand a second line", "fr", "b", 6),
    (8, "another text under the same id as the one before it", "en", "b", 6),
]
CLASHING = ["_row", "_text", "_doc_id", "fp", "size", "kept", "target", "rate", "_th", "sha", "piece", "length", "source_size", "path", "_e"]


def odd_docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def clashing_docs(spark):
    docs = odd_docs(spark)
    for name in CLASHING:
        docs = docs.withColumn(name, F.lit("x"))
    return docs


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
