"""Small documents with every awkward case, and comparison helpers."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SMALL = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977} thing{i % 13}" for i in range(3_000))
#: doc_id, text, lang, source: nulls in any column, empty, blank, one-word, very
#: long and repeated texts, and a repeated row.
AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (2, "the QUICK brown fox\tjumps over the lazy dog near the\nriver bank today", "en", "a"),
    (2, "the QUICK brown fox\tjumps over the lazy dog near the\nriver bank today", "en", "a"),
    (3, None, "en", "a"), (4, "", None, None), (5, " \t\r\n\v\f ", "de", None), (6, "word", None, "b"),
    (7, "word", "en", "b"), (None, "no id at all but some words in it", "en", "b"),
    (None, None, None, None), (8, LONG, "en", "c"), (9, LONG + " tail", "en", "c"),
    (10, "é ü ñ 漢字 \u00a0 \u2028 😀 é ｆｕｌｌ", "fr", "d"), (11, "<|endoftext|> <|startoftext|>a</s>", "fr", "d"),
    (12, "a\n\n\nb  c \n d\u00a0e\x1cf", "es", "d"),
]
CLASHES = ("score", "kept", "n_words", "component_id", "value", "key", "block", "node", "extra", "base", "piece",
           "sequence_id", "shard", "items", "_text", "label", "spans")


def awkward(spark: SparkSession, extra: bool = True) -> DataFrame:
    """The awkward documents, with extra columns of clashing names."""
    docs = spark.createDataFrame(
        [(i, t, l, s, None if t is None else len(t)) for i, t, l, s in AWKWARD],
        "doc_id long, text string, lang string, source string, n_chars long")
    for name in CLASHES if extra else ():
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


def documents(spark: SparkSession, sf_dir: str = SMALL) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
