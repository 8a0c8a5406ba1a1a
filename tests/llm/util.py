"""Rows that every operator must take: nulls, empty and long texts, ties, repeats and clashing columns."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977} and{i}" for i in range(30_000))

HARD = [
    (5, "The quick brown fox jumps over the lazy dog and runs away from here today"),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "The quick brown fox jumps over the lazy dog and runs away from here today"),
    (4, "The quick brown fox jumps over the lazy dog and runs away from here today"),
    (7, "ünï çødé 日本語 テキスト é́ <|endoftext|> don't"),
    (8, LONG),
    (None, "a row without an id"),
    (None, None),
    (10, "x"),
    (11, "line one\nline two\n\nline four"),
]


def hard_docs(spark):
    """HARD with extra columns whose names clash with those that operators use inside."""
    df = spark.createDataFrame(HARD, "doc_id long, text string")
    names = ("part", "own", "shard", "grp", "label", "_text", "_all", "score", "held_out", "fp_a", "node", "sequence_id",
             "_row", "martkit", "frame", "component_id", "n_chars", "lang", "source")
    return df.select("*", *[F.lit(None).cast("string").alias(n) if n != "n_chars" else F.length("text").cast(
        "long").alias(n) for n in names])


def empty(df):
    return df.limit(0)
