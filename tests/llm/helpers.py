"""Small tables with awkward rows."""

from __future__ import annotations

from pyspark.sql import functions as F

AWKWARD = [
    None, "", " ", "\n\n", "a", "a  b \n c", "Hello WORLD's don't", "x" * 5000, "word " * 20000,
    "Zürich Straße ÀÉ ǅ İstanbul ΑΣ Σ", "日本語 テキスト 한국어", "a\x1cb \x85c\xa0d　e", "emoji 👩‍👩‍👧 ok",
    "<|endoftext|> x<|startoftext|>y <|endoftext|>", "tail space \n ", "tabs\t\tand\r\nlines", "é ñ ́",
    "123 4567 1½ ² ①", "!!! ??? ...", "MIT License\nmit, license; Apache\nLicense", "same text", "same text",
]


def awkward_docs(spark):
    """Awkward texts; null id, repeated ids, null source, clashing extra columns."""
    rows = [(i, t, None if i % 5 == 0 else f"s{i % 3}") for i, t in enumerate(AWKWARD)]
    rows += [(None, "no id", "s1"), (3, "repeated id", "s2"), (1, "", "s1"), (1, "", "s1")]
    return (spark.createDataFrame(rows, "doc_id long, text string, source string")
            .withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
            .withColumn("id", F.lit("clash")).withColumn("score", F.lit("clash")).withColumn("n_tokens", F.lit(-1))
            .withColumn("size", F.lit(None).cast("string")).withColumn("n_words", F.lit(-1)))


def empty_docs(spark):
    return awkward_docs(spark).limit(0)
