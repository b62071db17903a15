"""Odd documents: nulls, empty and long texts, ties, repeated rows, and columns whose names the operators use."""

import pytest

ODD = [
    (3, "The cat sat on the mat and looked at the dog.", "en", "src0", 45),
    (3, "The cat sat on the mat and looked at the dog.", "en", "src0", 45),
    (1, None, None, None, None),
    (2, "", "en", None, 0),
    (None, "no id here, just some words of text", "en", "src1", 35),
    (None, None, None, "src1", None),
    (7, "   \n\t ", "fr", "src2", 6),
    (8, "word " * 30_000, "en", "src2", 150_000),
    (9, "x" * 20_000, "en", "src2", 20_000),
    (10, "日本語 é ñ ß 𝒳 '''s 12345 !!", "de", "src0", 24),
    (11, "The cat sat on the mat and looked at the dog.", "en", "src9", 45),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ODD, SCHEMA)
    clash = ["_key", "_node", "_range", "_row", "key", "score", "length", "ids", "_lik", "host", "h", "n", "label", "piece", "_text", "steps", "probability", "lang_found", "text_lang", "accepted", "fingerprint", "class_id", "class_size", "links",
             "sequence_id", "offset", "start", "n_features", "n_words", "weight", "rank", "id", "known"]
    return rows.withColumns({c: F.lit(c) for c in clash})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
