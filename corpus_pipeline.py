"""The corpus pipeline: quality, language, near duplicates, packing.

Each stage takes the documents that the one before it kept, and all but the last return the columns of documents. Null
texts count as empty; an empty table stays empty; repeated rows stay until the third stage, which keeps one of equal texts.
Texts of any length are taken whole. Ties of scores do not matter (a threshold decides), ties of languages go to the first by
name, of near duplicates to the least doc_id and then the least digest of the text. Extra columns of any name stay: rows
travel in one column while a stage works on them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opalgrid.llm import language, neardup, packing, quality
from opalgrid.llm.common import small_batches, stored, table
from opalgrid.llm.queries import vocabulary

#: Words that a worker keeps the ids of: fewer than alone, for the workers have served other stages before.
WORDS = 50_000


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.3 or more. The model is learned from the labelled rows of the whole table."""
    small_batches(spark)
    model = quality.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    return quality.with_score(rows, model).where(F.col("score") >= quality.KEPT_FROM).select("_row.*")


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the evidence settles; the source stands for the host."""
    small_batches(spark)
    model = language.learn(table(spark, sf_dir, "documents"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "text", "source")
    return language.identified(rows, model, host=F.col("source")).where("accepted").select("_row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of least doc_id."""
    small_batches(spark)
    return neardup.deduplicated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of 4096 tokens."""
    small_batches(spark)
    placed = packing.pack(docs, vocabulary("word_bpe_49k.json"), words=WORDS)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality classifier", keep_good),
    ("language ID", keep_identified),
    ("MinHash near-dedup", keep_one_of_each),
    ("best-fit packing", pack),
]

#: No stage can be written in SQL: fitted scores, weighted sampling and packing; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    kept = reduce(lambda d, s: stored(s[1](spark, d, sf_dir), "stage"), first, docs)
    return last(spark, kept, sf_dir)
