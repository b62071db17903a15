"""Fitting on bounded samples: the rows that may be learned from, and a model made by one task."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opalgrid.llm.common import claim, text_of


def held_out(key: str = "doc_id") -> Column:
    """Whether a document is kept from learning: the crc32 of its id as text, mod 5, is 0. False without id."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """id, text, y of at most `most` labelled documents that are not held out, the same ones at each run.

    The ids are drawn by a hash; a document with several labels counts by its largest, and of several texts of one id the
    one of least hash counts.
    """
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key))
    one = usable.groupBy(F.col(key).cast("long").alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    drawn = one.orderBy(F.xxhash64("id"), "id").limit(most)
    texts = docs.select(F.col(key).cast("long").alias("id"), text_of(text).alias("text"))
    found = texts.join(F.broadcast(drawn), "id")  # `most` rows of 12 bytes are broadcast
    return found.groupBy("id").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"), F.max("y").alias("y"))


def fitted(rows: DataFrame, fit: Callable[[pd.DataFrame], Any]) -> Any:
    """fit(rows) in one task, for samples of a fixed size; the model comes back pickled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("fit")
        parts = list(batches)
        if parts:
            yield pd.DataFrame({"model": [pickle.dumps(fit(pd.concat(parts, ignore_index=True)))]})

    found = rows.repartition(1).mapInPandas(run, "model binary").collect()
    return pickle.loads(bytes(found[0][0])) if found else fit(pd.DataFrame({f.name: [] for f in rows.schema}))
