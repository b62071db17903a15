"""Quartile bucket digests: fingerprints of byte triplets that stay near each other when texts do.

Each window of five bytes gives three triplets, hashed into 128 buckets. A digest holds, for each bucket, the quartile
that its count falls into; a code of the length; and how the quartiles relate. Two digests are compared by a difference
score with an upper bound, which makes a likeness from 0 to 1.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opalgrid.llm.common import by_ranges, dealt_by, pieces_of, text_of

BUCKETS = 128
#: Which two of the following bytes go with a byte, and the seed of that triplet.
TRIPLETS = ((1, 2, 0x1B873593), (1, 3, 0x85EBCA6B), (2, 4, 0xC2B2AE35))
#: A difference of this and more counts as none in common: what unrelated digests show on the mean, twice.
BOUND = 416
#: Differences of length codes and quartile ratios beyond this count as this.
PART_BOUND = 24


def codes(texts: Sequence[str]) -> np.ndarray:
    """A row of BUCKETS + 3 small numbers for each text: quartiles of the buckets, code of the length, two ratios."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    counts = np.zeros((len(raw), BUCKETS), np.int64)
    for s in pieces_of(sizes.tolist(), 1 << 20):
        b = np.frombuffer(b"".join(raw[s]), np.uint8).astype(np.uint32)
        n, own = len(b), sizes[s]
        rows = np.repeat(np.arange(len(own), dtype=np.int32), own)
        left = (np.repeat(np.cumsum(own), own) - np.arange(n)).astype(np.int64)  # bytes from here to the text's end
        for i, j, seed in TRIPLETS:
            if n <= j:
                continue
            h = b[: n - j] * np.uint32(0x9E3779B1)
            h ^= b[i : n - j + i] * np.uint32(0x85EBCA77) + np.uint32(seed)
            h *= np.uint32(0xC2B2AE3D)
            h ^= h >> np.uint32(15)
            h += b[j:] * np.uint32(0x27D4EB2F)
            h *= np.uint32(0x165667B1)
            at = rows[: n - j].astype(np.int64) * BUCKETS + (h >> np.uint32(25))
            counts[s] += np.bincount(at[left[: n - j] > j], minlength=len(own) * BUCKETS).reshape(-1, BUCKETS)
    ordered = np.sort(counts, axis=1)
    q = ordered[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    out = np.zeros((len(raw), BUCKETS + 3), np.uint8)
    out[:, :BUCKETS] = (counts[:, :, None] > q[:, None, :]).sum(axis=2)
    out[:, BUCKETS] = np.minimum(255, np.round(8 * np.log2(1 + sizes))).astype(np.uint8)
    most = np.maximum(1, q[:, 2])
    out[:, BUCKETS + 1], out[:, BUCKETS + 2] = q[:, 0] * 15 // most, q[:, 1] * 15 // most
    return out


def digest(row: np.ndarray) -> str:
    """Hex text of a row of codes(): length, ratios, then two bits for each bucket."""
    body = row[:BUCKETS].reshape(-1, 4)
    packed = body[:, 0] | body[:, 1] << 2 | body[:, 2] << 4 | body[:, 3] << 6
    return bytes([row[BUCKETS], row[BUCKETS + 1] << 4 | row[BUCKETS + 2]]).hex() + packed.astype(np.uint8).tobytes().hex()


def digest_codes(text: str) -> np.ndarray:
    """The row of codes() that a digest was made of."""
    raw = np.frombuffer(bytes.fromhex(text), np.uint8)
    body = (raw[2:, None] >> np.array([0, 2, 4, 6], np.uint8)) & 3
    return np.concatenate([body.reshape(-1), [raw[0], raw[1] >> 4, raw[1] & 15]]).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal rows of codes, down to 0 at BOUND: one less the bounded difference score. Symmetric."""
    apart = np.abs(a.astype(np.int16) - b.astype(np.int16))
    body = apart[:, :BUCKETS]
    score = body.sum(axis=1) + 3 * (body == 3).sum(axis=1) + np.minimum(PART_BOUND, apart[:, BUCKETS:].sum(axis=1))
    return 1 - np.minimum(score, BOUND) / BOUND


def fingerprints(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """docs with a column fingerprint, which replaces one of that name. Null texts count as empty; texts of under three bytes
    differ by length only; texts of any length are taken whole; repeated rows all stay."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([digest(r) for r in codes(texts.tolist())], dtype=object)

    return docs.withColumn("fingerprint", of(text_of(text)))


def alike(a: str = "fingerprint", b: str = "other") -> Callable:
    """Column: likeness of two columns of digests; null where either is null."""

    @F.pandas_udf("double")
    def of(x: pd.Series, y: pd.Series) -> pd.Series:
        both = (x.notna() & y.notna()).to_numpy()
        out = np.full(len(x), np.nan)
        if both.any():
            out[both] = likeness(np.stack([digest_codes(t) for t in x[both]]), np.stack([digest_codes(t) for t in y[both]]))
        return pd.Series(out)

    return F.nullif(of(a, b), F.lit(float("nan")))


def with_next(docs: DataFrame, fn: Callable[[list, list[str], list[str]], pd.DataFrame], schema: str, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """fn(ids, texts, texts of the next documents) over all documents, in batches.

    The next document is the one with the next smaller key; the last one's is the first. Ties go by text; rows without
    key are the last. One shuffle deals ranges of keys to tasks. Each task gets, besides its own rows, a copy of the first
    row of the range below it, so neither the driver nor any task sees the whole order.
    """
    spark = docs.sparkSession
    ranged, bounds = by_ranges(docs.select(F.col(key), text_of(text).alias("text")), key)
    own = ranged.select("_range", "_key", F.col(key).cast("long").alias("key"), "text")
    tops = sorted((r[0], r[1]) for r in own.groupBy("_range").agg(F.max("_key")).collect())  # one row for each range
    if not tops:
        return spark.createDataFrame([], schema)
    above = dict(zip([k for _, k in tops], [r for r, _ in [*tops[1:], tops[0]]], strict=True))
    # A range's first row ends the range above it; the first of all ends the lowest one.
    tops_by_key = own.where(F.col("_key").isin(list(above))) if len(above) <= 400 else own.join(F.broadcast(spark.createDataFrame([(k,) for k in above], "_key long")), "_key", "left_semi").select(own.columns)
    firsts = tops_by_key.groupBy("_key").agg(F.max("text").alias("text"))
    lead = F.create_map(*[F.lit(x) for pair in above.items() for x in pair]) if len(above) <= 400 else None
    if lead is not None:
        heads = firsts.select(F.element_at(lead, F.col("_key")).alias("_range"), F.lit(None).cast("long").alias("_key"), F.lit(None).cast("long").alias("key"), "text", F.lit(1).alias("_head"))
    else:
        where = spark.createDataFrame(list(above.items()), "_key long, _range int")
        heads = firsts.join(F.broadcast(where), "_key").select("_range", F.lit(None).cast("long").alias("_key"), F.lit(None).cast("long").alias("key"), "text", F.lit(1).alias("_head"))
    rows = own.withColumn("_head", F.lit(0)).unionByName(heads)
    ordered = dealt_by(rows, len(bounds) + 1, "_range").sortWithinPartitions("_range", "_head", F.desc("_key"), F.desc("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for batch in batches:
            for s in pieces_of([len(t) for t in batch["text"]], 1_000_000):
                part = batch.iloc[s]
                ids, texts, heads = part["key"].tolist(), part["text"].tolist(), part["_head"].tolist()
                if last is not None:
                    ids, texts, heads = [last[0], *ids], [last[1], *texts], [last[2], *heads]
                last = (ids[-1], texts[-1], heads[-1])
                kept = [i for i in range(len(ids) - 1) if not heads[i]]
                if kept:
                    yield fn([None if pd.isna(ids[i]) else int(ids[i]) for i in kept], [texts[i] for i in kept], [texts[i + 1] for i in kept])

    return ordered.select("_range", "key", "text", "_head").mapInPandas(run, schema)


def audit(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Fingerprints of each text, of an edited copy, and how near both and the next document's are.

    The edited text is the text with its last floor(n / 2) of n code points replaced by the first as many (or all) of the
    next document's. Null texts count as empty, texts of any length are taken whole, repeated rows each give a row. Ties of
    ids are ordered by text. Other columns are not read, so their names cannot clash.
    """

    def compare(ids: list, texts: list[str], following: list[str]) -> pd.DataFrame:
        halves = [len(t) // 2 for t in texts]
        edited = [t[: len(t) - h] + x[:h] for t, x, h in zip(texts, following, halves, strict=True)]
        a, b = codes(texts), codes(edited)
        c = np.concatenate([a[1:], codes(following[-1:])]) if texts[1:] == following[:-1] else codes(following)
        return pd.DataFrame({
            "doc_id": pd.array(ids, "Int64"), "n_chars": [len(t) for t in texts],
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
            "fingerprint": [digest(r) for r in a], "edited_fingerprint": [digest(r) for r in b],
            "near_edited": likeness(a, b), "near_next": likeness(a, c),
        })

    columns = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs, compare, columns, text=text, key=key)

