"""Importance resampling towards a target: documents are drawn by how much more the target uses their features.

1. Features (runs of words) are hashed to buckets; two histograms, of the corpus and of the target, are summed up task by
   task and then by bucket. A bucket's gain is the logarithm of the ratio of both shares, in thousandths.
2. A task scores a batch of texts at once: words are found by classes of bytes, their CRC32 goes column by column over all
   words of the batch, and gains are looked up and summed by document.
3. Gumbel noise, fixed by seed and id, turns the highest scores into a draw without replacement.
4. Scores are ranked by a distributed LSD radix sort. Records travel in blocks, one row each. A pass over a digit counts it
   in each block; sums over blocks give each (digit, block) the place of its first record; a block deals its records out by
   place, stably, and each block of places puts them where they belong. No key is compared, and no range is sampled.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opalgrid.llm.common import claim, cut, pieces_of, text_of

BUCKETS, WORDS, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024
#: Bytes of text that are worked on at once.
BATCH = 4_000_000
#: Bits of a digit, and records of a block.
BITS, BLOCK = 12, 1 << 18
#: A record: what is sorted by, what decides ties (ids from 1, 0 for none), and what goes along.
RECORD = np.dtype([("high", "<u8"), ("low", "<u8"), ("n_features", "<i8"), ("weight", "<i8"), ("score", "<i8")])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, t >> np.uint32(1) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


_CRC = _crc_table()


def _extended(state: np.ndarray, b: np.ndarray, starts: np.ndarray, sizes: np.ndarray, narrow: int = 32) -> np.ndarray:
    """The CRC registers after the bytes b[start : start + size] of each row; rows of over `narrow` bytes one by one."""
    state, clipped = state.copy(), np.minimum(sizes, narrow + 1)
    order = np.argsort(-clipped, kind="stable")
    shorter = -clipped[order]
    first = int(np.searchsorted(shorter, -narrow, side="left"))
    for i in order[:first].tolist():
        state[i] = ~np.uint32(zlib.crc32(b[starts[i] : starts[i] + sizes[i]].tobytes(), int(~state[i])))
    own, at = state[order[first:]], starts[order[first:]]
    for k in range(int(-shorter[first]) if first < len(order) else 0):
        n = int(np.searchsorted(shorter[first:], -k, side="left"))  # rows with more than k bytes
        own[:n] = _CRC[(own[:n] ^ b[at[:n] + k]) & np.uint32(0xFF)] ^ own[:n] >> np.uint32(8)
    state[order[first:]] = own
    return state


def features(texts: Sequence[str], words: int = WORDS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets of all features of the texts, the text that each belongs to, and the number of words of each text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    stops = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
    b = _LOWER[np.frombuffer(b"\n".join([*raw, b""]), np.uint8)]
    inside = _INSIDE[b]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(stops, starts, side="right")
    state, n = np.full(len(starts), np.uint32(0xFFFFFFFF)), len(starts)
    found, owners = [], []
    for k in range(words):
        if k:  # one more word, after a space, where the text has one
            inner = np.flatnonzero(owner[: n - k] == owner[k:]) if n > k else np.empty(0, np.int64)
            keep = np.full(n, np.uint32(0))
            space = _CRC[(state[inner] ^ np.uint32(32)) & np.uint32(0xFF)] ^ state[inner] >> np.uint32(8)
            keep[inner] = _extended(space, b, starts[inner + k], (ends - starts)[inner + k])
            state, at = keep, inner
        else:
            state, at = _extended(state, b, starts, ends - starts), np.arange(n)
        found.append((~state[at]).astype(np.int64) % buckets)
        owners.append(owner[at])
    return np.concatenate(found), np.concatenate(owners), np.bincount(owner, minlength=len(raw))


def histogram(docs: DataFrame, *, text: str = "text", words: int = WORDS, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: how often the whole texts hold a feature of each bucket. Buckets without are absent."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("features")
        total = np.zeros(buckets, np.int64)
        for frame in frames:
            for s in pieces_of(list(map(len, frame["_text"])), BATCH):
                total += np.bincount(features(frame["_text"].iloc[s].tolist(), words, buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    return docs.select(text_of(text).alias("_text")).mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket, from two histograms; they hold at most a row for each bucket."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for into, rows in ((s, corpus), (t, target)):
        for bucket, n in rows.collect():
            into[bucket] = n
    S, T = int(s.sum()) + buckets, int(t.sum()) + buckets
    return np.array([math.floor(1000 * math.log((b + 1.0) * S / ((a + 1.0) * T))) for a, b in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def noise(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, fixed by seed and id; the id of a row without one is empty."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weighed(docs: DataFrame, gain: np.ndarray, *, text: str = "text", key: str = "doc_id", words: int = WORDS) -> DataFrame:
    """doc_id, n_features, n_words, weight of each document. gain goes to the tasks: a number for each bucket."""
    buckets = len(gain)

    @F.pandas_udf("struct<n_features: long, n_words: long, weight: long>")
    def weigh(texts: pd.Series) -> pd.DataFrame:
        claim("features")
        out = []
        for s in pieces_of(list(map(len, texts)), BATCH):
            part = texts.iloc[s].tolist()
            found, owner, n_words = features(part, words, buckets)
            sums = np.concatenate([[0], np.cumsum(gain[found[np.argsort(owner, kind="stable")]])])
            n = np.bincount(owner, minlength=len(part))
            ends = np.cumsum(n)
            out.append(np.stack([n, n_words, sums[ends] - sums[ends - n]], axis=1))
        return pd.DataFrame(np.concatenate([np.empty((0, 3), np.int64), *out]), columns=["n_features", "n_words", "weight"])

    return docs.select(F.col(key).cast("long").alias(key), weigh(text_of(text)).alias("_w")).select(key, "_w.*")


def _packed(rows: DataFrame, low: int, high: int, block: int) -> DataFrame:
    """block, records: rows (id, n_features, weight, score) in blocks, each with its key: how far its score lies under the
    highest, then its id."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, held, made = [], 0, 0

        def close() -> pd.DataFrame:
            nonlocal kept, held, made
            records, kept, held, made = np.concatenate(kept), [], 0, made + 1
            return pd.DataFrame({"block": [(TaskContext.get().partitionId() << 32) + made], "records": [records.tobytes()]})

        for frame in frames:
            out = np.zeros(len(frame), RECORD)
            for c in ("n_features", "weight", "score"):
                out[c] = frame[c].to_numpy()
            out["high"] = (high - out["score"]).astype(np.uint64)
            out["low"] = np.where(frame["known"], frame["id"].to_numpy().astype(np.uint64) - np.uint64(low % 2**64) + np.uint64(1), np.uint64(0))
            kept.append(out)
            held += len(out)
            if held >= block:
                yield close()
        if held:
            yield close()

    known = rows.select(F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNotNull().alias("known"), "n_features", "weight", "score")
    return known.mapInPandas(pack, "block long, records binary")


def _digit(records: np.ndarray, field: str, shift: int, bits: int) -> np.ndarray:
    return (records[field] >> np.uint64(shift) & np.uint64((1 << bits) - 1)).astype(np.int64)


def _pass(blocks: DataFrame, field: str, shift: int, block: int, bits: int) -> DataFrame:
    """blocks after one stable counting sort by a digit; they are numbered by place, from 0, and full but for the last."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, raw in zip(frame["block"], frame["records"], strict=True):
                n = np.bincount(_digit(np.frombuffer(raw, RECORD), field, shift, bits))
                digits = np.flatnonzero(n)
                yield pd.DataFrame({"block": name, "digit": digits, "n": n[digits]})

    counts = cut(blocks.mapInPandas(count, "block long, digit long, n long"))
    totals = np.zeros((1 << bits) + 1, np.int64)  # a number for each value of a digit
    for digit, n in counts.groupBy("digit").agg(F.sum("n")).collect():
        totals[digit + 1] = n
    first = np.cumsum(totals)
    before = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("place", F.coalesce(F.sum("n").over(before), F.lit(0)))
    places = starts.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("digit", "place"))).alias("_p")).select("block", F.col("_p.digit").alias("digits"), F.col("_p.place").alias("places"))

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for raw, digits, starts in zip(frame["records"], frame["digits"], frame["places"], strict=True):
                records = np.frombuffer(raw, RECORD)
                digit = _digit(records, field, shift, bits)
                order = np.argsort(digit.astype(np.uint16), kind="stable")
                n = np.bincount(digit)[np.asarray(digits)]
                place = np.repeat(first[np.asarray(digits)] + np.asarray(starts) - (np.cumsum(n) - n), n) + np.arange(len(records))
                to = place // block
                moved = np.argsort(to, kind="stable")
                own, begin = np.unique(to[moved], return_index=True)
                for k, at in zip(own.tolist(), np.split(moved, begin[1:]), strict=True):
                    yield pd.DataFrame({"block": [k], "places": [(place[at] - k * block).astype("<u4").tobytes()], "records": [records[order[at]].tobytes()]})

    def gather(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        at = np.concatenate([np.frombuffer(p, "<u4") for p in rows["places"]])
        out = np.empty(len(at), RECORD)
        out[at] = np.concatenate([np.frombuffer(r, RECORD) for r in rows["records"]])
        return pd.DataFrame({"block": [key[0]], "records": [out.tobytes()]})

    dealt = blocks.join(places, "block").mapInPandas(deal, "block long, places binary, records binary")
    return cut(dealt.groupBy("block").applyInPandas(gather, "block long, records binary"))


def ranked(rows: DataFrame, drawn: int, *, key: str = "doc_id", block: int = BLOCK, bits: int = BITS) -> DataFrame:
    """key, n_features, weight, score, rank of rows with the first four: 1, 2, 3, ... by falling score, ties to the smaller
    id (rows without one first), null after the first `drawn`. Equal rows take one rank each."""
    ends = rows.agg(F.min(key), F.max(key), F.min("score"), F.max("score")).first()
    schema = f"`{key}` long, n_features long, weight long, score long, rank long"
    if ends[2] is None:
        return rows.select(key, "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    low, spread = ends[0] or 0, (ends[1] or 0) - (ends[0] or 0) + 1
    blocks = cut(_packed(rows.withColumnRenamed(key, "id"), low, ends[3], block))
    for field, most in (("low", spread), ("high", ends[3] - ends[2])):
        for shift in range(0, max(1, int(most).bit_length()), bits):
            blocks = _pass(blocks, field, shift, block, bits)

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k, raw in zip(frame["block"], frame["records"], strict=True):
                r = np.frombuffer(raw, RECORD)
                rank = k * block + 1 + np.arange(len(r))
                ids = pd.array(r["low"].astype(np.int64) + np.int64(low) - np.int64(1), "Int64")
                ids[r["low"] == 0] = pd.NA
                ranks = pd.array(rank, "Int64")
                ranks[rank > drawn] = pd.NA
                yield pd.DataFrame({key: ids, "n_features": r["n_features"], "weight": r["weight"], "score": r["score"], "rank": ranks})

    return blocks.mapInPandas(unpack, schema)


def resampled(docs: DataFrame, target: DataFrame, *, text: str = "text", key: str = "doc_id", words: int = WORDS, buckets: int = BUCKETS, least: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """key, n_features, weight, score, rank: a row for each row of docs. Of the N documents with at least `least` words,
    floor(percent * N / 100) are drawn, those of highest score; the rank of others is null.

    Null texts, and texts without words, have no features and weigh 0. An empty target leaves every bucket's share the same,
    an empty corpus gives no rows. Repeated rows count, and are drawn, each for itself; ties go to the smaller id, rows
    without id before others, and their noise is that of an empty id. Texts of any length are taken whole. Only key and text
    are read, so other columns cannot clash.
    """
    gain = gains(histogram(docs, text=text, words=words, buckets=buckets), histogram(target, text=text, words=words, buckets=buckets), buckets)
    rows = weighed(docs, gain, text=text, key=key, words=words).withColumn("score", F.col("weight") + noise(F.col(key), seed))
    rows = cut(rows)
    able = rows.where(F.col("n_words") >= least).drop("n_words")
    drawn = percent * able.count() // 100
    rest = rows.where(F.col("n_words") < least).select(key, "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return ranked(able, drawn, key=key).unionByName(rest)
