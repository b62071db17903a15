"""Token files: ids ranked by frequency, in byte-aligned codes of one to four bytes with separate control bytes.

A file holds consecutive documents in ascending order of their ids and stands alone:

    magic "OGT1" | u32 documents | u32 distinct ids | u64 ids | u64 data bytes
    i64 document id, u32 number of ids, u8 1 if the document has no id -- each as one array over the documents
    u32 distinct ids, most frequent first
    control bytes: two bits for each id, four ids a byte, lowest bits first: bytes of its rank, less one
    data bytes: the ranks, little-endian

Ranks are counted over all ids of the file. Decoding looks each control byte up in a table of four sizes.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opalgrid.llm.common import by_ranges, dealt_by, pieces_of, text_of
from opalgrid.llm.wordcache import encoder

MAGIC = b"OGT1"
HEAD = struct.Struct("<4sIIQQ")
#: Ids after which a file is closed.
IDS_EACH = 4_000_000
#: Sizes of the four codes that a control byte describes.
SIZES = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + np.uint8(1)


def encoded(doc_ids: np.ndarray, missing: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """One file. ids: all documents' ids, one after the other; sizes: how many each document has."""
    ids = np.asarray(ids, np.int64)
    counts = np.bincount(ids, minlength=1)
    order = np.argsort(-counts, kind="stable")
    order = order[: np.count_nonzero(counts)]
    rank = np.zeros(len(counts), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    ranks = rank[ids]
    widths = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    padded = np.zeros(-(-len(ids) // 4) * 4, np.uint8)
    padded[: len(ids)] = widths - 1
    control = padded[::4] | padded[1::4] << 2 | padded[2::4] << 4 | padded[3::4] << 6
    ends = np.cumsum(widths, dtype=np.int64)
    starts = ends - widths
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    data[starts] = ranks & np.uint32(0xFF)
    for k in range(1, int(widths.max(initial=0))):
        has = np.flatnonzero(widths > k)
        data[starts[has] + k] = (ranks[has] >> np.uint32(8 * k)) & np.uint32(0xFF)
    head = HEAD.pack(MAGIC, len(doc_ids), len(order), len(ids), len(data))
    return b"".join([head, doc_ids.astype("<i8").tobytes(), sizes.astype("<u4").tobytes(), missing.astype("u1").tobytes(), order.astype("<u4").tobytes(), control.tobytes(), data.tobytes()])


def decoded(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, flags of missing ids, numbers of ids, and all ids of a file."""
    magic, docs, distinct, n, size = HEAD.unpack_from(blob)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = HEAD.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(blob, kind, count, at)
        at += out.nbytes
        return out

    doc_ids, sizes, missing, order = take("<i8", docs), take("<u4", docs), take("u1", docs), take("<u4", distinct)
    widths = SIZES[take("u1", -(-n // 4))].reshape(-1)[:n]
    data = take("u1", size)
    ends = np.cumsum(widths, dtype=np.int64)
    starts = ends - widths
    ranks = data[starts].astype(np.uint32)
    for k in range(1, int(widths.max(initial=0))):
        has = np.flatnonzero(widths > k)
        ranks[has] |= data[starts[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return doc_ids, missing.astype(bool), sizes.astype(np.int64), order[ranks] if n else np.empty(0, np.uint32)


def put(folder: str, name: str, blob: bytes) -> None:
    """Writes a file under a name of its own first, so that a task that runs twice leaves a whole file."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    part = f"{path}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        out.write(blob)
    store.move(part, f"{path}/{name}")


def tokens(docs: DataFrame, path: str, *, text: str = "text", key: str = "doc_id", end_id: int = 2) -> DataFrame:
    """key, n, ids: the ids of each whole text and the end id, as little-endian 16-bit numbers where the vocabulary allows."""

    def encode_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path, blanks_matter=True)
        for batch in batches:
            texts = batch["text"].tolist()
            for s in pieces_of([len(t) for t in texts], 2_000_000):
                flat, sizes = encode(texts[s])
                ends = np.cumsum(sizes) + np.arange(1, len(sizes) + 1)
                ids = np.full(len(flat) + len(sizes), end_id, np.int32)
                ids[np.delete(np.arange(len(ids)), ends - 1)] = flat
                wide = len(ids) and ids.max() > 0xFFFF
                raw, w = (ids.astype("<u4").tobytes(), 4) if wide else (ids.astype("<u2").tobytes(), 2)
                cuts = [0, *(ends * w).tolist()]
                rest = batch.iloc[s].drop(columns="text")
                yield rest.assign(n=sizes + 1, ids=[raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)])

    rows = docs.select(*[c for c in docs.columns if c.startswith("_")], F.col(key).cast("long").alias("key"), text_of(text).alias("text"))
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInPandas(encode_all, f"{kept}, n long, ids binary")


def write(docs: DataFrame, folder: str, path: str, *, text: str = "text", key: str = "doc_id", end_id: int = 2, ids_each: int = IDS_EACH) -> DataFrame:
    """Writes token files of all documents into folder, in ascending order of key; returns a row for each file.

    Null texts count as empty, rows without key come first, repeated rows are all kept. Rows of one key are ordered by
    their ids. One shuffle, of compact ids, brings each range of keys to one task, which closes a file at `ids_each` ids;
    so no task holds more than one file's ids. File names are made from the range and a counter, so a task that is run
    again replaces its own files.
    """
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(folder)
    store.create_dir(place, recursive=True)
    ranged, bounds = by_ranges(docs, key)
    n = len(bounds) + 1
    rows = dealt_by(tokens(ranged.select("_range", "_key", key, text), path, text=text, key=key, end_id=end_id), n, "_range")

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_range, k, held, kept = None, 0, [], 0

        def close() -> pd.DataFrame:
            nonlocal k, held, kept
            rows = pd.concat(held)
            raw = [np.frombuffer(b, "<u2" if 2 * m == len(b) else "<u4") for b, m in zip(rows["ids"], rows["n"], strict=True)]
            name = f"part-{open_range:08d}-{k:06d}.ogt"
            key_of = rows["_key"].to_numpy(np.int64)
            blob = encoded(key_of, rows["key"].isna().to_numpy(), rows["n"].to_numpy(np.int64), np.concatenate(raw))
            put(folder, name, blob)
            out = pd.DataFrame({"file": [name], "documents": [len(rows)], "ids": [int(rows["n"].sum())], "bytes": [len(blob)]})
            k, held, kept = k + 1, [], 0
            return out

        for batch in batches:
            for r, part in batch.groupby("_range", sort=True):
                if open_range is not None and r != open_range:
                    if held:
                        yield close()
                    k = 0
                open_range = r
                for s in pieces_of(part["n"].tolist(), ids_each):
                    if held and kept + int(part["n"].iloc[s].sum()) > ids_each:
                        yield close()
                    held.append(part.iloc[s])
                    kept += int(part["n"].iloc[s].sum())
        if held:
            yield close()

    # Each document has an end id, so n is never 0 and tells the width of its ids.
    ordered = rows.sortWithinPartitions("_range", "_key", "ids")
    return ordered.mapInPandas(save, "file string, documents long, ids long, bytes long")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of all token files in folder: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit), file.

    start counts the ids of all documents before, over all files in order. An empty folder gives no rows.
    """

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, blob in zip(batch["file"], batch["content"], strict=True):
                doc_ids, missing, sizes, ids = decoded(blob)
                ends = np.cumsum(sizes)
                raw = ids.astype("<u4").tobytes()
                for s in pieces_of(sizes.tolist(), 500_000):
                    yield pd.DataFrame({
                        "file": file, "doc_id": pd.array(np.where(missing[s], 0, doc_ids[s]), "Int64").copy(), "at": (ends - sizes)[s], "n_tokens": sizes[s],
                        "ids": [raw[4 * (e - m) : 4 * e] for e, m in zip(ends[s].tolist(), sizes[s].tolist(), strict=True)], "_none": missing[s],
                    })

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.ogt").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    rows = named.mapInPandas(decode, "file string, doc_id long, at long, n_tokens long, ids binary, _none boolean")
    return rows.withColumn("doc_id", F.when(~F.col("_none"), F.col("doc_id"))).drop("_none")


def with_starts(rows: DataFrame, files: DataFrame) -> DataFrame:
    """rows of read() with start, from the numbers of ids of the files (the rows of write(), one for each file)."""
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    firsts = files.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("_first"))
    return rows.join(firsts, "file").withColumn("start", F.col("_first") + F.col("at")).drop("_first", "at")
