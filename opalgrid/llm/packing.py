"""Best-fit packing of tokenised documents into sequences of a fixed length.

Best-fit decreasing looks at lengths only, and there are at most `capacity` different ones. So the sequences are planned
once over the histogram of lengths: pieces of equal length that go into sequences with equal room are placed together, as
one interval. The tightest open room is found by a segment tree over the possible remaining capacities. The plan has some
thousand rows whatever the size of the corpus; each piece finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opalgrid.llm.common import cut, pieces_of, ranked, text_of
from opalgrid.llm.wordcache import WORDS, encoder

CAPACITY = 4096
END_ID = 1
#: Characters that are encoded together.
CHARACTERS = 250_000


class RoomTree:
    """Segment tree over the rooms 0..capacity, of which some are open; finds the tightest open one in logarithmic time."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.size)

    def mark(self, room: int, is_open: bool) -> None:
        i = room + self.size
        self.any[i] = is_open
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest open room that is `least` or more."""
        i = least + self.size
        if self.any[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over a histogram of lengths: rows (length, first rank, ranks, first sequence, offset).

    Pieces of one length with ranks from `first rank` on go, one each, into consecutive sequences from `first sequence`
    on, at `offset`. Lengths of zero and less, or over the capacity, are an error.
    """
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError("a length must lie between 1 and the capacity")
    tree = RoomTree(capacity)
    rooms: dict[int, deque[tuple[int, int]]] = {}
    out, sequences = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if not rooms.setdefault(room, deque()):
                tree.mark(room, True)
            rooms[room].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            # Once a sequence holds a piece of this length it is the tightest that takes another: each is filled in turn.
            room = tree.tightest(length)
            if room is None:
                room, first, open_ = capacity, sequences, left
            else:
                first, open_ = rooms[room].popleft()
                if not rooms[room]:
                    tree.mark(room, False)
            deep = room // length
            for n, each in ((min(open_, left // deep), deep), (1, left % deep)):
                if not each or not n or not open_:
                    continue
                for k in range(each):
                    out.append((length, rank, n, first, capacity - room + k * length))
                    rank += n
                put(room - each * length, first, n)
                first, open_, left = first + n, open_ - n, left - n * each
            if first > sequences:
                sequences = first
            elif open_:
                put(room, first, open_)
    return out


def pieces(docs: DataFrame, path: str, *, text: str = "text", key: str = "doc_id", end_id: int = END_ID, capacity: int = CAPACITY, words: int = WORDS) -> DataFrame:
    """Tokenised pieces of whole documents: key, piece, start, length, ids (little-endian unsigned 32-bit), ids_crc32.

    Null texts count as empty; an empty document is one piece, the end id. Documents over the capacity are cut into
    pieces of `capacity` ids, of which the last may be shorter. Other columns are left out.
    """

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path, blanks_matter=False, words=words)
        for batch in batches:
            texts = batch["text"].tolist()
            for s in pieces_of([len(t) for t in texts], CHARACTERS):
                flat, sizes = encode(texts[s])
                rows, begin = [], 0
                for doc, n in zip(batch["key"].iloc[s], sizes, strict=True):
                    ids = np.append(flat[begin : begin + n], end_id).astype("<u4")
                    begin += n
                    for k, at in enumerate(range(0, len(ids), capacity)):
                        one = ids[at : at + capacity].tobytes()
                        rows.append((doc, k, at, len(one) // 4, one, zlib.crc32(one)))
                yield pd.DataFrame(rows, columns=["key", "piece", "start", "length", "ids", "ids_crc32"])

    rows = docs.select(F.col(key).cast("long").alias("key"), text_of(text).alias("text"))
    out = rows.mapInPandas(cut_up, "key long, piece int, start long, length long, ids binary, ids_crc32 long")
    return out.withColumnRenamed("key", key)


def best_fit(pieces: DataFrame, *, key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset: the sequence that each is placed in, and where there.

    Needs the columns key, piece and length and keeps all others. Pieces without a length, or of zero, get no place
    (null). Repeated rows each get a place of their own. Call it on a stored table: pieces is read twice.
    """
    spark = pieces.sparkSession
    sizes = {r["length"]: r["n"] for r in pieces.where("length > 0").groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = plan(sizes, capacity) or [(0, 0, 0, 0, 0)]
    # An Arrow table goes to the JVM as it is; a list of rows goes through Python processes of its own on the executors.
    names = ["length", "first_rank", "ranks", "first_sequence", "offset"]
    placed = spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names))
    steps = placed.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("first_rank", "first_sequence", "offset"))).alias("steps"))
    salts = max(16, sum(sizes.values()) // 20_000)
    sized = pieces.withColumn("_length", F.coalesce("length", F.lit(0)))  # a null is no key to join on
    numbered = ranked(sized, ["_length"], [F.col(key), F.col("piece")], "_rank", salts)
    # At most `capacity` rows, by the check in plan().
    found = numbered.join(F.broadcast(steps.withColumnRenamed("length", "_length")), "_length", "left")
    step = F.element_at(F.filter("steps", lambda s: s["first_rank"] <= F.col("_rank")), -1)
    return found.withColumn("_step", step).withColumns(
        {"sequence_id": F.col("_step.first_sequence") + F.col("_rank") - F.col("_step.first_rank"), "offset": F.col("_step.offset")}
    ).drop("_step", "steps", "_rank", "_length")


def pack(docs: DataFrame, path: str, *, text: str = "text", key: str = "doc_id", end_id: int = END_ID, capacity: int = CAPACITY, words: int = WORDS) -> DataFrame:
    """Places of all pieces of the documents, without their ids: key, piece, start, length, ids_crc32, sequence_id, offset.
    words: how many a worker keeps the ids of."""
    return best_fit(cut(pieces(docs, path, text=text, key=key, end_id=end_id, capacity=capacity, words=words).drop("ids")), key=key, capacity=capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """Whole sequences from placed pieces that still hold ids: sequence_id, length, ids in order of their offsets."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda done, x: F.concat(done, x["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
