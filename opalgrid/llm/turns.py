"""Conversations from rows of turns: whole ones that fit a bound, and long ones in segments.

Rows are sorted by conversation and turn over ranges, so a conversation of any length spreads over many tasks. A task reads
its range as a stream. A conversation that lies within the range is made whole there, without another shuffle; what the
ends of a range cut, at most two for each task, meets in a second step, and is made whole if it fits the bound. A longer
one stays in segments of the bound each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opalgrid.llm.common import claim, stored

#: Characters and rows of a conversation, or of a segment of one, that are held at once.
CHARS, ROWS = 4_000_000, 50_000

PARTS = "conv long, whole boolean, part int, seq int, size long, n long, turn array<long>, role array<string>, text array<string>, live array<boolean>"
LISTS = ("turn", "role", "text", "live")


def rows_of(table: DataFrame, *, null: str = "", conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text of a table; a null role or text is the string `null`."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(null)).alias
    return table.select(F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), said(role)("role"), said(text)("text"))


def gathered(rows: DataFrame, *, chars: int = CHARS, most: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """(whole, parts) of rows (conv, turn, role, text, live): a row for each conversation within the bounds with its turns as
    arrays in order, and segments (conv, part, seq ascending) of the longer ones.

    The order is by turn, null first, then by role, by the digest of the text, and by the place where it was read. live
    marks rows that count; others only say that the conversation exists.
    """
    order = ["conv", "turn", "_role", "_tie", "_at"]
    keyed = rows.withColumns({"_role": F.substring("role", 1, 16), "_tie": F.xxhash64("role", "text"), "_at": F.monotonically_increasing_id()})
    sorted_ = keyed.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
    known = sorted_.select(F.coalesce("conv", F.lit(0)).alias("conv"), F.col("conv").isNotNull().alias("named"), F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNotNull().alias("timed"), "role", "text", "live")

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("turns")
        part = TaskContext.get().partitionId()
        held: dict[str, list] = {c: [] for c in LISTS}
        last: tuple | None = None
        size = seq = 0
        inner = False  # whether the conversation begins within this range

        made: list[tuple] = []  # rows of PARTS, handed on together

        def close(whole: bool) -> None:
            nonlocal held, size, seq
            made.append((last[0] if last[1] else None, whole, part, seq, size, len(held["turn"]), *held.values()))
            held, size, seq = {c: [] for c in LISTS}, 0, seq + 1

        def frame_of(rows: list[tuple]) -> pd.DataFrame:
            columns = dict(zip([c.split()[0] for c in PARTS.split(", ")], zip(*rows, strict=True), strict=True))
            return pd.DataFrame({**columns, "conv": pd.array(columns["conv"], "Int64")})

        for frame in frames:
            turns = [t if timed else None for t, timed in zip(frame["turn"].tolist(), frame["timed"].tolist(), strict=True)]
            for c, named, turn, role, text, live_ in zip(frame["conv"].tolist(), frame["named"].tolist(), turns, frame["role"], frame["text"], frame["live"].tolist(), strict=True):
                if last != (c, named):
                    if last is not None:
                        close(inner and not seq)
                        inner = True
                    last, seq = (c, named), 0
                elif held["turn"] and (size + len(text) > chars or len(held["turn"]) >= most):
                    close(False)
                held["turn"].append(turn)
                held["role"].append(role)
                held["text"].append(text)
                held["live"].append(live_)
                size += len(text) + len(role)
            if sum(r[4] for r in made) > chars or len(made) >= 1000:
                yield frame_of(made)
                made.clear()
        if last is not None:
            close(False)
            yield frame_of(made)

    made = stored(known.mapInPandas(gather, PARTS), "turns")
    cut_ = made.where(~F.col("whole"))
    sums = cut_.groupBy(F.col("conv").alias("_conv")).agg(F.sum("size").alias("_size"), F.sum("n").alias("_n"))
    fits = (F.col("_size") <= chars) & (F.col("_n") <= most)
    pieces = cut_.join(sums, F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv")
    joined = pieces.where(fits).groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "seq", *LISTS))).alias("_s"))
    whole = made.where("whole").select("conv", *LISTS).unionByName(joined.select("conv", *[F.flatten(F.col(f"_s.{c}")).alias(c) for c in LISTS]))
    return whole, pieces.where(~fits).select("conv", "part", "seq", *LISTS)
