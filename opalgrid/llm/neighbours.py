"""Approximate nearest neighbours by balanced posting lists.

Vectors are put into the lists of their nearest centroids, boundary vectors into several. Centroids are found by a
best-first walk over a graph of centroids in memory. A query reads the lists whose centroids are not much farther than
the nearest one; candidates are scored exactly, in double precision. Equal vectors are one entry, with as many of
their smallest ids as a result can hold, so a vector that a third of all rows share is no hot list.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opalgrid.llm.common import cut
from opalgrid.llm.fitting import fitted

#: Vectors that the centroids are fitted on; vectors of a list on the mean; least number of those vectors for a centroid.
MOST, LIST_SIZE, LEAST_EACH = 20_000, 96, 8
#: Lists a vector is put into at the most, and how much farther than the nearest they may be.
COPIES, BOUNDARY = 4, 1.12
#: How much farther than the nearest the lists that a query reads may be, whatever their number; centroids that a walk to
#: them looks at first.
RATIO, WIDTH = 1.35, 96
#: Vectors of one task: lists stand together on a shelf of so many, a longer list on several. Queries that it compares with them.
SHELF, SLICE = 32_768, 20_000
#: Neighbours of a centroid in the graph, and entry points of a walk.
DEGREE, ENTRIES = 24, 8


@dataclass
class Lists:
    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray

    def near(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The `width` nearest centroids of each unit vector that a walk finds, nearest first, and their distances."""
        n, lists = len(x), len(self.centroids)
        width = min(width, lists)
        ids = np.tile(self.entries, (n, 1))
        seen = np.zeros((n, lists), bool)
        rows = np.arange(n)
        seen[rows[:, None], ids] = True
        apart = 1 - x @ self.centroids[self.entries].T
        done = np.zeros(ids.shape, bool)
        while True:
            open_ = np.where(done, np.inf, apart)
            at = open_.argmin(axis=1)
            go = np.flatnonzero(np.isfinite(open_[rows, at]))
            if not len(go):
                break
            done[go, at[go]] = True
            around = self.graph[ids[go, at[go]]]
            new = ~seen[go[:, None], around]
            seen[go[:, None], around] = True
            far = 1 - np.einsum("nd,nkd->nk", x[go], self.centroids[around])
            more_ids, more_apart, more_done = np.zeros((n, around.shape[1]), np.int64), np.full((n, around.shape[1]), np.inf), np.ones((n, around.shape[1]), bool)
            more_ids[go], more_apart[go], more_done[go] = around, np.where(new, far, np.inf), ~new
            ids, apart, done = np.hstack([ids, more_ids]), np.hstack([apart, more_apart]), np.hstack([done, more_done])
            keep = np.argsort(apart, axis=1, kind="stable")[:, : max(width, self.entries.size)]
            ids, apart, done = (np.take_along_axis(v, keep, axis=1) for v in (ids, apart, done))
            done |= ~np.isfinite(apart)
        order = np.argsort(apart, axis=1, kind="stable")[:, :width]
        return np.take_along_axis(ids, order, axis=1), np.sqrt(np.maximum(2 * np.take_along_axis(apart, order, axis=1), 0))

    def within(self, x: np.ndarray, ratio: float, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of all lists up to `ratio` times as far as the nearest. A walk whose last centroid is still within
        the ratio is taken again, twice as wide."""
        rows, lists, todo = [], [], np.arange(len(x))
        while len(todo):
            ids, apart = self.near(x[todo], width)
            near = apart <= np.maximum(apart[:, :1], 1e-9) * ratio
            more = near[:, -1] & (ids.shape[1] < len(self.centroids))
            r, c = np.nonzero(near & ~more[:, None])
            rows.append(todo[r])
            lists.append(ids[r, c])
            todo, width = todo[more], 2 * width
        return (np.concatenate(rows), np.concatenate(lists)) if rows else (np.empty(0, np.int64), np.empty(0, np.int64))


def fit(rows: pd.DataFrame, lists: int, rounds: int = 8) -> Lists:
    """Balanced k-means over unit vectors: a centroid that holds more than its share seems farther away."""
    x = np.array(rows["unit"].tolist(), float) if len(rows) else np.zeros((1, 1))
    lists = max(1, min(lists, len(x)))
    rng = np.random.default_rng(7)
    c = x[rng.permutation(len(x))[:lists]].copy()
    share = np.zeros(lists)
    for _ in range(rounds):
        own = np.concatenate([(1 - x[i : i + 4096] @ c.T + share).argmin(axis=1) for i in range(0, len(x), 4096)])
        sizes = np.bincount(own, minlength=lists)
        share = 0.02 * np.clip(sizes * lists / len(x) - 1, -1, 4)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        empty = np.flatnonzero(sizes == 0)
        sums[empty] = x[rng.integers(0, len(x), len(empty))]
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    degree = min(DEGREE, lists)
    graph = np.concatenate([np.argpartition(1 - c[i : i + 2048] @ c.T, degree - 1, axis=1)[:, :degree] for i in range(0, lists, 2048)])
    return Lists(c, graph, np.unique(np.linspace(0, lists - 1, min(ENTRIES, lists)).astype(np.int64)))


def usable(rows: DataFrame, *, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """key and vector (array of doubles) of the rows that take part: with an id, no null, zero or non-finite vector, and
    as many components as most rows have (ties: more)."""
    v = F.col(vector).cast("array<double>")
    sound = F.size(v).cast("int") > 0
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    some = F.exists(v, lambda x: x != 0)
    good = rows.select(F.col(key).cast("long").alias(key), v.alias("vector")).where(F.col(key).isNotNull() & sound & finite & some & F.col("vector").isNotNull())
    sizes = good.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return good.where(F.size("vector") == (sizes[0]["d"] if sizes else 0))


def distinct(rows: DataFrame, most: int, *, key: str = "vec_id") -> DataFrame:
    """vector and ids: each different vector with its `most` smallest ids. Repeated ids count once."""
    order = Window.partitionBy("vector").orderBy(key)
    few = rows.withColumn("_k", F.dense_rank().over(order)).where(F.col("_k") <= most)
    return few.groupBy("vector").agg(F.sort_array(F.collect_set(key)).alias("ids"))


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # large and small numbers keep their squares
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def nearest(rows: DataFrame, is_query: str, k: int = 5, *, vector: str = "embedding", key: str = "vec_id", lists: int | None = None, ratio: float = RATIO) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found of each row that meets the SQL condition is_query.

    Nearness is the cosine of the original vectors; ties go to the smaller id. A row is no neighbour of itself. Rows that
    take no part (see usable) neither ask nor answer. A query whose lists hold fewer than k others reads all lists, so it
    gets k, or all there are. Repeated rows count once, and of several vectors
    with one id the least counts; other columns are not read.
    """
    spark = rows.sparkSession
    good = usable(rows, vector=vector, key=key)
    digest = F.xxhash64("vector")
    several = cut(good.groupBy(key).agg((F.min(digest) != F.max(digest)).alias("_s")).where("_s").select(key))
    if several.limit(1).count():
        least = good.join(several, key, "left_semi").groupBy(key).agg(F.min("vector").alias("vector"))
        good = good.join(several, key, "left_anti").select(key, "vector").unionByName(least)
    entries = cut(distinct(good, k + 1, key=key).withColumn("entry", F.element_at("ids", 1)))
    n = entries.count()
    asking = good.where(is_query).select(F.col(key).alias("query_id"), "vector").distinct()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    drawn = entries.select("entry", "vector").orderBy(F.xxhash64("entry")).limit(MOST)

    def learn(part: pd.DataFrame) -> Lists:
        units = _unit(np.array(part["vector"].tolist(), float))
        return fit(pd.DataFrame({"unit": list(units)}), lists or max(1, min(MOST // LEAST_EACH, n // LIST_SIZE)))

    index = spark.sparkContext.broadcast(fitted(drawn, learn))

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _listed(batches, index.value, COPIES, BOUNDARY)

    posted = entries.select("entry", "vector").mapInPandas(put, "list int, entry long, vector array<double>")
    wanted = cut(asking.join(entries.select("entry", F.col("vector").alias("v")), F.col("vector") == F.col("v")).select("query_id", "entry"))
    sizes = {r["list"]: r["count"] for r in posted.groupBy("list").count().collect()}  # one row for each list, of which the sample bounds the number
    shelf_of, many = shelves(sizes, len(index.value.centroids))
    rows_of = spark.createDataFrame([(i, int(shelf_of[i]), int(many[i])) for i in sizes], "list int, first int, many int")
    shelved = posted.join(F.broadcast(rows_of), "list").withColumn("shelf", F.col("first") + F.pmod(F.xxhash64("entry"), F.col("many")).cast("int")).drop("first", "many")

    def compare(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        """The k + 1 best of a shelf, and what ties with them, for each query: of all lists that it reads there at once."""
        out = []
        if len(q) and len(x):
            x = x.sort_values("list", kind="stable")
            b, ids = _unit(np.array(x["vector"].tolist(), float)), x["entry"].to_numpy(np.int64)
            lists, starts = np.unique(x["list"].to_numpy(), return_index=True)
            spans = dict(zip(lists.tolist(), zip(starts, [*starts[1:], len(x)], strict=True), strict=True))
            for i in range(0, len(q), 2000):
                part = q.iloc[i : i + 2000]
                a, entry = _unit(np.array(part["vector"].tolist(), float)), part["entry"].to_numpy(np.int64)
                reads = np.concatenate(part["lists"].tolist())
                reader = np.repeat(np.arange(len(part)), part["lists"].map(len))
                order = np.argsort(reads, kind="stable")
                ends = np.flatnonzero(np.diff(reads[order])) + 1
                found = []
                for own in np.split(order, ends):
                    begin, end = spans.get(int(reads[own[0]]), (0, 0))
                    if begin == end:
                        continue
                    s = a[reader[own]] @ b[begin:end].T
                    m = min(k + 1, end - begin)
                    r, c = np.nonzero(s >= np.partition(s, end - begin - m, axis=1)[:, [end - begin - m]] - 1e-12)  # ties stay
                    found.append((reader[own][r], ids[begin:end][c], s[r, c]))
                if found:
                    who, what, score = best(*map(np.concatenate, zip(*found, strict=True)), k + 1)
                    out.append(pd.DataFrame({"query": entry[who], "found": what, "score": score}))
        return pd.concat(out) if out else pd.DataFrame({"query": [], "found": [], "score": []})

    def found_by(wanted: DataFrame, ratio: float) -> DataFrame:
        """query_id, vec_id, score of the rows wanted (query_id, entry), from lists up to ratio times as far."""

        def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            yield from _read(batches, index.value, ratio, shelf_of, many)

        asked = entries.join(wanted.select("entry").distinct(), "entry", "left_semi").select("entry", "vector")
        slices = max(1, -(-asked.count() // SLICE))
        readers = asked.mapInPandas(ask, "shelf int, entry long, vector array<double>, lists array<int>").withColumn("slice", F.pmod(F.xxhash64("entry", F.lit(7)), F.lit(slices)).cast("int"))
        dealt = shelved.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        pairs = readers.groupBy("shelf", "slice").cogroup(dealt.groupBy("shelf", "slice")).applyInPandas(compare, "query long, found long, score double")
        once = pairs.groupBy("query", "found").agg(F.max("score").alias("score"))
        best = once.withColumn("_k", F.rank().over(Window.partitionBy("query").orderBy(F.desc("score")))).where(F.col("_k") <= k + 1)
        named = best.join(entries.select(F.col("entry").alias("found"), "ids"), "found").select("query", "score", F.explode("ids").alias("vec_id"))
        first = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        few = named.withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= k + 1).drop("_k")
        return cut(wanted.join(few, wanted["entry"] == few["query"]).where("query_id <> vec_id").select("query_id", "vec_id", "score"))

    results = found_by(wanted, ratio)
    enough = min(k, entries.agg(F.sum(F.size("ids"))).first()[0] - 1)
    short = wanted.join(results.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= enough), "query_id", "left_anti")
    short = cut(short)
    if short.limit(1).count():
        results = results.join(short, "query_id", "left_anti").unionByName(found_by(short, float("inf")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return results.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", F.least("score", F.lit(1.0)).alias("score"))


def shelves(sizes: dict[int, int], lists: int) -> tuple[np.ndarray, np.ndarray]:
    """The first shelf of each list, and on how many it stands: short ones share a shelf, a long one has several for itself."""
    first, many, at, held = np.zeros(lists, np.int32), np.ones(lists, np.int32), 0, 0
    for i, n in sorted(sizes.items()):
        if held and held + n > SHELF:
            at, held = at + 1, 0
        first[i], many[i] = at, max(1, -(-n // SHELF))
        if n > SHELF:
            at, held = at + int(many[i]), 0
        else:
            held += n
    return first, many


def best(query: np.ndarray, found: np.ndarray, score: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query the `most` best different ones found, and those that tie with the last."""
    order = np.lexsort((-score, found, query))
    once = np.ones(len(order), bool)
    once[1:] = (np.diff(query[order]) != 0) | (np.diff(found[order]) != 0)
    order = order[once]
    order = order[np.lexsort((-score[order], query[order]))]
    query, found, score = query[order], found[order], score[order]
    starts = np.flatnonzero(np.diff(query, prepend=-1))
    sizes = np.diff([*starts, len(query)])
    least = np.repeat(score[starts + np.minimum(sizes, most) - 1], sizes)
    keep = score >= least - 1e-12
    return query[keep], found[keep], score[keep]


def _read(batches: Iterator[pd.DataFrame], index: Lists, ratio: float, first: np.ndarray, many: np.ndarray) -> Iterator[pd.DataFrame]:
    """A row for each shelf that a vector reads, with the lists that it reads there: those up to ratio times as far as the
    nearest."""
    for batch in batches:
        for i in range(0, len(batch), 100):
            part = batch.iloc[i : i + 100]
            row, lists = index.within(_unit(np.array(part["vector"].tolist(), float)), ratio)
            n = many[lists]
            row, lists = np.repeat(row, n), np.repeat(lists, n)
            shelf = first[lists] + np.arange(len(lists)) - np.repeat(np.cumsum(n) - n, n)
            order = np.lexsort((lists, shelf, row))
            row, lists, shelf = row[order], lists[order].astype(np.int32), shelf[order].astype(np.int32)
            starts = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(shelf, prepend=-1) != 0))
            at = row[starts]
            yield pd.DataFrame({"shelf": shelf[starts], "entry": part["entry"].to_numpy(np.int64)[at], "vector": part["vector"].iloc[at].tolist(), "lists": np.split(lists, starts[1:]) if len(starts) else []})


def _listed(batches: Iterator[pd.DataFrame], index: Lists, most: int, ratio: float) -> Iterator[pd.DataFrame]:
    """A row for each list of each vector: the nearest one, and others (`most` in all) up to `ratio` times as far."""
    for batch in batches:
        for i in range(0, len(batch), 1000):
            part = batch.iloc[i : i + 1000]
            ids, apart = index.near(_unit(np.array(part["vector"].tolist(), float)), most)
            row, column = np.nonzero(apart <= np.maximum(apart[:, :1] * ratio, 1e-9))
            found = ids[row, column]
            yield pd.DataFrame({"list": found.astype(np.int32), "entry": part["entry"].to_numpy(np.int64)[row], "vector": part["vector"].iloc[row].tolist()})
