"""Near duplicates: improved consistent weighted sampling over TF-IDF shingles, banded and verified.

1. Equal texts become one node. Different texts travel in batches of some megabytes. Each batch asks, for each of its
   distinct shingles of five words, how many texts hold it; the questions are dealt by hash, so each count is exact and
   no task holds more than its share of the hashes.
2. With the answers each text gets consistent weighted samples, in bands; one that holds a common shingle gets more bands
   of samples by counts alone. Nodes that agree on a whole band share a bucket.
3. Each node of a bucket is compared with the bucket's centre, the node that has most company. A pair is a link if the
   weighted Jaccard similarity of its TF-IDF shingles reaches the threshold, or that of their plain counts does.
4. Links that no centre shows are looked for where a bucket still holds nodes of different classes. The search among its
   nodes is exact: a pair can only reach the threshold if it shares one of the rarest shingles of both, and only if what is
   left of both from the first such shingle on would be enough, as would what it shares with what is left after it. Each pair of nodes of different classes that passes
   is compared. Pairs are taken by slices of their hashes, and after each slice classes are merged, so that pairs whose ends
   meet in one class meanwhile need no comparison; at the end each pair is either decided or within a class.
5. Classes are the connected components of the links, found by label propagation over tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opalgrid.llm.common import NO_ID, Rows, all_shingles, claim, cut, forgotten, give_back, mixed, partitions, pieces_of, stored, text_of

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 12, 4
#: Slices of pairs' hashes; pairs of holders of a shingle that the first slices have for each node; holders that a task has
#: on one side; what sums of doubles may be off by.
SLICES, EACH, HOLDERS, SLACK = 4096, 1000, 2000, 1e-9
#: Nodes whose ids are broadcast (16 bytes each); more are joined.
SMALL = 250_000
#: Bytes of text of a batch, and hashes that one task counts.
BATCH, COUNTED = 2_000_000, 500_000
#: A shingle is common if it weighs less than the rarest does by this factor. A pair without common shingles that is alike
#: by counts (0.8) is still alike by weights (0.76), which the first bands find.
LIGHT = 1.25
#: Bits that hashes of shingles lose, so that they take less room: 56 are left.
SHIFT = np.uint64(8)

Set = tuple[np.ndarray, np.ndarray]


def squeezed(x: np.ndarray) -> bytes:
    """A 64-bit array, its bytes by place and then compressed."""
    raw = np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(x).to_bytes(4, "little") + pa.compress(raw, "zstd", asbytes=True) if len(x) else b""


def restored(b: bytes) -> np.ndarray:
    if not b:
        return np.empty(0, np.uint64)
    n = int.from_bytes(b[:4], "little")
    raw = pa.decompress(b[4:], 8 * n, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view(np.uint64).reshape(-1)


def squeezed_set(h: np.ndarray) -> bytes:
    return squeezed(np.diff(h, prepend=np.uint64(0)))


def restored_set(b: bytes) -> np.ndarray:
    return np.cumsum(restored(b), dtype=np.uint64)


def sets(texts: Sequence[str], words: int = WORDS) -> Iterator[Set]:
    """For each text its shingles' hashes, ascending, and their counts."""
    for h, n in all_shingles(texts, words):
        yield h >> SHIFT, n


def _texts(docs: DataFrame, text: str, key: str) -> DataFrame:
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("_key"), text_of(text).alias("_text"))
    return rows.withColumn("_node", F.unhex(F.md5("_text")))


def _once(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """_node, _text: each different text once. Only texts that have copies are shuffled."""
    rows = rows.select("_node", "_text")
    copied = cut(counts.where("n > 1").select("_node"))
    copied = F.broadcast(copied) if copied.count() <= SMALL else copied
    one_each = rows.join(copied, "_node", "left_semi").groupBy("_node").agg(F.first("_text").alias("_text"))
    return rows.join(copied, "_node", "left_anti").unionByName(one_each)


def _batches(once: DataFrame) -> DataFrame:
    """batch (its first node), nodes, sizes (bytes of each text), texts (compressed), shingles: kept, so that a batch stays
    what it is when it is read again."""

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("shingles")
        nodes: list[bytes] = []
        texts: list[bytes] = []
        held = 0

        def close() -> pd.DataFrame:
            nonlocal nodes, texts, held
            sizes = np.fromiter(map(len, texts), np.uint64, len(texts))
            joined = pa.compress(b"".join(texts), "zstd", asbytes=True)
            out = pd.DataFrame({"batch": [nodes[0]], "nodes": [b"".join(nodes)], "sizes": [squeezed(sizes)], "texts": [joined], "words": [sum(t.count(b" ") for t in texts)]})
            nodes, texts, held = [], [], 0
            return out

        for frame in frames:
            for node, t in zip(frame["_node"], frame["_text"], strict=True):
                raw = t.encode("utf-8", "surrogatepass")
                if texts and held + len(raw) > BATCH:
                    yield close()
                nodes.append(bytes(node))
                texts.append(raw)
                held += len(raw)
        if texts:
            yield close()
        give_back()

    return cut(once.mapInPandas(gather, "batch binary, nodes binary, sizes binary, texts binary, words long"))


def _opened(sizes: bytes, texts: bytes) -> list[Set]:
    """The sets of a batch's texts."""
    n = restored(sizes).astype(np.int64)
    raw = pa.decompress(texts, int(n.sum()), "zstd", asbytes=True)
    ends = np.cumsum(n).tolist()
    return list(sets([raw[e - k : e].decode("utf-8", "surrogatepass") for e, k in zip(ends, n.tolist(), strict=True)]))


def _joined(found: list[Set]) -> np.ndarray:
    return np.concatenate([np.empty(0, np.uint64), *(h for h, _ in found)])


def _frequencies(batches: DataFrame) -> DataFrame:
    """batch, answers: for each batch, in parts that ascend, the number of texts that hold each of its distinct shingles.

    A batch asks for all its shingles by ranges of hashes; the task of a range adds up what all batches hold and answers
    each. Hashes are even, so no range is hotter than others; a shingle that many texts share is asked for once a batch.
    """
    spark = batches.sparkSession
    total = batches.agg(F.sum("words")).first()[0] or 0
    parts = max(partitions(spark), -(-total // COUNTED))

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("shingles")
        for frame in frames:
            for batch, sizes, texts in zip(frame["batch"], frame["sizes"], frame["texts"], strict=True):
                h, n = np.unique(_joined(_opened(sizes, texts)), return_counts=True)
                part = ((h >> np.uint64(24)) * np.uint64(parts)) >> np.uint64(32)
                own, starts = np.unique(part, return_index=True)
                rows = [(k, bytes(batch), squeezed_set(h[a:b]), squeezed(n[a:b])) for k, a, b in zip(own.tolist(), starts, [*starts[1:], len(h)], strict=False)]
                yield pd.DataFrame(rows, columns=["part", "batch", "h", "n"])
        give_back()

    def answer(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        claim("shingles")
        h = list(map(restored_set, rows["h"]))
        ends = np.cumsum([len(x) for x in h])
        _, which = np.unique(np.concatenate(h), return_inverse=True)
        held = np.bincount(which, weights=np.concatenate(list(map(restored, rows["n"])))).astype(np.uint64)[which]
        return pd.DataFrame({"batch": rows["batch"], "part": key[0], "df": list(map(squeezed, np.split(held, ends[:-1])))})

    with Rows(spark, 4):  # a row is a batch
        asked = batches.select("batch", "sizes", "texts").mapInPandas(ask, "part long, batch binary, h binary, n binary")
        found = cut(asked.groupBy("part").applyInPandas(answer, "batch binary, part long, df binary"))
    return found.groupBy("batch").agg(F.transform(F.sort_array(F.collect_list(F.struct("part", "df"))), lambda x: x["df"]).alias("answers"))


@cache
def _seeds(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None] | np.uint64(1)


def samples(h: np.ndarray, *weights: np.ndarray, n: int = BANDS * ROWS) -> list[np.ndarray]:
    """For each of the weights, n consistent weighted samples of the set, as 64-bit numbers; two sets share each with
    probability equal to their weighted Jaccard similarity.

    From a hash of element and sample come r and c, both of a gamma distribution with shape 2, and b, uniform; with
    t = floor(ln w / r + b) the sample is the (element, t) of least ln c - r (t - b) - r.
    """
    seeds, rows = _seeds(n), np.arange(n)
    best = [np.full(n, np.inf, np.float32) for _ in weights]
    out = [np.zeros(n, np.uint64) for _ in weights]
    step = 1024
    for begin in range(0, len(h), step):
        e = h[begin : begin + step]
        x = e[None, :] * seeds
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        high, low = (x >> np.uint64(32)).astype(np.uint32), x.astype(np.uint32)
        c = ((high >> np.uint32(16)).astype(np.float32) + np.float32(0.5)) * ((high & np.uint32(0xFFFF)).astype(np.float32) + np.float32(0.5))
        c *= np.float32(2.0**-32)
        np.log(c, out=c)
        np.negative(c, out=c)
        np.maximum(c, np.float32(1e-9), out=c)
        np.log(c, out=c)
        low ^= high * np.uint32(0x9E3779B1)
        r = ((low >> np.uint32(22)).astype(np.float32) + np.float32(0.5)) * (((low >> np.uint32(12)) & np.uint32(0x3FF)).astype(np.float32) + np.float32(0.5))
        r *= np.float32(2.0**-20)
        np.log(r, out=r)
        np.negative(r, out=r)
        b = ((low & np.uint32(0xFFF)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-12)
        for k, w in enumerate(weights):
            t = np.log(w[begin : begin + step])[None, :] / r
            t += b
            np.floor(t, out=t)
            own = c - r * (t - b + np.float32(1))
            at = own.argmin(axis=1)
            less = own[rows, at] < best[k]
            best[k] = np.where(less, own[rows, at], best[k])
            out[k] = np.where(less, mixed(e[at] + t[rows, at].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), out[k])
    return out


def _banded(s: np.ndarray, salt: np.ndarray) -> list[int]:
    """A hash of the samples of each band."""
    keys = salt.copy()
    for column in s.reshape(BANDS, -1).T:
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64).tolist()


def _signed(batches: DataFrame, frequencies: DataFrame, total: int) -> DataFrame:
    """_node, bands (hashes of the samples of each band, none without words), df (of its shingles, squeezed)."""
    salt = mixed(np.arange(1, 2 * BANDS + 1, dtype=np.uint64) << np.uint64(32)).reshape(2, BANDS)
    rarest = math.log1p(total)

    def bands_of(h: np.ndarray, n: np.ndarray, idf: np.ndarray) -> list[int]:
        if not len(h):
            return []
        plain = n.astype(np.float32)
        w = plain * idf.astype(np.float32)
        if idf.min() * LIGHT >= rarest:
            return _banded(samples(h, w)[0], salt[0])
        by_weight, by_count = samples(h, w, plain)
        return _banded(by_weight, salt[0]) + _banded(by_count, salt[1])

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("shingles")
        for frame in frames:
            for nodes, sizes, texts, answers in zip(frame["nodes"], frame["sizes"], frame["texts"], frame["answers"], strict=True):
                found = _opened(sizes, texts)
                every = _joined(found)
                held = np.concatenate([np.empty(0, np.uint64), *map(restored, answers if answers is not None else [])])
                df = held[np.searchsorted(np.unique(every), every)]
                ends = np.cumsum([len(h) for h, _ in found])[:-1]
                idf = np.split(np.log1p(total / df), ends)
                yield pd.DataFrame({
                    "_node": [nodes[k : k + 16] for k in range(0, len(nodes), 16)], "bands": [bands_of(*x, i) for x, i in zip(found, idf, strict=True)], "df": list(map(squeezed, np.split(df, ends))),
                })
        give_back()

    both = batches.select("batch", "nodes", "sizes", "texts").join(frequencies, "batch", "left").drop("batch")
    with Rows(batches.sparkSession, 4):
        return stored(both.mapInPandas(sign, "_node binary, bands array<long>, df binary"), "signed")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two weighted sets; 0 if either is empty."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    u = np.union1d(a[0], b[0])
    x, y = np.zeros(len(u)), np.zeros(len(u))
    x[np.searchsorted(u, a[0])], y[np.searchsorted(u, b[0])] = a[1], b[1]
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


def alike(a: tuple[np.ndarray, np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray, np.ndarray], total: int) -> float:
    """The larger of two similarities of sets (hashes, counts, document frequencies): by counts, and by weights."""
    u = np.union1d(a[0], b[0])
    at, bt = np.searchsorted(u, a[0]), np.searchsorted(u, b[0])
    x, y, df = np.zeros(len(u)), np.zeros(len(u)), np.ones(len(u))
    x[at], y[bt], df[at], df[bt] = a[1], b[1], a[2], b[2]
    measures = np.stack([np.ones(len(u)), np.log1p(total / df)])
    return float(((np.minimum(x, y) * measures).sum(axis=1) / (np.maximum(x, y) * measures).sum(axis=1)).max())


def _kept_sets(docs: DataFrame, nodes: DataFrame, signed: DataFrame, text: str, key: str) -> DataFrame:
    """_node, h, n, df of the nodes (_node, _key), each once."""
    few = nodes.count() <= SMALL
    rows = _texts(docs, text, key).join(F.broadcast(nodes) if few else nodes, ["_node", "_key"], "left_semi")

    def weigh(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("shingles")
        for frame in frames:
            for s in pieces_of([len(t) for t in frame["_text"]], BATCH):
                part = frame.iloc[s]
                got = list(sets(part["_text"].tolist()))
                yield pd.DataFrame({"_node": part["_node"], "h": [squeezed_set(h) for h, _ in got], "n": [squeezed(n) for _, n in got]})
        give_back()

    once = rows.mapInPandas(weigh, "_node binary, h binary, n binary").dropDuplicates(["_node"])
    return stored(once.join(signed.select("_node", "df"), "_node"), "sets")


def _compared(pairs: DataFrame, sets: DataFrame, total: int) -> DataFrame:
    """Distinct pairs (a, b) of nodes with their similarity."""
    side = lambda s: sets.select(F.col("_node").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("h", "n", "df")])

    @F.pandas_udf("double")
    def of(ha: pd.Series, na: pd.Series, da: pd.Series, hb: pd.Series, nb: pd.Series, db: pd.Series) -> pd.Series:
        claim("shingles")
        last: tuple[bytes, tuple] | None = None
        out = []
        for h, n, d, *b in zip(ha, na, da, hb, nb, db, strict=True):
            if last is None or last[0] != h:  # pairs of one centre follow each other
                last = h, (restored_set(h), restored(n).astype(float), restored(d).astype(float))
            out.append(alike(last[1], (restored_set(b[0]), restored(b[1]).astype(float), restored(b[2]).astype(float)), total))
        return pd.Series(out, dtype=float)

    joined = pairs.join(side("b"), "b").join(side("a"), "a")
    with Rows(pairs.sparkSession, 128):  # a row holds two texts' sets
        return cut(joined.select("a", "b", of("h_a", "n_a", "df_a", "h_b", "n_b", "df_b").alias("similarity")))


def _beginnings(nodes: DataFrame, sets: DataFrame, total: int, threshold: float) -> DataFrame:
    """A row for each shingle (h) of a node's beginning that other texts hold too: its count n and weight w.

    A text's shingles are ordered by document frequency, then hash. Its beginning is what lies before the place from where
    less than the threshold's share is left, by counts and by weights: alike texts share a shingle of both beginnings. Each
    row also has what is left from its shingle on (left_n, left_w) and the sums of all (all_n, all_w).
    """

    def begin(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("shingles")
        for frame in frames:
            parts: list[pd.DataFrame] = []
            for node, *packed in zip(frame["_node"], frame["h"], frame["n"], frame["df"], strict=True):
                h, n, df = restored_set(packed[0]), restored(packed[1]).astype(float), restored(packed[2]).astype(np.int64)
                if not len(h):
                    continue
                order = np.lexsort((h, df))
                h, n, df = h[order].astype(np.int64), n[order], df[order]
                both = np.stack([n, n * np.log1p(total / df)])
                left = np.concatenate([both[:, ::-1].cumsum(axis=1)[:, ::-1], np.zeros((2, 1))], axis=1)
                k = int((left[:, :-1] >= threshold * left[:, :1] * (1 - SLACK)).any(axis=0).sum())
                own = np.flatnonzero(df[:k] > 1)
                parts.append(pd.DataFrame({
                    "h": h[own], "node": bytes(node), "n": both[0, own], "w": both[1, own],
                    "left_n": left[0, own], "left_w": left[1, own], "all_n": left[0, 0], "all_w": left[1, 0],
                }))
            if parts:
                yield pd.concat(parts)

    with Rows(nodes.sparkSession, 32):
        numbers = ", ".join(f"{c} double" for c in ("n", "w", "left_n", "left_w", "all_n", "all_w"))
        return cut(nodes.join(sets, "_node").mapInPandas(begin, f"h long, node binary, {numbers}"))


def _held_by_several(held: DataFrame, labels: DataFrame) -> tuple[DataFrame, int]:
    """held with each node's label, without shingles that one class holds alone; the label of most holders (main) and the
    number of parts that the other holders are dealt to; and the number of pairs of holders to look at, at most."""
    named = held.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    of_class = named.groupBy("h", "label").agg(F.count("*").alias("c"))
    sizes = of_class.groupBy("h").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.sum("c").alias("c"), F.max("c").alias("most"))
    sizes = cut(sizes.where("c > most").select("h", "main", F.expr("(c - most) * double(c)").alias("pairs"), F.ceil((F.col("c") - F.col("most")) / HOLDERS).cast("int").alias("parts")))
    return named.join(sizes.drop("pairs"), "h"), int(sizes.agg(F.sum("pairs")).first()[0] or 0)


def _may_be_alike(named: DataFrame, threshold: float, since: int, until: int) -> DataFrame:
    """Pairs (a, b) of nodes of different classes, in slices since to until, that shingles of their beginnings do not rule
    out. The rows of a pair are those shingles from which on enough is left of both; as less is left from each to the next,
    these are the first that it shares. They and what is left of either after the last of them are as much as alike texts share."""
    side = lambda s: [F.col(c).alias(f"{c}_{s}") for c in ("node", "label", "n", "w", "left_n", "left_w", "all_n", "all_w")]
    one = named.where("label <> main").select("h", "main", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), *side("x"))
    other = named.select("h", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), *side("y"))
    pair = F.struct(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b"))
    met = one.join(other, ["h", "part"]).where("label_x <> label_y AND (label_y = main OR node_x < node_y)")
    needed = {c: (F.col(f"all_{c}_x") + F.col(f"all_{c}_y")) * (threshold / (1 + threshold) * (1 - SLACK)) for c in ("n", "w")}
    left = [F.least(f"left_{c}_x", f"left_{c}_y") >= needed[c] for c in ("n", "w")]
    met = met.withColumn("p", pair).where(left[0] | left[1]).where(F.pmod(F.xxhash64("p.a", "p.b"), F.lit(SLICES)).between(since, until - 1))
    sums = []
    for c in ("n", "w"):
        rest = F.least(F.col(f"left_{c}_x") - F.col(f"{c}_x"), F.col(f"left_{c}_y") - F.col(f"{c}_y"))
        sums += [(F.sum(F.least(f"{c}_x", f"{c}_y")) + F.min(rest)).alias(c), F.max(needed[c]).alias(f"needed_{c}")]
    return met.groupBy("p").agg(*sums).where("n >= needed_n * (1 - 1e-9) OR w >= needed_w * (1 - 1e-9)").select("p.a", "p.b")


def _contested(members: DataFrame, labels: DataFrame) -> DataFrame:
    """bucket, node, label of those buckets (bucket, node) that hold more than one class."""
    named = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed_ = named.groupBy("bucket").agg((F.min("label") != F.max("label")).alias("_mixed")).where("_mixed").drop("_mixed")
    return named.join(mixed_, "bucket")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (node, label) after more links (a, b), of nodes with or without label."""
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    every = labels.unionByName(ends.join(labels, "node", "left_anti").withColumn("label", F.col("node")))
    side = lambda c: every.select(F.col("node").alias(c), F.col("label").alias(f"_{c}"))
    between = links.join(side("a"), "a").join(side("b"), "b").where("_a <> _b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct()
    new = components(between).select(F.col("node").alias("label"), F.col("label").alias("_to"))
    return cut(every.join(new, "label", "left").select("node", F.coalesce("_to", "label").alias("label")))


def _linked(members: DataFrame, pairs: DataFrame, sets: DataFrame, total: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(links, labels): the links (a, b) that show which nodes are of one class, and the label of each linked node. members
    are the buckets (bucket, node); pairs (a, b) are nodes b to compare with their bucket's centre a."""
    known = _compared(pairs, sets, total)
    known = cut(known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity").dropDuplicates(["a", "b"]))  # two centres may meet twice
    links = known.where(F.col("similarity") >= threshold).select("a", "b")
    labels = components(links)
    open_ = cut(_contested(members, labels).select(F.col("node").alias("_node")).distinct())
    nodes = open_.count()
    if not nodes:
        return links, labels
    held = _beginnings(open_, sets, total, threshold)
    done = width = 0
    while done < SLICES:
        named, most = _held_by_several(held, labels)
        if not most:
            break
        width = max(4 * width, SLICES * EACH * nodes // most, 1)
        until = min(SLICES, done + width)
        asked = _may_be_alike(named, threshold, done, until).join(known, ["a", "b"], "left_anti")
        more = _compared(asked, sets, total).where(F.col("similarity") >= threshold).select("a", "b")
        if more.limit(1).count():
            links, labels = links.unionByName(more), _merged(labels, more)
        done = until
    return links, labels


def components(links: DataFrame) -> DataFrame:
    """node, label: the least node that each node of the links (a, b) is connected to.

    Each round gives every node the least label around it and then that label's own label, until nothing changes.
    """
    edges = cut(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
    while True:
        around = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m"))
        near = labels.join(around, labels["node"] == around["a"]).select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("on"))
        new = cut(near.join(jump, near["label"] == jump["via"], "left").select("node", "old", F.least("label", F.coalesce("on", "label")).alias("label")))
        changed = new.where(F.col("label") != F.col("old")).limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels


def classes(docs: DataFrame, *, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """A row for each row of docs: key, _node (digest of the text), _label (least node of its class), class_id (least key of
    its class), class_size, links (how many different texts its text was found alike to: in a class of several texts, 1 or
    more). Classes with the same least key (none, or one of several texts) differ by _label only.

    Null texts count as empty. Texts without words are near their own copies only; texts of one to four words are one
    shingle. Words are compared in lower case. Rows without key count as the least key; repeated rows are copies. Texts of
    any length are taken whole. Only the key and the text are read, so other columns cannot clash.
    """
    spark = docs.sparkSession
    rows = _texts(docs, text, key)
    counts = cut(rows.groupBy("_node").agg(F.min("_key").alias("_key"), F.count("*").alias("n")))
    total = counts.count()
    batches = _batches(_once(rows, counts))
    frequencies = _frequencies(batches)
    forgotten(spark)
    signed = _signed(batches, frequencies, total)
    del batches, frequencies
    forgotten(spark)
    found = signed.select("_node", F.explode("bands").alias("bucket"))
    sizes = found.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = cut(found.join(sizes, "bucket"))  # only of buckets that more than one node shares
    company = members.groupBy("_node").agg(F.sum("size").alias("company"))
    ranked = members.select("bucket", "_node").join(company, "_node")
    centres = ranked.groupBy("bucket").agg(F.max(F.struct("company", "_node"))["_node"].alias("a"))
    pairs = cut(members.join(centres, "bucket").select("a", F.col("_node").alias("b")).where("a <> b").distinct())
    need = cut(company.select("_node").join(counts.select("_node", "_key"), "_node"))
    held = _kept_sets(docs, need, signed, text, key)
    links, labels = _linked(members.select("bucket", F.col("_node").alias("node")), pairs, held, total, threshold)
    degrees = links.select(F.col("a").alias("_node")).unionByName(links.select(F.col("b").alias("_node"))).groupBy("_node").agg(F.count("*").alias("links"))
    named = counts.join(labels, counts["_node"] == labels["node"], "left").select("_node", "_key", "n", F.coalesce("label", "_node").alias("label"))
    sizes = named.groupBy("label").agg(F.min("_key").alias("_class"), F.sum("n").alias("class_size"))
    of_node = cut(named.select("_node", "label").join(sizes, "label").join(degrees, "_node", "left"))
    forgotten(spark, signed, held)
    out = rows.select("_key", "_node").join(of_node, "_node")
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select(real("_key").alias(key), "_node", F.col("label").alias("_label"), real("_class").alias("class_id"), "class_size", F.coalesce("links", F.lit(0)).alias("links"))


def deduplicated(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with one row of each class: the one of least key (rows without key first), of those the one of least digest."""
    found = classes(docs, text=text, key=key)
    safe = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(NO_ID))
    least = found.where(safe(key) == safe("class_id")).groupBy("_label", safe(key).alias("_key"), "_node").agg(F.count("*").alias("_n"))
    kept = cut(least.groupBy("_label").agg(F.min(F.struct("_node", "_key", "_n")).alias("_one")).select("_one.*"))
    kept = F.broadcast(kept) if kept.count() <= SMALL else kept
    rows = docs.select(F.struct(*docs.columns).alias("_row"), safe(key).alias("_key"), F.unhex(F.md5(text_of(text))).alias("_node")).join(kept, ["_key", "_node"])
    once = rows.where("_n = 1").unionByName(rows.where("_n > 1").dropDuplicates(["_key", "_node"]))
    return once.select("_row.*")
