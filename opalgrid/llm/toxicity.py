"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

All terms of the sample count; none is left out, and a vector's length is that of the whole text, words that the sample
lacks included. Rare words of the subject would hide the few that the label turns on, so a term's inverse document
frequency is raised by how far the likelihood-ratio test ties the term to either label. The nearest examples vote with
weights that fall with distance; the label's share pulls thin votes towards it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opalgrid.llm.common import LETTERS, claim, pieces_of, text_of, word_hashes
from opalgrid.llm.fitting import fitted, held_out, sample

#: Labelled documents that are learned from, neighbours that vote, blocks of examples, terms whose weights lie in a matrix.
MOST, NEIGHBOURS, BLOCKS, COMMON = 20_000, 25, 32, 256
#: Share of the blocks that are visited first, for a bound on the rest.
FIRST = 4
#: The statistic that chance passes once in a million terms, and what the root of its excess is multiplied by in a term's
#: weight (at four times the statistic: 1 + RAISED * sqrt(3)).
BY_CHANCE, RAISED = 24.0, 30.0
#: Votes that the prior counts for.
PRIOR = 0.5
#: Characters, and texts, that are looked at together.
CHARACTERS, TEXTS = 300_000, 64

Bag = tuple[np.ndarray, np.ndarray]


def bags(texts: Sequence[str]) -> Iterator[Bag]:
    """For each text the hashes of its different words, ascending, and their counts."""
    for s in pieces_of([len(t) for t in texts], CHARACTERS):
        w, counts = word_hashes(texts[s], LETTERS)
        for own in np.split(w, np.cumsum(counts)[:-1]):
            yield np.unique(own, return_counts=True)


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all slices starts[i] : starts[i] + sizes[i], one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


class Blocks:
    """What a search works with: the most common terms are columns of a matrix; each other term has a posting list, cut
    where blocks of examples end, with the largest weight of each cut."""

    def __init__(self, index: Index) -> None:
        n, sizes = len(index.ids), np.diff(index.begins)
        t, doc, w = np.repeat(np.arange(len(sizes)), sizes), index.docs.astype(np.int32), index.weights
        each = -(-max(n, 1) // BLOCKS)
        blocks = -(-n // each)
        self.begins = np.minimum(np.arange(blocks + 1) * each, n)  # of each block's examples
        frequent = np.argsort(-sizes, kind="stable")[:COMMON]
        self.column = np.full(len(sizes), -1)  # of a common term
        self.column[frequent] = np.arange(len(frequent))
        dense = self.column[t] >= 0
        at = self.column[t[dense]]
        self.common = np.zeros((len(frequent), n), np.float32)
        self.common[at, doc[dense]] = w[dense]
        self.common_most = np.zeros((len(frequent), blocks), np.float32)
        np.maximum.at(self.common_most, (at, doc[dense] // each), w[dense])
        t, doc, w = t[~dense], doc[~dense], w[~dense]
        #: Example and weight, 32 bits each, side by side, by term and example.
        self.postings = np.stack([doc, w.view(np.int32)], axis=1).reshape(-1).view(np.int64)
        new = np.flatnonzero(np.diff(t, prepend=-1).astype(bool) | np.diff(doc // each, prepend=-1).astype(bool))
        self.cuts = np.searchsorted(t[new], np.arange(len(sizes) + 1))  # where each term's cuts begin
        self.cut_block = (doc[new] // each).astype(np.int16)
        self.cut_begin = np.append(new, len(t))
        self.cut_most = np.maximum.reduceat(w, new) if len(new) else np.empty(0, np.float32)


@dataclass
class Index:
    """Examples, and the weights of their terms. It travels without its Blocks, which each worker makes for itself."""

    terms: np.ndarray  # hashes, ascending
    factor: np.ndarray  # inverse document frequency, raised
    unknown: float  # the same of a word that no example has
    ids: np.ndarray
    labels: np.ndarray
    share: float
    begins: np.ndarray = field(repr=False)  # (terms + 1): where each term's postings begin
    docs: np.ndarray = field(repr=False)  # by term and example
    weights: np.ndarray = field(repr=False)

    def __getstate__(self) -> dict[str, Any]:
        return {k: v for k, v in self.__dict__.items() if k != "blocks"}

    @cached_property
    def blocks(self) -> Blocks:
        return Blocks(self)

    def vector(self, bag: Bag) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the known terms, and their weights in a vector of length one over all of the text's words."""
        h, n = bag
        if not len(h):
            return np.empty(0, np.int64), np.empty(0, np.float32)
        at = np.searchsorted(self.terms, h)
        known = at < len(self.terms)
        known[known] = self.terms[at[known]] == h[known]
        w = (1 + np.log(n)) * self.unknown
        w[known] *= self.factor[at[known]] / self.unknown
        return at[known], (w[known] / np.sqrt((w * w).sum())).astype(np.float32)

    def nearest(self, queries: Sequence[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each vector the k examples of largest cosine, and the cosines; ties to the smaller id.

        Examples without a common term never count. The blocks of the largest bounds are searched first; of the others,
        those whose bound reaches the k-th cosine found.
        """
        n, work = len(self.ids), self.blocks
        blocks = len(work.begins) - 1
        dense = np.zeros((len(queries), len(work.common)), np.float32)
        for i, (t, w) in enumerate(queries):
            c = work.column[t]
            dense[i, c[c >= 0]] = w[c >= 0]
        sums, bounds = dense @ work.common, dense @ work.common_most
        sizes = np.diff(work.begins)
        for (t, w), own, bound in zip(queries, sums, bounds, strict=True):
            rest = work.column[t] < 0
            first, count = work.cuts[t[rest]], work.cuts[t[rest] + 1] - work.cuts[t[rest]]
            at, x = runs(first, count), np.repeat(w[rest].astype(float), count)
            block = work.cut_block[at]
            bound = bound + np.bincount(block, x * work.cut_most[at], minlength=blocks)
            order, done, least = np.argsort(-bound, kind="stable"), 0, 0.0
            found, cosines = np.empty(0, np.int64), np.empty(0)
            for upto in (max(1, blocks // FIRST), blocks):
                now = np.zeros(blocks, bool)
                now[order[done:upto]] = True
                now &= (bound > 0) & (bound >= least - 1e-5)
                done = upto
                if not now.any():
                    continue
                some = now[block]
                begin, size = work.cut_begin[at[some]], (work.cut_begin[at[some] + 1] - work.cut_begin[at[some]])
                p = work.postings[runs(begin, size)].view(np.int32).reshape(-1, 2)
                scores = own + np.bincount(p[:, 0], np.repeat(x[some], size) * p[:, 1].view(np.float32), minlength=n)
                scores[~np.repeat(now, sizes)] = 0
                hit = np.flatnonzero(scores > max(1e-7, least - 1e-6))
                found, cosines = np.concatenate([found, hit]), np.concatenate([cosines, scores[hit]])
                if len(found) > k:
                    least = np.partition(cosines, len(cosines) - k)[len(cosines) - k]
            kept = cosines >= least - 1e-6
            found, cosines = found[kept], np.minimum(np.round(cosines[kept], 6), 1.0)
            best = np.lexsort((self.ids[found], -cosines))[:k]
            yield found[best], cosines[best]


def _relevance(df: np.ndarray, pos: np.ndarray, n: int, total: int) -> np.ndarray:
    """The likelihood-ratio statistic of each term and the label: df examples hold it, pos of them labelled 1."""
    g = np.zeros(len(df))
    cells = ((pos, df * total), (df - pos, df * (n - total)), (total - pos, (n - df) * total), (n - df - total + pos, (n - df) * (n - total)))
    for seen, expected in cells:
        with np.errstate(divide="ignore", invalid="ignore"):
            g += np.where(seen > 0, 2 * seen * np.log(seen * n / expected), 0)
    return g


def _clusters(vectors: np.ndarray, groups: int = BLOCKS // 4, rounds: int = 8) -> np.ndarray:
    """A group for each row: spherical k-means from seeds that lie far from each other, the same at each run."""
    if not len(vectors):
        return np.empty(0, np.int64)
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    seeds = [0]
    near = unit @ unit[0]
    for _ in range(min(groups, len(unit)) - 1):
        seeds.append(int(near.argmin()))
        near = np.maximum(near, unit @ unit[seeds[-1]])
    centres = unit[seeds]
    for _ in range(rounds):
        own = (unit @ centres.T).argmax(axis=1)
        sums = np.array([unit[own == k].sum(axis=0) for k in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return (unit @ centres.T).argmax(axis=1)


def fit(rows: pd.DataFrame) -> Index:
    """An index of the examples id, y, h, n (a bag of words, as bytes). Without rows it has one score, one half."""
    rows = rows.sort_values("id", kind="stable")
    n, y = len(rows), rows["y"].to_numpy(np.int64)
    h = [np.frombuffer(b, np.uint64) for b in rows["h"]]
    counts = np.concatenate([np.empty(0, np.uint32), *(np.frombuffer(b, np.uint32) for b in rows["n"])])
    terms, t = np.unique(np.concatenate([np.empty(0, np.uint64), *h]), return_inverse=True)
    doc = np.repeat(np.arange(n), [len(x) for x in h])
    df, total = np.bincount(t, minlength=len(terms)).astype(float), int(y.sum())
    g = _relevance(df, np.bincount(t, weights=y[doc], minlength=len(terms)), n, total)
    factor = np.log1p(n / np.maximum(df, 1)) * (1 + RAISED * np.sqrt(np.maximum(0, g / BY_CHANCE - 1)))
    w = (1 + np.log(counts)) * factor[t]
    w = w / np.sqrt(np.bincount(doc, w * w, minlength=n))[doc] if n else w
    # Examples that share common terms (of one language), and the strongest term, lie together: blocks get tight bounds.
    frequent = np.argsort(-df, kind="stable")[:COMMON]
    column = np.full(len(terms), -1)
    column[frequent] = np.arange(len(frequent))
    dense = column[t] >= 0
    common = np.zeros((n, len(frequent)), np.float32)
    common[doc[dense], column[t[dense]]] = w[dense]
    order = np.lexsort((-np.where(df[t] >= n / 200, w, 0), doc))
    heads = np.searchsorted(doc[order], np.arange(n)) if len(doc) else np.zeros(n, np.int64)
    has = np.bincount(doc, minlength=n) > 0
    strongest = np.full(n, len(terms))
    strongest[has] = t[order[heads[has]]]
    places = np.lexsort((np.arange(n), strongest, _clusters(common)))
    place = np.empty(n, np.int64)
    place[places] = np.arange(n)
    doc = place[doc]
    order = np.lexsort((doc, t))
    begins = np.searchsorted(t[order], np.arange(len(terms) + 1)).astype(np.int32)
    docs = doc[order].astype(np.uint16 if n <= 1 << 16 else np.int32)
    return Index(terms, factor.astype(np.float32), float(np.log1p(n)) or 1.0, rows["id"].to_numpy(np.int64)[places], y[places], (total + 0.5) / (n + 1), begins, docs, w[order].astype(np.float32))


def score(index: Index, found: np.ndarray, cosines: np.ndarray) -> tuple[float, list[dict[str, Any]]]:
    """Score by the nearest examples, and the three nearest. Without any: the share of the label."""
    votes = cosines**2 / (1.1 - cosines)
    p = (float((votes * index.labels[found]).sum()) + PRIOR * index.share) / (float(votes.sum()) + PRIOR)
    return p, [{"id": int(index.ids[i]), "cosine": float(c), "label": int(index.labels[i])} for i, c in zip(found[:3], cosines, strict=False)]


def scores(index: Index, texts: Sequence[str]) -> Iterator[tuple[float, list[dict[str, Any]]]]:
    for at in range(0, len(texts), TEXTS):
        vectors = [index.vector(b) for b in bags(texts[at : at + TEXTS])]
        for found, cosines in index.nearest(vectors):
            yield score(index, found, cosines)


def counted(rows: DataFrame) -> DataFrame:
    """id, y, h, n: the bags of words of rows id, text, y."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("toxicity")
        for batch in batches:
            got = list(bags(batch["text"].tolist()))
            yield pd.DataFrame({"id": batch["id"], "y": batch["y"], "h": [h.tobytes() for h, _ in got], "n": [n.astype(np.uint32).tobytes() for _, n in got]})

    return rows.mapInPandas(run, "id long, y int, h binary, n binary")


def learn(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", most: int = MOST, text: str = "text", key: str = "doc_id") -> Index:
    return fitted(counted(sample(docs, labels, label, most, text=text, key=key)), fit)


def scored(docs: DataFrame, index: Index, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (the three nearest examples) of each whole text, and nothing else.

    Null and empty texts, and texts of unknown words, have no nearest examples and score the label's share in the sample.
    Texts of any length are taken whole. Repeated rows each give a row; equal texts score the same. Ties between examples
    go to the smaller id. Other columns are not read, so their names cannot clash.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by the sample

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("toxicity")
        for batch in batches:
            got = list(scores(shared.value, batch["text"].tolist()))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": [x[0] for x in got], "predicted": [int(x[0] >= 0.5) for x in got], "evidence": [x[1] for x in got]})

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), held_out(key).alias("held_out"), text_of(text).alias("text"))
    return rows.mapInPandas(run, "doc_id long, held_out boolean, score double, predicted int, evidence array<struct<id: long, cosine: double, label: int>>")
