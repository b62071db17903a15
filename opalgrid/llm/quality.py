"""Quality classifier: a generalised additive model with pairwise interactions.

Features of the text are cut into bins. Cyclic boosting visits one feature after the other and fits a tree of at most
three leaves over its bins, so that each feature ends as one lookup table; the strongest pairs then get tables of their
own from trees with one cut on either side. A score is the sum of the looked-up numbers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opalgrid.llm.common import claim, text_of
from opalgrid.llm.fitting import fitted, held_out, sample

#: Labelled documents that are learned from; bins of a feature, and of one in a pair; rounds and rate of the boosting.
MOST, BINS, PAIR_BINS, ROUNDS, RATE, PAIRS = 20_000, 32, 8, 150, 0.15, 6
#: A score from here on keeps a document.
KEPT_FROM = 0.3
FEATURES = ("length", "word_length", "upper", "lower", "digits", "symbols", "bangs", "bars", "stops", "lines", "line_length", "distinct_words", "distinct_lines", "wide", "spaces", "odd_ends")


def _group(chars: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars)] = 1
    return out


_KINDS = np.stack([
    _group(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _group(b"abcdefghijklmnopqrstuvwxyz"), _group(b"0123456789"), _group(b"#$%&*+/<=>@\\^_`{}~[]()"),
    _group(b"!?"), _group(b"|"), _group(b".,;:"), _group(bytes(range(128, 256))), _group(b" \t\n\r"),
])
_LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789.,;:?!'\")") | frozenset(range(128, 256))


def features(texts: Sequence[str]) -> np.ndarray:
    """A row of FEATURES for each text; all zero for an empty one."""
    out = np.zeros((len(texts), len(FEATURES)))
    for i, t in enumerate(texts):
        raw = t.encode("utf-8", "surrogatepass")
        if not raw:
            continue
        kinds = _KINDS @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / len(raw)
        words, lines = raw.split(), raw.split(b"\n")
        n = max(1, len(words))
        distinct = set(words)
        odd = sum(1 for w in distinct if w[-1] not in _LETTERS)
        out[i] = (
            np.log1p(len(raw)), (len(raw) - raw.count(b" ")) / n, *kinds[:7], np.log1p(len(lines)), np.log1p(len(raw) / len(lines)),
            len(distinct) / n, len(set(lines)) / len(lines), kinds[7], kinds[8], odd / max(1, len(distinct)),
        )
    return out


@dataclass
class Model:
    edges: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += table[np.searchsorted(edges, x[:, j], side="right")]
        if self.pairs:
            coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.pair_edges)]
            for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
                out += table[coarse[i], coarse[j]]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + 1.0)


def _cut(g: np.ndarray, h: np.ndarray, begin: int, end: int) -> tuple[float, int]:
    """Gain and place of the best cut of the bins begin..end-1."""
    if end - begin < 2:
        return 0.0, begin
    a, b = np.cumsum(g[begin:end]), np.cumsum(h[begin:end])
    left, right, whole = a[:-1] ** 2 / (b[:-1] + 1), (a[-1] - a[:-1]) ** 2 / (b[-1] - b[:-1] + 1), a[-1] ** 2 / (b[-1] + 1)
    gain = left + right - whole
    k = int(gain.argmax())
    return float(gain[k]), begin + k + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values over bins of a tree with at most three leaves."""
    cuts = [0, len(g)]
    for _ in range(2):
        gain, at = max(_cut(g, h, a, b) for a, b in zip(cuts, cuts[1:], strict=False))
        if gain <= 1e-9:
            break
        cuts = sorted({*cuts, at})
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:], strict=False):
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree with one cut on either axis of a table of gradients."""
    a, b = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    best, out = 0.0, np.zeros_like(g)
    for i in range(len(g) - 1):
        for j in range(g.shape[1] - 1):
            parts = []
            for s in (a, b):
                p, q, r, w = s[i, j], s[i, -1], s[-1, j], s[-1, -1]
                parts.append(np.array([p, q - p, r - p, w - q - r + p]))
            gain = float((parts[0] ** 2 / (parts[1] + 1)).sum() - a[-1, -1] ** 2 / (b[-1, -1] + 1))
            if gain > best + 1e-9:
                v = _leaf(*parts)
                best, out = gain, np.empty_like(g)
                out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = v
    return best, out


def fit(rows: pd.DataFrame) -> Model:
    """The model of rows text, y. Without rows every text scores one half."""
    texts = rows["text"].tolist()
    x, y = features(texts), rows["y"].to_numpy(float) if len(rows) else np.empty(0)
    width = len(FEATURES)
    if not len(x):
        return Model([np.empty(0)] * width, 0.0, [np.zeros(1)] * width, [np.empty(0)] * width, [], [])
    edges, pair_edges = [_edges(x[:, j], BINS) for j in range(width)], [_edges(x[:, j], PAIR_BINS) for j in range(width)]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(pair_edges)]
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    logit, tables = np.full(len(y), base), [np.zeros(len(e) + 1) for e in edges]

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(width):
            g, h = slopes()
            n = len(tables[j])
            step = RATE * _tree(np.bincount(bins[j], g, n), np.bincount(bins[j], h, n))
            tables[j] += step
            logit += step[bins[j]]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = slopes()
        shape = len(pair_edges[i]) + 1, len(pair_edges[j]) + 1
        at = coarse[i] * shape[1] + coarse[j]
        return np.bincount(at, g, shape[0] * shape[1]).reshape(shape), np.bincount(at, h, shape[0] * shape[1]).reshape(shape)

    ranked = sorted(((_quadrants(*grid(i, j))[0], i, j) for i, j in combinations(range(width), 2)), reverse=True)
    pairs = [(i, j) for gain, i, j in ranked[:PAIRS] if gain > 4]
    pair_tables = [np.zeros((len(pair_edges[i]) + 1, len(pair_edges[j]) + 1)) for i, j in pairs]
    for _ in range(ROUNDS // 5):
        for k, (i, j) in enumerate(pairs):
            step = RATE * _quadrants(*grid(i, j))[1]
            pair_tables[k] += step
            logit += step[coarse[i], coarse[j]]
    return Model(edges, base, tables, pair_edges, pairs, pair_tables)


def learn(docs: DataFrame, labels: DataFrame, *, label: str = "quality", most: int = MOST, text: str = "text", key: str = "doc_id") -> Model:
    return fitted(sample(docs, labels, label, most, text=text, key=key), fit)


def with_score(docs: DataFrame, model: Model, *, text: str = "text", name: str = "score") -> DataFrame:
    """docs with the score of each whole text, however long (null: empty, and an empty text has features of zero); all other
    columns stay, but one called as `name`, which is replaced. Equal texts score the same; repeated rows all stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        claim("quality")
        for t in texts:
            yield pd.Series(shared.value.scores(features(t.tolist())))

    return docs.withColumn(name, of(text_of(text)))


def scored(docs: DataFrame, model: Model, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score, predicted of each row; null and empty texts have a score too, texts of any length are scored
    whole, repeated rows each give a row. Other columns are not read, so their names cannot clash."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), held_out(key).alias("held_out"), text_of(text).alias("text"))
    out = with_score(rows, model)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= KEPT_FROM).cast("int").alias("predicted"))
