"""Byte-level byte-pair encoding and decoding with vectorised pre-tokenisation.

Texts of a chunk lie in one array of code points. Each code point becomes a symbol (its class, or how many letters of a
contraction follow an apostrophe), and each symbol a function from states to states. Functions are composed, which is
associative: block by block, then over the blocks by doubling, so the state before each code point is known without
walking through the text. State and symbol tell where a pre-token begins. The pre-tokens are byte slices; slices that are
new get their merges together, in rounds over arrays; known ones come from a cache.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opalgrid.llm.common import claim, pieces_of, text_of
from opalgrid.llm.wordcache import IdCache, gathered, summed

# Symbols: a blank, other white space, a letter, a number, anything else, an apostrophe before a contraction's one or two
# letters, and the end of a text.
BLANK, SPACE, LETTER, NUMBER, OTHER, ONE, TWO, END = range(8)
# States: nothing open, a blank that the next word takes, a run of letters, of numbers, of others, one or two letters of a
# contraction to come.
FRESH, TAKEN, LETTERS, NUMBERS, OTHERS, LAST, LAST_TWO = range(7)
STATES = 7
#: The contractions of the pattern, without their apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """The state after each (symbol, state), and whether a token begins at a symbol that is no white space."""
    after, begins = np.zeros((8, 8), np.uint8), np.zeros((8, 8), bool)
    run = {LETTER: LETTERS, NUMBER: NUMBERS, OTHER: OTHERS, ONE: OTHERS, TWO: OTHERS}
    for state in range(STATES):
        after[BLANK, state], after[SPACE, state], after[END, state] = TAKEN, FRESH, FRESH
        for symbol, kind in run.items():
            after[symbol, state] = kind
            begins[symbol, state] = state not in (kind, TAKEN)
            if symbol in (ONE, TWO) and state not in (OTHERS, TAKEN):
                after[symbol, state] = LAST if symbol == ONE else LAST_TWO
        if state in (LAST, LAST_TWO):
            after[LETTER, state], begins[LETTER, state] = FRESH if state == LAST else LAST, False
    return after, begins


AFTER, BEGINS = _transitions()


@cache
def classes() -> np.ndarray:
    """The symbol of each code point, apostrophes as OTHER."""
    out = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for c in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
    out[[9, 10, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    out[32] = BLANK
    return out


def symbols(points: np.ndarray) -> np.ndarray:
    """points: code points; 0x110000 ends a text."""
    ends = points > sys.maxunicode
    out = np.where(ends, np.uint8(END), classes()[np.where(ends, 0, points)])
    quotes = np.flatnonzero(points == ord("'"))
    if len(quotes):
        padded = np.concatenate([points, np.full(2, 0x110000, points.dtype)])
        first, second = padded[quotes + 1], padded[quotes + 2]
        one, two = np.zeros(len(quotes), bool), np.zeros(len(quotes), bool)
        for x in CONTRACTIONS:
            if len(x) == 1:
                one |= first == ord(x)
            else:
                two |= (first == ord(x[0])) & (second == ord(x[1]))
        out[quotes[one]] = ONE
        out[quotes[two & ~one]] = TWO
    return out


def states_before(symbol: np.ndarray, width: int = 128) -> np.ndarray:
    """The state before each symbol, from FRESH at the start, by composing the symbols' functions."""
    n = len(symbol)
    rows = -(-n // width)
    grid = np.full(rows * width, END, np.uint8)
    grid[:n] = symbol
    columns = np.ascontiguousarray(grid.reshape(rows, width).T) * np.uint8(8)
    table = AFTER.reshape(-1)
    whole = np.tile(np.arange(STATES, dtype=np.uint8)[:, None], (1, rows))  # state after each block, by the state before it
    for c in range(width):
        whole = table[columns[c] + whole]
    step = 1
    while step < rows:  # composition over blocks by doubling
        whole[:, step:] = _compose(whole[:, :-step].copy(), whole[:, step:])
        step *= 2
    state = np.empty(rows, np.uint8)
    state[0], state[1:] = FRESH, whole[FRESH, :-1]
    before = np.empty((width, rows), np.uint8)
    for c in range(width):
        before[c] = state
        state = table[columns[c] + state]
    return before.T.reshape(-1)[:n]


def _compose(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """For each column: the function `first`, followed by `then`."""
    return np.take_along_axis(then, first.astype(np.intp), axis=0)


def token_starts(points: np.ndarray) -> np.ndarray:
    """Whether a pre-token begins at each code point; ends of texts count as tokens of their own."""
    symbol = symbols(points)
    white = symbol <= SPACE
    begins = BEGINS[symbol, states_before(symbol)]
    before = np.concatenate([[False], white[:-1]])
    follows = np.concatenate([~white[1:] & (symbol[1:] != END), [False]])
    begins[white] = (~before | follows)[white]
    begins[symbol == END] = True
    return begins


class Vocabulary:
    """Merges over bytes by rank, with a cache of known slices."""

    #: Slices of more bytes are merged one by one, with a heap.
    LONG = 64

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        most = max(ranks.values()) + 1
        self.pieces = np.zeros(most, np.int64)
        for b, i in ranks.items():
            self.pieces[i] = len(b)
        self.ends = np.cumsum(self.pieces)
        self.flat = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(most)), np.uint8)
        pairs = {}
        for b, i in ranks.items():
            for k in range(1, len(b)):
                left, right = ranks.get(b[:k]), ranks.get(b[k:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        order = np.array(sorted(pairs), np.int64)
        bits = int(np.ceil(np.log2(max(4, 4 * len(order)))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.merged = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
        left = order
        at = self._place(order)
        while len(left):  # each free place takes one key; the others go on to the next place
            free = self.keys[at] < 0
            first = np.unique(at[free], return_index=True)[1]
            took = np.flatnonzero(free)[first]
            self.keys[at[took]] = left[took]
            self.merged[at[took]] = [pairs[int(k)] for k in left[took]]
            rest = np.ones(len(left), bool)
            rest[took] = False
            left, at = left[rest], (at[rest] + 1) & self.mask
        self.known = IdCache(self._encode)

    def _place(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that two adjacent ids merge to; a large number if none."""
        key = left << 32 | right
        at = self._place(key)
        out = np.full(len(key), 1 << 40, np.int64)
        todo = np.arange(len(key))
        while len(todo):
            found = self.keys[at]
            hit = found == key[todo]
            out[todo[hit]] = self.merged[at[hit]]
            go = ~hit & (found >= 0)
            todo, at = todo[go], (at[go] + 1) & self.mask
        return out

    def merge(self, slices: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all slices, and how many each has. In each round, each slice merges its first pair of least rank."""
        sizes = np.fromiter(map(len, slices), np.int64, len(slices))
        ids = self.single[np.frombuffer(b"".join(slices), np.uint8)]
        owner = np.repeat(np.arange(len(slices)), sizes)
        pair = np.full(len(ids), 1 << 40, np.int64)  # rank of each id with the next one
        inside = owner[:-1] == owner[1:]
        pair[:-1][inside] = self.rank_of(ids[:-1][inside], ids[1:][inside])
        done_ids, done_owner = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while len(ids):
            firsts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            least = np.minimum.reduceat(pair, firsts)
            counts = np.diff(np.append(firsts, len(ids)))
            open_ = least < 1 << 40
            going = np.repeat(open_, counts)
            if not going.all():
                done_ids.append(ids[~going])
                done_owner.append(owner[~going])
                ids, owner, pair, least, counts = ids[going], owner[going], pair[going], least[open_], counts[open_]
                if not len(ids):
                    break
            at = np.flatnonzero(pair == np.repeat(least, counts))
            at = at[np.concatenate([[True], owner[at][1:] != owner[at][:-1]])]
            ids[at] = pair[at]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            moved = np.cumsum(keep)[at] - 1
            ids, owner, pair = ids[keep], owner[keep], pair[keep]
            for i in (moved, moved - 1):  # only pairs beside a merge have changed
                i = i[(i >= 0)]
                last = (i + 1 >= len(ids)) | (owner[np.minimum(i + 1, len(ids) - 1)] != owner[i])
                pair[i[last]] = 1 << 40
                j = i[~last]
                pair[j] = self.rank_of(ids[j], ids[j + 1])
        all_ids, all_owner = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(all_owner, kind="stable")
        return all_ids[order], np.bincount(all_owner, minlength=len(slices))

    def merge_long(self, piece: bytes) -> list[int]:
        """The same for one slice of any length, in n log n steps."""
        ids: list[int | None] = [int(self.single[b]) for b in piece]
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))

        def rank(i: int) -> int | None:
            j = after[i]
            return self.ranks.get(self.bytes_of[ids[i]] + self.bytes_of[ids[j]]) if j < n else None

        heap = [(r, i) for i in range(n - 1) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] is None or rank(i) != r:
                continue
            j = after[i]
            ids[i], ids[j] = r, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (i, before[i]):
                if k >= 0 and (x := rank(k)) is not None:
                    heapq.heappush(heap, (x, k))
        return [x for x in ids if x is not None]

    def _encode(self, slices: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        short = [s for s in slices if len(s) <= self.LONG]
        ids, sizes = self.merge(short)
        if len(short) == len(slices):
            return ids, sizes
        parts = iter(np.split(ids, np.cumsum(sizes)[:-1]) if short else [])
        out = [np.asarray(self.merge_long(s), np.int64) if len(s) > self.LONG else next(parts) for s in slices]
        return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each text has. Ids of a slice never cross its ends."""
        if not texts:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        points = np.full(int(lengths.sum()) + len(texts), 0x110000, np.uint32)
        stops = np.cumsum(lengths + 1) - 1
        inner = np.ones(len(points), bool)
        inner[stops] = False
        points[inner] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        begins = token_starts(points)
        width = (points > 0x7F).astype(np.int8)
        if width.any():
            width += points > 0x7FF
            width += points > 0xFFFF
        width += 1
        width[stops] = 0
        offset = np.cumsum(width, dtype=np.int64) - width
        cuts = np.flatnonzero(begins)
        buffer = "".join(texts).encode("utf-8", "surrogatepass")
        real = cuts[inner[cuts]]
        at = offset[real].tolist()
        flat, sizes = self.known.ids(map(buffer.__getitem__, map(slice, at, [*at[1:], len(buffer)])), len(at))
        return flat, summed(sizes, np.bincount(np.searchsorted(stops, real), minlength=len(texts)))

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of ids, and the offset at which each id's bytes begin."""
        sizes = self.pieces[ids]
        return gathered(self.flat, self.ends[ids] - sizes, sizes).tobytes(), np.cumsum(sizes) - sizes


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of this worker process, which keeps its cache from task to task."""
    claim(f"vocabulary {path}", _vocabulary.cache_clear)
    return _vocabulary(path)


@cache
def _vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file of lines `base64 rank`."""
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


def encoded(docs: DataFrame, path: str, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, ids, offsets: the ids of each whole text and where each id's bytes begin in the text's UTF-8.

    Null texts count as empty and have no ids; repeated rows each give a row.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabulary(path)
        for batch in batches:
            texts = batch["text"].tolist()
            for s in pieces_of([len(t) for t in texts], 1_000_000):
                flat, sizes = words.encode(texts[s])
                ids = np.split(flat, np.cumsum(sizes)[:-1])
                yield pd.DataFrame({"key": batch["key"].iloc[s].tolist(), "ids": ids, "offsets": [words.decode(x)[1] for x in ids]})

    rows = docs.select(F.col(key).cast("long").alias("key"), text_of(text).alias("text"))
    return rows.mapInPandas(run, "key long, ids array<int>, offsets array<long>").withColumnRenamed("key", key)


def decoded(rows: DataFrame, path: str, *, ids: str = "ids") -> DataFrame:
    """rows with a column decoded, which replaces one of that name: the bytes of the array of ids (null for null)."""

    @F.pandas_udf("binary")
    def run(column: pd.Series) -> pd.Series:
        words = vocabulary(path)
        return pd.Series([None if x is None else words.decode(np.asarray(x, np.int64))[0] for x in column], dtype=object)

    return rows.withColumn("decoded", run(ids))


def round_trip(docs: DataFrame, path: str, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of each text's ids and of what they decode to.

    Null texts count as empty, texts of any length are taken whole, repeated rows each give a row. Other columns are not
    read, so their names cannot clash.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabulary(path)
        for batch in batches:
            texts = batch["text"].tolist()
            for s in pieces_of([len(t) for t in texts], 1_000_000):
                flat, sizes = words.encode(texts[s])
                cuts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
                raw = flat.astype("<u4").tobytes()
                back, offsets = words.decode(flat)
                stops = [*offsets.tolist(), len(back)]
                yield pd.DataFrame({
                    "doc_id": batch["key"].iloc[s].tolist(), "n_tokens": sizes,
                    "ids_sha256": [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(cuts, cuts[1:], strict=False)],
                    "decoded_sha256": [hashlib.sha256(back[stops[a] : stops[b]]).hexdigest() for a, b in zip(cuts, cuts[1:], strict=False)],
                })

    rows = docs.select(F.col(key).cast("long").alias("key"), text_of(text).alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
