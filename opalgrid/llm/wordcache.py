"""Tokenizers over whole texts, by way of a bounded cache of the ids of blank-separated chunks.

A byte-pair encoder never merges across the boundaries of its pre-tokenizer. Texts are cut at blanks where such a boundary
is certain; each new chunk is encoded by the tokenizers library, and known chunks are gathered from the cache. Texts in
which a cut at a blank would not be safe go to the library whole.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Callable, Iterable, Sequence
from itertools import chain

import numpy as np

from opalgrid.llm.common import claim, give_back

#: A blank whose left neighbour is white space and whose right one is too, or the end: runs of white space are one token then.
_RUN = re.compile(r"\s (?!\S)")
#: Characters that str.split() cuts at, though the Unicode property White_Space does not hold them.
_CONTROLS = re.compile("[\x1c-\x1f]")

#: Stands before a chunk that has no blank before it, where blanks matter; no text holds it, for it is no character.
_FIRST = "\udfff"
#: Marks that may follow a word; none is a letter or a number.
_MARKS = ".,;:!?$%&*#|)\"'"


def _byte_chars() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it prints, else the next free one."""
    prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(others)}


_BYTE_CHARS = _byte_chars()
#: Words that a worker keeps the ids of; half as many chunks.
WORDS = 800_000


class IdCache(dict):
    """Chunk -> number of the chunk, whose ids lie in one flat array.

    Looking up a chunk that is not known gives it the next number; `ids` has the new ones encoded, all at once. When it is
    full, chunks that have turned up once only are forgotten; all are, if that is not enough.
    """

    def __init__(self, encode: Callable[[list], tuple[np.ndarray, np.ndarray]], most: int = 500_000, most_ids: int = 8_000_000) -> None:
        super().__init__()
        self.encode, self.most, self.most_ids = encode, most, most_ids
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.flat, self.starts, self.used = np.empty(1 << 20, np.int32), np.zeros(1 << 16, np.int64), 0
        self.seen = np.zeros(1 << 16, np.int64)
        self.new: list = []

    def __missing__(self, chunk: str | bytes) -> int:
        k = self[chunk] = len(self)
        self.new.append(chunk)
        return k

    def _add(self, ids: np.ndarray, sizes: np.ndarray, n: int) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while n + len(sizes) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.seen = np.concatenate([self.seen, np.zeros_like(self.seen)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[n + 1 : n + 1 + len(sizes)] = self.used + np.cumsum(sizes)
        self.used += len(ids)

    def _forget(self) -> None:
        n = len(self)
        keep = np.flatnonzero(self.seen[:n] > 1)
        starts = self.starts[keep]
        sizes = self.starts[keep + 1] - starts
        ids, names = gathered(self.flat, starts, sizes), list(self)
        self.clear()
        if len(keep) <= self.most // 2 and len(ids) <= self.most_ids // 2:
            self.update(zip([names[k] for k in keep.tolist()], range(len(keep)), strict=True))
            self._add(ids, sizes, 0)

    def numbers(self, chunks: Iterable, count: int) -> np.ndarray:
        """The number of each chunk; those that were new are encoded. Numbers hold until the next call."""
        if len(self) > self.most or self.used > self.most_ids:
            self._forget()
        before = len(self)
        try:
            which = np.fromiter(map(self.__getitem__, chunks), np.int64, count)
            for i in range(0, len(self.new), 20_000):
                self._add(*self.encode(self.new[i : i + 20_000]), before + i)
        except BaseException:  # numbers without ids must not stay
            self.clear()
            raise
        self.new = []
        self.seen[: len(self)] += np.bincount(which, minlength=len(self))
        return which

    def ids(self, chunks: Iterable, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, one after the other, and how many each has."""
        which = self.numbers(chunks, count)
        starts = self.starts[which]
        sizes = self.starts[which + 1] - starts
        return gathered(self.flat, starts, sizes), sizes


class Encoder:
    """texts -> one flat array of ids and the number of ids of each text."""

    def __init__(self, path: str, *, blanks_matter: bool, words: int = WORDS) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        #: The same model for words that are one pre-token: they come normalised, as byte characters.
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.model.normalizer = self.model.pre_tokenizer = None
        self.blanks_matter = blanks_matter
        # A new word costs a call of the library, a new chunk of known parts only a look-up of these.
        self.words = IdCache(self._encode, most=words)
        self.chunks = IdCache(self._put_together, most=words // 2)

    def _plain(self, word: str) -> str | None:
        """The byte characters of a word of letters only (and a blank before it, where blanks matter), else None."""
        if self.blanks_matter:
            body, first = (word[1:], "\u0120") if word[:1] == " " else (word, "")
            if body.isascii():
                return first + body if body.isalpha() else None
        else:
            body, first = word if word.isascii() else "".join(map(str.lower, unicodedata.normalize("NFC", word))), ""
        if not body.isalpha():
            return None
        return first + (body if body.isascii() else body.encode().decode("latin-1").translate(_BYTE_CHARS))

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = [self._plain(w) for w in words]
        sizes = np.zeros(len(words), np.int64)
        easy = [k for k, w in enumerate(plain) if w is not None]
        parts = [easy[i : i + 200] for i in range(0, len(easy), 200)]
        found = self.model.encode_batch([[plain[k] for k in part] for part in parts], is_pretokenized=True, add_special_tokens=False)
        for part, e in zip(parts, found, strict=True):
            sizes[part] = np.bincount(e.word_ids, minlength=len(part))
        hard = [k for k, w in enumerate(plain) if w is None]
        others = [e.ids for e in self.tokenizer.encode_batch([words[k] for k in hard], add_special_tokens=False)]
        sizes[hard] = [len(x) for x in others]
        ends = np.cumsum(sizes)
        flat, of_hard = np.empty(int(ends[-1]) if len(ends) else 0, np.int32), np.zeros(len(words), bool)
        of_hard[hard] = True
        where = np.repeat(of_hard, sizes)
        flat[~where] = np.fromiter(chain.from_iterable(e.ids for e in found), np.int32)
        flat[where] = np.fromiter(chain.from_iterable(others), np.int32)
        return flat, sizes

    def _put_together(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Chunks as words and the marks behind them: a pre-token never holds a letter or number and marks behind it."""
        parts: list[str] = []
        counts = np.ones(len(chunks), np.int64)
        matter = self.blanks_matter
        for k, c in enumerate(chunks):
            if matter:
                c = c[1:] if c[:1] == _FIRST else " " + c
            word = c.rstrip(_MARKS)
            if len(word) < len(c) and word and word[-1].lower()[-1:].isalnum():
                parts += (word if matter or not word.isascii() else word.lower(), c[len(word) :])
                counts[k] = 2
            else:
                parts.append(c if matter or not c.isascii() else c.lower())
        flat, sizes = self.words.ids(parts, len(parts))
        return flat, summed(sizes, counts)

    def _chunks(self, text: str) -> list[str]:
        if not self.blanks_matter:
            return text.split() if not _CONTROLS.search(text) else [text]
        if _RUN.search(text):
            return [_FIRST + text]
        first, *rest = text.split(" ")
        return [_FIRST + first, *rest] if first else rest

    def __call__(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        split = [self._chunks(t) for t in texts]
        n = np.fromiter(map(len, split), np.int64, len(split))
        flat, sizes = self.chunks.ids(chain.from_iterable(split), int(n.sum()))
        return flat, summed(sizes, n)


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices flat[starts[i] : starts[i] + sizes[i]], one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


def summed(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of values; a run may be empty."""
    sums = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]


_encoders: dict[tuple[str, bool, int], Encoder] = {}


def encoder(path: str, *, blanks_matter: bool, words: int = WORDS) -> Callable[[Sequence[str]], tuple[np.ndarray, np.ndarray]]:
    """The encoder of this worker process for a vocabulary file; its cache outlives a task."""
    key = (path, blanks_matter, words)
    claim(f"encoder {key}", _encoders.clear)
    if key not in _encoders:
        _encoders[key] = Encoder(path, blanks_matter=blanks_matter, words=words)
        give_back()  # what reading the vocabulary took
    return _encoders[key]
