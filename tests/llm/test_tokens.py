"""Byte-level BPE, packing and token files against the public libraries."""

import base64
import bisect
import functools
import hashlib
import random
import uuid
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from opalgrid.llm import bytebpe, common, packing, queries, tokenbin, wordcache

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
LETTERS = list("aésTÜß'dmlrev 123 \n\t.!$ßΣσİǅ日é́\x1c\x00") + [" "] * 8


def library(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@functools.cache
def public():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def reference():
    return public()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=LETTERS, max_size=40), min_size=1, max_size=6))
def test_byte_bpe_is_the_library_s(texts):
    words = bytebpe.vocabulary(RANKS)
    flat, sizes = words.encode(texts)
    for text, ids in zip(texts, np.split(flat, np.cumsum(sizes)[:-1]), strict=True):
        assert ids.tolist() == public().encode_ordinary(text)
        back, offsets = words.decode(ids)
        assert back == text.encode()
        assert all(back[a:].startswith(words.bytes_of[i]) for a, i in zip(offsets, ids, strict=True))


def test_long_words(reference):
    words = bytebpe.vocabulary(RANKS)
    random.seed(5)
    texts = ["a" * 3000, "".join(random.choices("ab", k=2000)), "!" * 500 + "x", ""]
    flat, sizes = words.encode(texts)
    for text, ids in zip(texts, np.split(flat, np.cumsum(sizes)[:-1]), strict=True):
        assert ids.tolist() == reference.encode_ordinary(text)


@pytest.mark.parametrize(("path", "blanks"), [(WORDS, False), (BYTES, True)])
def test_cached_encoder_is_the_library_s(path, blanks):
    random.seed(3)
    encode, own = library(path), wordcache.Encoder(path, blanks_matter=blanks)
    own.words.most = own.chunks.most = 500  # forgets often
    texts = ["".join(random.choices(LETTERS, k=random.randint(0, 60))) for _ in range(1500)] + ["", "x" * 3000, "<|endoftext|> a<|endoftext|>", "ΑΣ ΑΣ. İstanbul Üeİ'", "a  b \n c ", " "]
    for i in range(0, len(texts), 40):
        flat, sizes = own(texts[i : i + 40])
        for text, ids in zip(texts[i : i + 40], np.split(flat, np.cumsum(sizes)[:-1]), strict=True):
            assert ids.tolist() == encode(text), text


def test_byte_bpe_query(spark, small, docs, reference):
    rows = {r.doc_id: r for r in queries.op7_byte_bpe(spark, small).collect()}
    for d in docs.collect():
        ids = np.array(reference.encode_ordinary(d.text), "<u4")
        r = rows[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(d.text.encode()).hexdigest())


def test_byte_bpe_odd(odd, none, reference):
    out = bytebpe.encoded(odd, RANKS).collect()
    expected = Counter((r.doc_id, tuple(reference.encode_ordinary(r.text or ""))) for r in odd.collect())
    assert Counter((r.doc_id, tuple(r.ids)) for r in out) == expected
    assert bytebpe.decoded(bytebpe.encoded(odd, RANKS), RANKS).where("doc_id = 2").first().decoded == b""
    assert bytebpe.round_trip(none, RANKS).count() == 0


def best_fit_decreasing(lengths, capacity):
    rooms, n = [], 0
    for x in sorted(lengths, reverse=True):
        i = bisect.bisect_left(rooms, x)
        room = rooms.pop(i) if i < len(rooms) else capacity
        n += room == capacity
        bisect.insort(rooms, room - x)
    return n, sorted(rooms)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=300), st.integers(50, 120))
def test_plan_is_best_fit_decreasing(lengths, capacity):
    rows = packing.plan(Counter(lengths), capacity)
    fill = Counter()
    ranks = {n: [] for n in lengths}
    for length, rank, n, first, offset in rows:
        ranks[length] += range(rank, rank + n)
        for s in range(first, first + n):
            assert fill[s] == offset
            fill[s] += length
    assert all(sorted(v) == list(range(Counter(lengths)[k])) for k, v in ranks.items())
    n, rooms = best_fit_decreasing(lengths, capacity)
    assert (len(fill), sorted(capacity - v for v in fill.values())) == (n, rooms)


def gapless(rows, capacity=4096):
    ends = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert ends[r.sequence_id] == r.offset
        ends[r.sequence_id] += r.length
    assert max(ends.values(), default=0) <= capacity
    return len(ends)


def test_packing_query(spark, small, docs):
    rows, encode = queries.op2_best_fit_packing(spark, small).collect(), library(WORDS)
    expected, lengths = {}, []
    for d in docs.collect():
        ids = np.array([*encode(d.text), 1], "<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            expected[d.doc_id, k] = (at, len(part), zlib.crc32(part.tobytes()))
            lengths.append(len(part))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected
    assert gapless(rows) == best_fit_decreasing(lengths, 4096)[0]


def test_packing_odd(odd, none):
    rows = packing.pack(odd, WORDS).collect()
    assert gapless(rows) and {r.length for r in rows if r.doc_id in (1, 2, 7)} == {1}
    assert sum(r.doc_id == 3 for r in rows) == 2 and sum(r.length for r in rows if r.doc_id == 8) == 30_001
    assert packing.pack(none, WORDS).count() == 0
    whole = packing.sequences(packing.best_fit(common.cut(packing.pieces(odd, WORDS)))).collect()
    assert all(len(r.ids) == 4 * r.length for r in whole) and sum(r.length for r in whole) == sum(r.length for r in rows)


def test_one_length_for_all(spark):
    rows = packing.best_fit(common.cut(spark.range(5000).selectExpr("id AS doc_id", "0 AS piece", "700L AS length"))).collect()
    assert gapless(rows) == 1000


def test_plan_of_places_needs_no_python_on_executors(spark):
    """The planned intervals are a local relation; as a list of rows they went through Python processes beside the others."""
    placed = packing.best_fit(spark.range(50).selectExpr("id AS doc_id", "0 AS piece", "id * 80 + 1 AS length"))
    assert "ExistingRDD" not in placed._jdf.queryExecution().executedPlan().toString()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**20), max_size=30), max_size=8))
def test_file_round_trip(lists):
    ids = np.array([x for y in lists for x in y], np.int64)
    blob = tokenbin.encoded(np.arange(len(lists)), np.zeros(len(lists), bool), np.array([len(x) for x in lists], np.int64), ids)
    doc_ids, missing, sizes, back = tokenbin.decoded(blob)
    assert doc_ids.tolist() == list(range(len(lists))) and sizes.tolist() == [len(x) for x in lists]
    assert back.tolist() == ids.tolist() and not missing.any()


def test_token_files_query(spark, small, docs):
    rows, encode, at = {r.doc_id: r for r in queries.op8_token_files(spark, small).collect()}, library(BYTES), 0
    for d in sorted(docs.collect(), key=lambda d: d.doc_id):
        ids = np.array([*encode(d.text), 2], "<u4")
        assert (rows[d.doc_id].start, rows[d.doc_id].n_tokens, rows[d.doc_id].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_token_files_odd(spark, odd, none):
    encode = library(BYTES)
    for docs, n in ((odd, 11), (none, 0)):
        folder = f"{common.scratch(spark)}/odd-{uuid.uuid4().hex}"
        files = common.cut(tokenbin.write(docs, folder, BYTES, ids_each=1000))
        rows = tokenbin.with_starts(tokenbin.read(spark, folder), files).collect()
        assert len(rows) == n
        rows.sort(key=lambda r: r.start)
        ends = [r.start + r.n_tokens for r in rows]
        assert [r.start for r in rows] == [0, *ends[:-1]] if rows else True
        ids = [(-1 if r.doc_id is None else r.doc_id) for r in rows]
        assert ids == sorted(ids)
        expected = Counter((d.doc_id, tuple([*encode(d.text), 2])) for d in docs.collect())
        assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in rows) == expected


def test_pieces_without_length_get_no_place(spark):
    rows = spark.createDataFrame([(1, 0, 5), (2, 0, None), (3, 0, 0), (4, 0, 4092), (2, 0, None)], "doc_id long, piece int, length long")
    found = sorted((r.doc_id, r.sequence_id, r.offset) for r in packing.best_fit(rows).na.fill(-1).collect())
    assert [x[0] for x in found] == [1, 2, 2, 3, 4]
    assert [x[1] >= 0 for x in found] == [True, False, False, False, True]
