"""Importance resampling against a plain reading of its definition."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from opalgrid.llm import resampling


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def runs_of(text, n):
    w = words_of(text)
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def plainly(docs, target, n=1, least=20, percent=10):
    s, t = Counter(b for _, x in docs for b in runs_of(x, n)), Counter(b for x in target for b in runs_of(x, n))
    S, T = sum(s.values()), sum(t.values())
    out = []
    for i, x in docs:
        f = runs_of(x, n)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in f)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(x)) >= least))
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    drawn = percent * len(able) // 100
    ranks = [(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(able)]
    return sorted([*ranks, *[(*r[:4], None) for r in out if not r[4]]], key=str)


def rows(df):
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_features(n):
    rng = random.Random(n)
    texts = ["", "One", "a1 B2;c3 ÀÉ 日本語 " + "Z" * 100, *("".join(rng.choices("abAZ09 _-é\x00\x7f", k=rng.randrange(80))) for _ in range(60))]
    found, owner, n_words = resampling.features(texts, n)
    assert [sorted(found[owner == i].tolist()) for i in range(len(texts))] == [sorted(runs_of(t, n)) for t in texts]
    assert n_words.tolist() == [len(words_of(t)) for t in texts]


def test_draw(spark, small, docs):
    target = spark.read.parquet(f"{small}/benchmark.parquet")
    want = plainly([(r[0], r[1]) for r in docs.select("doc_id", "text").collect()], [r[0] for r in target.select("text").collect()])
    assert rows(resampling.resampled(docs, target)) == want


def test_draw_odd(spark, odd, none):
    pairs = [(r[0], r[1]) for r in odd.select("doc_id", "text").collect()]
    assert rows(resampling.resampled(odd, odd, least=1, percent=70)) == plainly(pairs, [x for _, x in pairs], least=1, percent=70)
    assert rows(resampling.resampled(odd, none, words=2, least=2, percent=100)) == plainly(pairs, [], n=2, least=2, percent=100)
    assert rows(resampling.resampled(none, odd)) == []


@pytest.mark.parametrize("bits,block", [(3, 16), (12, 1 << 18), (5, 1000)])
def test_radix_ranks(spark, bits, block):
    rng = random.Random(bits)
    made = [(rng.choice([None, *range(-40, 40), 2**60]), i, i, rng.randrange(-30, 30)) for i in range(900)]
    df = spark.createDataFrame(made, "doc_id long, n_features long, weight long, score long").repartition(7)
    got = [tuple(r) for r in resampling.ranked(df, 900, bits=bits, block=block).orderBy("rank").collect()]
    assert [r[4] for r in got] == list(range(1, 901))
    assert sorted(r[1] for r in got) == list(range(900))
    key = [(-r[3], r[0] is not None, r[0] or 0) for r in got]
    assert key == sorted(key)
