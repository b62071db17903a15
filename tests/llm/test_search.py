"""Archive audit and nearest neighbours against brute force."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from opalgrid.llm import common, neighbours, queries, warc


def test_records_and_offsets(spark, small):
    rows = {r.page_id: r for r in warc.leaves(warc.records(spark.read.parquet(f"{small}/pages.parquet"))).collect()}
    at = 0
    for p in sorted(spark.read.parquet(f"{small}/pages.parquet").collect(), key=lambda p: p.page_id):
        body = p.html.encode()
        record = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: {p.url}\r\nContent-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
        r = rows[p.page_id]
        assert (r.offset, r.length, r.digest) == (at, len(record), hashlib.sha256(record).hexdigest())
        at += len(record)


def test_audit_finds_each_damage(spark, small):
    a = warc.leaves(warc.records(spark.read.parquet(f"{small}/pages.parquet"), pages_each=16))
    ids = F.col("page_id")
    digest = F.when(ids.isin(3, 33), F.lit("0" * 64)).otherwise(F.col("digest"))
    b = common.cut(a).where(ids != 10).withColumns({"digest": digest, "length": F.when(ids == 33, F.col("length") - 1).otherwise(F.col("length"))})
    extra = b.where(ids == 20).withColumns({"offset": F.col("offset") + 1, "page_id": F.lit(-1).cast("long")})
    found = {(r.page_id, r.damage) for r in warc.audit(a, b.unionByName(extra)).collect()}
    assert found == {(3, "changed"), (33, "cut"), (10, "missing"), (-1, "extra")}
    assert warc.audit(a, a).count() == 0
    roots = [dict(warc.roots(x).collect()) for x in (a, b)]
    assert sum(roots[0][f] != roots[1][f] for f in roots[0]) == 2


def test_audit_odd(spark):
    pages = spark.createDataFrame([(None, None, None), (1, "u", ""), (1, "u", ""), (2, None, "x" * 100_000)], "page_id long, url string, html string").withColumn("record", F.lit(1))
    rows = warc.records(pages)
    a = common.cut(warc.leaves(rows))
    assert a.count() == 4 and a.select("file", "offset").distinct().count() == 4
    assert warc.audit(a, a.where("page_id = 1")).where("damage = 'missing'").count() == 2
    none = warc.leaves(warc.records(pages.limit(0)))
    assert warc.audit(none, none).count() == 0


def test_offsets_without_or_with_repeated_ids(spark, tmp_path):
    """Records without id, of one id, and equal records lie side by side; a replica without damage shows none."""
    pages = [(None, "u", "a" * 50), (None, "v", "b" * 70), (None, "u", "a" * 50), (1, "u", "c"), (1, "w", "d" * 9), (1, "u", "c"), (2, "x", "e")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    rows = warc.leaves(warc.records(spark.read.parquet(f"{tmp_path}/pages.parquet"))).collect()
    assert len(rows) == len(pages)
    for file in {r.file for r in rows}:
        own = sorted((r for r in rows if r.file == file), key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0, *(r.length for r in own[:-1])]).tolist()
        assert [r.page_id or 0 for r in own] == sorted(r.page_id or 0 for r in own)
    assert queries.op5_merkle_audit(spark, str(tmp_path)).count() == 0


def brute(rows, queries_, k=5):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in queries_:
        i = int(np.flatnonzero(ids == q)[0])
        s = np.round(x @ x[i], 12)
        out[q] = [(int(ids[j]), float(s[j])) for j in np.lexsort((ids, -s)) if j != i][:k]
    return out


def test_recall(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    expected = brute(rows, [i for i, _ in rows if i % 50 == 0])
    found = queries.op10_posting_lists(spark, folder).collect()
    hits = sum((r.vec_id in {i for i, _ in expected[r.query_id]}) for r in found)
    assert hits >= 0.9 * sum(map(len, expected.values()))
    for r in found:
        if r.vec_id in dict(expected[r.query_id]):
            assert abs(r.score - dict(expected[r.query_id])[r.vec_id]) < 1e-9


def test_walk_finds_the_nearest_centroids(spark):
    import pandas as pd

    x = np.random.default_rng(0).normal(size=(4000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lists = neighbours.fit(pd.DataFrame({"unit": list(x)}), 200)
    ids, apart = lists.near(x[:200], 10)
    true = np.argsort(1 - x[:200] @ lists.centroids.T, axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) for a, b in zip(ids, true, strict=True)]) > 8.5
    assert (np.diff(apart, axis=1) >= -1e-12).all()
    sizes = np.bincount(ids[:, 0], minlength=200)
    assert sizes.max() < 15


def test_the_ratio_alone_selects_lists(spark):
    import pandas as pd

    x = np.random.default_rng(1).normal(size=(6000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lists = neighbours.fit(pd.DataFrame({"unit": list(x)}), 600)
    true = np.sqrt(2 - 2 * x[:50] @ lists.centroids.T)
    true = true <= true.min(axis=1, keepdims=True) * neighbours.RATIO
    rows, found = lists.within(x[:50], neighbours.RATIO)
    got = np.zeros_like(true)
    got[rows, found] = True
    assert true.sum(axis=1).max() > 96 and not (got & ~true).any()
    assert got.sum() > 0.97 * true.sum()
    assert len(rows) == got.sum()


def test_recall_stays_as_vectors_grow(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(400, 24))
    for n in (4_000, 16_000):
        x = centres[rng.integers(0, 400, n)] + rng.normal(size=(n, 24))
        rows = list(enumerate(x.tolist()))
        expected = brute(rows, range(0, n, n // 40))
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        found = neighbours.nearest(df, f"vec_id % {n // 40} = 0").collect()
        hits = sum(r.vec_id in dict(expected[r.query_id]) for r in found)
        assert hits >= 0.9 * sum(map(len, expected.values())), n


def test_few_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (50, [0.0, 1.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, None]), (8, [1.0, 1.0]), (None, [1.0, 0.0]), (9, [1.0]), (8, [1.0, 1.0]), (100, [nan, nan])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("list", F.lit(1))
    found = neighbours.nearest(df, "vec_id % 50 = 0").collect()
    got = {q: [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] for q in (0, 50, 100)}
    assert got == {0: [1, 2, 8, 50], 50: [8, 0, 1, 2], 100: []}
    assert neighbours.nearest(df.limit(0), "vec_id % 50 = 0").count() == 0


def test_queries_on_a_centroid_get_k_neighbours(spark):
    """Two far groups; a few vectors apart from both: their own list holds fewer than k others."""
    rng = np.random.default_rng(8)
    lone = [[0.0, 0.0, 1.0], [0.0, 0.001, 1.0]]
    rows = list(enumerate([*lone, *([1.0, *(0.01 * rng.normal(size=2)).tolist()] for _ in range(300)), *([0.01, 1.0, 0.01 * rng.normal()] for _ in range(300))]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(df, "vec_id < 2", lists=40).collect()
    expected = brute(rows, [0, 1])
    for q in (0, 1):
        assert [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] == [i for i, _ in expected[q]]


def test_hot_vector(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [1.0] * 8 if i % 3 == 0 else rng.normal(size=8).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    expected = brute(rows, [i for i in range(0, 900, 50)])
    found = neighbours.nearest(df, "vec_id % 50 = 0").collect()
    for q in (0, 150, 300):  # queries that are copies: the smallest other ids, at cosine 1
        assert [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] == [i for i, _ in expected[q]]


def test_an_id_with_several_vectors_counts_once(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(200)]
    rows += [(i, rng.normal(size=6).tolist()) for i in range(0, 200, 3)] + rows[:20]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id % 50 = 0").collect()
    least = {i: min(v for j, v in rows if j == i) for i, _ in rows}
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in least.items()}
    for q in (0, 50, 100, 150):
        mine = [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q]
        assert len(mine) == len(set(mine)) == 5
        assert all(r.score == pytest.approx(float(unit[q] @ unit[r.vec_id]), abs=1e-9) for r in got if r.query_id == q)


def test_a_query_makes_rows_by_shelves_not_by_lists(spark, monkeypatch):
    """Lists that stand together answer a query with one set of rows; where it reads all, that is right to the last."""
    monkeypatch.setattr(neighbours, "SHELF", 600)
    rng = np.random.default_rng(11)
    rows = list(enumerate(rng.normal(size=(2_000, 16)).tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(df, "vec_id % 50 = 0", lists=60, ratio=float("inf")).collect()
    expected = brute(rows, range(0, 2_000, 50))
    assert len(found) == 200 and all(r.vec_id in dict(expected[r.query_id]) for r in found)

    sizes = {i: 100 for i in range(50)} | {50: 1_500}
    first, many = neighbours.shelves(sizes, 51)
    assert many[50] == 3 and (many[:50] == 1).all() and first[50] == first[:50].max() + 1
    assert max(np.bincount(first[:50])) * 100 <= 600
    index = neighbours.fit(pd.DataFrame({"unit": [*(rng.normal(size=(2_000, 16)))]}), 51)
    batch = pd.DataFrame({"entry": range(20), "vector": [v for _, v in rows[:20]]})
    read = pd.concat(neighbours._read(iter([batch]), index, float("inf"), first, many))
    assert len(read) == 20 * (first[50] + 3)  # a row for each shelf
    assert sum(map(len, read["lists"])) == 20 * (50 + 3)
