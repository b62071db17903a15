"""Queries against their SQL on tables that end in the middle of a position, a frame and a pair of channels."""

import os

import duckdb
import pytest

from opalgrid.operators import blocks
from opalgrid.plans import registry
from tests.test_queries import TABLES, Counter, plain

ODD = ["a11_ratio", "a36_pearson", "a37_manders_fold", "a38_rwc", "a39_costes", "j04_channel_pairs", "u02_measure", "u06_default_profile", "j15_tile_pixels", "t07_padded_tiles", "t08_drift_corrected_tiles", "t10_otsu", "w10_latest"]


@pytest.fixture(scope="module")
def odd(small, tmp_path_factory):
    """The small tables, of embeddings the first 42 rows: the last object has one channel, its position one frame."""
    folder = str(tmp_path_factory.mktemp("odd"))
    for t in TABLES:
        where = " WHERE vec_id < 42" if t == "embeddings" else ""
        duckdb.sql(f"COPY (SELECT * FROM '{small}/{t}.parquet'{where}) TO '{folder}/{t}.parquet' (FORMAT parquet)")
    return folder


@pytest.mark.parametrize("name", ODD)
def test_odd(spark, odd, name):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(odd, t)}.parquet'")
    df = registry.QUERIES[name](spark, odd)
    rows = Counter(tuple(map(plain, r)) for r in df.collect())
    listed = ", ".join(f'"{c}"' for c in df.columns)
    assert rows == Counter(tuple(map(plain, r)) for r in db.sql(f"SELECT {listed} FROM ({registry.SQL[name]})").fetchall())


def test_otsu_takes_the_lowest_of_equal_thresholds(spark):
    """Bins 4 and 7 part the image equally well; sums of doubles in their own order say that 7 does better."""
    count = {0: 2, 2: 5, 4: 2, 7: 5, 14: 1, 15: 1}
    values = [float(b) for b, n in count.items() for _ in range(n)]
    values[-1] = 16.0
    pixels = spark.createDataFrame([(1, 0, 0, 0, 0, x, v) for x, v in enumerate(values)], "position long, tp int, c int, z int, y int, x int, value double")
    assert blocks.otsu(pixels).first().threshold == 5.0
