"""Sinks of many positions, and frames followed without a data frame for each."""

import os

import numpy as np

from opalgrid.operators import profiles
from opalgrid.streaming import frames


def test_a_sink_has_files_by_ranges_not_by_positions(spark, tmp_path):
    df = spark.range(4_000).selectExpr("id DIV 4 AS position", "id AS n", "'sizes' AS output")
    for by in (None, ["output"]):
        path = profiles.write_ranges(df, f"{tmp_path}/{'wide' if by else 'plain'}", ["position"], by)
        assert sum(f.endswith(".parquet") for _, _, names in os.walk(path) for f in names) <= 8  # 1,000 positions
        assert sorted(map(tuple, profiles.read_table(spark, path, df).collect())) == sorted(map(tuple, df.collect()))


def test_follow_takes_arrays(spark):
    at = lambda *p: tuple(np.array(v, np.int64) for v in zip(*p, strict=True))
    last = {"tp": -1, "pixels": {}, "most": 0}
    found = [o.values.tolist() for o in frames.follow({0: at((0, 0, 1), (0, 1, 1), (5, 5, 2)), 1: at((0, 0, 7), (0, 1, 8), (5, 5, 9), (5, 5, 3)), 3: at((0, 0, 1))}, last, 0.25)]
    # Labels 7 and 8 overlap track 1 alike: the lesser goes on with it. Of the pixel that comes twice the first counts.
    assert found == [[[0, 1, 1], [0, 2, 2]], [[1, 7, 1], [1, 8, 3], [1, 9, 2]], [[3, 1, 4]]]
