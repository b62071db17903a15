"""Files through a decoder, metadata from two sources, frames that come twice, and the hook for models, by value."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from opalgrid.operators import profiles
from opalgrid.sources import catalog, logs
from opalgrid.streaming import frames


def test_decoders_give_rows_or_frames(spark, tmp_path):
    """Sub-folders are read; an empty file has no rows, and files that the pattern leaves out are not read."""
    (tmp_path / "in").mkdir()
    for name, content in (("a.raw", b"\x01\x02"), ("in/b.raw", b"\x03"), ("empty.raw", b""), ("c.txt", b"\x09")):
        (tmp_path / name).write_bytes(content)
    files = catalog.contents(spark, str(tmp_path), "*.raw")
    as_rows = catalog.decoded(files, lambda b: list(enumerate(b)), "x int, value long")
    as_frame = catalog.decoded(files, lambda b: pd.DataFrame({"i": np.arange(len(b)), "v": np.frombuffer(b, np.uint8)}), "x int, value long")
    for df in (as_rows, as_frame):
        assert df.dtypes == [("path", "string"), ("x", "int"), ("value", "bigint")]
        assert sorted((r.path.split("/")[-1], r.x, r.value) for r in df.collect()) == [("a.raw", 0, 1), ("a.raw", 1, 2), ("b.raw", 0, 3)]


def test_decoder_of_nulls_and_of_no_files(spark):
    files = spark.createDataFrame([("a", None), ("b", bytearray(b"\x05"))], "path string, content binary")
    ones = lambda df: catalog.decoded(df, lambda b: [(len(b),)], "n int").collect()
    assert [tuple(r) for r in ones(files)] == [("b", 1)]
    assert ones(files.limit(0)) == []


def test_the_second_source_is_preferred(spark):
    """A null value of the second source counts as its value; null keys meet."""
    schema = "file int, key string, value string"
    first = spark.createDataFrame([(1, "a", "old"), (1, "b", "old"), (2, None, "old"), (3, "a", "old")], schema)
    second = spark.createDataFrame([("new", "a", 1), ("new", None, 2), (None, "a", 3), ("new", "z", 9)], "value string, key string, file int")
    found = {(r.file, r.key): r.value for r in logs.preferred(first, second, ["file", "key"]).collect()}
    assert found == {(1, "a"): "new", (1, "b"): "old", (2, None): "new", (3, "a"): None, (9, "z"): "new"}


def test_frames_count_once_within_the_watermark(spark, tmp_path):
    """The same frame in one file, in two files and in two runs; other columns come from its first row."""
    rows = spark.createDataFrame([(p, tp, 1_600_000_000 + tp * 60) for p in (1, 2) for tp in range(5)], "position long, tp int, s int").select("position", "tp", F.timestamp_seconds("s").alias("ts"))
    stream = lambda: frames.unique_frames(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"))
    for _ in range(2):
        rows.union(rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        frames.run_to_table(stream(), f"{tmp_path}/out", f"{tmp_path}/state")
    found = spark.read.schema(rows.schema).parquet(f"{tmp_path}/out").select("position", "tp").collect()
    assert sorted(map(tuple, found)) == [(p, tp) for p in (1, 2) for tp in range(5)]


def test_a_model_scores_batches(spark):
    """Each vector's scores are the model's, whatever batch it is in; rows without vector have none."""
    vectors = [[float(i), 1.0, -2.0 * i] for i in range(25)]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)] + [(99, None)], "id int, vec array<double>").repartition(3)
    found = {r.id: r.embedding for r in profiles.scored_tiles(rows, profiles.projection(2, 3)).collect()}
    weights = profiles.projection(2, 3)(np.eye(3))
    assert found.pop(99) is None and len(found) == 25
    assert all(np.allclose(found[i], np.array(v) @ weights) for i, v in enumerate(vectors))
    assert profiles.scored_tiles(rows.where("id < 0"), profiles.projection(2, 3)).collect() == []
    assert {r.embedding for r in profiles.scored_tiles(rows.where("id = 99"), profiles.projection(2, 3)).collect()} == {None}
