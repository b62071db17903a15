"""Tracking as a stream against its batch twin."""

import os

from pyspark.sql import functions as F

from opalgrid.streaming import frames


def test_empty_frames_hold_nothing_up(spark, tmp_path):
    """A tile without any mask pixel at tp 1."""
    rows = [(1, 0, tp, y, x, 1) for tp in (0, 2, 3) for y in (2, 3) for x in (2, 3)] + [(1, 1, tp, 5, 5, 1) for tp in range(4)]
    masks = spark.createDataFrame(rows, "position long, tile int, tp int, y int, x int, label int")
    pixels = spark.range(4).select(F.lit(1).cast("long").alias("position"), F.col("id").cast("int").alias("tp"))
    marked = frames.with_markers(masks, pixels, masks)
    marked.repartition(2, "tp").write.parquet(f"{tmp_path}/in")
    frames.run_to_table(frames.tracked_stream(frames.read_masks(spark, f"{tmp_path}/in", marked.schema)), f"{tmp_path}/out", f"{tmp_path}/state")
    key = ("position", "tile", "tp", "label", "track")
    found = sorted(spark.read.schema(frames.TRACKS).parquet(f"{tmp_path}/out").select(*key).collect())
    assert found == sorted(frames.tracked(masks).select(*key).collect()) and len(found) == 7


def test_first_write_wins_within_a_batch(spark, tmp_path):
    """Two files bring the same frame in one micro-batch: the earlier one's rows count, all of them, and no other."""
    schema = "position long, tile int, tp int, y int, x int, label int"
    frame = lambda tp, label, n: spark.createDataFrame([(1, 0, tp, y, 0, label) for y in range(n)], schema).coalesce(1)
    for k, (tp, label, n) in enumerate([(0, 1, 3), (0, 2, 5), (1, 1, 2)]):
        frame(tp, label, n).write.parquet(f"{tmp_path}/made{k}")
        (part,) = (tmp_path / f"made{k}").glob("part-*")
        (tmp_path / "in").mkdir(exist_ok=True)
        part.rename(tmp_path / "in" / f"{k}.parquet")
        os.utime(tmp_path / "in" / f"{k}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    for run in range(2):  # the second stream brings nothing new
        frames.append_new_frames(frames.read_masks(spark, f"{tmp_path}/in", schema, 100), f"{tmp_path}/out", f"{tmp_path}/state{run}")
    found = frames.read_frames(spark, f"{tmp_path}/out", schema).groupBy("tp", "label").count().collect()
    assert sorted(map(tuple, found)) == [(0, 1, 3), (1, 1, 2)]


def split(df, path, n, mode="append"):
    df.repartition(n).write.mode(mode).parquet(path)


def test_frames_over_several_files_and_batches(spark, tmp_path):
    """Every file of a frame's first writer counts, in one batch or in many; another writer's rows, a second stream over the same
    files, and a batch that is run again change nothing."""
    schema = "position long, tile int, tp int, y int, x int, label int"
    masks = spark.createDataFrame([(1, 0, tp, y, y, 1) for tp in range(3) for y in range(20)], schema)
    for told in (True, False):
        rows = frames.announced(masks) if told else masks
        source, out = f"{tmp_path}/in{told}", f"{tmp_path}/out{told}"
        split(rows, source, 5)
        stream = lambda files, source=source, rows=rows: frames.read_masks(spark, source, rows.schema, files)
        frames.append_new_frames(stream(2), out, f"{tmp_path}/one{told}")
        split(rows.withColumn("label", F.lit(9)), source, 3)
        frames.append_new_frames(stream(1), out, f"{tmp_path}/one{told}")  # goes on with new files only
        frames.append_new_frames(stream(100), out, f"{tmp_path}/two{told}")  # another stream reads all again
        assert sorted(frames.read_frames(spark, out, masks.schema).collect()) == sorted(masks.collect())


def test_a_writer_that_never_ends_does_not_win(spark, tmp_path):
    """A frame waits until all of one writer's rows have come; half of a frame is never shown."""
    masks = spark.createDataFrame([(1, 0, 0, y, y, 1) for y in range(6)], "position long, tile int, tp int, y int, x int, label int")
    rows, source, out = frames.announced(masks), f"{tmp_path}/in", f"{tmp_path}/out"
    split(rows.where("y < 3").withColumn("label", F.lit(7)), source, 1)
    stream = lambda: frames.read_masks(spark, source, rows.schema, 1)
    frames.append_new_frames(stream(), out, f"{tmp_path}/state")
    assert frames.read_frames(spark, out, masks.schema).count() == 0
    split(rows, source, 2)
    frames.append_new_frames(stream(), out, f"{tmp_path}/state")
    assert sorted(frames.read_frames(spark, out, masks.schema).collect()) == sorted(masks.collect())


def test_markers_and_rows_in_any_order(spark, tmp_path):
    """Markers a batch before their rows, after them, and frames out of order: all as in a batch."""
    rows = [(1, tile, tp, y + tp, x, 1) for tile in (0, 1) for tp in range(5) for y in (2, 3, 4) for x in (2, 3) if (tile, tp) != (1, 2)]
    masks = spark.createDataFrame(rows, "position long, tile int, tp int, y int, x int, label int")
    pixels = spark.range(5).select(F.lit(1).cast("long").alias("position"), F.col("id").cast("int").alias("tp"))
    marked = frames.with_markers(masks, pixels, masks)
    marks, data = marked.where("label IS NULL"), marked.where("label IS NOT NULL")
    key = ("position", "tile", "tp", "label", "track")
    want = sorted(frames.tracked(masks).select(*key).collect())
    for k, parts in enumerate(([marks, data], [data, marks], [data.where("tp > 2"), marks.where("tp < 3"), data.where("y % 2 = 0 AND tp < 3"), marks.where("tp > 2"), data.where("y % 2 = 1 AND tp < 3"), data])):
        for part in parts:
            split(part.coalesce(1), f"{tmp_path}/in{k}", 1)
        frames.run_to_table(frames.tracked_stream(frames.read_masks(spark, f"{tmp_path}/in{k}", marked.schema)), f"{tmp_path}/out{k}", f"{tmp_path}/state{k}")
        assert sorted(spark.read.schema(frames.TRACKS).parquet(f"{tmp_path}/out{k}").select(*key).collect()) == want
