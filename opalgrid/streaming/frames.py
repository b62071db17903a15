"""Frames as a stream: first write wins, and tracking with state."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

TRACKS = "position long, tile int, tp int, label int, track int"
#: Column with who wrote a row and when; column with how many rows the writer says the frame has.
WRITER, ROWS = "_writer", "frame_rows"
#: Parts of the list of frames, of which a batch reads those that its frames fall into.
BUCKETS = 64


def announced(frames: DataFrame) -> DataFrame:
    """frames with the number of rows of each frame (position, tp), so that a reader knows when it has all of them."""
    return frames.join(frames.groupBy("position", "tp").agg(F.count("*").alias(ROWS)), ["position", "tp"])


def read_masks(spark: SparkSession, path: str, schema: Any, files: int = 1) -> DataFrame:
    """A stream of stored masks, some files at a time, with their writer: the job that wrote a file, which its name tells,
    or else the file itself."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    job = F.regexp_extract("_metadata.file_path", r"part-\d+-([0-9a-f]{8}-[0-9a-f-]{27})", 1)
    by = F.when(job != "", job).otherwise(F.col("_metadata.file_path"))
    return stream.withColumn(WRITER, F.struct(F.col("_metadata.file_modification_time").alias("at"), by.alias("by"), F.col("_metadata.file_path").alias("file")))


def _found(spark: SparkSession, path: str, schema: Any) -> DataFrame:
    """The table at path, or none of its rows if there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def _removed(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def append_new_frames(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Appends frames (position, tp) that are not in the table at path yet, until the stream has no more.

    A frame may come in many files and batches. Where its rows tell how many there are (see announced), they wait beside the
    table until all of one writer have come; of several writers that are complete, the one that began first is taken. Where
    they do not tell, the first writer's rows count as they come. All other writers' rows are dropped: the first write wins.

    Each batch has a folder of its own, which a batch that is run again replaces. Beside the table lies a list of its frames,
    their writers and files in parts, of which a batch reads those that it needs; no batch reads the table.
    """
    run = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex[:12]
    listed, waiting = path.rstrip("/") + "-frames", path.rstrip("/") + f"-waiting-{run}"
    frame = ["position", "tp"]

    def write(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        told = F.col(ROWS) if ROWS in batch.columns else F.lit(None).cast("long")
        rows = batch.unionByName(_found(spark, f"{waiting}/{n - 1}", batch.schema)).withColumn("_bucket", F.pmod(F.hash(*frame), F.lit(BUCKETS)))
        rows = rows.persist()
        parts = [r[0] for r in rows.select("_bucket").distinct().collect()]  # at most BUCKETS
        have = _found(spark, listed, "position long, tp int, by string, file string, batch string, bucket int").where(F.col("bucket").isin(parts) & (F.col("batch") != f"{run}-{n}"))
        have = have.select(*frame, F.col("by").alias("_by"), "file").persist()
        came = rows.groupBy(*frame, f"{WRITER}.by").agg(F.min(f"{WRITER}.at").alias("at"), F.count("*").alias("n"), F.max(told).alias("told"))
        whole = came.where("told IS NULL OR n >= told").join(have, frame, "left_anti")
        new = whole.groupBy(*frame).agg(F.min(F.struct("at", "by"))["by"].alias("_by"))
        owners = new.unionByName(have.drop("file").distinct())
        # Of a frame that is there already, only more files of its writer may follow, and only if it did not tell how many rows.
        mine = rows.join(owners, frame).where(F.col(f"{WRITER}.by") == F.col("_by")).withColumn("file", F.col(f"{WRITER}.file")).join(have.drop("_by"), [*frame, "file"], "left_anti")
        taken = mine.join(have.select(*frame, F.lit(True).alias("_there")).distinct(), frame, "left").where(told.isNull() | F.col("_there").isNull())
        taken.select(*[c for c in batch.columns if c not in (WRITER, ROWS)]).write.mode("overwrite").parquet(f"{path}/batch={run}-{n}")
        rows.join(owners, frame, "left_anti").select(*batch.columns).write.mode("overwrite").parquet(f"{waiting}/{n}")
        taken.select(*frame, F.col("_by").alias("by"), "file", F.col("_bucket").alias("bucket")).distinct().write.mode("overwrite").partitionBy("bucket").parquet(f"{listed}/batch={run}-{n}")
        _removed(spark, f"{waiting}/{n - 2}")
        have.unpersist()
        rows.unpersist()

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def read_frames(spark: SparkSession, path: str, schema: Any) -> DataFrame:
    """The table that append_new_frames fills."""
    return spark.read.schema(schema).parquet(path).drop("batch")


def _link(y: np.ndarray, x: np.ndarray, label: np.ndarray, last: dict, least: float) -> dict[int, int]:
    """label -> track of a frame, given the last frame's pixels and tracks: best overlap, each track continued once."""
    track = np.fromiter((last["pixels"].get(p, -1) for p in zip(y.tolist(), x.tolist(), strict=True)), np.int64, len(y))
    both = track >= 0
    if not both.any():
        return {}
    pairs, shared = np.unique(np.stack([label[both], track[both]], axis=1), axis=0, return_counts=True)
    a, b = Counter(label.tolist()), Counter(last["pixels"].values())
    found = [(n / (a[v] + b[t] - n), v, t) for (v, t), n in zip(pairs.tolist(), shared.tolist(), strict=True)]
    best: dict[int, tuple[float, int]] = {}
    for iou, v, t in sorted(found, key=lambda f: (f[1], -f[0], f[2])):
        best.setdefault(v, (iou, t))
    taken: dict[int, int] = {}
    for v, (iou, t) in sorted(best.items(), key=lambda e: (-e[1][0], e[0])):
        if iou >= least:
            taken.setdefault(t, v)
    return {v: t for t, v in taken.items()}


def follow(frames: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], last: dict, least: float) -> Iterator[pd.DataFrame]:
    """Tracks of frames (y, x, label) in order; last (tp, pixels, most) is brought up to date. New objects get fresh numbers.
    Of a pixel that comes twice the first counts."""
    for tp in sorted(frames):
        y, x, label = frames[tp]
        once = np.sort(np.unique(np.stack([y, x], axis=1), axis=0, return_index=True)[1])
        y, x, label = y[once], x[once], label[once]
        known = _link(y, x, label, last if tp == last["tp"] + 1 else last | {"pixels": {}}, least)
        for v in sorted(set(label.tolist()) - set(known)):
            last["most"] += 1
            known[v] = last["most"]
        last["tp"] = tp
        last["pixels"] = {(r, c): known[v] for r, c, v in zip(y.tolist(), x.tolist(), label.tolist(), strict=True)}
        yield pd.DataFrame({"tp": tp, "label": sorted(known), "track": [known[k] for k in sorted(known)]})


def tracked(masks: DataFrame, least: float = 0.25) -> DataFrame:
    """position, tile, tp, label, track of masks, batch: each tile's frames are followed in order, in one pass."""

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        last = {"tp": -(10**9), "pixels": {}, "most": 0}
        out = list(follow({int(t): tuple(f[c].to_numpy(np.int64) for c in ("y", "x", "label")) for t, f in part.groupby("tp")}, last, least))
        rows = pd.concat(out) if out else pd.DataFrame({"tp": [], "label": [], "track": []})
        return rows.assign(position=key[0], tile=key[1])[["position", "tile", "tp", "label", "track"]]

    return masks.groupBy("position", "tile").applyInPandas(run, TRACKS)


def with_markers(masks: DataFrame, pixels: DataFrame, tiles: DataFrame) -> DataFrame:
    """masks and, for each tile (position, tile) and each tp of its position's pixels, a marker: a row without y, x and label
    that tells how many pixels the frame has, none if it is empty."""
    own = ["position", "tile", "tp"]
    marks = pixels.select("position", "tp").distinct().join(tiles.select("position", "tile").distinct(), "position")
    sizes = masks.select(*own, "y", "x", "label").distinct().groupBy(*own).agg(F.count("*").alias(ROWS))
    none = F.lit(None).cast("int")
    marks = marks.join(sizes, own, "left").select(*own, none.alias("y"), none.alias("x"), none.alias("label"), F.coalesce(ROWS, F.lit(0)).alias(ROWS))
    return masks.select(*own, "y", "x", "label", F.lit(None).cast("long").alias(ROWS)).unionByName(marks)


class Tracker(StatefulProcessor):
    """Follows the frames of one tile as they come. State: the last frame's number, how many tracks there are, the last
    frame's pixels with their tracks, and for each frame that waits the pixels so far and how many it has."""

    def __init__(self, first_tp: int, least: float, told: bool) -> None:
        self.first_tp, self.least, self.told = first_tp, least, told  # told: whether markers come

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.at = handle.getValueState("at", "tp int, most int")
        self.pixels = handle.getListState("pixels", "y int, x int, track int")
        self.early = handle.getMapState("early", "tp int", "y array<int>, x array<int>, label array<int>, told long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        tp, most = self.at.get() if self.at.exists() else (self.first_tp - 1, 0)
        came = pd.concat([r[["tp", "y", "x", "label", *[ROWS] * self.told]] for r in rows])
        for t, part in came[came["tp"] > tp].groupby("tp"):
            y, x, label, told = self.early.getValue((int(t),)) if self.early.containsKey((int(t),)) else ([], [], [], None)
            data = part[part["label"].notna()]
            both = pd.DataFrame({"y": [*y, *data["y"]], "x": [*x, *data["x"]], "label": [*label, *data["label"]]}).astype(int).drop_duplicates()
            marks = part[ROWS].dropna() if self.told else []
            told = int(marks.iloc[0]) if len(marks) else told
            self.early.updateValue((int(t),), (both["y"].tolist(), both["x"].tolist(), both["label"].tolist(), told))
        last = None
        while self.early.containsKey((tp + 1,)):
            y, x, label, told = self.early.getValue((tp + 1,))
            if self.told and (told is None or len(y) < told):
                break
            if last is None:
                last = {"tp": tp, "pixels": {(p[0], p[1]): p[2] for p in self.pixels.get()} if self.pixels.exists() else {}, "most": most}
            tp += 1
            self.early.removeKey((tp,))
            for out in follow({tp: tuple(np.array(v, np.int64) for v in (y, x, label))}, last, self.least):
                if len(out):
                    yield out.assign(position=key[0], tile=key[1])[["position", "tile", "tp", "label", "track"]]
        if last is not None:
            self.at.update((last["tp"], last["most"]))
            if last["pixels"]:
                self.pixels.put([(y, x, t) for (y, x), t in last["pixels"].items()])
            else:
                self.pixels.clear()

    def close(self) -> None:
        pass


def tracked_stream(stream: DataFrame, first_tp: int = 0, least: float = 0.25) -> DataFrame:
    """The same over a stream (see with_markers), with state for each tile. A frame is followed once its marker and all rows
    that the marker tells of have come, in whatever order and batches, and all frames before it from first_tp on; one that comes
    again is skipped. In a stream without markers, what comes of a frame in one batch is the whole frame. Needs the RocksDB
    state store (see run_to_table)."""
    tracker = Tracker(first_tp, least, ROWS in stream.columns)
    return stream.groupBy("position", "tile").transformWithStateInPandas(tracker, TRACKS, "append", "None")


def run_to_table(df: DataFrame, path: str, checkpoint: str) -> None:
    """Writes a streaming result to a Parquet table until its source has no more."""
    name, spark = "spark.sql.streaming.stateStore.providerClass", df.sparkSession
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        _until_done(df, path, checkpoint)
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def _until_done(df: DataFrame, path: str, checkpoint: str) -> None:
    df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def unique_frames(stream: DataFrame, minutes: int = 10) -> DataFrame:
    """Rows with a time column ts, the first of each (position, tp) within the watermark.

    Rows that come later than it are left out, as are rows of 1970 or before: there the watermark starts."""
    return stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", f"{minutes} minutes").dropDuplicatesWithinWatermark(["position", "tp"])
