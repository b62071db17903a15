"""From long measurements to wide profiles, and the tables they are stored in."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opalgrid.operators.features import KEYS
from opalgrid.operators.graphs import shared_folder


def metric_name(*parts: object) -> str:
    """Parts joined by slashes; a pair of channels prints as (a, b)."""
    return "/".join(f"({p[0]}, {p[1]})" if isinstance(p, tuple) else str(p) for p in parts)


def metric_column(channel: Column, *parts: Column) -> Column:
    return F.concat_ws("/", channel.cast("string"), *parts)


def profile(measurements: DataFrame, names: list[str], keys: list[str] | None = None) -> DataFrame:
    """One row for each object, a column for each name in order; absent ones are null. Of several values the last by ord
    counts, or the largest where there is no ord."""
    last = F.max_by("value", "ord") if "ord" in measurements.columns else F.max("value")
    return measurements.groupBy(*(keys or KEYS)).pivot("metric", sorted(names)).agg(last)


def with_metadata(rows: DataFrame, step: str) -> DataFrame:
    """Columns renamed to metadata_*, with the object (what follows the last underscore of the step)."""
    named = rows.withColumnsRenamed({"tile": "metadata_tile", "label": "metadata_label", "tp": "metadata_tp"})
    return named.withColumn("metadata_object", F.substring_index(F.lit(step), "_", -1))


def overlap_profile(measurements: DataFrame, relabel: DataFrame, names: list[str]) -> DataFrame:
    """profile, with labels mapped back through relabel (tile, tp, label -> old_label)."""
    back = measurements.join(relabel, ["position", "tile", "tp", "label"]).withColumn("label", F.col("old_label")).drop("old_label")
    return profile(back, names)


def expanded(vectors: DataFrame, size: int, vec: str = "vec") -> DataFrame:
    """Columns X_0.. of a vector column."""
    rest = [c for c in vectors.columns if c != vec]
    return vectors.select(*rest, *[F.get(vec, F.lit(i)).cast("double").alias(f"X_{i}") for i in range(size)])


def joined_families(first: DataFrame, *others: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The first family's rows with the columns of the others where they have them."""
    out = first
    for other in others:
        out = out.join(other, keys or KEYS, "left")
    return out


def stacked(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def histogram(rows: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Bins of equal width from the least to the largest value: bin (from 0), n."""
    low, high = (F.broadcast(rows.agg(F.min(value).alias("_low"), F.max(value).alias("_high"))), None)
    placed = rows.where(F.col(value).isNotNull()).join(low)
    at = F.least(F.lit(bins - 1), F.floor(F.coalesce(F.try_divide(F.col(value) - F.col("_low"), F.col("_high") - F.col("_low")), F.lit(0.0)) * bins))
    return placed.groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


# Sinks -----------------------------------------------------------------------------------------------------------------


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: Rows of a frame that one chunk of the mask store holds.
CHUNK = 256
FRAME = ["position", "tp", "tile"]


def write_masks(masks: DataFrame, path: str) -> str:
    """Masks (position, tile, tp, y, x, label) as run-length chunks: a row for each tile, frame and CHUNK rows of pixels, with its
    extent, number of pixels and runs (y, x, n, label). A repeated pixel counts once.

    Files hold ranges of position, tp and tile, in order, so that Parquet's statistics tell which chunks a read needs.
    """
    line = Window.partitionBy(*FRAME, "label", "y").orderBy("x")
    runs = masks.select(*FRAME, "label", "y", "x").distinct().withColumn("_start", F.col("x") - F.row_number().over(line))
    runs = runs.groupBy(*FRAME, "label", "y", "_start").agg(F.min("x").alias("x"), F.count("*").cast("int").alias("n"))
    chunks = runs.groupBy(*FRAME, F.floor(F.col("y") / CHUNK).cast("int").alias("chunk")).agg(
        F.min("y").alias("least_y"), F.max("y").alias("most_y"), F.min("x").alias("least_x"), F.max(F.col("x") + F.col("n") - 1).alias("most_x"), F.sum("n").alias("pixels"),
        F.sort_array(F.collect_list(F.struct("y", "x", "n", "label"))).alias("runs"),
    )
    chunks.repartitionByRange(*FRAME, "chunk").sortWithinPartitions(*FRAME, "chunk").write.mode("overwrite").parquet(path)
    return path


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunks of write_masks. Conditions on position, tile, tp and extents reach the files."""
    run = "runs array<struct<y: int, x: int, n: int, label: int>>"
    return spark.read.schema(f"position long, tp int, tile int, chunk int, least_y int, most_y int, least_x int, most_x int, pixels long, {run}").parquet(path)


def pixels_of(chunks: DataFrame) -> DataFrame:
    """position, tile, tp, y, x, label of chunks."""
    runs = chunks.select("position", "tile", "tp", F.inline("runs"))
    return runs.select("position", "tile", "tp", "y", F.explode(F.sequence("x", F.col("x") + F.col("n") - 1)).alias("x"), "label")


def write_table(df: DataFrame, path: str, by: list[str], mode: str = "overwrite") -> str:
    """A Parquet table partitioned by columns; with overwrite, only the partitions that df has are replaced."""
    df.write.partitionBy(*by).option("compression", "zstd").option("partitionOverwriteMode", "dynamic").mode(mode).parquet(path)
    return path


def write_ranges(df: DataFrame, path: str, order: list[str], by: list[str] | None = None) -> str:
    """A Parquet table in ranges of columns of many values, of which a folder each would be too many: Parquet's statistics tell
    which files hold a value. by: columns of few values, with a folder each."""
    writer = df.repartitionByRange(*(by or []), *order).sortWithinPartitions(*(by or []), *order).write
    (writer.partitionBy(*by) if by else writer).option("compression", "zstd").mode("overwrite").parquet(path)
    return path


def read_table(spark: SparkSession, path: str, schema: DataFrame) -> DataFrame:
    return spark.read.schema(schema.schema).parquet(path).select(schema.columns)


def append_checked(new: DataFrame, path: str, known: dict[str, str], by: list[str]) -> str:
    """Appends to a typed table; columns that it does not know, or of other types, are an error."""
    wrong = {f.name: f.dataType.simpleString() for f in new.schema if known.get(f.name) != f.dataType.simpleString()}
    if wrong:
        raise ValueError(f"not in the table's schema: {wrong}")
    return write_table(new, path, by, "append")


def upserted(stored: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """stored, and the rows of new whose key (path and timepoint) is not stored yet: what is there stays."""
    return stored.unionByName(new.join(stored.select(*key).distinct(), key, "left_anti"))


def unfinished(positions: DataFrame, done: DataFrame) -> DataFrame:
    return positions.join(done.select("position").distinct(), "position", "left_anti")


def saved_steps(rows: DataFrame, every: int, steps: list[str]) -> DataFrame:
    return rows.where((F.col("tp") % every == 0) & F.col("step").isin(steps))


def latest(rows: DataFrame, n: int, by: list[str]) -> DataFrame:
    """Rows of the last n timepoints of each group."""
    return rows.withColumn("_k", F.dense_rank().over(Window.partitionBy(*by).orderBy(F.desc("tp")))).where(F.col("_k") <= n).drop("_k")


def attributes(rows: DataFrame) -> DataFrame:
    """file and a map of its attributes, from rows file, key, value."""
    return rows.groupBy("file").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "value")))).alias("meta"))


def preferred_source(rows: DataFrame, ranks: dict[str, int], keys: list[str]) -> DataFrame:
    """Rows of the best source of each key, by rank; sources without a rank are left out."""
    rank = F.lit(None).cast("int")
    for name, k in ranks.items():
        rank = F.when(F.col("source") == name, k).otherwise(rank)
    best = F.min("_rank").over(Window.partitionBy(*keys))
    return rows.withColumn("_rank", rank).where("_rank IS NOT NULL").withColumn("_best", best).where("_rank = _best").drop("_rank", "_best")


# Hooks for models ------------------------------------------------------------------------------------------------------


def scored_tiles(rows: DataFrame, fn: Callable[[np.ndarray], np.ndarray], vec: str = "vec") -> DataFrame:
    """rows with embedding: what a model makes of batches of vectors (rows by components); null where there is no vector."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known = batch[vec].notna()
            scores = iter(np.asarray(fn(np.array(batch[vec][known].tolist(), float)), float) if known.any() else ())
            yield batch.drop(columns=vec).assign(embedding=pd.Series([next(scores) if k else None for k in known], batch.index, object))

    rest = [f for f in rows.schema if f.name != vec]
    return rows.mapInPandas(run, ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rest), "embedding array<double>"]))


def projection(components: int, size: int, seed: int = 1) -> Callable[[np.ndarray], np.ndarray]:
    """A fixed random projection: a stand-in for a model."""
    matrix = np.random.default_rng(seed).normal(size=(size, components)) / np.sqrt(size)
    return lambda x: x @ matrix


def chosen_channels(planes: DataFrame, order: list[int]) -> DataFrame:
    """Rows of some channels, numbered by their place in the list."""
    places = F.create_map(*[F.lit(v) for k, c in enumerate(order) for v in (c, k)])
    return planes.where(F.col("c").isin(order)).withColumn("ord", F.element_at(places, F.col("c")))


def global_step(masks: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A function over all stored masks of each position, ordered by time."""
    return masks.groupBy("position").applyInPandas(lambda part: fn(part.sort_values(["tp", "y", "x"])), schema)


def validated(steps: list[dict]) -> list[str]:
    """Problems of a job's steps: unknown inputs, a save interval under 1, fewer than 2 kept frames for a tracker."""
    names = {s["name"] for s in steps}
    out = [f"{s['name']} needs {i}, which is no step" for s in steps for i in s.get("needs", []) if i not in names]
    out += [f"{s['name']}: save_interval is under 1" for s in steps if s.get("save_interval", 1) < 1]
    return out + [f"{s['name']}: a tracker needs 2 kept frames" for s in steps if s["name"].startswith("track") and s.get("retain", 2) < 2]
