"""Closures over edges: connected components by alternating stars, running totals over ranges."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a temporary one serves only where all run on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    kept = spark.sparkContext._jsc.sc().getCheckpointDir()
    if kept.isEmpty():
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        kept = spark.sparkContext._jsc.sc().getCheckpointDir()
    return kept.get().rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def running_total(df: DataFrame, order: list[Column | str], value: Column, name: str) -> DataFrame:
    """df with the sum of value over all rows before, in the order of columns that no two rows share: ranges of rows are
    summed apart, and one row for each range is ordered."""
    ranged = df.withColumn("_value", value).repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    kept = checkpointed(ranged)  # ranges are drawn by a sample, so they are kept
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = kept.groupBy("_part").agg(F.sum("_value").alias("_sum")).select("_part", F.coalesce(F.sum("_sum").over(upto), F.lit(0)).alias("_first"))
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = kept.withColumn("_own", F.coalesce(F.sum("_value").over(within), F.lit(0))).join(sums, "_part")
    return placed.withColumn(name, F.col("_first") + F.col("_own")).drop("_part", "_value", "_own", "_first")


#: Nodes with more edges than this, and than the SHARE-th part of all, are hubs; so there are at most 2 * SHARE hubs.
HUB, SHARE = 50_000, 10_000


def _starred(both: DataFrame, edges: int, small: bool, hub: int) -> DataFrame:
    """One half-round over edges (a, b), each in both directions. Of a node's neighbours and itself take the least: its greater
    neighbours (large star), or its lesser ones and itself (small star), are linked to that."""
    some = both.where("b < a") if small else both
    least = some.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count("*").alias("n"))
    many = F.col("n") > max(hub, edges // SHARE)
    hubs, rest = F.broadcast(least.where(many).select("a", "m")), least.where(~many).select("a", "m")
    # A hub's edges learn the least from a broadcast, where they are; only those of other nodes meet by node.
    rows = some.join(hubs, "a", "left").withColumnRenamed("m", "_hub")
    met = rows.where("_hub IS NOT NULL").select("a", "b", F.col("_hub").alias("m")).unionByName(rows.where("_hub IS NULL").join(rest, "a").select("a", "b", "m"))
    if not small:
        return met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b")


def components(edges: DataFrame, hub: int = HUB) -> DataFrame:
    """node, component (its least node) of the edges (a, b).

    Rounds of a large and a small star each, until edges stay the same: every node is linked to its component's least then.
    A round's sign (number and digest of its edges) is gathered while they are kept, so it takes no job of its own.
    """
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    now = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    count, sign = now.count(), None
    turned = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    while count:
        large = checkpointed(_starred(turned(now), 2 * count, False, hub).distinct())
        watch = Observation()
        small = _starred(turned(large), 2 * count, True, hub).distinct()
        now = checkpointed(small.observe(watch, F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")))
        count, before, sign = watch.get["n"], sign, (watch.get["n"], watch.get["h"])
        if sign == before:
            break
    return nodes.join(now.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").withColumn("component", F.coalesce("component", "node"))


def merged_sets(rows: DataFrame, item: str, group: str) -> DataFrame:
    """item, component: groups that share an item become one."""
    node = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    found = components(rows.select(node("g", group).alias("a"), node("i", item).alias("b")))
    items = rows.select(F.col(item), node("i", item).alias("node")).distinct()
    return items.join(found, "node").select(item, "component")
