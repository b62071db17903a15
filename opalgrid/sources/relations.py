"""The data model's relations, derived from the given tables by Spark, and the same derivations in SQL for checks.

pixels, masks, signals, cell_info, lineage, merges, picks, frames, files, log_lines, vectors, tiles, drifts: see the README.
Each is a lazy DataFrame; nothing is read before a query needs it.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class Relations:
    """Lazy relations over the Parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def pixels(self) -> DataFrame:
        v = F.col("vec_id")
        return self.table("embeddings").select(
            F.expr("CAST(vec_id DIV 20 AS BIGINT)").alias("position"), F.expr("CAST((vec_id DIV 4) % 5 AS INT)").alias("tp"),
            F.expr("CAST((vec_id DIV 2) % 2 AS INT)").alias("c"), (v % 2).cast("int").alias("z"), F.posexplode("embedding").alias("pos", "v"),
        ).select("position", "tp", "c", "z", F.expr("CAST(pos DIV 8 AS INT)").alias("y"), (F.col("pos") % 8).cast("int").alias("x"), F.col("v").cast("double").alias("value"))

    @cached_property
    def masks(self) -> DataFrame:
        label = F.when(F.col("y") >= 4, 2).otherwise(0) + F.when(F.col("x") >= 4, 1).otherwise(0) + 1
        inside = (F.col("c") == 0) & (F.col("z") == 0) & (F.abs("value") >= 0.05)
        return self.pixels.where(inside).select("position", F.lit(0).alias("tile"), "tp", "y", "x", label.cast("int").alias("label"))

    @cached_property
    def signals(self) -> DataFrame:
        day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
        keys = self.table("events").select(
            F.concat(F.lit("extraction/"), "event_type").alias("path"), (F.col("user_id") % 10).cast("int").alias("trap"),
            F.expr("CAST(user_id DIV 10 + 1 AS INT)").alias("cell_label"), day.cast("int").alias("tp"), "value",
        )
        return keys.groupBy("path", "trap", "cell_label", "tp").agg(F.round(F.avg("value"), 6).alias("value"))

    @cached_property
    def cell_info(self) -> DataFrame:
        mother = F.when(F.col("tp") < 10, 0).otherwise(F.expr("cell_label DIV 2")).cast("int")
        seen = self.signals.where("path = 'extraction/view'")
        return seen.select("trap", "cell_label", F.col("tp").alias("timepoint"), mother.alias("mother_assign_dynamic")).distinct()

    @cached_property
    def lineage(self) -> DataFrame:
        rows = self.cell_info.where("cell_label > 1")
        return rows.select("trap", F.expr("CAST(cell_label DIV 2 AS INT)").alias("mother_label"), F.col("cell_label").alias("daughter_label")).distinct()

    @cached_property
    def merges(self) -> DataFrame:
        a = self.cell_info.select("trap", F.col("cell_label").alias("left_label")).distinct().where("left_label % 4 = 1 OR left_label % 8 = 2")
        b = self.cell_info.select("trap", F.col("cell_label").alias("right_label")).distinct()
        return a.withColumn("right_label", F.col("left_label") + 1).join(b, ["trap", "right_label"]).select("trap", "left_label", "right_label")

    @cached_property
    def picks(self) -> DataFrame:
        return self.cell_info.where("cell_label % 3 = 0").select("trap", "cell_label").distinct()

    @cached_property
    def frames(self) -> DataFrame:
        mothers = F.transform(F.sequence(F.lit(1), F.max("cell_label")), lambda i: F.floor(i / 2).cast("int"))
        return self.cell_info.groupBy(F.col("trap").alias("tile"), F.col("timepoint").alias("tp")).agg(F.sort_array(F.collect_list("cell_label")).alias("cell_label"), mothers.alias("mother_assign"))

    @cached_property
    def files(self) -> DataFrame:
        well = F.when(F.col("user_id") % 3 == 0, "A").when(F.col("user_id") % 3 == 1, "B").otherwise("C")
        end = F.when(F.col("event_id") % 7 == 0, ".txt").otherwise(".tif")
        path = F.concat(
            F.lit("/data/plate"), (F.col("user_id") % 2).cast("string"), F.lit("/img__"), well, F.lpad((F.col("user_id") % 12 + 1).cast("string"), 2, "0"),
            F.lit("__"), (F.col("event_id") % 2 + 1).cast("string"), F.lit("__"), "event_type", end,
        )
        return self.table("events").select(path.alias("path")).distinct()

    @cached_property
    def log_lines(self) -> DataFrame:
        k = F.col("o_orderkey")
        text = (
            F.when(k % 4 == 0, F.concat(F.lit("interval: "), (k % 500).cast("string")))
            .when(k % 4 == 1, F.concat(F.lit("GFP,GFP,0,"), (k % 90).cast("string"), F.lit(",5,0.6,PIFOC")))
            .when(k % 4 == 2, "-----Acquisition settings-----")
            .otherwise(F.concat(F.lit("Run Name: "), "o_orderpriority"))
        )
        return self.table("orders").select((F.col("o_custkey") % 50).alias("file"), k.alias("line"), text.alias("text"))

    @cached_property
    def vectors(self) -> DataFrame:
        return self.table("embeddings").select(F.expr("CAST(vec_id DIV 5 AS INT)").alias("tile"), (F.col("vec_id") % 5).cast("int").alias("tp"), F.lit(0).alias("label"), F.col("embedding").alias("vec"))

    @cached_property
    def tiles(self) -> DataFrame:
        p = F.col("position")
        return self.pixels.select("position").distinct().select("position", (p % 3).cast("int").alias("tile"), (p % 5 - 1).cast("int").alias("y0"), (p % 7 - 1).cast("int").alias("x0"), F.lit(4).alias("h"), F.lit(4).alias("w"))

    @cached_property
    def drifts(self) -> DataFrame:
        rows = self.pixels.where("c = 0 AND z = 0").groupBy("position", "tp")
        return rows.agg(F.round(F.max("value") * 4, 3).alias("dy"), F.round(F.min("value") * 4, 3).alias("dx"))

    @cached_property
    def objects(self) -> DataFrame:
        """Pixels of every object in every channel, largest over z: position, tile, tp, label, c, y, x, v."""
        from opalgrid.operators.features import object_pixels, reduce_z

        return object_pixels(self.masks, reduce_z(self.pixels, "max"))

    def numbered(self, df: DataFrame, *order: str) -> DataFrame:
        return df.withColumn("ord", F.row_number().over(Window.partitionBy("trap").orderBy(*order)))


#: The same derivations in DuckDB's SQL.
SQL = {
    "pixels": """SELECT CAST(vec_id // 20 AS BIGINT) AS position, CAST((vec_id // 4) % 5 AS INT) AS tp, CAST((vec_id // 2) % 2 AS INT) AS c,
 CAST(vec_id % 2 AS INT) AS z, CAST((i-1) // 8 AS INT) AS y, CAST((i-1) % 8 AS INT) AS x, CAST(embedding[i] AS DOUBLE) AS value FROM embeddings, range(1, 65) r(i)""",
    "masks": """SELECT position, 0 AS tile, tp, y, x, CAST((CASE WHEN y >= 4 THEN 2 ELSE 0 END) + (CASE WHEN x >= 4 THEN 1 ELSE 0 END) + 1 AS INT) AS label
 FROM pixels WHERE c = 0 AND z = 0 AND abs(value) >= 0.05""",
    "signals": """SELECT concat('extraction/', event_type) AS path, CAST(user_id % 10 AS INT) AS trap, CAST(user_id // 10 + 1 AS INT) AS cell_label,
 CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INT) AS tp, round(avg(value), 6) AS value FROM events GROUP BY 1, 2, 3, 4""",
    "cell_info": """SELECT DISTINCT trap, cell_label, tp AS timepoint, CAST(CASE WHEN tp < 10 THEN 0 ELSE cell_label // 2 END AS INT) AS mother_assign_dynamic
 FROM signals WHERE path = 'extraction/view'""",
    "lineage": "SELECT DISTINCT trap, CAST(cell_label // 2 AS INT) AS mother_label, cell_label AS daughter_label FROM cell_info WHERE cell_label > 1",
    "merges": """SELECT DISTINCT a.trap, a.cell_label AS left_label, b.cell_label AS right_label FROM cell_info a JOIN cell_info b
 ON a.trap = b.trap AND b.cell_label = a.cell_label + 1 WHERE a.cell_label % 4 = 1 OR a.cell_label % 8 = 2""",
    "picks": "SELECT DISTINCT trap, cell_label FROM cell_info WHERE cell_label % 3 = 0",
    "frames": """SELECT trap AS tile, timepoint AS tp, list_sort(list(cell_label)) AS cell_label,
 list_transform(range(1, max(cell_label) + 1), lambda i: CAST(i // 2 AS INT)) AS mother_assign FROM cell_info GROUP BY 1, 2""",
    "files": """SELECT DISTINCT concat('/data/plate', CAST(user_id % 2 AS VARCHAR), '/img__', CASE user_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END,
 lpad(CAST(user_id % 12 + 1 AS VARCHAR), 2, '0'), '__', CAST(event_id % 2 + 1 AS VARCHAR), '__', event_type,
 CASE WHEN event_id % 7 = 0 THEN '.txt' ELSE '.tif' END) AS path FROM events""",
    "log_lines": """SELECT o_custkey % 50 AS file, o_orderkey AS line, CASE o_orderkey % 4 WHEN 0 THEN concat('interval: ', CAST(o_orderkey % 500 AS VARCHAR))
 WHEN 1 THEN concat('GFP,GFP,0,', CAST(o_orderkey % 90 AS VARCHAR), ',5,0.6,PIFOC') WHEN 2 THEN '-----Acquisition settings-----'
 ELSE concat('Run Name: ', o_orderpriority) END AS text FROM orders""",
    "vectors": "SELECT CAST(vec_id // 5 AS INT) AS tile, CAST(vec_id % 5 AS INT) AS tp, 0 AS label, embedding AS vec FROM embeddings",
    "tiles": "SELECT DISTINCT position, CAST(position % 3 AS INT) AS tile, CAST(position % 5 - 1 AS INT) AS y0, CAST(position % 7 - 1 AS INT) AS x0, 4 AS h, 4 AS w FROM pixels",
    "drifts": "SELECT position, tp, round(max(value) * 4, 3) AS dy, round(min(value) * 4, 3) AS dx FROM pixels WHERE c = 0 AND z = 0 GROUP BY 1, 2",
    "flat": "SELECT position, tp, c, y, x, max(value) AS v FROM pixels GROUP BY ALL",
    "objects": "SELECT m.position, m.tile, m.tp, m.label, p.c, p.y, p.x, p.v FROM masks m JOIN flat p USING (position, tp, y, x)",
    "captures": r"""SELECT path, regexp_extract(path, '.*__([A-Z][0-9]{2})__([0-9])__([A-Za-z]+)\.tif', 1) AS well, regexp_extract(path, '.*__([A-Z][0-9]{2})__([0-9])__([A-Za-z]+)\.tif', 2) AS field,
 regexp_extract(path, '.*__([A-Z][0-9]{2})__([0-9])__([A-Za-z]+)\.tif', 3) AS channel FROM files WHERE regexp_matches(path, '^.*__([A-Z][0-9]{2})__([0-9])__([A-Za-z]+)\.tif')""",
    "tracks": "SELECT DISTINCT trap, cell_label FROM cell_info",
    "views": "SELECT trap, cell_label, tp, value FROM signals WHERE path = 'extraction/view'",
    "last_mothers": "SELECT trap, cell_label, arg_max(mother_assign_dynamic, timepoint) AS mother FROM cell_info GROUP BY 1, 2",
    "sizes": "SELECT position, tile, tp, label, CAST(count(*) AS BIGINT) AS n FROM masks GROUP BY ALL",
}


def with_relations(sql: str) -> str:
    """sql with the relations that it names, and those that they name, as common table expressions before it."""
    need: list[str] = []

    def visit(text: str) -> None:
        for name in SQL:
            if name not in need and re.search(rf"(?i)\b(from|join|,)\s+{name}\b", text):
                visit(SQL[name])
                if name not in need:
                    need.append(name)

    visit(sql)
    if not need:
        return sql
    heads = ",\n".join(f"{name} AS ({SQL[name]})" for name in need)
    own = re.match(r"\s*WITH (RECURSIVE )?", sql)
    return f"WITH {own[1] or ''}{heads},\n{sql[own.end() :]}" if own else f"WITH {heads}\n{sql}"
