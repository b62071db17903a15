"""Zernike moments of all degrees that the survey names."""

from pyspark.sql import functions as F

from opalgrid.operators import features


def test_degree_nine(spark):
    objects = spark.range(25).select(F.lit(1).cast("long").alias("position"), F.lit(0).alias("tile"), F.lit(0).alias("tp"), F.lit(1).alias("label"), F.lit(0).alias("c"), (F.col("id") / 5).cast("int").alias("y"), (F.col("id") % 5).cast("int").alias("x"), F.col("id").cast("double").alias("v"))
    for value in (None, F.col("v")):
        row = features.zernike(objects, value=value).first().asDict()
        assert {k for k in row if k.startswith("zernike_")} == {f"zernike_{n}_{m}" for n in range(10) for m in range(n % 2, n + 1, 2)}
        assert row["zernike_9_9"] is not None and row["zernike_0_0"] > 0
