"""All queries of the profiling engine by name, with the SQL that gives the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opalgrid.operators import blocks as B
from opalgrid.operators import features as M
from opalgrid.operators import graphs as G
from opalgrid.operators import profiles as P
from opalgrid.operators import tracks as T
from opalgrid.plans import feature_sql as Q
from opalgrid.sources import catalog as C
from opalgrid.sources import logs as L
from opalgrid.sources.relations import Relations, with_relations
from opalgrid.streaming import frames as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

K = M.KEYS
NAME = r".*__([A-Z][0-9]{2})__([0-9])__([A-Za-z]+)\.tif"


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a function of the relations under a name; sql may name relations and tables."""

    def add(fn: Callable[[Relations], DataFrame]) -> Callable:
        @functools.wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Relations(spark, folder))

        QUERIES[name] = run
        if sql:
            SQL[name] = with_relations(sql)
        return fn

    return add


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, so that sums in another order are equal; a zero has no sign."""
    return df.select(*[(F.round(f.name, places) + F.lit(0.0)).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name) for f in df.schema])


def r6(expression: str, name: str) -> str:
    return f"round({expression}, 6) + 0.0 AS {name}"


KEYS = "position, tile, tp, label"

# Objects ---------------------------------------------------------------------------------------------------------------

for _id, _name, _sql in (
    ("a01", "area", "CAST(count(*) AS DOUBLE)"), ("a09", "centroid_x", "avg(x + 1)"), ("a09b", "centroid_y", "avg(y + 1)"),
    ("a12", "spherical_volume", "4.0 / 3 * pi() * pow(count(*) / pi(), 1.5)"),
):
    query(f"{_id}_{_name}", f"SELECT {KEYS}, {r6(_sql, _name)} FROM masks GROUP BY ALL")(lambda r, n=_name: rounded(M.mask_metrics(r.masks, [n])))

for _id, _name, _sql in (
    ("a02", "mean", "avg(v)"), ("a03", "total", "sum(v)"), ("a04", "total_squared", "sum(v * v)"), ("a07", "median", "median(v)"), ("a08", "std", "stddev_pop(v)"),
):
    query(f"{_id}_{_name}", f"SELECT {KEYS}, c, {r6(_sql, _name)} FROM objects GROUP BY {KEYS}, c")(lambda r, n=_name: rounded(M.pixel_metrics(r.objects, [n])))

query("a05_max2p5pc", f"""SELECT {KEYS}, c, {r6('avg(v)', 'max2p5pc')} FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS}, c ORDER BY v DESC) AS k, count(*) OVER (PARTITION BY {KEYS}, c) AS n FROM objects)
 WHERE k <= ceil(n * 0.025) GROUP BY {KEYS}, c""")(lambda r: rounded(M.top_share(r.objects)))
query("a06_max5px_median", f"""SELECT {KEYS}, c, {r6('CASE WHEN count(*) > 5 THEN avg(v) FILTER (k <= 5) / nullif(median(v), 0) END', 'max5px_median')}
 FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS}, c ORDER BY v DESC) AS k FROM objects) GROUP BY {KEYS}, c""")(lambda r: rounded(M.top5_median(r.objects)))
#: Where the sum of values is within rounding of zero, the quotient says nothing: null.
query("a10_moment_of_inertia", f"""SELECT {KEYS}, c, CASE WHEN abs(sum(v)) >= 0.001 THEN round((sum((x+1.0)*(x+1.0)*v) - sum((x+1.0)*v)*sum((x+1.0)*v)/sum(v) + sum((y+1.0)*(y+1.0)*v) - sum((y+1.0)*v)*sum((y+1.0)*v)/sum(v))
 / (sum(v)*sum(v)), 3) + 0.0 END AS moment_of_inertia FROM objects GROUP BY {KEYS}, c""")(
    lambda r: rounded(M.pixel_metrics(r.objects, ["moment_of_inertia", "total"]).withColumn("moment_of_inertia", F.when(F.abs("total") >= 0.001, F.col("moment_of_inertia"))).drop("total"), 3)
)
PAIRS = f"SELECT {KEYS}, y, x, max(v) FILTER (c = 0) AS v0, max(v) FILTER (c = 1) AS v1 FROM objects GROUP BY {KEYS}, y, x"
query("a11_ratio", f"SELECT {KEYS}, {r6('CASE WHEN bool_or(v1 = 0) THEN NULL ELSE median(v0 / nullif(v1, 0)) END', 'ratio')} FROM ({PAIRS}) GROUP BY ALL")(lambda r: rounded(M.ratio(M.two_channels(r.objects, 0, 1))))
DISTANCE = f"""SELECT {', '.join('m.' + k for k in K)}, m.y, m.x, sqrt(min((m.y - o.oy) * (m.y - o.oy) + (m.x - o.ox) * (m.x - o.ox))) AS d FROM masks m JOIN
 (SELECT DISTINCT {KEYS}, y + dy AS oy, x + dx AS ox FROM masks, (VALUES (-1, 0), (1, 0), (0, -1), (0, 1)) s(dy, dx)
  EXCEPT SELECT {KEYS}, y, x FROM masks) o USING ({KEYS}) GROUP BY ALL"""
query("a13_distance_map", f"SELECT {KEYS}, y, x, {r6('d', 'd')} FROM ({DISTANCE})")(lambda r: rounded(M.distance_map(r.masks)))
query("a14_conical_volume", f"SELECT {KEYS}, {r6('4 * sum(d)', 'conical_volume')} FROM ({DISTANCE}) GROUP BY ALL")(lambda r: rounded(M.conical_volume(r.masks)))
query("a15_min_maj_eccentricity_volume", Q.rounded("shape"))(lambda r: rounded(M.shape_metrics(r.masks)))
OUTSIDE = "SELECT f.* FROM flat f WHERE NOT EXISTS (SELECT 1 FROM masks m WHERE m.position = f.position AND m.tp = f.tp AND m.y = f.y AND m.x = f.x)"
query("a16_eccentricity", f"SELECT {KEYS}, eccentricity FROM ({Q.rounded('shape')})")(lambda r: rounded(M.shape_metrics(r.masks).select(*K, "eccentricity")))
query("a17_volume", f"SELECT {KEYS}, volume FROM ({Q.rounded('shape')})")(lambda r: rounded(M.shape_metrics(r.masks).select(*K, "volume")))
query("a18_background", f"SELECT position, tp, c, {r6('median(v)', 'background')} FROM ({OUTSIDE}) GROUP BY ALL")(lambda r: rounded(M.background(r.masks, M.reduce_z(r.pixels, "max")).drop("background_max5")))
query("a19_background_max5", f"SELECT position, tp, c, {r6('avg(v)', 'background_max5')} FROM (SELECT *, row_number() OVER (PARTITION BY position, tp, c ORDER BY v DESC) AS k FROM ({OUTSIDE})) WHERE k <= 5 GROUP BY ALL")(
    lambda r: rounded(M.background(r.masks, M.reduce_z(r.pixels, "max")).drop("background"))
)
query("a20_localisation", Q.rounded("localisation", f"{KEYS}, c"))(lambda r: rounded(M.localisation(r.masks, M.reduce_z(r.pixels, "max"))))
query("a21_nuc_est_conv", f"SELECT {KEYS}, c, nuc_est_conv FROM ({Q.rounded('localisation', f'{KEYS}, c')})")(lambda r: rounded(M.localisation(r.masks, M.reduce_z(r.pixels, "max")).select(*K, "c", "nuc_est_conv")))
query("a22_nuc_conv_3d")(lambda r: rounded(M.localisation_3d(r.masks, r.pixels)))
for _fun, _sql in (("max", "max(value)"), ("add", "sum(value)"), ("mean", "avg(value)"), ("median", "median(value)"), ("div", "max(value) FILTER (z = 0) / nullif(max(value) FILTER (z = 1), 0)")):
    query(f"a23_reduce_z_{_fun}", f"SELECT position, tp, c, y, x, {r6(_sql, 'v')} FROM pixels GROUP BY ALL")(lambda r, f=_fun: rounded(M.reduce_z(r.pixels, f)))
for _fun, _sql in (("add", "a.v + b.v"), ("max", "greatest(a.v, b.v)"), ("div", "a.v / nullif(b.v, 0)")):
    query(f"a24_channels_{_fun}", f"SELECT position, tp, -1 AS c, y, x, {r6(_sql, 'v')} FROM flat a JOIN flat b USING (position, tp, y, x) WHERE a.c = 0 AND b.c = 1")(lambda r, f=_fun: rounded(M.combine_channels(M.reduce_z(r.pixels, "max"), 0, 1, f)))
query("a30_sizeshape", Q.rounded("sizeshape"))(lambda r: rounded(M.sizeshape(r.masks)))
query("a31_intensity", f"""SELECT {KEYS}, c, {r6('sum(v)', 'integrated')}, {r6('avg(v)', 'mean')}, {r6('stddev_pop(v)', 'std')}, {r6('min(v)', 'min')}, {r6('max(v)', 'max')}, {r6('quantile_cont(v, 0.25)', 'lower_quartile')},
 {r6('median(v)', 'median')}, {r6('quantile_cont(v, 0.75)', 'upper_quartile')}, {r6('mad(v)', 'mad')} FROM objects GROUP BY {KEYS}, c""")(lambda r: rounded(M.intensity(r.objects).drop("mass_displacement")))
query("a31b_intensity_edge", Q.rounded("intensity", f"{KEYS}, c"))(lambda r: rounded(M.intensity(r.objects, r.masks)))
query("a32_feret_max", f"SELECT {KEYS}, feret_max FROM ({Q.rounded('feret')})")(lambda r: rounded(M.feret(r.masks).drop("feret_min")))
query("a32b_feret_min", f"SELECT {KEYS}, feret_min FROM ({Q.rounded('feret')})")(lambda r: rounded(M.feret(r.masks).drop("feret_max")))
query("a33_texture", Q.rounded("texture", f"{KEYS}, c"))(lambda r: rounded(M.texture(r.objects)))
query("a34_radial_distribution", f"SELECT {KEYS}, c, ring, {r6('frac_at_d', 'frac_at_d')}, {r6('mean_frac', 'mean_frac')}, {r6('radial_cv', 'radial_cv')} FROM ({Q.RADIAL})")(lambda r: rounded(M.radial_distribution(r.objects)))
query("a35_zernike", Q.rounded("zernike"))(lambda r: rounded(M.MASK_FAMILIES["zernike"](r.masks)))
query("a35b_radial_zernikes", Q.rounded("radial_zernikes", f"{KEYS}, c"))(lambda r: rounded(M.zernike(r.objects, value=F.col("v"))))
query("a36_pearson", Q.rounded("pearson"))(lambda r: rounded(M.pearson(M.two_channels(r.objects, 0, 1))))
query("a37_manders_fold", f"""SELECT {KEYS}, {r6('sum(CASE WHEN v1 >= t1 THEN v0 ELSE 0 END) / nullif(sum(v0), 0)', 'manders_1')}, {r6('sum(CASE WHEN v0 >= t0 THEN v1 ELSE 0 END) / nullif(sum(v1), 0)', 'manders_2')} FROM
 (SELECT *, 0.15 * max(v0) OVER (PARTITION BY {KEYS}) AS t0, 0.15 * max(v1) OVER (PARTITION BY {KEYS}) AS t1 FROM (SELECT {KEYS}, y, x, abs(v0) AS v0, abs(v1) AS v1 FROM ({PAIRS}))) WHERE v0 >= t0 OR v1 >= t1 GROUP BY {KEYS}""")(
    lambda r: rounded(M.manders_fold(M.two_channels(r.objects.withColumn("v", F.abs("v")), 0, 1)))
)
query("a38_rwc", Q.rounded("rwc"))(lambda r: rounded(M.rwc(M.two_channels(r.objects.withColumn("v", F.abs("v")), 0, 1))))
query("a39_costes", Q.rounded("costes"))(lambda r: rounded(M.costes(M.two_channels(r.objects.withColumn("v", F.abs("v")), 0, 1))))

_TREE = [(None, None, "None", "None", "area"), (0, None, "None", "max", "mean"), (1, None, "None", "max", "median"), (0, 1, "add", "max", "mean")]
MEASURED = f"""SELECT {KEYS}, 'None/None/area' AS metric, CAST(count(*) AS DOUBLE) AS value FROM masks GROUP BY {KEYS}
 UNION ALL SELECT {KEYS}, '0/max/mean', avg(v) FROM objects WHERE c = 0 GROUP BY {KEYS} UNION ALL SELECT {KEYS}, '0/max/median', median(v) FROM objects WHERE c = 0 GROUP BY {KEYS}
 UNION ALL SELECT {KEYS}, '1/max/mean', avg(v) FROM objects WHERE c = 1 GROUP BY {KEYS} UNION ALL SELECT {KEYS}, '1/max/median', median(v) FROM objects WHERE c = 1 GROUP BY {KEYS}
 UNION ALL SELECT {KEYS}, '(0, 1)/add/max/mean', avg(v0 + v1) FROM ({PAIRS}) GROUP BY {KEYS}"""
query("u02_measure", f"SELECT {KEYS}, metric, {r6('value', 'value')} FROM ({MEASURED})")(lambda r: rounded(M.measure(r.masks, r.pixels, _TREE)))
NAMES = ["None/None/area", *[f"{c}/max/{m}" for c in (0, 1) for m in ("mean", "median", "std")]]
PROFILE = f"""SELECT {KEYS}, CAST(count(*) FILTER (c = 0) AS DOUBLE) AS "None/None/area", """ + ", ".join(r6(f"{f}(v) FILTER (c = {c})", f'"{c}/max/{m}"') for c in (0, 1) for m, f in (("mean", "avg"), ("median", "median"), ("std", "stddev_pop"))) + f" FROM objects GROUP BY {KEYS}"


def wide(r: Relations) -> DataFrame:
    steps = [(None, None, "None", "None", "area"), *[(c, None, "None", "max", m) for c in (0, 1) for m in ("mean", "median", "std")]]
    return rounded(P.profile(M.measure(r.masks, r.pixels, steps), NAMES))


query("a50_profile", PROFILE)(wide)
STANDARD, STANDARD_NAMES = Q.standard()


def standard_profile(r: Relations) -> DataFrame:
    return rounded(P.profile(M.measure(r.masks, r.pixels, M.default_instructions([0, 1])), STANDARD_NAMES))


query("u06_default_profile", STANDARD)(standard_profile)
query("o06_metric_order", f"SELECT metric, CAST(row_number() OVER (ORDER BY metric) AS INT) AS place FROM (SELECT DISTINCT metric FROM ({MEASURED}))")(
    lambda r: M.measure(r.masks, r.pixels, _TREE).select("metric").distinct().withColumn("place", F.row_number().over(Window.orderBy("metric")))  # one row for each metric
)
ALL = (("mean", "avg(v)"), ("total", "sum(v)"), ("total_squared", "sum(v * v)"), ("median", "median(v)"), ("std", "stddev_pop(v)"), ("min", "min(v)"), ("max", "max(v)"), ("lower_quartile", "quantile_cont(v, 0.25)"), ("upper_quartile", "quantile_cont(v, 0.75)"))
query("u01_registry", f"SELECT {KEYS}, c, " + ", ".join(r6(f, n) for n, f in ALL) + f" FROM objects GROUP BY {KEYS}, c")(lambda r: rounded(M.pixel_metrics(r.objects, [n for n, _ in ALL])))


@query("u07_missing_channels", "SELECT p.position, i.c FROM (SELECT DISTINCT position FROM pixels) p, (VALUES (0), (1), (5)) i(c) WHERE NOT EXISTS (SELECT 1 FROM pixels x WHERE x.position = p.position AND x.c = i.c)")
def _(r: Relations) -> DataFrame:
    """Channels that instructions need and a position does not have; the steps themselves are sound."""
    if P.validated([{"name": "tile"}, {"name": "extract", "needs": ["tile"]}]):
        raise ValueError("the steps do not fit each other")
    need = r.spark.createDataFrame([(0,), (1,), (5,)], "c int")
    return r.pixels.select("position").distinct().join(F.broadcast(need)).join(r.pixels.select("position", "c").distinct(), ["position", "c"], "left_anti")


@query("s12_profile_sink", PROFILE)
def _(r: Relations) -> DataFrame:
    df = wide(r)
    path = P.write_ranges(df, P.new_folder(r.spark, "profiles"), ["position"])
    return P.read_table(r.spark, path, df)


@query("j01_joined_families", f'SELECT * FROM (SELECT {KEYS}, CAST(count(*) AS BIGINT) AS area FROM masks GROUP BY {KEYS}) LEFT JOIN (SELECT {KEYS}, {r6("avg(v)", "mean")} FROM objects WHERE c = 1 GROUP BY {KEYS}) USING ({KEYS})')
def _(r: Relations) -> DataFrame:
    areas = r.masks.groupBy(*K).agg(F.count("*").alias("area"))
    return rounded(P.joined_families(areas, M.pixel_metrics(r.objects.where("c = 1"), ["mean"]).drop("c")))


query("j02_object_pixels", f"SELECT {KEYS}, c, y, x, {r6('v', 'v')} FROM objects")(lambda r: rounded(r.objects))
query("j03_overlapping_objects", f"SELECT stack, {KEYS}, c, count(*) AS n, {r6('sum(v)', 'total')} FROM (SELECT 0 AS stack, * FROM objects UNION ALL SELECT 1 AS stack, * REPLACE (1 AS label) FROM objects) GROUP BY stack, {KEYS}, c")(
    lambda r: rounded(M.object_pixels(r.masks.withColumn("stack", F.lit(0)).unionByName(r.masks.withColumn("stack", F.lit(1)).withColumn("label", F.lit(1))), M.reduce_z(r.pixels, "max")).groupBy("stack", *K, "c").agg(F.count("*").alias("n"), F.sum("v").alias("total")))
)
query("j04_channel_pairs", f"SELECT {KEYS}, y, x, {r6('v0', 'v0')}, {r6('v1', 'v1')} FROM ({PAIRS})")(lambda r: rounded(M.two_channels(r.objects, 0, 1)))


@query("j05_objects_by_instructions", f"SELECT position, tp, label, metric FROM (SELECT DISTINCT {KEYS} FROM masks), (VALUES ('area'), ('mean'), ('std')) m(metric)")
def _(r: Relations) -> DataFrame:
    metrics = r.spark.createDataFrame([("area",), ("mean",), ("std",)], "metric string")
    return r.masks.select(*K).distinct().join(F.broadcast(metrics)).select("position", "tp", "label", "metric")  # three rows


query("p03_filled_outlines", f"""WITH RECURSIVE o AS (SELECT {KEYS}, min(y) - 1 AS ya, max(y) + 1 AS yb, min(x) - 1 AS xa, max(x) + 1 AS xb FROM masks GROUP BY {KEYS}),
 grid AS (SELECT {KEYS}, CAST(i AS INT) AS y, CAST(j AS INT) AS x, i = ya OR i = yb OR j = xa OR j = xb AS rim FROM o, range(-1, 10) a(i), range(-1, 10) b(j) WHERE i BETWEEN ya AND yb AND j BETWEEN xa AND xb),
 wall AS (SELECT {KEYS}, y, x FROM ({Q.RIM}) WHERE edges > 0), free AS (SELECT * FROM grid ANTI JOIN wall USING ({KEYS}, y, x)),
 outside AS (SELECT {KEYS}, y, x FROM free WHERE rim UNION SELECT f.position, f.tile, f.tp, f.label, f.y, f.x FROM outside s JOIN free f ON f.position = s.position AND f.tile = s.tile AND f.tp = s.tp AND f.label = s.label AND abs(f.y - s.y) + abs(f.x - s.x) = 1)
 SELECT {KEYS}, y, x FROM grid ANTI JOIN outside USING ({KEYS}, y, x)""")(lambda r: M.fill_outline(M.rim(r.masks).where("inside < 4").select(*K, "y", "x")))
query("w06_relabelled", f"SELECT {KEYS}, y, x, CAST(dense_rank() OVER (PARTITION BY position, tile, tp ORDER BY label) AS INT) AS new_label FROM masks WHERE label <> 2")(lambda r: B.relabelled(r.masks.where("label <> 2"), ["position", "tile", "tp"]).select(*K, "y", "x", "new_label"))
query("w07_existing_labels", f"SELECT DISTINCT {KEYS} FROM masks")(lambda r: r.masks.select(*K).distinct())
query("o03_top_pixels", f"SELECT {KEYS}, c, CAST(k AS INT) AS k, {r6('v', 'v')} FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS}, c ORDER BY v DESC) AS k FROM objects) WHERE k <= 5")(
    lambda r: rounded(r.objects.withColumn("k", F.row_number().over(Window.partitionBy(*K, "c").orderBy(F.desc("v")))).where("k <= 5").select(*K, "c", "k", "v"))
)
query("p10_label_guard", "SELECT CAST(count(*) AS BIGINT) AS n, max(label) AS most FROM masks")(lambda r: B.checked_labels(r.masks).agg(F.count("*").alias("n"), F.max("label").alias("most")))
query("x11_layers", "SELECT position, tile, tp, label, list_sort(list(y * 8 + x)) AS layer FROM masks GROUP BY ALL")(lambda r: r.masks.groupBy(*K).agg(F.sort_array(F.collect_list(F.col("y") * 8 + F.col("x"))).alias("layer")))

# Blocks ----------------------------------------------------------------------------------------------------------------

query("t01_grid_tiles", "SELECT position, tp, c, z, y, x, CAST((y // 3) * 2 + x // 3 AS INT) AS tile FROM pixels WHERE y < 6 AND x < 6")(lambda r: B.grid_tiles(r.pixels, 3, 8, 8).drop("value"))
query("t02_clip_outliers", f"""SELECT position, tp, c, z, y, x, {r6('greatest(0, least(1, (value - low) / nullif(high - low, 0)))', 'value')} FROM pixels JOIN
 (SELECT position, tp, c, quantile_cont(value, 0.005) AS low, quantile_cont(value, 0.995) AS high FROM pixels GROUP BY ALL) USING (position, tp, c)""")(lambda r: rounded(B.clip_outliers(r.pixels)))
query("t03_to_8bit", "SELECT position, tp, c, z, y, x, CAST(floor(abs(value) * 255) AS INT) AS value FROM pixels")(lambda r: B.to_8bit(r.pixels.withColumn("value", F.abs("value"))))
SCALED = "SELECT position, tp, c, z, y, x, (value - avg(value) OVER w) / nullif(stddev_pop(value) OVER w, 0) AS value FROM pixels WINDOW w AS (PARTITION BY position, tp, c)"
query("t04_standard_scale", f"SELECT position, tp, c, z, y, x, {r6('value', 'value')} FROM ({SCALED})")(lambda r: rounded(B.standard_scale(r.pixels)))
query("t05_cropped", f"SELECT position, tp, c, z, y, x, {r6('value', 'value')}, CAST((y // 4) * 2 + x // 4 AS INT) AS tile FROM ({SCALED})")(lambda r: rounded(B.cropped(r.pixels, 4, 8, 8)))
query("t06_drift")(lambda r: B.drift(r.pixels))
MOVED = """SELECT t.position, t.tile, d.tp, CAST(trunc(t.y0 - d.sy) AS INT) AS y0, CAST(trunc(t.x0 - d.sx) AS INT) AS x0, t.h, t.w FROM tiles t JOIN
 (SELECT position, tp, sum(dy) OVER w AS sy, sum(dx) OVER w AS sx FROM drifts WINDOW w AS (PARTITION BY position ORDER BY tp)) d USING (position)"""
query("w08_drift_centres", MOVED)(lambda r: B.centres(r.tiles, r.drifts))
query("w09_tile_ranges", "SELECT position, tile, y0 - h // 2 AS top, y0 - h // 2 + h AS bottom, x0 - w // 2 AS first, x0 - w // 2 + w AS last FROM tiles")(
    lambda r: r.tiles.selectExpr("position", "tile", "CAST(y0 - h DIV 2 AS INT) AS top", "CAST(y0 - h DIV 2 + h AS INT) AS bottom", "CAST(x0 - w DIV 2 AS INT) AS first", "CAST(x0 - w DIV 2 + w AS INT) AS last")
)
WINDOWS = f"""SELECT position, tile, tp, k.c, k.z, CAST(dy AS INT) AS dy, CAST(dx AS INT) AS dx, p.value FROM ({MOVED}) m, range(0, 4) a(dy), range(0, 4) b(dx), (SELECT DISTINCT c, z FROM pixels) k
 LEFT JOIN pixels p ON p.position = m.position AND p.tp = m.tp AND p.c = k.c AND p.z = k.z AND p.y = m.y0 + dy AND p.x = m.x0 + dx"""
query("j15_tile_pixels", f"SELECT * FROM ({WINDOWS.replace('SELECT position, tile, tp', 'SELECT m.position, m.tile, m.tp')})")(lambda r: B.window_pixels(B.centres(r.tiles, r.drifts), r.pixels))
STILL = "SELECT t.position, t.tile, d.tp, t.y0, t.x0, t.h, t.w FROM tiles t JOIN (SELECT position, tp FROM drifts) d USING (position)"


def padded_sql(windows: str) -> str:
    """Windows with columns' medians, then rows', where the image ends; null where a side lacks more than a quarter."""
    rows = WINDOWS.replace(MOVED, windows).replace("SELECT position, tile, tp", "SELECT m.position, m.tile, m.tp")
    side = lambda a: f"min({a}) FILTER (value IS NOT NULL) OVER w AS low_{a}, 3 - max({a}) FILTER (value IS NOT NULL) OVER w AS high_{a}"
    lacks = " OR ".join(f"coalesce({e}_{a} > 1, true)" for a in ("dy", "dx") for e in ("low", "high"))
    return f"""WITH p AS ({rows}), s AS (SELECT *, {side('dy')}, {side('dx')}, coalesce(value, median(value) OVER (PARTITION BY position, tile, tp, c, z, dx)) AS v FROM p WINDOW w AS (PARTITION BY position, tile, tp, c, z)),
 f AS (SELECT *, coalesce(v, median(v) OVER (PARTITION BY position, tile, tp, c, z, dy)) AS filled FROM s)
 SELECT position, tile, tp, c, z, dy, dx, round(CASE WHEN NOT ({lacks}) THEN filled END, 6) + 0.0 AS value FROM f"""


query("t07_padded_tiles", padded_sql(STILL))(lambda r: rounded(B.padded(B.window_pixels(r.tiles.join(r.drifts.select("position", "tp"), "position"), r.pixels))))
query("t08_drift_corrected_tiles", padded_sql(MOVED))(lambda r: rounded(B.padded(B.window_pixels(B.centres(r.tiles, r.drifts), r.pixels))))
query("t09_single_tile", "SELECT DISTINCT position, 4 AS cy, 4 AS cx, 4 AS size FROM pixels")(lambda r: r.pixels.select("position").distinct().select("position", *[F.lit(v).alias(n) for n, v in zip(("cy", "cx", "size"), B.single_tile(8, 8, 4), strict=True)]))
query("p11_inner_centres", "SELECT position, tp, y, x FROM pixels WHERE c = 0 AND z = 0 AND value > 0.2 AND y > 2 AND y < 6 AND x > 2 AND x < 6")(lambda r: B.inner_centres(r.pixels.where("c = 0 AND z = 0 AND value > 0.2").select("position", "tp", "y", "x"), 2, 8))
query("t10_otsu", f"""WITH s AS (SELECT position, tp, c, z, value, min(value) OVER w AS low, max(value) OVER w AS high FROM pixels WINDOW w AS (PARTITION BY position, tp, c, z)),
 n AS (SELECT position, tp, c, z, low, high, CAST(least(15, floor(coalesce((value - low) / nullif(high - low, 0), 0) * 16)) AS INT) AS bin, count(*) AS n FROM s GROUP BY ALL),
 u AS (SELECT *, sum(n) OVER up AS n0, sum(n * bin) OVER up AS s0, sum(n) OVER w AS na, sum(n * bin) OVER w AS sa FROM n WINDOW w AS (PARTITION BY position, tp, c, z), up AS (PARTITION BY position, tp, c, z ORDER BY bin)),
 g AS (SELECT *, coalesce(n0 * (na - n0) * pow(s0 / n0 - (sa - s0) / nullif(na - n0, 0), 2), 0) AS between_parts FROM u)
 SELECT position, tp, c, z, round(low + (high - low) * (arg_min(bin, (-round(between_parts, 6), bin)) + 1) / 16, 6) + 0.0 AS threshold FROM g GROUP BY position, tp, c, z, low, high""")(lambda r: rounded(B.otsu(r.pixels)))


def bright(r: Relations) -> DataFrame:
    return r.pixels.where("c = 0 AND z = 0 AND value > 0.1").select("position", "tp", "y", "x")


REGIONS = """b AS (SELECT position, tp, y, x FROM pixels WHERE c = 0 AND z = 0 AND value > 0.1),
 e AS (SELECT p.position, p.tp, p.y, p.x, q.y AS y2, q.x AS x2 FROM b p JOIN b q ON q.position = p.position AND q.tp = p.tp AND abs(q.y - p.y) <= 1 AND abs(q.x - p.x) <= 1),
 reach AS (SELECT * FROM e UNION SELECT r.position, r.tp, r.y, r.x, e.y2, e.x2 FROM reach r JOIN e ON e.position = r.position AND e.tp = r.tp AND e.y = r.y2 AND e.x = r.x2),
 named AS (SELECT position, tp, y, x, min(y2 * 8 + x2) AS k, bool_or(y2 IN (0, 7) OR x2 IN (0, 7)) AS edge FROM reach GROUP BY ALL),
 found AS (SELECT position, tp, y, x, CAST(dense_rank() OVER (PARTITION BY position, tp ORDER BY k) AS INT) AS label FROM named WHERE NOT edge)"""
query("t11_regions", f"WITH RECURSIVE {REGIONS} SELECT * FROM found")(lambda r: B.regions(bright(r), 8, 8))


def kept_regions(r: Relations, tile: int = 4) -> DataFrame:
    """Regions whose major axis lies between 2 and 8, with the centre at least half a tile from the edges."""
    found = B.regions(bright(r), 8, 8).withColumn("tile", F.lit(0))
    centre = found.groupBy(*K).agg(F.avg("y").alias("centre_y"), F.avg("x").alias("centre_x"))
    inside = F.lit(True)
    for c in ("centre_y", "centre_x"):
        inside = inside & (F.col(c) >= tile / 2) & (F.col(c) <= 8 - tile / 2)
    return rounded(M.sizeshape(found).where("major_axis > 2 AND major_axis < 8").join(centre.where(inside), K))


query("t12_region_filter", f"""WITH RECURSIVE {REGIONS}, shapes AS (SELECT *, 0 AS tile FROM found)
 SELECT * FROM ({Q.rounded('sizeshape').replace('masks', 'shapes')}) JOIN (SELECT {KEYS}, {r6('avg(y)', 'centre_y')}, {r6('avg(x)', 'centre_x')} FROM shapes GROUP BY {KEYS}) USING ({KEYS})
 WHERE major_axis > 2 AND major_axis < 8 AND centre_y BETWEEN 2 AND 6 AND centre_x BETWEEN 2 AND 6""")(kept_regions)
query("t13_mean_template", """WITH centres AS (SELECT position, tp, y, x FROM pixels WHERE c = 0 AND z = 0 AND value > 0.2 AND y BETWEEN 1 AND 6 AND x BETWEEN 1 AND 6)
 SELECT CAST(p.y - s.y + 1 AS INT) AS dy, CAST(p.x - s.x + 1 AS INT) AS dx, round(avg(p.value), 6) + 0.0 AS value FROM centres s JOIN pixels p ON p.position = s.position AND p.tp = s.tp AND abs(p.y - s.y) <= 1 AND abs(p.x - s.x) <= 1 GROUP BY 1, 2""")(
    lambda r: rounded(B.mean_template(r.pixels.where("c = 0 AND z = 0 AND value > 0.2").select("position", "tp", "y", "x"), r.pixels, 1))
)
query("t14_local_maxima", f"SELECT a.position, a.tp, a.c, a.y, a.x, {r6('a.v', 'v')} FROM flat a WHERE NOT EXISTS (SELECT 1 FROM flat b WHERE b.position = a.position AND b.tp = a.tp AND b.c = a.c AND abs(b.y - a.y) <= 1 AND abs(b.x - a.x) <= 1 AND (b.v > a.v OR (b.v = a.v AND (b.y, b.x) < (a.y, a.x))))")(lambda r: rounded(B.local_maxima(M.reduce_z(r.pixels, "max"))))
query("t15_flattened_labels", f"""SELECT position, tile, tp, y, x, label, CAST(dense_rank() OVER (PARTITION BY position, tile, tp ORDER BY label) AS INT) AS new_label FROM
 (SELECT position, tile, tp, y, x, max(label) AS label FROM (SELECT * FROM masks UNION ALL SELECT * REPLACE (label + 1 AS label) FROM masks WHERE x = 3) GROUP BY ALL)""")(lambda r: B.flattened_labels(r.masks.unionByName(r.masks.where("x = 3").withColumn("label", F.col("label") + 1))))
query("t16_projection", f"SELECT position, tp, c, y, x, {r6('v', 'v')} FROM flat")(lambda r: rounded(M.reduce_z(r.pixels, "max")))
query("t17_updated_labels", f"SELECT m.position, m.tile, m.tp, m.y, m.x, m.label, CAST(m.k + 10 AS INT) AS new_label FROM (SELECT *, dense_rank() OVER (PARTITION BY position, tile, tp ORDER BY label) AS k FROM masks) m")(
    lambda r: B.ordinal_labels(r.masks, r.masks.select("tile", "tp").distinct().withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(4)))).withColumn("new_label", F.col("k") + 10)).select("position", "tile", "tp", "y", "x", "label", "new_label")
)
query("t18_tile_locations", "SELECT d.position, d.tp, t.tile, CASE WHEN d.tp = 0 THEN t.y0 END AS y0, CASE WHEN d.tp = 0 THEN t.x0 END AS x0, d.dy, d.dx FROM drifts d JOIN tiles t USING (position)")(
    lambda r: r.drifts.join(r.tiles, "position").select("position", "tp", "tile", F.when(F.col("tp") == 0, F.col("y0")).alias("y0"), F.when(F.col("tp") == 0, F.col("x0")).alias("x0"), "dy", "dx")
)
query("s24_tile_sheet", "SELECT position, tp, c, z, CAST((y // 4) * 2 + x // 4 AS INT) AS tile, CAST(y % 4 AS INT) AS y, CAST(x % 4 AS INT) AS x, value FROM pixels WHERE (y // 4) * 2 + x // 4 < 3")(lambda r: B.tile_sheet(r.pixels, 4, 4, 2, 3))
query("s07_aligned_dimensions", "SELECT position, 0 AS tp, c, 0 AS z, y, x, value FROM pixels WHERE tp = 0 AND z = 0")(lambda r: C.aligned(r.pixels.where("tp = 0 AND z = 0"), "CYX"))
query("p07_selected_tiles", "SELECT position, tp, c, z, y, x, value FROM pixels WHERE tp = 2 AND c IN (0, 1) AND z = 1")(lambda r: r.pixels.where((F.col("tp") == 2) & F.col("c").isin(0, 1) & (F.col("z") == 1)))
query("p08_channel_order", f"SELECT position, tp, c, y, x, {r6('v', 'v')}, CAST(1 - c AS INT) AS ord FROM flat")(lambda r: rounded(P.chosen_channels(M.reduce_z(r.pixels, "max"), [1, 0])))
query("u04_segmented", """WITH RECURSIVE b AS (SELECT position, tp, y, x FROM (SELECT *, avg(v) OVER (PARTITION BY position, tp) AS m FROM flat WHERE c = 0) WHERE v > m),
 e AS (SELECT p.position, p.tp, p.y, p.x, q.y AS y2, q.x AS x2 FROM b p JOIN b q ON q.position = p.position AND q.tp = p.tp AND abs(q.y - p.y) <= 1 AND abs(q.x - p.x) <= 1),
 reach AS (SELECT * FROM e UNION SELECT r.position, r.tp, r.y, r.x, e.y2, e.x2 FROM reach r JOIN e ON e.position = r.position AND e.tp = r.tp AND e.y = r.y2 AND e.x = r.x2)
 SELECT position, 0 AS tile, tp, y, x, CAST(dense_rank() OVER (PARTITION BY position, tp ORDER BY k) AS INT) AS label FROM (SELECT position, tp, y, x, min(y2 * 8 + x2) AS k FROM reach GROUP BY ALL)""")(lambda r: B.segmented(M.reduce_z(r.pixels, "max"), B.threshold_labels, 0))

# Files and logs --------------------------------------------------------------------------------------------------------


def captured(r: Relations) -> DataFrame:
    return C.captures(r.files, NAME, "WFC")


query("s01_scan", "SELECT path, split_part(path, '/', -1) AS name FROM files WHERE regexp_matches(split_part(path, '/', -1), '^img__A[^/]*view\\.tif$')")(lambda r: C.matching(r.files, "img__A*view.tif").select("path", "name"))
query("s01b_listing")(lambda r: C.scan(r.spark, r.folder, "*.parquet").select(F.element_at(F.split("path", "/"), -1).alias("name"), "length"))
query("s02_captures", "SELECT path, well, field, channel FROM captures")(lambda r: captured(r).select("path", F.col("W").alias("well"), F.col("F").alias("field"), F.col("C").alias("channel")))
query("s03_positions", "SELECT concat_ws('__', well, field) AS position, list(path ORDER BY channel, path) AS paths FROM captures GROUP BY 1")(lambda r: C.positions(captured(r), "WFC"))
query("s04_dimensions", "SELECT concat_ws('__', well, field) AS position, CAST(count(*) AS BIGINT) AS n_files, CAST(count(DISTINCT channel) AS BIGINT) AS \"n_C\", count(*) = count(DISTINCT channel) AS complete FROM captures GROUP BY 1")(lambda r: C.dimensions(captured(r), "WFC"))
query("s05_sizes_from_stems", "SELECT 'T' AS dim, CAST(max(tp) - min(tp) + 1 AS INT) AS size FROM pixels UNION ALL SELECT 'C', max(c) - min(c) + 1 FROM pixels UNION ALL SELECT 'Z', max(z) - min(z) + 1 FROM pixels")(
    lambda r: C.sizes_from_stems(r.pixels.select(F.format_string("/data/img_T%03d_C%d_Z%d.tif", "tp", "c", "z").alias("path")).distinct())
)
query("s06_image_planes", "SELECT concat_ws('__', well, field) AS position, path, 0 AS tp, CAST(dense_rank() OVER (PARTITION BY concat_ws('__', well, field) ORDER BY channel) - 1 AS INT) AS c, 0 AS z FROM captures")(lambda r: C.image_planes(captured(r), "WFC"))
query("s08_image_folders", "SELECT regexp_extract(path, '^(.*)/', 1) AS folder, path, CAST(dense_rank() OVER (PARTITION BY regexp_extract(path, '^(.*)/', 1) ORDER BY channel) - 1 AS INT) AS c FROM captures")(
    lambda r: captured(r).withColumn("folder", F.regexp_extract("path", "^(.*)/", 1)).select("folder", "path", (F.dense_rank().over(Window.partitionBy("folder").orderBy("C")) - 1).alias("c"))
)
query("s09_roots", "SELECT DISTINCT split_part(path, '/', 3) AS position FROM files")(lambda r: C.roots(r.files, "/data"))
query("s10_checksum", "SELECT concat_ws('__', well, field) AS position, md5(string_agg(path, '' ORDER BY path)) AS md5 FROM captures GROUP BY 1")(lambda r: C.checksum(captured(r).select(C.position_key("WFC").alias("position"), "path", F.col("path").cast("binary").alias("content"))))
query("s10b_checksum_of_digests", "SELECT concat_ws('__', well, field) AS position, md5(string_agg(md5(path), '' ORDER BY path)) AS md5 FROM captures GROUP BY 1")(lambda r: C.checksum_of_digests(captured(r).withColumn("position", C.position_key("WFC")), "path"))
query("s11_first_log", "SELECT regexp_extract(path, '^(.*)/', 1) AS folder, min(path) AS path, 'legacy' AS kind FROM files WHERE path LIKE '%.txt' GROUP BY 1")(lambda r: C.first_log(r.files))
query("s23_paired", r"""SELECT regexp_extract(path, '([^/]+)__(click|view)\.', 1) AS name, count(DISTINCT regexp_extract(path, '([^/]+)__(click|view)\.', 2)) = 2 AS complete FROM files WHERE regexp_matches(path, '([^/]+)__(click|view)\.') GROUP BY 1""")(lambda r: C.paired(r.files, r"([^/]+)__(click|view)\.", ["click", "view"]))
query("p09_first_channel", "SELECT arg_min(name, ord) AS name, min(ord) AS ord FROM (SELECT DISTINCT channel AS name, CAST(dense_rank() OVER (ORDER BY channel) AS INT) AS ord FROM captures) WHERE regexp_matches(name, '(?i)^(?:P)')")(
    lambda r: C.first_channel(captured(r).select(F.col("C").alias("name")).distinct().select("name", F.dense_rank().over(Window.orderBy("name")).alias("ord")), "P")
)
query("x03_position_key", "SELECT path, concat_ws('__', well, field) AS position FROM captures")(lambda r: captured(r).select("path", C.position_key("WFC").alias("position")))
query("x17_stems", r"SELECT path, regexp_replace(split_part(path, '/', -1), '\.[^.]*$', '') AS stem FROM files")(lambda r: r.files.select("path", C.stem().alias("stem")))
query("o01_multisort", "SELECT path, CAST(row_number() OVER (ORDER BY field, well, channel, path) AS BIGINT) AS place FROM captures")(lambda r: G.running_total(captured(r), ["F", "W", "C", "path"], F.lit(1), "before").select("path", (F.col("before") + 1).alias("place")))
query("w14_round_robin", "SELECT position, CAST((row_number() OVER (ORDER BY position) - 1) % 3 AS INT) AS worker FROM (SELECT DISTINCT position FROM pixels)")(lambda r: T.round_robin(r.pixels, "position", 3))
query("s16_sections", f"""SELECT file, line, text, CASE WHEN count(*) FILTER (text LIKE '-----Acq%') OVER (PARTITION BY file ORDER BY line) > 0 THEN 'acquisition' ELSE '' END AS section, text LIKE '-----Acq%' AS is_marker FROM log_lines""")(lambda r: L.sections(r.log_lines, [("acquisition", f"^{L.ACQUISITION}")]))
HEADS = "SELECT *, count(*) FILTER (text LIKE '-----Acq%') OVER (PARTITION BY file ORDER BY line) AS k FROM log_lines"
GENERAL = f"SELECT file, replace(lower(split_part(text, ':', 1)), ' ', '_') AS key, arg_min(trim(substring(text, position(':' IN text) + 1)), line) AS value FROM ({HEADS}) WHERE k = 0 AND text LIKE '%:%' GROUP BY 1, 2"
query("x07_general", GENERAL)(lambda r: L.general(r.log_lines))
query("x08_acquisition", "SELECT file, line, split_part(text, ',', 1) AS channel, CAST(split_part(text, ',', 4) AS INT) AS exposure, CAST(split_part(text, ',', 5) AS INT) AS n_z, CAST(split_part(text, ',', 6) AS DOUBLE) AS z_spacing, split_part(text, ',', 7) AS method FROM log_lines WHERE text LIKE 'GFP,GFP,%'")(
    lambda r: L.acquisition(r.log_lines, ["GFP", "mCherry"])
)
query("x09_groups", "SELECT file, CAST(line AS VARCHAR) AS name, CAST(line % 7 AS DOUBLE) AS x, CAST(line % 11 AS DOUBLE) AS y FROM log_lines WHERE text LIKE 'Run Name%'")(
    lambda r: L.groups(r.log_lines.where("text LIKE 'Run Name%'").select("file", F.concat(F.lit("Group: "), F.col("line").cast("string"), F.lit(", "), (F.col("line") % 7).cast("string"), F.lit(", "), (F.col("line") % 11).cast("string")).alias("text")))
)
NUMBERS = r"SELECT file, 'interval' AS word, CAST(arg_min(regexp_extract(text, 'interval:\s*(\d+)', 1), line) AS BIGINT) AS value FROM log_lines WHERE text LIKE 'interval:%' GROUP BY 1"
query("x10_numbers", NUMBERS)(lambda r: L.numbers(r.log_lines, ["interval", "frames"]))
query("s28b_preferred", f"SELECT file, key, coalesce(CAST(n.value AS VARCHAR), g.value) AS value FROM ({GENERAL}) g FULL JOIN (SELECT file, word AS key, value FROM ({NUMBERS})) n USING (file, key)")(
    lambda r: L.preferred(L.general(r.log_lines), L.numbers(r.log_lines, ["interval"]).select("file", F.col("word").alias("key"), F.col("value").cast("string").alias("value")), ["file", "key"])
)
query("p16_minimal_metadata", r"""SELECT file, list_distinct(list(split_part(text, ',', 1)) FILTER (text LIKE 'GFP,GFP,%')) AS channels, CAST(NULL AS BIGINT) AS ntimepoints, CAST(arg_min(regexp_extract(text, 'interval:\s*(\d+)', 1), line) FILTER (text LIKE 'interval:%') AS BIGINT) AS timeinterval
 FROM log_lines GROUP BY 1""")(lambda r: L.minimal(r.log_lines, ["GFP"]))
GRAMMAR = [
    {"name": "acquisition", "startswith": "-----Acq", "kind": "table", "header": False, "columns": [("channel", "str"), ("pair", "str"), ("skip", "int"), ("exposure", "int"), ("rest", "str")]},
    {"name": "run", "startswith": "Run Name: 1", "kind": "regex", "regex": r"interval: (\d+)", "map": "int", "next_section": "after"},
    {"name": "after", "kind": "list", "map": "str"},
    {"name": "other", "contains": "Name: 2", "kind": "text"},
    {"name": "low", "endswith": "LOW", "kind": "regexs", "regex": r"(\d)", "map": "int"},
]
PARSED = r"""m AS (SELECT file, line, trim(text) AS text, CASE WHEN starts_with(trim(text), '-----Acq') THEN 'acquisition' WHEN starts_with(trim(text), 'Run Name: 1') THEN 'run' WHEN contains(text, 'Name: 2') THEN 'other' WHEN ends_with(trim(text), 'LOW') THEN 'low' END AS mark FROM log_lines WHERE trim(text) <> ''),
 b AS (SELECT *, count(mark) OVER (PARTITION BY file ORDER BY line) AS block FROM m),
 s AS (SELECT *, first_value(mark) OVER (PARTITION BY file, block ORDER BY line) AS section FROM b WHERE block > 0),
 hit AS (SELECT file, block, min(line) AS first FROM s WHERE section = 'run' AND regexp_matches(text, 'interval: (\d+)') GROUP BY ALL),
 cells AS (SELECT file, line, string_split(text, ',') AS f FROM s WHERE section = 'acquisition' AND mark IS NULL AND len(string_split(text, ',')) >= 5),
 after AS (SELECT s.file, s.line, string_split(s.text, ',') AS f FROM s JOIN hit USING (file, block) WHERE s.line > hit.first),
 low AS (SELECT file, line, regexp_extract_all(CASE WHEN mark IS NULL THEN text ELSE left(text, length(text) - 3) END, '(\d)', 1) AS f FROM s WHERE section = 'low'),
 parsed AS (SELECT file, 'acquisition' AS section, line, CAST(i AS INT) AS pos, k AS key, trim(CASE WHEN i < 4 THEN f[i + 1] ELSE array_to_string(list_transform(f[5:], lambda v: trim(v)), ',') END) AS value, t AS type FROM cells, (VALUES (0, 'channel', 'str'), (1, 'pair', 'str'), (2, 'skip', 'int'), (3, 'exposure', 'int'), (4, 'rest', 'str')) k(i, k, t)
  UNION ALL SELECT file, 'run', max(line), 0, 'match', arg_max(v, line), 'int' FROM (SELECT s.file, s.line, regexp_extract(s.text, 'interval: (\d+)', 1) AS v FROM s JOIN hit ON hit.file = s.file AND hit.block = s.block AND hit.first = s.line) GROUP BY file
  UNION ALL SELECT file, 'after', line, CAST(i AS INT), 'list', trim(f[i + 1]), 'str' FROM after, range(0, 40) r(i) WHERE i < len(f)
  UNION ALL SELECT file, 'other', line, 0, 'text', text, 'str' FROM s WHERE section = 'other' AND mark IS NULL
  UNION ALL SELECT file, 'low', line, CAST(i AS INT), 'match', f[i + 1], 'int' FROM low, range(0, 40) r(i) WHERE i < len(f))"""
META = "SELECT file, map_from_entries(list(ROW(k, v) ORDER BY k)) AS meta FROM (SELECT file, concat_ws('/', section, key) AS k, coalesce(arg_max(value, line * 100 + pos), '0') AS v FROM parsed WHERE section IN ({sections}) GROUP BY 1, 2) GROUP BY 1"
query("s17_grammar", f"WITH {PARSED} SELECT * FROM parsed")(lambda r: L.by_grammar(r.log_lines, GRAMMAR))
query("s28_legacy_metadata", f"WITH {PARSED} {META.format(sections="'acquisition', 'run', 'after', 'other', 'low'")}")(lambda r: L.flattened(L.by_grammar(r.log_lines, GRAMMAR)))
query("x04_flattened", f"WITH {PARSED} {META.format(sections="'acquisition'")}")(lambda r: L.flattened(L.by_grammar(r.log_lines, GRAMMAR).where("section = 'acquisition'")))
query("x05_epoch", "SELECT o_orderkey, CAST(epoch(o_orderdate::TIMESTAMP) AS BIGINT) - CASE WHEN timezone('Europe/London', o_orderdate::TIMESTAMP) = timezone('UTC', o_orderdate::TIMESTAMP) THEN 0 ELSE 3600 END AS seconds FROM orders")(
    lambda r: r.table("orders").select("o_orderkey", L.epoch(F.date_format("o_orderdate", "yyyy-MM-dd"), "yyyy-MM-dd").alias("seconds"))
)
query("x06_typed", "SELECT line, try_cast(text AS INT) AS as_int, try_cast(text AS DOUBLE) AS as_float, length(text) > 0 AS as_bool FROM log_lines")(lambda r: r.log_lines.select("line", L.typed(F.col("text"), "int").alias("as_int"), L.typed(F.col("text"), "float").alias("as_float"), L.typed(F.col("text"), "bool").alias("as_bool")))
query("s21_attributes", "SELECT path AS file, map_from_entries(list(ROW(CAST(trap AS VARCHAR), CAST(n AS VARCHAR)) ORDER BY CAST(trap AS VARCHAR))) AS meta FROM (SELECT path, trap, count(*) AS n FROM signals GROUP BY ALL) GROUP BY 1")(
    lambda r: P.attributes(r.signals.groupBy(F.col("path").alias("file"), F.col("trap").cast("string").alias("key")).agg(F.count("*").cast("string").alias("value")))
)
query("s22_load_meta", "SELECT file, line, CAST(json_extract(j, '$.o') AS BIGINT) AS o FROM (SELECT file, line, '{\"o\": ' || line || '}' AS j FROM log_lines)")(lambda r: r.log_lines.select("file", "line", F.from_json(F.concat(F.lit('{"o": '), F.col("line").cast("string"), F.lit("}")), "o BIGINT")["o"].alias("o")))
query("j16_flagged_channels", """SELECT file, CASE WHEN gfp + cherry = 0 THEN ['cherry', 'gfp'] ELSE list_filter([CASE WHEN cherry <> 0 THEN 'cherry' END, CASE WHEN gfp <> 0 THEN 'gfp' END], lambda x: x IS NOT NULL) END AS channels
 FROM (SELECT o_custkey AS file, CAST(max(o_orderkey % 2) AS INT) AS gfp, CAST(min(o_orderkey % 3) AS INT) AS cherry FROM orders GROUP BY 1)""")(
    lambda r: L.flagged_channels(r.table("orders").groupBy(F.col("o_custkey").alias("file")).agg(F.max(F.col("o_orderkey") % 2).alias("gfp"), F.min(F.col("o_orderkey") % 3).alias("cherry")), "file", ["gfp", "cherry"])
)
query("x14_null_to_zero", "SELECT file, CAST(sum(coalesce(try_cast(split_part(text, ',', 4) AS INT), 0)) AS BIGINT) AS total FROM log_lines GROUP BY 1")(lambda r: r.log_lines.groupBy("file").agg(F.sum(F.coalesce(F.get(F.split("text", ","), F.lit(3)).try_cast("int"), F.lit(0))).alias("total")))
query("x01_flattened_tree", "SELECT * FROM (VALUES ('0', 'max', 'mean'), ('0', 'max', 'std'), ('1', 'add', 'area')) t(channel, reduction, metric), (SELECT DISTINCT position FROM pixels)")(
    lambda r: r.pixels.select("position").distinct().select("position", F.explode(F.from_json(F.lit('{"0": {"max": ["mean", "std"]}, "1": {"add": ["area"]}}'), "map<string,map<string,array<string>>>")).alias("channel", "t")).select("position", "channel", F.explode("t").alias("reduction", "m")).select("position", "channel", "reduction", F.explode("m").alias("metric"))
)
query("x02_metric_names", f"SELECT DISTINCT position, concat_ws('/', CAST(c AS VARCHAR), 'max', 'mean') AS metric, '(0, 1)/div/ratio' AS pair FROM objects")(lambda r: r.objects.select("position", P.metric_column(F.col("c"), F.lit("max"), F.lit("mean")).alias("metric"), F.lit(P.metric_name((0, 1), "div", "ratio")).alias("pair")).distinct())

# Signals and tracks ----------------------------------------------------------------------------------------------------

query("s18_signal", "SELECT path, trap, cell_label, tp, value FROM signals WHERE path = 'extraction/click'")(lambda r: r.signals.where("path = 'extraction/click'"))
query("s19_available", "SELECT DISTINCT path FROM signals WHERE starts_with(path, 'extraction')")(lambda r: r.signals.select("path").distinct().where(F.startswith("path", F.lit("extraction"))))
query("s20_upsert", "SELECT path, trap, cell_label, tp, CASE WHEN tp < 10 THEN value ELSE -value END AS value FROM signals")(lambda r: P.upserted(r.signals.where("tp < 10"), r.signals.withColumn("value", -F.col("value")), ["path", "tp"]))
query("p01_cell_rows", "SELECT * FROM cell_info WHERE cell_label = 2 AND trap = 3")(lambda r: T.cell_rows(r.cell_info, 2, 3))
query("p02_at_time", "SELECT t.trap, coalesce(list_sort(list(cell_label) FILTER (cell_label IS NOT NULL)), []) AS labels FROM (SELECT DISTINCT trap FROM cell_info) t LEFT JOIN (SELECT * FROM cell_info WHERE timepoint = 5) USING (trap) GROUP BY 1")(lambda r: T.at_time(r.cell_info, 5))
MINUTES = "SELECT *, CAST(tp * 5 AS INT) AS minute FROM signals"
query("p04_until_minute", f"SELECT * FROM ({MINUTES}) WHERE minute <= 60 AND value IS NOT NULL")(lambda r: T.until_minute(r.signals, 60))
query("w11_minutes", MINUTES)(lambda r: T.with_minutes(r.signals))
query("p05_retained", "SELECT s.* FROM signals s JOIN (SELECT path, trap, cell_label FROM signals JOIN (SELECT path, count(DISTINCT tp) AS t FROM signals GROUP BY 1) USING (path) GROUP BY path, trap, cell_label, t HAVING count(value) > t * 0.4) USING (path, trap, cell_label)")(lambda r: T.retained(r.signals, 0.4))
query("p06_picked", "SELECT s.* FROM signals s WHERE (SELECT count(*) FROM picks) = 0 OR EXISTS (SELECT 1 FROM picks p WHERE p.trap = s.trap AND p.cell_label = s.cell_label)")(lambda r: T.picked(r.signals, r.picks))
query("p12_saved_steps", "SELECT 'segment' AS step, position, tile, tp, y, x, label FROM masks WHERE tp % 2 = 0")(lambda r: P.saved_steps(r.masks.withColumn("step", F.lit("segment")), 2, ["segment"]))
query("p13_unfinished", "SELECT DISTINCT position FROM pixels WHERE position % 3 <> 0")(lambda r: P.unfinished(r.pixels.select("position").distinct(), r.masks.where("position % 3 = 0")))
query("p14_metadata", f"SELECT position, tile AS metadata_tile, tp AS metadata_tp, label AS metadata_label, 'nuclei' AS metadata_object, n FROM sizes")(lambda r: P.with_metadata(r.masks.groupBy(*K).agg(F.count("*").alias("n")), "extract_nuclei"))
query("p15_trap_labels", "SELECT trap, list_sort(list_distinct(list(cell_label))) AS labels, list_sort(list_distinct(list(timepoint))) AS times FROM cell_info GROUP BY 1")(lambda r: r.cell_info.groupBy("trap").agg(F.sort_array(F.collect_set("cell_label")).alias("labels"), F.sort_array(F.collect_set("timepoint")).alias("times")))
query("j06_is_in", "SELECT s.* FROM tracks s SEMI JOIN picks USING (trap, cell_label)")(lambda r: T.is_in(r.cell_info.select("trap", "cell_label").distinct(), r.picks))
query("j06b_is_not_in", "SELECT s.* FROM tracks s ANTI JOIN picks USING (trap, cell_label)")(lambda r: T.is_in(r.cell_info.select("trap", "cell_label").distinct(), r.picks, negated=True))
query("j07_validate_lineage", "SELECT l.* FROM lineage l SEMI JOIN (SELECT trap, cell_label AS mother_label FROM tracks) USING (trap, mother_label)")(lambda r: T.validate_lineage(r.lineage, r.cell_info))
query("j07b_used_in_lineage", "SELECT trap, cell_label, cell_label IN (SELECT mother_label FROM lineage l WHERE l.trap = t.trap UNION SELECT daughter_label FROM lineage l WHERE l.trap = t.trap) AS used FROM tracks t")(lambda r: T.used_in_lineage(r.cell_info.select("trap", "cell_label").distinct(), r.lineage))
query("j08_with_mother", "SELECT s.trap, s.cell_label, path, tp, value, coalesce(mother_label, 0) AS mother_label FROM signals s LEFT JOIN lineage l ON l.trap = s.trap AND l.daughter_label = s.cell_label")(lambda r: T.with_mother(r.signals, r.lineage).select("trap", "cell_label", "path", "tp", "value", "mother_label"))
SINGLES = "SELECT trap, left_label, right_label FROM merges WHERE left_label % 4 = 1 AND left_label % 8 <> 1"
query("j09_apply_merges", f"""WITH m AS ({SINGLES}), ok AS (SELECT DISTINCT a.path, m.* FROM m JOIN (SELECT DISTINCT path, trap, cell_label FROM signals) a ON a.trap = m.trap AND a.cell_label = m.left_label JOIN (SELECT DISTINCT path, trap, cell_label FROM signals) b ON b.path = a.path AND b.trap = m.trap AND b.cell_label = m.right_label),
 cut AS (SELECT ok.*, (SELECT max(tp) FROM signals s WHERE s.path = ok.path AND s.trap = ok.trap AND s.cell_label = ok.left_label AND s.value > 0) AS at FROM ok)
 SELECT s.path, s.trap, s.cell_label, s.tp, s.value FROM signals s WHERE NOT EXISTS (SELECT 1 FROM cut c WHERE c.path = s.path AND c.trap = s.trap AND (c.right_label = s.cell_label OR (c.left_label = s.cell_label AND s.tp > c.at)))
 UNION ALL SELECT s.path, s.trap, c.left_label, s.tp, s.value FROM signals s JOIN cut c ON c.path = s.path AND c.trap = s.trap AND c.right_label = s.cell_label WHERE s.tp > c.at""")(lambda r: T.apply_merges(r.signals, r.merges.where("left_label % 4 = 1 AND left_label % 8 <> 1")))
query("j09b_apply_chains", """WITH RECURSIVE tr AS (SELECT DISTINCT path, trap, cell_label FROM signals), one AS (SELECT trap, left_label, min(right_label) AS right_label FROM merges GROUP BY ALL),
 ok AS (SELECT a.path, o.* FROM one o JOIN tr a ON a.trap = o.trap AND a.cell_label = o.left_label JOIN tr b ON b.path = a.path AND b.trap = o.trap AND b.cell_label = o.right_label),
 up AS (SELECT path, trap, right_label AS label, left_label AS start FROM ok UNION ALL SELECT up.path, up.trap, up.label, ok.left_label FROM up JOIN ok ON ok.path = up.path AND ok.trap = up.trap AND ok.right_label = up.start),
 starts AS (SELECT path, trap, label, min(start) AS start FROM up GROUP BY ALL),
 p AS (SELECT s.*, coalesce(start, s.cell_label) AS start FROM signals s LEFT JOIN starts t ON t.path = s.path AND t.trap = s.trap AND t.label = s.cell_label),
 cut AS (SELECT path, trap, start, cell_label, max(tp) FILTER (value > 0) AS cut FROM p GROUP BY ALL),
 k AS (SELECT *, max(cut) OVER (PARTITION BY path, trap, start ORDER BY cell_label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS begin, cell_label = max(cell_label) OVER (PARTITION BY path, trap, start) AS last FROM cut)
 SELECT path, trap, CAST(start AS INT) AS cell_label, tp, arg_max(value, cell_label) AS value FROM p JOIN k USING (path, trap, start, cell_label)
 WHERE (begin IS NULL OR tp > begin) AND (last OR cut IS NULL OR tp <= cut) GROUP BY path, trap, start, tp""")(lambda r: T.apply_merges(r.signals, r.merges))
LINKS = """SELECT position, tile, tp, label, previous, iou FROM (SELECT *, row_number() OVER (PARTITION BY position, tile, tp, label ORDER BY iou DESC, previous) AS k FROM (SELECT s.position, s.tile, s.tp, s.label, s.previous, s.i / (a.n + b.n - s.i) AS iou FROM
 (SELECT m.position, m.tile, m.tp, m.label, p.label AS previous, count(*) AS i FROM masks m JOIN masks p ON p.position = m.position AND p.tile = m.tile AND p.tp = m.tp - 1 AND p.y = m.y AND p.x = m.x GROUP BY ALL) s
 JOIN sizes a ON a.position = s.position AND a.tile = s.tile AND a.tp = s.tp AND a.label = s.label JOIN sizes b ON b.position = s.position AND b.tile = s.tile AND b.tp = s.tp - 1 AND b.label = s.previous)) WHERE k = 1 AND iou >= 0.25"""
query("j10_overlap_links", f"SELECT position, tile, tp, label, previous, {r6('iou', 'iou')} FROM ({LINKS})")(lambda r: rounded(T.overlap_links(r.masks)))
query("j10b_track_ids", f"""WITH RECURSIVE l AS (SELECT position, tile, tp, label, previous FROM (SELECT *, row_number() OVER (PARTITION BY position, tile, tp, previous ORDER BY iou DESC, label) AS k FROM ({LINKS})) WHERE k = 1),
 t AS (SELECT position, tile, tp, label, tp AS tp0, label AS label0 FROM (SELECT DISTINCT {KEYS} FROM masks) ANTI JOIN l USING ({KEYS})
  UNION ALL SELECT l.position, l.tile, l.tp, l.label, t.tp0, t.label0 FROM t JOIN l ON l.position = t.position AND l.tile = t.tile AND l.tp = t.tp + 1 AND l.previous = t.label)
 SELECT position, tile, tp, label, format('{{}}/{{}}/{{:06d}}/{{:06d}}', position, tile, tp0, label0) AS track FROM t""")(lambda r: T.track_ids(r.masks))
TRACKING = "SELECT tile, tp, unnest(cell_label) AS cell_label, mother_assign FROM frames"
query("j11_tracking_table", f"SELECT tile, tp, cell_label, coalesce(mother_assign[cell_label], 0) AS mother_label FROM ({TRACKING})")(lambda r: T.tracking_table(r.frames))
query("j12_consecutives", "SELECT a.trap, a.cell_label, a.timepoint, b.timepoint AS later FROM cell_info a JOIN cell_info b ON b.trap = a.trap AND b.cell_label = a.cell_label AND b.timepoint = a.timepoint + 2")(lambda r: T.consecutives(r.cell_info, 1))
PER = "SELECT trap, timepoint, count(*) AS n FROM cell_info GROUP BY ALL"
query("j13_pairs_over_gaps", f"WITH per AS ({PER}) SELECT a.trap, CAST(sum(a.n * b.n) AS BIGINT) AS npairs FROM per a JOIN per b ON b.trap = a.trap AND b.timepoint - a.timepoint BETWEEN 1 AND 2 GROUP BY 1")(lambda r: T.pairs_over_gaps(r.cell_info, 2))
query("w13_pairs_over_time", f"""WITH per AS ({PER}), added AS (SELECT a.trap, a.timepoint, CAST(coalesce(sum(a.n * b.n), 0) AS BIGINT) AS added FROM per a LEFT JOIN per b ON b.trap = a.trap AND a.timepoint - b.timepoint BETWEEN 1 AND 2 GROUP BY ALL)
 SELECT trap, timepoint, CAST(sum(added) OVER (PARTITION BY trap ORDER BY timepoint) AS BIGINT) AS total, added AS increment FROM added""")(lambda r: T.pairs_over_time(r.cell_info, 2))
query("j14_split_known", "SELECT n.trap, n.cell_label, CAST(s.position AS INT) AS position, s.position IS NOT NULL AS known FROM tracks n LEFT JOIN (SELECT trap, cell_label, row_number() OVER (PARTITION BY trap ORDER BY cell_label) - 1 AS position FROM picks) s USING (trap, cell_label)")(lambda r: T.split_known(r.cell_info, r.picks))
query("s27_modifiers", "SELECT trap, mother_label, daughter_label, CASE WHEN trap % 2 = 0 THEN 'merged' ELSE 'plain' END AS source FROM lineage")(
    lambda r: P.preferred_source(r.lineage.withColumn("source", F.lit("plain")).unionByName(r.lineage.where("trap % 2 = 0").withColumn("source", F.lit("merged"))), {"merged": 0, "plain": 1}, ["trap"])
)
query("a51_overlap_profile", f"SELECT {KEYS}, {r6('avg(v)', 'mean')} FROM objects WHERE c = 0 GROUP BY {KEYS}")(
    lambda r: rounded(P.overlap_profile(M.pixel_metrics(r.objects.where("c = 0").withColumn("label", F.col("label") + 100), ["mean"]).selectExpr(*K, "'mean' AS metric", "mean AS value"), r.masks.select("position", "tile", "tp", (F.col("label") + 100).alias("label"), F.col("label").alias("old_label")).distinct(), ["mean"]))
)
query("a52_expanded_vectors", "SELECT tile, tp, label, " + ", ".join(f'round(CAST(vec[{i + 1}] AS DOUBLE), 6) + 0.0 AS "X_{i}"' for i in range(64)) + " FROM vectors")(lambda r: rounded(P.expanded(r.vectors, 64)))
query("a53_max_labels", "SELECT trap, max(cell_label) AS max_label FROM cell_info GROUP BY 1")(lambda r: T.max_labels(r.cell_info))
query("a54_max_labels_until", "SELECT trap, coalesce(max(cell_label) FILTER (timepoint <= 3), 0) AS max_label FROM cell_info GROUP BY 1")(lambda r: T.max_labels(r.cell_info, 3))
query("a55_counts", "SELECT CAST(count(DISTINCT trap) AS BIGINT) AS ntraps, max(timepoint) + 1 AS ntimepoints FROM cell_info")(lambda r: r.cell_info.agg(F.count_distinct("trap").alias("ntraps"), (F.max("timepoint") + 1).alias("ntimepoints")))
query("a56_info_tree", "SELECT trap, map_from_entries(list(ROW(timepoint, labels) ORDER BY timepoint)) AS tree FROM (SELECT trap, timepoint, list_sort(list(cell_label)) AS labels FROM cell_info GROUP BY ALL) GROUP BY 1")(lambda r: T.info_tree(r.cell_info))
query("a57_accumulated", "SELECT tile, list(cell_label ORDER BY tp) AS cell_label FROM frames GROUP BY 1")(lambda r: T.accumulated(r.frames, "cell_label"))
query("a58_groupsort", "SELECT trap, list_sort(list(DISTINCT cell_label)) AS cells FROM cell_info GROUP BY 1")(lambda r: r.cell_info.groupBy("trap").agg(F.sort_array(F.collect_set("cell_label")).alias("cells")))
OFFSETS = "SELECT trap, n AS cells, CAST(coalesce(sum(n) OVER (ORDER BY trap ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS \"offset\" FROM (SELECT trap, CAST(count(DISTINCT cell_label) AS BIGINT) AS n FROM cell_info GROUP BY 1)"
MD = "SELECT trap, mother, daughter FROM (SELECT trap, mother, CAST(row_number() OVER (PARTITION BY trap ORDER BY cell_label) AS INT) AS daughter FROM last_mothers) WHERE mother <> 0"
query("a59_mother_bud_matrix", f"SELECT CAST(o.\"offset\" + daughter - 1 AS BIGINT) AS bud, CAST(o.\"offset\" + mother - 1 AS BIGINT) AS mother_index FROM ({MD}) JOIN ({OFFSETS}) o USING (trap)")(lambda r: T.mother_bud_pairs(r.cell_info))
query("a60_presence", "SELECT trap, cell_label, " + ", ".join(f'coalesce(bool_or(timepoint = {t}), false) AS "{t}"' for t in range(30)) + " FROM cell_info GROUP BY ALL")(lambda r: T.presence(r.cell_info))
query("a61_histogram", "SELECT CAST(least(19, floor((value - low) / nullif(high - low, 0) * 20)) AS INT) AS bin, CAST(count(*) AS BIGINT) AS n FROM signals, (SELECT min(value) AS low, max(value) AS high FROM signals) WHERE value IS NOT NULL GROUP BY 1")(lambda r: P.histogram(r.signals, "value"))
query("w01_presence_starts", "SELECT trap, cell_label, timepoint FROM (SELECT *, count(*) OVER (PARTITION BY trap, cell_label ORDER BY timepoint RANGE BETWEEN CURRENT ROW AND 2 FOLLOWING) AS n FROM cell_info) WHERE n = 3 AND timepoint >= 2 AND timepoint < 20")(lambda r: T.presence_starts(r.cell_info, 3, 2, 20))
query("w02_label_offsets", OFFSETS)(lambda r: T.label_offsets(r.cell_info))
query("w03_located", f"SELECT CAST(idx AS BIGINT) AS idx, arg_max(trap, \"offset\") AS trap, CAST(idx - max(\"offset\") + 1 AS INT) AS cell_label FROM (SELECT range AS idx FROM range(0, (SELECT count(*) FROM tracks))) JOIN ({OFFSETS}) ON \"offset\" < idx + 1 GROUP BY idx")(
    lambda r: T.located(T.label_offsets(r.cell_info).withColumn("idx", F.explode(F.sequence(F.col("offset"), F.col("offset") + F.col("cells") - 1))).select("idx"), T.label_offsets(r.cell_info))
)
query("w04_last_mothers", "SELECT trap, cell_label, mother FROM last_mothers")(lambda r: T.last_mothers(r.cell_info))
query("w05_mothers_daughters", MD)(lambda r: T.mothers_daughters(r.cell_info))
query("w10_latest", "SELECT position, tile, tp, y, x, label FROM (SELECT *, dense_rank() OVER (PARTITION BY position ORDER BY tp DESC) AS k FROM masks) WHERE k <= 2")(lambda r: P.latest(r.masks, 2, ["position"]))
query("w12_first_where", "SELECT trap, cell_label, coalesce(min(tp) FILTER (value > 50), -1) AS first FROM views GROUP BY ALL")(lambda r: T.first_where(r.signals.where("path = 'extraction/view'"), ["trap", "cell_label"], "tp", F.col("value") > 50))
query("o02_sorted_signal", "SELECT path, trap, cell_label, tp, CAST(row_number() OVER (PARTITION BY path, tp ORDER BY trap, cell_label) AS INT) AS place FROM signals")(lambda r: r.signals.select("path", "trap", "cell_label", "tp", F.row_number().over(Window.partitionBy("path", "tp").orderBy("trap", "cell_label")).alias("place")))
CHAINS = "f AS (SELECT trap, left_label, min(right_label) AS right_label FROM merges GROUP BY ALL), ends AS (SELECT trap, left_label AS label, right_label AS e FROM f UNION ALL SELECT ends.trap, ends.label, f.right_label FROM ends JOIN f ON f.trap = ends.trap AND f.left_label = ends.e), last AS (SELECT trap, label, max(e) AS e FROM ends GROUP BY ALL)"
query("o04_chain_order", f"WITH RECURSIVE {CHAINS} SELECT m.trap, m.left_label, m.right_label, CAST(e AS INT) AS chain, CAST(row_number() OVER (PARTITION BY m.trap, e ORDER BY m.left_label) AS INT) AS depth FROM merges m JOIN last ON last.trap = m.trap AND last.label = m.left_label")(lambda r: T.chain_order(r.merges))
query("o05_preview", "SELECT trap, cell_label FROM tracks ORDER BY trap, cell_label LIMIT 10")(lambda r: r.cell_info.select("trap", "cell_label").distinct().orderBy("trap", "cell_label").limit(10))
query("g01_union_all", f"SELECT {KEYS}, y, x FROM masks UNION ALL SELECT {KEYS}, y, x FROM masks WHERE tp = 0")(lambda r: P.stacked(r.masks, r.masks.where("tp = 0")).select(*K, "y", "x"))
query("g02_components", """WITH RECURSIVE e AS (SELECT concat(trap, '/', left_label) AS a, concat(trap, '/', right_label) AS b FROM merges UNION SELECT concat(trap, '/', right_label), concat(trap, '/', left_label) FROM merges),
 reach AS (SELECT a AS node, a AS other FROM e UNION SELECT r.node, e.b FROM reach r JOIN e ON e.a = r.other) SELECT node, min(other) AS component FROM reach GROUP BY 1""")(
    lambda r: G.components(r.merges.select(F.format_string("%d/%d", "trap", "left_label").alias("a"), F.format_string("%d/%d", "trap", "right_label").alias("b")))
)
query("g02b_merged_sets", """WITH RECURSIVE e AS (SELECT DISTINCT concat('g', trap) AS a, concat('i', left_label) AS b FROM merges), two AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
 reach AS (SELECT a AS node, a AS other FROM two UNION SELECT r.node, e.b FROM reach r JOIN two e ON e.a = r.other) SELECT CAST(substring(node, 2) AS INT) AS item, min(other) AS component FROM reach WHERE node LIKE 'i%' GROUP BY 1""")(lambda r: G.merged_sets(r.merges.select(F.col("left_label").alias("item"), F.col("trap").alias("group")), "item", "group"))
query("g03_group_merges", "SELECT m.*, EXISTS (SELECT 1 FROM merges o WHERE o.trap = m.trap AND (o.right_label = m.left_label OR o.left_label = m.right_label)) AS chained FROM merges m")(lambda r: T.group_merges(r.merges))
query("g04_merge_lineage", """WITH RECURSIVE mo AS (SELECT trap, daughter_label AS k, min(mother_label) AS m FROM lineage GROUP BY ALL),
 v AS (SELECT x.trap, x.left_label, x.right_label FROM merges x LEFT JOIN mo a ON a.trap = x.trap AND a.k = x.left_label LEFT JOIN mo b ON b.trap = x.trap AND b.k = x.right_label WHERE a.m IS NULL OR b.m IS NULL OR a.m = b.m),
 f AS (SELECT trap, left_label, min(right_label) AS right_label FROM v GROUP BY ALL), ends AS (SELECT trap, left_label AS label, right_label AS e FROM f UNION ALL SELECT ends.trap, ends.label, f.right_label FROM ends JOIN f ON f.trap = ends.trap AND f.left_label = ends.e),
 last AS (SELECT trap, label, max(e) AS e FROM ends GROUP BY ALL)
 SELECT DISTINCT l.trap, coalesce(a.e, l.mother_label) AS mother_label, coalesce(b.e, l.daughter_label) AS daughter_label FROM lineage l LEFT JOIN last a ON a.trap = l.trap AND a.label = l.mother_label LEFT JOIN last b ON b.trap = l.trap AND b.label = l.daughter_label""")(lambda r: T.merge_lineage(r.lineage, r.merges))
query("g05_set_operations", "SELECT trap, cell_label, 'both' AS kind FROM tracks SEMI JOIN picks USING (trap, cell_label) UNION ALL SELECT trap, cell_label, 'rest' FROM tracks ANTI JOIN picks USING (trap, cell_label)")(
    lambda r: r.cell_info.select("trap", "cell_label").intersect(r.picks).withColumn("kind", F.lit("both")).unionByName(r.cell_info.select("trap", "cell_label").subtract(r.picks).withColumn("kind", F.lit("rest")))
)
query("g06_distinct_lineage", "SELECT DISTINCT trap, mother_label FROM lineage")(lambda r: r.lineage.select("trap", "mother_label").distinct())
query("x12_index_pairs", "SELECT trap, [[trap, mother_label], [trap, daughter_label]] AS pair FROM lineage")(lambda r: r.lineage.select("trap", F.array(F.array("trap", "mother_label"), F.array("trap", "daughter_label")).alias("pair")))
query("x13_format_segmentation", "SELECT tile AS trap, cell_label, coalesce(mother_assign[cell_label], 0) AS mother_assign_dynamic, tp AS timepoint FROM (SELECT tile, tp, mother_assign, unnest(cell_label[1:least(len(cell_label), len(mother_assign))]) AS cell_label FROM frames)")(lambda r: T.format_segmentation(r.frames))
query("x15_state_rows", "SELECT CAST(max(tp) OVER (PARTITION BY tile) - tp AS INT) AS tp_back, tile AS trap, unnest(range(0, len(cell_label)))::INT AS pos, unnest(cell_label) AS value FROM frames")(lambda r: T.state_rows(r.frames, "cell_label"))
query("x16_states", "SELECT tile AS trap, list(cell_label ORDER BY tp DESC) AS state FROM frames GROUP BY 1")(lambda r: T.states(T.state_rows(r.frames, "cell_label")))
query("r05_latest_labels", "SELECT tile, arg_max(cell_label, tp) AS cell_label FROM frames GROUP BY 1")(lambda r: T.latest_labels(r.frames))

# Stores, hooks and streams ---------------------------------------------------------------------------------------------

MASKS = "SELECT position, tile, tp, y, x, label FROM masks"


@query("s13_mask_store", MASKS)
def _(r: Relations) -> DataFrame:
    return P.pixels_of(P.read_chunks(r.spark, P.write_masks(r.masks, P.new_folder(r.spark, "masks"))))


@query("s14_step_output", "SELECT position, tile, tp, y, x, label FROM masks WHERE tile = 0 AND tp < 3")
def _(r: Relations) -> DataFrame:
    return P.pixels_of(P.read_chunks(r.spark, P.write_masks(r.masks, P.new_folder(r.spark, "steps"))).where("tile = 0 AND tp < 3"))


@query("s15_typed_store", "SELECT trap, cell_label, tp, value FROM views")
def _(r: Relations) -> DataFrame:
    rows = r.signals.where("path = 'extraction/view'").drop("path")
    known = {"trap": "int", "cell_label": "int", "tp": "int", "value": "double"}
    path = P.new_folder(r.spark, "typed")
    P.append_checked(rows.where("tp < 15").withColumn("value", F.lit(0.0)), path, known, ["tp"])
    P.append_checked(rows.where("tp >= 15"), path, known, ["tp"])
    P.write_table(rows.where("tp < 15"), path, ["tp"])  # replaces those timepoints only
    return P.read_table(r.spark, path, rows)


@query("s25_global_sink", f"SELECT 'sizes' AS output, {KEYS}, n FROM sizes")
def _(r: Relations) -> DataFrame:
    df = r.masks.groupBy(*K).agg(F.count("*").alias("n")).withColumn("output", F.lit("sizes"))
    return P.read_table(r.spark, P.write_ranges(df, P.new_folder(r.spark, "outputs"), ["position"], ["output"]), df)


@query("s26_tracking_sink", f"SELECT tile, tp, cell_label, coalesce(mother_assign[cell_label], 0) AS mother_label FROM ({TRACKING})")
def _(r: Relations) -> DataFrame:
    df = T.tracking_table(r.frames)
    return P.read_table(r.spark, P.write_table(df, P.new_folder(r.spark, "tracking"), ["tile"]), df)


WEIGHTS = P.projection(4, 64)(np.eye(64)).T.tolist()  # what the projection makes of unit vectors
query("u03_scored_tiles", "SELECT tile, tp, label, " + ", ".join(r6(f"list_dot_product(CAST(vec AS DOUBLE[]), {w})", f'"X_{i}"') for i, w in enumerate(WEIGHTS)) + " FROM vectors")(
    lambda r: rounded(P.expanded(P.scored_tiles(r.vectors, P.projection(4, 64)), 4, "embedding"))
)


def _pixels_of(content: bytes) -> pd.DataFrame:
    """A decoder of text: a line for each mask pixel, numbers between commas."""
    return pd.DataFrame(np.array(content.replace(b"\n", b",").split(b",")[:-1]).astype(np.int64).reshape(-1, 6) if content else np.empty((0, 6), np.int64))


@query("s04b_decoded", MASKS)
def _(r: Relations) -> DataFrame:
    """Files that a user's decoder reads, any number of them."""
    source, names = P.new_folder(r.spark, "raw"), ["position", "tile", "tp", "y", "x", "label"]
    r.masks.select(F.concat_ws(",", *names).alias("value")).write.text(source)
    types = {f.name: f.dataType.simpleString() for f in r.masks.schema}
    return C.decoded(C.contents(r.spark, source, "*.txt"), _pixels_of, ", ".join(f"{n} {types[n]}" for n in names)).select(*r.masks.columns)


query("u05_hook", "SELECT trap, CAST(count(*) AS BIGINT) AS n FROM cell_info GROUP BY 1")(lambda r: r.cell_info.transform(lambda df: df.groupBy("trap").agg(F.count("*").alias("n"))))


def _paths(part: pd.DataFrame) -> pd.DataFrame:
    out = part.groupby(["position", "label"], as_index=False).agg(first=("tp", "min"), frames=("tp", "nunique"))
    return out.astype({"position": np.int64, "label": np.int32, "first": np.int32, "frames": np.int64})


query("r06_global_step", "SELECT position, label, min(tp) AS first, CAST(count(DISTINCT tp) AS BIGINT) AS frames FROM masks GROUP BY ALL")(lambda r: P.global_step(r.masks, _paths, "position long, label int, first int, frames long"))
TRACKED = f"""WITH RECURSIVE l AS (SELECT position, tile, tp, label, previous FROM (SELECT *, row_number() OVER (PARTITION BY position, tile, tp, previous ORDER BY iou DESC, label) AS k FROM ({LINKS})) WHERE k = 1),
 t AS (SELECT position, tile, tp, label, tp AS tp0, label AS label0 FROM (SELECT DISTINCT {KEYS} FROM masks) ANTI JOIN l USING ({KEYS})
  UNION ALL SELECT l.position, l.tile, l.tp, l.label, t.tp0, t.label0 FROM t JOIN l ON l.position = t.position AND l.tile = t.tile AND l.tp = t.tp + 1 AND l.previous = t.label)
 SELECT position, tile, tp, label, CAST(dense_rank() OVER (PARTITION BY position, tile ORDER BY tp0, label0) AS INT) AS track FROM t"""
query("r02_tracked_batch", TRACKED)(lambda r: S.tracked(r.masks))


@query("r01_incremental_frames", f"SELECT {KEYS}, n FROM sizes")
def _(r: Relations) -> DataFrame:
    """Frames come in pieces, over several files and batches; sizes are taken of the table that the stream fills."""
    source, out, rows = P.new_folder(r.spark, "in"), P.new_folder(r.spark, "frames"), S.announced(r.masks)
    rows.repartition(6).write.parquet(source)
    S.append_new_frames(S.read_masks(r.spark, source, rows.schema, 2), out, P.new_folder(r.spark, "state"))
    return S.read_frames(r.spark, out, r.masks.schema).groupBy(*K).agg(F.count("*").alias("n"))


@query("r04_first_write_wins", MASKS)
def _(r: Relations) -> DataFrame:
    """A second writer brings other labels, and all of it comes twice, in two streams: the first writer's rows are there."""
    source, out, rows = P.new_folder(r.spark, "in"), P.new_folder(r.spark, "frames"), S.announced(r.masks)
    rows.repartition(4).write.parquet(source)
    rows.withColumn("label", F.col("label") + 100).repartition(3).write.mode("append").parquet(source)
    for _ in range(2):
        S.append_new_frames(S.read_masks(r.spark, source, rows.schema, 100), out, P.new_folder(r.spark, "state"))
    return S.read_frames(r.spark, out, r.masks.schema)


@query("r04b_unique_frames", "SELECT DISTINCT position, tp FROM masks")
def _(r: Relations) -> DataFrame:
    """All frames come twice."""
    source, out = P.new_folder(r.spark, "in"), P.new_folder(r.spark, "frames")
    rows = r.masks.select("position", "tp", F.timestamp_seconds(F.col("tp") * 60 + 1_600_000_000).alias("ts")).distinct()
    for _ in range(2):
        rows.repartition(2).write.mode("append").parquet(source)
    S.run_to_table(S.unique_frames(r.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(source)), out, P.new_folder(r.spark, "state"))
    return r.spark.read.schema(rows.schema).parquet(out).select("position", "tp")


@query("r02_tracked_stream", TRACKED)
def _(r: Relations) -> DataFrame:
    """Markers and rows come in files of their own, the markers of half of the frames before their rows, others after."""
    source, out = P.new_folder(r.spark, "in"), P.new_folder(r.spark, "tracks")
    marked = S.with_markers(r.masks, r.pixels, r.masks)
    early = F.col("label").isNull() == (F.col("tp") % 2 == 0)
    for part in (marked.where(early), marked.where(~early)):
        part.repartition(2).write.mode("append").parquet(source)
    S.run_to_table(S.tracked_stream(S.read_masks(r.spark, source, marked.schema, 2).drop(S.WRITER)), out, P.new_folder(r.spark, "state"))
    return r.spark.read.schema(S.TRACKS).parquet(out)


@query("r03_state_snapshots", "SELECT CAST(max(tp) OVER (PARTITION BY tile) - tp AS INT) AS tp_back, tile AS trap, unnest(range(0, len(cell_label)))::INT AS pos, unnest(cell_label) AS value FROM frames")
def _(r: Relations) -> DataFrame:
    df = T.state_rows(r.frames, "cell_label")
    return P.read_table(r.spark, P.write_table(df, P.new_folder(r.spark, "snapshots"), ["tp_back"]), df)


FLAGSHIP = QUERIES["u06_default_profile"]
