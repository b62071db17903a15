"""Measurements of objects: which pixels belong to an object, and what is computed from them.

An object is keyed by position, tile, tp and label. Metrics that SQL can express are aggregate expressions, all computed
in one aggregation; those that need an object's shape run per object in numpy, on tables that are grouped by the key.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opalgrid.operators.graphs import checkpointed

KEYS = ["position", "tile", "tp", "label"]
KEY_TYPES = "position long, tile int, tp int, label int"
PLANE = ["position", "tp", "c", "y", "x"]

REDUCERS: dict[str, Callable[[str], Column]] = {
    "max": F.max,
    "add": F.sum,
    "mean": F.avg,
    "median": F.median,
    "div": lambda v: F.aggregate(
        F.slice(F.sort_array(F.collect_list(F.struct("z", v))), 2, 1 << 30), F.min_by(v, "z"), lambda a, s: F.try_divide(a, s[v])
    ),
}


def reduce_z(pixels: DataFrame, fun: str, value: str = "value") -> DataFrame:
    """One plane for each position, tp and channel: max, add, mean or median over z, or div, the values in z order each
    divided by the next (null after a zero)."""
    return pixels.groupBy(*PLANE).agg(REDUCERS[fun](value).alias("v"))


COMBINED: dict[str, Callable[[Column, Column], Column]] = {"add": lambda a, b: a + b, "max": F.greatest, "div": F.try_divide}


def combine_channels(planes: DataFrame, first: int, second: int, fun: str, name: int = -1) -> DataFrame:
    """A new channel from two: add, max or div of their values at each pixel. Channels become columns first: no self-join."""
    both = planes.groupBy("position", "tp", "y", "x").pivot("c", [first, second]).agg(F.first("v")).dropna()
    return both.select("position", "tp", F.lit(name).alias("c"), "y", "x", COMBINED[fun](F.col(str(first)), F.col(str(second))).alias("v"))


def object_pixels(masks: DataFrame, planes: DataFrame) -> DataFrame:
    """The pixels of every object in every channel. A pixel may belong to several objects or stacks of masks."""
    return masks.join(planes, ["position", "tp", "y", "x"]).select(*[c for c in ("stack",) if c in masks.columns], *KEYS, "c", "y", "x", "v")


# Aggregate expressions -------------------------------------------------------------------------------------------------

MASK_METRICS: dict[str, Callable[[], Column]] = {
    "area": lambda: F.count("*").cast("double"),
    "centroid_x": lambda: F.avg(F.col("x") + 1),
    "centroid_y": lambda: F.avg(F.col("y") + 1),
    "spherical_volume": lambda: 4 / 3 * F.pi() * F.pow(F.count("*") / F.pi(), 1.5),
}


def _inertia() -> Column:
    m = F.sum("v")
    spread = [F.sum(F.col(a) * F.col(a) * F.col("v")) - F.try_divide(F.sum(F.col(a) * F.col("v")) * F.sum(F.col(a) * F.col("v")), m) for a in ("xx", "yy")]
    return F.try_divide(spread[0] + spread[1], m * m)


PIXEL_METRICS: dict[str, Callable[[], Column]] = {
    "mean": lambda: F.avg("v"),
    "total": lambda: F.sum("v"),
    "total_squared": lambda: F.sum(F.col("v") * F.col("v")),
    "median": lambda: F.median("v"),
    "std": lambda: F.stddev_pop("v"),
    "min": lambda: F.min("v"),
    "max": lambda: F.max("v"),
    "lower_quartile": lambda: F.percentile("v", F.lit(0.25)),
    "upper_quartile": lambda: F.percentile("v", F.lit(0.75)),
    "moment_of_inertia": _inertia,
}


def mask_metrics(masks: DataFrame, names: Iterable[str]) -> DataFrame:
    """A column for each mask-only metric; pixels are never joined."""
    return masks.groupBy(*KEYS).agg(*[MASK_METRICS[n]().alias(n) for n in names])


def pixel_metrics(objects: DataFrame, names: Iterable[str]) -> DataFrame:
    """A column for each metric of an object in a channel, all in one aggregation."""
    one_based = objects.withColumns({"xx": F.col("x") + 1.0, "yy": F.col("y") + 1.0})
    return one_based.groupBy(*KEYS, "c").agg(*[PIXEL_METRICS[n]().alias(n) for n in names])


def top_share(objects: DataFrame, share: float = 0.025, name: str = "max2p5pc") -> DataFrame:
    """Mean of the ceil(share * n) largest values of each object and channel."""
    w = Window.partitionBy(*KEYS, "c")
    ranked = objects.withColumns({"_k": F.row_number().over(w.orderBy(F.desc("v"))), "_n": F.count("*").over(w)})
    return ranked.where(F.col("_k") <= F.ceil(F.col("_n") * share)).groupBy(*KEYS, "c").agg(F.avg("v").alias(name))


def top5_median(objects: DataFrame, name: str = "max5px_median") -> DataFrame:
    """Mean of the five largest values over the median; null up to five pixels, or where the median is 0."""
    ranked = objects.withColumn("_k", F.row_number().over(Window.partitionBy(*KEYS, "c").orderBy(F.desc("v"))))
    top = F.avg(F.when(F.col("_k") <= 5, F.col("v")))
    return ranked.groupBy(*KEYS, "c").agg(F.when(F.count("*") > 5, F.try_divide(top, F.median("v"))).alias(name))


def two_channels(objects: DataFrame, first: int, second: int) -> DataFrame:
    """Pixels of objects with the values of two channels side by side: v0, v1, null where a channel has no such pixel."""
    wide = objects.where(F.col("c").isin(first, second)).groupBy(*KEYS, "y", "x").pivot("c", [first, second]).agg(F.first("v"))
    return wide.withColumnsRenamed({str(first): "v0", str(second): "v1"})


def ratio(pairs: DataFrame) -> DataFrame:
    """Median of v0 / v1; null if any v1 is 0."""
    value = F.when(~F.bool_or(F.col("v1") == 0), F.median(F.try_divide("v0", "v1")))
    return pairs.groupBy(*KEYS).agg(value.alias("ratio"))


def background(masks: DataFrame, planes: DataFrame) -> DataFrame:
    """Pixels in no mask, of each position, tp and channel: their median and the mean of the five largest."""
    outside = planes.join(masks.select("position", "tp", "y", "x").distinct(), ["position", "tp", "y", "x"], "left_anti")
    plane = ["position", "tp", "c"]
    five = outside.withColumn("_k", F.row_number().over(Window.partitionBy(*plane).orderBy(F.desc("v")))).where("_k <= 5")  # kept to five before the shuffle
    tops = five.groupBy(*plane).agg(F.avg("v").alias("background_max5"))
    return outside.groupBy(*plane).agg(F.median("v").alias("background")).join(tops, plane)


def pearson(pairs: DataFrame) -> DataFrame:
    """Correlation of two channels and slope of the second on the first, over pixels that both have; null without spread."""
    v0, v1 = F.when(F.col("v1").isNotNull(), F.col("v0")), F.when(F.col("v0").isNotNull(), F.col("v1"))
    cov = F.covar_pop("v0", "v1")
    r = F.try_divide(cov, F.stddev_pop(v0) * F.stddev_pop(v1))
    return pairs.groupBy(*KEYS).agg(r.alias("pearson"), F.try_divide(cov, F.var_pop(v0)).alias("slope"))


def manders_fold(pairs: DataFrame, share: float = 0.15) -> DataFrame:
    """Manders' fractions: of each channel's sum, what lies where the other is over `share` of its maximum."""
    w = Window.partitionBy(*KEYS)
    t = pairs.withColumns({"t0": share * F.max("v0").over(w), "t1": share * F.max("v1").over(w)})
    part = lambda v, o: F.try_divide(F.sum(F.when(F.col(f"v{o}") >= F.col(f"t{o}"), F.col(f"v{v}")).otherwise(0.0)), F.sum(f"v{v}"))
    return t.where("v0 >= t0 OR v1 >= t1").groupBy(*KEYS).agg(part(0, 1).alias("manders_1"), part(1, 0).alias("manders_2"))


def rwc(pairs: DataFrame, share: float = 0.15) -> DataFrame:
    """Rank-weighted colocalisation: Manders' fractions, each pixel weighted by how near its two ranks are."""
    w = Window.partitionBy(*KEYS)
    ranked = pairs.withColumns({"r0": F.dense_rank().over(w.orderBy(F.asc_nulls_last("v0"))), "r1": F.dense_rank().over(w.orderBy(F.asc_nulls_last("v1"))), "t0": share * F.max("v0").over(w), "t1": share * F.max("v1").over(w)})
    ranked = ranked.withColumn("n", F.greatest(F.max("r0").over(w), F.max("r1").over(w)))
    weight = (F.col("n") - F.abs(F.col("r0") - F.col("r1"))) / F.col("n")
    both = F.col("v0").__ge__(F.col("t0")) & F.col("v1").__ge__(F.col("t1"))
    part = lambda v: F.try_divide(F.sum(F.when(both, F.col(v) * weight).otherwise(0.0)), F.sum(F.when(F.col(v) >= F.col(f"t{v[1]}"), F.col(v)).otherwise(0.0)))
    return ranked.groupBy(*KEYS).agg(part("v0").alias("rwc_1"), part("v1").alias("rwc_2"))


def rim(masks: DataFrame) -> DataFrame:
    """masks with the number of a pixel's four neighbours that are of its object: inside."""
    keep = [c for c in masks.columns if c != "inside"]
    near = F.lit(0)
    for line, along in (("y", "x"), ("x", "y")):
        w = Window.partitionBy(*KEYS, line).orderBy(along)
        for step in (-1, 1):
            near = near + (F.count("*").over(w.rangeBetween(step, step)) > 0).cast("int")
    return masks.select(*keep, near.alias("inside"))


def sizeshape(masks: DataFrame) -> DataFrame:
    """Bounding box, extent, axes of the ellipse with the same second moments, eccentricity, orientation, perimeter (outer
    edges) and equivalent diameter of each object."""
    pixels = masks if "inside" in masks.columns else rim(masks)
    yy, xx, xy = F.var_pop("y") + 1 / 12, F.var_pop("x") + 1 / 12, F.covar_pop("y", "x")
    stats = pixels.groupBy(*KEYS).agg(
        F.count("*").alias("area"), F.min("y").alias("min_y"), F.max("y").alias("max_y"), F.min("x").alias("min_x"), F.max("x").alias("max_x"),
        yy.alias("yy"), xx.alias("xx"), xy.alias("xy"), F.sum(4 - F.col("inside")).cast("long").alias("perimeter"),
    )
    root = F.sqrt(F.pow(F.col("yy") - F.col("xx"), 2) / 4 + F.pow("xy", 2))
    mid = (F.col("yy") + F.col("xx")) / 2
    box = (F.col("max_y") - F.col("min_y") + 1) * (F.col("max_x") - F.col("min_x") + 1)
    major, minor = 4 * F.sqrt(mid + root), 4 * F.sqrt(F.greatest(mid - root, F.lit(0.0)))
    return stats.select(
        *KEYS, "area", "min_y", "max_y", "min_x", "max_x", "perimeter", (F.col("area") / box).alias("extent"), F.sqrt(4 * F.col("area") / F.pi()).alias("equivalent_diameter"),
        major.alias("major_axis"), minor.alias("minor_axis"), F.sqrt(1 - F.try_divide(minor * minor, major * major)).alias("eccentricity"),
    )


def intensity(objects: DataFrame, masks: DataFrame | None = None) -> DataFrame:
    """Integrated, mean, deviation, extremes, quartiles, median absolute deviation and mass displacement; with masks, or
    where objects say how many neighbours of a pixel are inside (see rim), the same sums over edge pixels."""
    if masks is not None and "inside" not in objects.columns:
        objects = objects.join(rim(masks).select(*KEYS, "y", "x", "inside"), [*KEYS, "y", "x"])
    centred = objects.withColumn("_off", F.abs(F.col("v") - F.median("v").over(Window.partitionBy(*KEYS, "c"))))
    shift = lambda a: F.pow(F.try_divide(F.sum(F.col(a) * F.col("v")), F.sum("v")) - F.avg(a), 2)
    edge = F.when(F.col("inside") < 4, F.col("v")) if masks is not None else None
    edges = [F.sum(edge).alias("integrated_edge"), F.avg(edge).alias("mean_edge"), F.stddev_pop(edge).alias("std_edge")] if masks is not None else []
    return centred.groupBy(*KEYS, "c").agg(
        F.sum("v").alias("integrated"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.percentile("v", F.lit(0.25)).alias("lower_quartile"), F.median("v").alias("median"), F.percentile("v", F.lit(0.75)).alias("upper_quartile"),
        F.sqrt(shift("x") + shift("y")).alias("mass_displacement"), F.median("_off").alias("mad"), *edges,
    )


#: Offsets of grey-level pairs: along a row, along a column, and along both diagonals.
DIRECTIONS = ((0, 1), (1, 0), (1, 1), (1, -1))


def texture(objects: DataFrame, levels: int = 8, steps: Iterable[tuple[int, int]] = DIRECTIONS) -> DataFrame:
    """Haralick's contrast, energy, homogeneity and entropy of the grey-level pairs within an object, in each direction:
    columns contrast_0 and so on, by the place of the direction among `steps`. Null where no pair lies in a direction."""
    w = Window.partitionBy(*KEYS, "c")
    low, high = F.min("v").over(w), F.max("v").over(w)
    grey = objects.withColumn("g", F.least(F.lit(levels - 1), F.floor(F.coalesce(F.try_divide(F.col("v") - low, high - low), F.lit(0.0)) * levels)).cast("int"))
    ways = []
    for k, (dy, dx) in enumerate(steps):  # the partner lies on the pixel's line in this direction, one step on
        line = Window.partitionBy(*KEYS, "c", dy * F.col("x") - dx * F.col("y")).orderBy(dy * F.col("y") + dx * F.col("x"))
        length = dy * dy + dx * dx
        ways.append(F.struct(F.lit(k).alias("way"), F.max("g").over(line.rangeBetween(length, length)).alias("g2")))
    found = grey.select(*KEYS, "c", "g", F.array(*ways).alias("_w")).select(*KEYS, "c", "g", F.explode("_w").alias("_w")).select(*KEYS, "c", "g", "_w.*")
    pairs = found.where("g2 IS NOT NULL").groupBy(*KEYS, "c", "way", "g", "g2").agg(F.count("*").alias("n"))
    p, d = F.col("n") / F.sum("n").over(Window.partitionBy(*KEYS, "c", "way")), F.col("g") - F.col("g2")
    sums = {"contrast": d * d * F.col("p"), "energy": F.col("p") * F.col("p"), "homogeneity": F.col("p") / (1 + d * d), "entropy": -F.col("p") * F.log2("p")}
    ways = range(len(tuple(steps)))
    return pairs.withColumn("p", p).groupBy(*KEYS, "c").agg(*[F.sum(F.when(F.col("way") == k, v)).alias(f"{n}_{k}") for k in ways for n, v in sums.items()])


def radial_distribution(objects: DataFrame, bins: int = 4) -> DataFrame:
    """Of each ring of normalised distance from the centroid: fraction of the intensity, mean fraction, and spread over 8 wedges."""
    w = Window.partitionBy(*KEYS, "c")
    dy, dx = F.col("y") - F.avg("y").over(w), F.col("x") - F.avg("x").over(w)
    placed = objects.withColumns({"dy": dy, "dx": dx}).withColumn("r", F.sqrt(F.col("dy") * F.col("dy") + F.col("dx") * F.col("dx")))
    ring = F.least(F.lit(bins - 1), F.floor(F.coalesce(F.try_divide(F.col("r"), F.max("r").over(w)), F.lit(0.0)) * bins)).cast("int")
    wedge = (F.when(F.col("dy") > 0, 1).otherwise(0) + F.when(F.col("dx") > 0, 2).otherwise(0) + F.when(F.abs("dx") > F.abs("dy"), 4).otherwise(0)).alias("wedge")
    by_wedge = placed.withColumn("ring", ring).groupBy(*KEYS, "c", "ring", wedge).agg(F.sum("v").alias("s"), F.count("*").alias("n"), F.avg("v").alias("m"))
    rings = by_wedge.groupBy(*KEYS, "c", "ring").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.try_divide(F.stddev_pop("m"), F.avg("m")).alias("radial_cv"))
    share = F.try_divide(F.col("s"), F.sum("s").over(w))
    return rings.select(*KEYS, "c", "ring", share.alias("frac_at_d"), F.try_divide(share, F.col("n") / F.sum("n").over(w)).alias("mean_frac"), "radial_cv")


def radial_profile(objects: DataFrame, bins: int = 4) -> DataFrame:
    """radial_distribution with a column for each ring: frac_at_d_0 and so on."""
    columns = [F.max(F.when(F.col("ring") == k, F.col(n))).alias(f"{n}_{k}") for k in range(bins) for n in ("frac_at_d", "mean_frac", "radial_cv")]
    return radial_distribution(objects, bins).groupBy(*KEYS, "c").agg(*columns)


def zernike(objects: DataFrame, degree: int = 9, value: Column | None = None) -> DataFrame:
    """Magnitudes of the Zernike moments up to a degree, on the circle about the centroid that encloses the object. With
    value, weighted by it (radial moments of a channel); without, of the mask."""
    w = Window.partitionBy(*KEYS, "c")
    dy, dx = F.col("y") - F.avg("y").over(w), F.col("x") - F.avg("x").over(w)
    placed = objects.withColumns({"dy": dy, "dx": dx}).withColumn("d", F.sqrt(F.col("dy") * F.col("dy") + F.col("dx") * F.col("dx")))
    unit = placed.withColumns({"r": F.coalesce(F.try_divide(F.col("d"), F.max("d").over(w)), F.lit(0.0)), "a": F.atan2("dy", "dx"), "k": value if value is not None else F.lit(1.0)})
    columns = []
    for n in range(degree + 1):
        for m in range(n % 2, n + 1, 2):
            radial = sum((F.lit((-1) ** s * math.factorial(n - s) / (math.factorial(s) * math.factorial((n + m) // 2 - s) * math.factorial((n - m) // 2 - s))) * F.pow("r", n - 2 * s) for s in range((n - m) // 2 + 1)), F.lit(0.0))
            real, imaginary = F.sum(radial * F.cos(m * F.col("a")) * F.col("k")), F.sum(radial * F.sin(m * F.col("a")) * F.col("k"))
            columns.append((F.try_divide((n + 1) / F.pi() * F.sqrt(real * real + imaginary * imaginary), F.sum("k"))).alias(f"zernike_{n}_{m}"))
    return unit.groupBy(*KEYS, "c").agg(*columns)


# Per object, in numpy --------------------------------------------------------------------------------------------------


def filled(y: np.ndarray, x: np.ndarray, pad: int = 1) -> np.ndarray:
    """The boolean bounding box of pixels, with `pad` empty pixels around."""
    out = np.zeros((y.max() - y.min() + 1 + 2 * pad, x.max() - x.min() + 1 + 2 * pad), bool)
    out[y - y.min() + pad, x - x.min() + pad] = True
    return out


def distances(mask: np.ndarray) -> np.ndarray:
    """Euclidean distance of each true pixel to the nearest false one; 0 at false ones, and where there is none. The last
    two axes are the image; before them may stand an axis of images of one size.

    Down the columns distances come from running maxima; along the rows, offsets grow until none can be nearer.
    """
    far = sum(mask.shape[-2:])
    at = np.arange(mask.shape[-2], dtype=np.int64)[:, None]
    above = at - np.maximum.accumulate(np.where(mask, -far, at), axis=-2)
    below = np.flip(np.minimum.accumulate(np.flip(np.where(mask, 2 * far, at), -2), axis=-2), -2) - at
    column = np.minimum(np.minimum(above, below), far) ** 2
    column *= ~mask.all(axis=(-2, -1), keepdims=True)
    out, k = column.copy(), 1
    while k < mask.shape[-1] and k * k < out.max():
        np.minimum(out[..., k:], column[..., :-k] + k * k, out=out[..., k:])
        np.minimum(out[..., :-k], column[..., k:] + k * k, out=out[..., :-k])
        k += 1
    return np.sqrt(out)


#: Pixels of boxes that are measured at once.
STACK = 2_000_000


def stacks(ys: Sequence[np.ndarray], xs: Sequence[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Objects, given by their pixels, as stacks of boxes of like size with empty pixels around: which objects, the stack,
    and each of their pixels' row and column, one object after the other."""
    tops, lefts = (np.array([a.min() for a in v]) for v in (ys, xs))
    sizes = np.array([(y.max() - top + 3, x.max() - left + 3) for y, x, top, left in zip(ys, xs, tops, lefts, strict=True)])
    classes = 1 << np.ceil(np.log2(sizes)).astype(int)  # powers of two, so that few sizes occur
    order = np.lexsort((classes[:, 1], classes[:, 0]))
    begin = 0
    while begin < len(order):
        h, w = classes[order[begin]]
        end = begin + int(np.argmin(np.append((classes[order[begin:]] == (h, w)).all(axis=1), False)))
        for some in np.split(order[begin:end], range(max(1, STACK // (h * w)), end - begin, max(1, STACK // (h * w)))):
            y, x = (np.concatenate([v[i] - first[i] + 1 for i in some]) for v, first in ((ys, tops), (xs, lefts)))
            n = np.repeat(np.arange(len(some)), [len(ys[i]) for i in some])
            out = np.zeros((len(some), h, w), bool)
            out[n, y, x] = True
            yield some, out, y, x
        begin = end


def _of_shapes(masks: DataFrame, kind: str, measure: Callable[[list[np.ndarray], list[np.ndarray]], Any]) -> DataFrame:
    """KEYS, y, x (arrays of an object's pixels) and d: measure() of many objects' pixels at once."""
    one_each = masks.groupBy(*KEYS).agg(F.collect_set(F.struct("y", "x")).alias("_p")).select(*KEYS, F.col("_p.y").alias("y"), F.col("_p.x").alias("x"))

    @F.pandas_udf(kind)
    def run(y: pd.Series, x: pd.Series) -> pd.Series:
        return pd.Series(measure(list(y), list(x)) if len(y) else [])

    return one_each.withColumn("d", run("y", "x"))


def depths(ys: list[np.ndarray], xs: list[np.ndarray]) -> list[np.ndarray]:
    """The distance of each pixel of each object to the nearest pixel outside it."""
    out: list = [None] * len(ys)
    for some, stack, y, x in stacks(ys, xs):
        n = [len(ys[i]) for i in some]
        d = distances(stack)[np.repeat(np.arange(len(some)), n), y, x]
        for i, one in zip(some, np.split(d, np.cumsum(n)[:-1]), strict=True):
            out[i] = one
    return out


def distance_map(masks: DataFrame) -> DataFrame:
    """Distance d of each pixel of an object to the nearest pixel outside it. A repeated pixel counts once."""
    return _of_shapes(masks, "array<double>", depths).select(*KEYS, F.inline(F.arrays_zip("y", "x", "d")))


def conical_volume(masks: DataFrame) -> DataFrame:
    """Four times the sum of the distances of an object's pixels to its outside."""
    return _of_shapes(masks, "double", lambda y, x: [4 * d.sum() for d in depths(y, x)]).select(*KEYS, F.col("d").alias("conical_volume"))


def axes_of(masks: np.ndarray) -> np.ndarray:
    """Half axes, shorter and longer, of each of a stack of objects, from three distance maps; halves round to even."""
    near = distances(masks)
    dn = distances(near != near.max(axis=(-2, -1), keepdims=True)) * masks
    cone = distances(dn == 0) * masks
    return np.stack([np.round(near.max(axis=(-2, -1))), np.round(dn.max(axis=(-2, -1)) + cone.sum(axis=(-2, -1)) / 2)], axis=-1)


def half_axes(ys: list[np.ndarray], xs: list[np.ndarray]) -> list[np.ndarray]:
    out = np.zeros((len(ys), 2))
    for some, stack, _, _ in stacks(ys, xs):
        out[some] = axes_of(stack)
    return list(out)


def shape_metrics(masks: DataFrame) -> DataFrame:
    """minor, major, eccentricity and volume of each object, from its distance maps."""
    found = _of_shapes(masks, "array<double>", half_axes).select(*KEYS, F.col("d")[0].alias("minor"), F.col("d")[1].alias("major"))
    a, b = F.col("minor"), F.col("major")
    return found.select(*KEYS, "minor", "major", F.try_divide(F.sqrt(F.greatest(F.lit(0.0), b * b - a * a)), b).alias("eccentricity"), (4 / 3 * math.pi * a * a * b).alias("volume"))


def convolved(image: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Same-size convolution with zeros around, by Fourier transforms."""
    shape = [a + b - 1 for a, b in zip(image.shape, kernel.shape, strict=True)]
    axes = tuple(range(image.ndim))
    out = np.fft.irfftn(np.fft.rfftn(image, shape, axes) * np.fft.rfftn(kernel, shape, axes), shape, axes)
    return out[tuple(slice((k - 1) // 2, (k - 1) // 2 + n) for k, n in zip(kernel.shape, image.shape, strict=True))]


def bell(side: int, *spread: float) -> np.ndarray:
    """A Gaussian kernel that sums to one, exp(-x^2 / (2 s)) along each axis with its spread s; tiny values are cut to 0."""
    at = np.arange(side) - (side - 1) / 2
    grids = np.meshgrid(*[at] * len(spread), indexing="ij")
    k = np.exp(-sum(g**2 / (2 * s) for g, s in zip(grids, spread, strict=True)))
    k[k < np.finfo(float).eps * k.max()] = 0
    return k / k.sum()


def small_peaks(image: np.ndarray, mask: np.ndarray) -> float:
    """Largest value inside the mask of the whole image summed over a disk of radius 3 (0.025 n) / 5, n values of the
    object not zero; zeros lie around the image."""
    r = 3 * (0.025 * np.count_nonzero(image[mask])) / 5
    k = int(np.ceil(r))
    g = np.mgrid[-k : k + 1, -k : k + 1]
    return float(convolved(image, ((g**2).sum(axis=0) <= r * r).astype(float))[mask].max())


def nucleus_estimate(image: np.ndarray, mask: np.ndarray, room: Sequence[tuple[int, int]], alpha: float = 0.95, share: float = 0.085, z_ratio: float = 1.0) -> float:
    """Best match of a Gaussian of the size a nucleus would have, in a plane or a stack of planes: of the object less its
    median, zero around it, convolved and divided by what a flat nucleus would give.

    image and mask are a window of the image; room says how far the image goes on before and after it, down and along. A
    plane's kernel has the variance sigma^2; a stack's has sigma, and sigma * z_ratio across planes, as its variance.
    """
    values = image[mask]
    quantile = -2 * math.log(1 - alpha)
    r = math.sqrt(share * np.count_nonzero(values) / math.pi)
    sigma = r / math.sqrt(quantile)
    if not sigma:
        return float("nan")
    side = int(np.ceil(2 * r))
    k = bell(2 * side + 1, *((sigma**2,) * 2 if image.ndim == 2 else (sigma * z_ratio, sigma, sigma)))
    # Beyond the kernel's reach of the object, all is zero: one such pixel stands for the rest of the image.
    cuts, pads = [slice(None)] * (image.ndim - 2), [(0, 0)] * (image.ndim - 2)
    for axis, (before, after) in zip((-2, -1), room, strict=True):
        held = np.flatnonzero(mask.any(axis=tuple(a for a in range(-image.ndim, 0) if a != axis)))
        cuts.append(slice(held[0], held[-1] + 1))
        pads.append((min(side + 1, held[0] + before), min(side + 1, image.shape[axis] - 1 - held[-1] + after)))
    own = np.pad(np.where(mask, image - np.median(values), 0)[tuple(cuts)], pads)
    return float(convolved(own, k).max() / ((k**2).sum() * alpha * math.pi * quantile * sigma**2))


#: Sides of the squares that pixels are dealt by where windows meet them.
SQUARE = 64


def _windows(masks: DataFrame, pixels: DataFrame, value: str, reach: float, fn: Callable[..., tuple], names: list[str], tiles: DataFrame | None) -> DataFrame:
    """fn(image, mask, room) of each object in each channel, over its window of the image: its bounding box and, around it, the
    number of its pixels times `reach`. Missing pixels are 0. The image is what a position has at one tp or, with tiles
    (position, tile, y0, x0, h, w), the object's tile.

    A window meets the pixels of the squares that it touches: no task holds an image, and no window is transformed but its own.
    """
    deep = "z" in pixels.columns
    frame = ["position", "tp"]
    if tiles is not None:
        inside = (F.col("y") >= F.col("y0")) & (F.col("y") < F.col("y0") + F.col("h")) & (F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x0") + F.col("w"))
        masks = masks.join(tiles.select("position", "tile", "y0", "x0", "h", "w"), ["position", "tile"]).where(inside).select(*KEYS, "y", "x")
    boxes = masks.groupBy(*KEYS).agg(F.collect_set(F.struct("y", "x")).alias("_m")).select(*KEYS, F.col("_m.y").alias("my"), F.col("_m.x").alias("mx"))
    planes = pixels.groupBy(*frame, "c").agg(*[f(a).alias(f"{n}{a}") for a in ("y", "x", *["z"] * deep) for n, f in (("least_", F.min), ("most_", F.max))])
    if tiles is None:
        of_masks = masks.groupBy(*frame).agg(*[f(a).alias(f"{n}{a}_") for a in ("y", "x") for n, f in (("least_", F.min), ("most_", F.max))])
        planes = planes.join(of_masks, frame)
        planes = planes.withColumns({f"{n}{a}": f(f"{n}{a}", f"{n}{a}_") for a in ("y", "x") for n, f in (("least_", F.least), ("most_", F.greatest))}).drop(*[f"{n}{a}_" for a in "yx" for n in ("least_", "most_")])
        each = boxes.join(planes, frame)
    else:
        own = tiles.select("position", "tile", F.col("y0").alias("least_y"), (F.col("y0") + F.col("h") - 1).alias("most_y"), F.col("x0").alias("least_x"), (F.col("x0") + F.col("w") - 1).alias("most_x"))
        each = boxes.join(planes.drop("least_y", "most_y", "least_x", "most_x"), frame).join(own, ["position", "tile"])
    around = F.ceil(F.size("my") * reach).cast("int")
    each = each.withColumns({f"{side}_{a}": f(g(f"m{a}") + sign * around, f"{n}_{a}") for a in ("y", "x") for side, n, g, f, sign in (("from", "least", F.array_min, F.greatest, -1), ("to", "most", F.array_max, F.least, 1))})
    square = lambda c: F.floor(F.col(c) / SQUARE).cast("int")
    touched = each.select(*KEYS, "c", "from_y", "to_y", "from_x", "to_x", F.explode(F.sequence(square("from_y"), square("to_y"))).alias("_sy"))
    touched = touched.withColumn("_sx", F.explode(F.sequence(square("from_x"), square("to_x"))))
    placed = pixels.withColumns({"_sy": square("y"), "_sx": square("x")})
    met = touched.join(placed, [*frame, "c", "_sy", "_sx"]).where("y BETWEEN from_y AND to_y AND x BETWEEN from_x AND to_x")
    near = met.groupBy(*KEYS, "c").agg(F.collect_list(F.struct("y", "x", *["z"] * deep, F.col(value).cast("double").alias("v"))).alias("_n"))
    rows = each.join(near, [*KEYS, "c"], "left")
    empty = lambda c: F.coalesce(F.col(f"_n.{c}"), F.array())
    first = F.col("least_z") if deep else F.lit(0)
    count = F.col("most_z") - F.col("least_z") + 1 if deep else F.lit(1)

    @F.pandas_udf("array<double>")
    def run(box: pd.DataFrame, my: pd.Series, mx: pd.Series, y: pd.Series, x: pd.Series, z: pd.Series, v: pd.Series) -> pd.Series:
        out = []
        for b, own_y, own_x, py, px, pz, pv in zip(box.itertuples(index=False), my, mx, y, x, z, v, strict=True):
            shape = (b.n, b.to_y - b.from_y + 1, b.to_x - b.from_x + 1)
            image = np.zeros(shape)
            if len(py):
                image[np.asarray(pz, int) - b.z, np.asarray(py, int) - b.from_y, np.asarray(px, int) - b.from_x] = np.nan_to_num(np.asarray(pv, float))
            mask = np.zeros(shape, bool)
            mask[:, np.asarray(own_y) - b.from_y, np.asarray(own_x) - b.from_x] = True
            room = ((b.from_y - b.least_y, b.most_y - b.to_y), (b.from_x - b.least_x, b.most_x - b.to_x))
            out.append([*fn(image, mask, room)] if deep else [*fn(image[0], mask[0], room)])
        return pd.Series(out)

    sides = F.struct(*[f"{n}_{a}" for n in ("from", "to", "least", "most") for a in ("y", "x")], first.cast("int").alias("z"), count.cast("int").alias("n"))
    found = rows.select(*KEYS, "c", run(sides, "my", "mx", empty("y"), empty("x"), empty("z") if deep else F.transform(empty("y"), lambda _: F.lit(0)), empty("v")).alias("_f"))
    return found.select(*KEYS, "c", *[F.nanvl(F.col("_f")[i], F.lit(None)).alias(n) for i, n in enumerate(names)])


def localisation(masks: DataFrame, planes: DataFrame, tiles: DataFrame | None = None) -> DataFrame:
    """small_peaks_conv and nuc_est_conv of each object and channel. Null for an object of zeros only."""
    return _windows(masks, planes, "v", 3 * 0.025 / 5, lambda v, m, room: (small_peaks(v, m), nucleus_estimate(v, m, room)), ["small_peaks_conv", "nuc_est_conv"], tiles)


def localisation_3d(masks: DataFrame, pixels: DataFrame, pixel_size: float = 0.23, z_spacing: float = 0.6, tiles: DataFrame | None = None) -> DataFrame:
    """nuc_conv_3d of each object and channel over all planes of its stack. Null for an object of zeros only."""
    return _windows(masks, pixels, "value", 0.0, lambda v, m, room: (nucleus_estimate(v, m, room, z_ratio=z_spacing / pixel_size),), ["nuc_conv_3d"], tiles)


def costes(pairs: DataFrame) -> DataFrame:
    """Manders' fractions over Costes' threshold: the largest value of the first channel under which, or under what the
    regression line makes of it in the second, pixels are not correlated.

    A pixel lies under every threshold above its level: the lesser of its first value and of where the line meets its second.
    So pixels in the order of levels are the sets that thresholds cut off, and running sums tell their correlation. Where the
    channels go against each other nothing is over the threshold. Null without spread or covariance.
    """
    w = Window.partitionBy(*KEYS)
    of = {"_a": F.avg("v0"), "_b": F.avg("v1"), "_va": F.var_pop("v0"), "_vb": F.var_pop("v1"), "_cov": F.covar_pop("v0", "v1"), "_n": F.count("*"), "_high": F.max("v0")}
    stats = pairs.withColumns({k: f.over(w) for k, f in of.items()})
    apart = F.col("_vb") - F.col("_va")
    slope = F.when((F.col("_n") > 1) & (F.col("_cov") != 0), (apart + F.sqrt(apart * apart + 4 * F.col("_cov") * F.col("_cov"))) / (2 * F.col("_cov")))
    lined = stats.withColumn("_slope", slope).withColumns({"_x": F.col("v0") - F.col("_a"), "_y": F.col("v1") - F.col("_b")})
    lined = lined.withColumn("_u", F.when(F.col("_slope") > 0, F.least(F.col("v0"), F.col("_a") + F.col("_y") / F.col("_slope"))))
    upto = w.orderBy("_u").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    runs = {"_k": F.count("*"), "_sx": F.sum("_x"), "_sy": F.sum("_y"), "_sxy": F.sum(F.col("_x") * F.col("_y"))}
    run = lined.withColumns({k: f.over(upto) for k, f in runs.items()})
    loose = (F.col("_k") < 3) | (F.col("_k") * F.col("_sxy") <= F.col("_sx") * F.col("_sy"))
    last = run.withColumn("_last", F.max(F.when(loose, F.col("_u"))).over(w))
    level = F.when(F.col("_slope") > 0, F.coalesce(F.min(F.when((F.col("_u") > F.col("_last")) | F.col("_last").isNull(), F.col("_u"))).over(w), F.col("_high"))).when(F.col("_slope").isNotNull(), F.col("_high"))
    cut = last.withColumn("_t", level)
    share = lambda v: F.when(F.max("_t").isNotNull(), F.try_divide(F.coalesce(F.sum(F.when(F.col("_u") > F.col("_t"), F.col(v))), F.lit(0.0)), F.sum(v)))
    return cut.groupBy(*KEYS).agg(F.max("_t").alias("threshold"), share("v0").alias("costes_1"), share("v1").alias("costes_2"))


def hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull, in order."""
    pts = sorted(map(tuple, points))

    def half(seq: Iterable[tuple]) -> list[tuple]:
        out: list[tuple] = []
        for p in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(half(pts) + half(reversed(pts)) or pts[:1], float)


def feret(masks: DataFrame) -> DataFrame:
    """feret_max, the largest distance between pixels of an object, and feret_min, its smallest width between parallel
    lines: over the corners and edges of its convex hull."""

    def measure(ys: list[np.ndarray], xs: list[np.ndarray]) -> list[list[float]]:
        out = []
        for y, x in zip(ys, xs, strict=True):
            h = hull(np.stack([y, x], axis=1).tolist())
            edges = np.roll(h, -1, axis=0) - h
            length = np.linalg.norm(edges, axis=1)
            keep = length > 0
            longest = math.sqrt(max(((h - p) ** 2).sum(axis=1).max() for p in h))
            reach = h @ (np.stack([-edges[keep, 1], edges[keep, 0]], axis=1) / length[keep, None]).T
            out.append([longest, float((reach.max(axis=0) - reach.min(axis=0)).min()) if keep.any() else 0.0])
        return out

    return _of_shapes(masks, "array<double>", measure).select(*KEYS, F.col("d")[0].alias("feret_max"), F.col("d")[1].alias("feret_min"))


def fill_outline(outlines: DataFrame) -> DataFrame:
    """Pixels of objects whose outline is given: everything that the outside does not reach, stepping to four sides."""

    def fill(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        wall = filled(part["y"].to_numpy(), part["x"].to_numpy())
        outside = np.zeros_like(wall)
        outside[0, :] = outside[-1, :] = outside[:, 0] = outside[:, -1] = True
        while True:
            grown = outside.copy()
            grown[1:] |= outside[:-1]
            grown[:-1] |= outside[1:]
            grown[:, 1:] |= outside[:, :-1]
            grown[:, :-1] |= outside[:, 1:]
            grown &= ~wall
            if (grown == outside).all():
                break
            outside = grown
        y, x = np.nonzero(~outside)
        return pd.DataFrame(dict(zip(KEYS, key, strict=True)) | {"y": y - 1 + part["y"].min(), "x": x - 1 + part["x"].min()})[[*KEYS, "y", "x"]]

    return outlines.groupBy(*KEYS).applyInPandas(fill, f"{KEY_TYPES}, y int, x int")


# Registry and the fused measurement ------------------------------------------------------------------------------------

#: Features that give several columns: of a mask, of an object in a channel (and its mask), and of a pair of channels.
MASK_FAMILIES: dict[str, Callable[..., DataFrame]] = {
    "sizeshape": sizeshape,
    "feret": feret,
    "zernike": lambda masks, **options: zernike(masks.withColumn("c", F.lit(0)), **options).drop("c"),
    "shape": shape_metrics,
    "conical_volume": conical_volume,
}
CHANNEL_FAMILIES: dict[str, Callable[..., DataFrame]] = {
    "intensity": lambda objects, masks, planes, edge_measurements=True: intensity(objects, masks if edge_measurements else None),
    "texture": lambda objects, masks, planes, **options: texture(objects, **options),
    "radial_distribution": lambda objects, masks, planes, **options: radial_profile(objects, **options),
    "radial_zernikes": lambda objects, masks, planes, **options: zernike(objects, value=F.col("v"), **options),
    "max2p5pc": lambda objects, masks, planes, **options: top_share(objects, **options),
    "max5px_median": lambda objects, masks, planes: top5_median(objects),
    "localisation": lambda objects, masks, planes: localisation(masks, planes),
}
PAIR_FAMILIES: dict[str, Callable[..., DataFrame]] = {"pearson": pearson, "costes": costes, "manders_fold": manders_fold, "rwc": rwc, "ratio": ratio}
#: Pair features that look at sizes of values, not their signs.
UNSIGNED = ("costes", "manders_fold", "rwc")
#: The standard job: features of each channel, and of each pair of channels.
FEATURES = ("radial_zernikes", "intensity", "feret", "texture", "radial_distribution", "zernike")
PAIR_FEATURES = ("pearson", "costes", "manders_fold", "rwc")


def _columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (*KEYS, "c")]


def measure(masks: DataFrame, pixels: DataFrame, instructions: list[tuple], options: dict[str, dict] | None = None) -> DataFrame:
    """Long measurements (position, tile, tp, label, metric, value) of instructions (ch0, ch1, red_ch, red_z, metric).

    ch0 None: a mask-only metric, without a join to pixels. ch1 None: a metric of one channel. Otherwise of two: those of
    PAIR_FAMILIES side by side (red_ch "None"), others of the two combined by red_ch. A metric is a name of MASK_METRICS or
    PIXEL_METRICS, or a family; a family's columns are named family/column. options: keyword arguments of families.
    Where families are asked for, masks are read once, and pixels once for each z-reduction. Objects' pixels are made and
    partitioned by object once; all families work on that without another exchange.
    """
    options = options or {}
    own = lambda name: options.get(name, {})
    parts = int(masks.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    families = any(i[4] in {**MASK_FAMILIES, **CHANNEL_FAMILIES, **PAIR_FAMILIES} for i in instructions)
    placed = masks.select(*KEYS, "y", "x")
    # For families, partitioned by object once: what is grouped by object, or by object and more, stays where it is from here on.
    placed = checkpointed(rim(placed.repartition(parts, *KEYS))) if families else placed.withColumn("inside", F.lit(None).cast("int"))
    long = []
    mask_only = sorted({i[4] for i in instructions if i[0] is None})
    if names := [m for m in mask_only if m not in MASK_FAMILIES]:
        long.append((mask_metrics(placed, names), [(m, m) for m in names], F.lit("None/None/")))
    for family in [m for m in mask_only if m in MASK_FAMILIES]:
        wide = MASK_FAMILIES[family](placed, **own(family))
        long.append((wide, [(f"{family}/{c}", c) for c in _columns(wide)], F.lit("None/None/")))
    for red_z in sorted({i[3] for i in instructions if i[0] is not None}):
        here = [i for i in instructions if i[0] is not None and i[3] == red_z]
        needed = sorted({c for i in here for c in i[:2] if c is not None})
        some = pixels.where(F.col("c").isin(needed))
        planes = reduce_z(some.repartition(parts, "position", "tp", "y", "x") if families else some, red_z)
        joined = placed.join(planes, ["position", "tp", "y", "x"]).select(*KEYS, "c", "y", "x", "v", "inside")
        objects = checkpointed(joined.repartition(parts, *KEYS).sortWithinPartitions(*KEYS, "c")) if families else joined
        single = [i for i in here if i[1] is None]
        of_channel = F.concat(F.col("c").cast("string"), F.lit(f"/{red_z}/"))
        for name in sorted({i[4] for i in single if i[4] in CHANNEL_FAMILIES or i[4] in MASK_FAMILIES}):
            channels = sorted({i[0] for i in single if i[4] == name})
            if name in CHANNEL_FAMILIES:
                wide = CHANNEL_FAMILIES[name](objects.where(F.col("c").isin(channels)), placed, planes.where(F.col("c").isin(channels)), **own(name))
            else:
                wide = MASK_FAMILIES[name](placed, **own(name)).withColumn("c", F.explode(F.lit(channels)))
            long.append((wide, [(f"{name}/{c}", c) for c in _columns(wide)], of_channel))
        plain = [i for i in single if i[4] not in CHANNEL_FAMILIES and i[4] not in MASK_FAMILIES]
        if plain:
            names = sorted({i[4] for i in plain})
            wide = pixel_metrics(objects.where(F.col("c").isin(sorted({i[0] for i in plain}))), names)
            long.append((wide, [(m, m) for m in names], of_channel))
        for a, b, how in sorted({(i[0], i[1], i[2]) for i in here if i[1] is not None}):
            names = sorted({i[4] for i in here if i[:3] == (a, b, how)})
            prefix = F.lit(f"({a}, {b})/{how}/{red_z}/")
            both = two_channels(objects.where(F.col("c").isin(a, b)), a, b)
            if how == "None":
                sizes = both.withColumns({v: F.abs(v) for v in ("v0", "v1")})
                for name in names:
                    wide = PAIR_FAMILIES[name](sizes if name in UNSIGNED else both, **own(name))
                    long.append((wide, [(f"{name}/{c}", c) for c in _columns(wide)], prefix))
            else:
                value = F.when(F.col("v0").isNotNull() & F.col("v1").isNotNull(), COMBINED[how](F.col("v0"), F.col("v1")))
                wide = pixel_metrics(both.select(*KEYS, F.lit(-1).alias("c"), "y", "x", value.alias("v")), names)
                long.append((wide, [(m, m) for m in names], prefix))
    out = None
    for wide, names, prefix in long:
        entries = F.array(*[F.struct(F.concat(prefix, F.lit(path)).alias("metric"), F.col(m).cast("double").alias("value")) for path, m in names])
        part = wide.select(*KEYS, F.explode(entries).alias("e")).select(*KEYS, "e.metric", "e.value")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no instructions")
    return out


def default_instructions(channels: list[int], features: Iterable[str] = FEATURES) -> list[tuple]:
    """The standard job: size and shape of each object, features of each channel over max z, and the colocalisation of each
    pair of channels."""
    out: list[tuple] = [(None, None, "None", "None", "sizeshape")]
    out += [(c, None, "None", "max", f) for c in channels for f in features]
    return out + [(a, b, "None", "max", f) for i, a in enumerate(channels) for b in channels[i + 1 :] for f in PAIR_FEATURES]
