"""Operators on image blocks, as tables of pixels: tiling, scaling, drift, crops, regions."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opalgrid.operators.graphs import checkpointed, components

IMAGE = ["position", "tp", "c", "z"]


def grid_tiles(pixels: DataFrame, size: int, height: int, width: int) -> DataFrame:
    """pixels with tile, of a grid of whole tiles in row order; pixels beyond the last whole tile are dropped."""
    rows, columns = height // size, width // size
    inside = (F.col("y") < size * rows) & (F.col("x") < size * columns)
    return pixels.where(inside).withColumn("tile", (F.floor(F.col("y") / size) * columns + F.floor(F.col("x") / size)).cast("int"))


def clip_outliers(pixels: DataFrame, clip: float = 0.5) -> DataFrame:
    """Values of each position, tp and channel rescaled from their clip-th and (100 - clip)-th percentiles to 0..1."""
    keys = ["position", "tp", "c"]
    low, high = (F.min("value"), F.max("value")) if clip == 0 else (F.percentile("value", F.lit(clip / 100)), F.percentile("value", F.lit(1 - clip / 100)))
    limits = pixels.groupBy(*keys).agg(low.alias("_low"), high.alias("_high"))
    scaled = F.try_divide(F.col("value") - F.col("_low"), F.col("_high") - F.col("_low"))
    return pixels.join(limits, keys).withColumn("value", F.greatest(F.lit(0.0), F.least(F.lit(1.0), scaled))).drop("_low", "_high")


def to_8bit(pixels: DataFrame) -> DataFrame:
    return pixels.withColumn("value", F.floor(F.col("value") * 255).cast("int"))


def standard_scale(pixels: DataFrame) -> DataFrame:
    """Values less the mean, over the population deviation, of each position, tp and channel; null without deviation."""
    keys = ["position", "tp", "c"]
    stats = pixels.groupBy(*keys).agg(F.avg("value").alias("_m"), F.stddev_pop("value").alias("_s"))
    return pixels.join(stats, keys).withColumn("value", F.try_divide(F.col("value") - F.col("_m"), F.col("_s"))).drop("_m", "_s")


def cropped(pixels: DataFrame, size: int, height: int, width: int, *, clip: float | None = None, eight_bit: bool = False, scale: bool = True) -> DataFrame:
    """Clipping, 8 bits, scaling and tiling, in this order; only scaling and tiling by default."""
    rows = pixels if clip is None else clip_outliers(pixels, clip)
    rows = to_8bit(rows) if eight_bit else rows
    rows = standard_scale(rows) if scale else rows
    return grid_tiles(rows, size, height, width)


def centres(tiles: DataFrame, drifts: DataFrame) -> DataFrame:
    """tiles at each tp of drifts: their origin less all drifts up to it, cut towards zero."""
    w = Window.partitionBy("position").orderBy("tp").rowsBetween(Window.unboundedPreceding, 0)
    moved = drifts.select("position", "tp", F.sum("dy").over(w).alias("sy"), F.sum("dx").over(w).alias("sx"))
    rows = tiles.join(moved, "position")
    return rows.select("position", "tile", "tp", (F.col("y0") - F.col("sy")).cast("int").alias("y0"), (F.col("x0") - F.col("sx")).cast("int").alias("x0"), "h", "w")


def window_pixels(windows: DataFrame, pixels: DataFrame) -> DataFrame:
    """Every place of each window (dy, dx) in every channel and z of the table, with the value of the pixel there, null
    outside and where there is no such image: an equi-join on coordinates."""
    places = windows.withColumn("dy", F.explode(F.sequence(F.lit(0), F.col("h") - 1))).withColumn("dx", F.explode(F.sequence(F.lit(0), F.col("w") - 1)))
    at = places.withColumns({"y": F.col("y0") + F.col("dy"), "x": F.col("x0") + F.col("dx")})
    kinds = F.broadcast(pixels.select("c", "z").distinct())  # a row for each channel and z
    return at.crossJoin(kinds).join(pixels, [*IMAGE, "y", "x"], "left").select("position", "tile", "tp", "c", "z", "dy", "dx", "value")


def padded(tile_pixels: DataFrame, most: float = 0.25) -> DataFrame:
    """Windows with their outside filled: by the median of each column first, then of each row. A window of which any
    side lacks more than `most` of its size is missing altogether (null)."""
    keys = ["position", "tile", "tp", "c", "z"]
    own, columns, rows = Window.partitionBy(*keys), Window.partitionBy(*keys, "dx"), Window.partitionBy(*keys, "dy")
    have = F.col("value").isNotNull()
    size = lambda a: F.max(a).over(own) + 1
    low = lambda a: F.min(F.when(have, F.col(a))).over(own)
    high = lambda a: size(a) - 1 - F.max(F.when(have, F.col(a))).over(own)
    lacks = [F.coalesce(side(a) > most * size(a), F.lit(True)) for a in ("dy", "dx") for side in (low, high)]
    bad = lacks[0] | lacks[1] | lacks[2] | lacks[3]
    filled = tile_pixels.withColumn("_bad", bad).withColumn("_v", F.coalesce("value", F.median("value").over(columns)))
    filled = filled.withColumn("_v", F.coalesce("_v", F.median("_v").over(rows)))
    return filled.select(*keys, "dy", "dx", F.when(~F.col("_bad"), F.col("_v")).alias("value"))


def single_tile(height: int, width: int, size: int | None) -> tuple[int, int, int]:
    """Centre and size of the only tile of an image: the whole image without a size, or where it is too small for one."""
    if size is None or min(height, width) // 2 <= size // 2:
        return height // 2, width // 2, min(height, width)
    return height // 2, width // 2, size


def inner_centres(found: DataFrame, half: int, least_side: int) -> DataFrame:
    """Tile centres (y, x) at least half a tile from the edges."""
    return found.where((F.col("y") > half) & (F.col("y") < least_side - half) & (F.col("x") > half) & (F.col("x") < least_side - half))


def phase_shift(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """How far b has moved from a, by phase correlation."""
    cross = np.fft.fft2(a) * np.conj(np.fft.fft2(b))
    cross /= np.maximum(np.abs(cross), 1e-12)
    at = np.unravel_index(np.abs(np.fft.ifft2(cross)).argmax(), a.shape)
    return tuple(int(k - n if k > n // 2 else k) for k, n in zip(at, a.shape, strict=True))


def drift(pixels: DataFrame, c: int = 0, z: int = 0) -> DataFrame:
    """position, tp, dy, dx against the frame before; a first frame has none. Missing pixels are 0; two frames of different
    size are compared on the larger. Pairs of frames are independent."""
    flat = pixels.where((F.col("c") == c) & (F.col("z") == z)).select("position", "tp", "y", "x", F.coalesce("value", F.lit(0.0)).cast("double").alias("v"))

    def packed(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        image = np.zeros((part["y"].max() + 1, part["x"].max() + 1))
        image[part["y"], part["x"]] = part["v"]
        return pd.DataFrame({"position": [key[0]], "tp": [key[1]], "height": [image.shape[0]], "width": [image.shape[1]], "plane": [image.tobytes()]})

    planes = flat.groupBy("position", "tp").applyInPandas(packed, "position long, tp int, height int, width int, plane binary")
    w = Window.partitionBy("position").orderBy("tp")
    rows = planes.select("position", "tp", F.struct("height", "width", "plane").alias("own"), F.lag(F.struct("height", "width", "plane")).over(w).alias("before"))

    def image_of(one: Any, shape: tuple[int, int]) -> np.ndarray:
        found = np.frombuffer(one["plane"], float).reshape(int(one["height"]), int(one["width"]))
        return np.pad(found, [(0, n - m) for n, m in zip(shape, found.shape, strict=True)])

    @F.pandas_udf("struct<dy: double, dx: double>")
    def shift(own: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
        out = []
        for a, b in zip(own.to_dict("records"), before.to_dict("records"), strict=True):
            if b["plane"] is None:
                out.append((0.0, 0.0))
                continue
            shape = tuple(int(max(a[n], b[n])) for n in ("height", "width"))
            out.append(phase_shift(image_of(b, shape), image_of(a, shape)))
        return pd.DataFrame(out, columns=["dy", "dx"]).astype(float)

    return rows.select("position", "tp", shift("own", "before").alias("s")).select("position", "tp", "s.dy", "s.dx")


def otsu(pixels: DataFrame, bins: int = 16) -> DataFrame:
    """Threshold of each position, tp, c and z that parts its histogram with the largest variance between the parts,
    the lowest of several (equal to six places)."""
    w = Window.partitionBy(*IMAGE)
    low, high = F.min("value").over(w), F.max("value").over(w)
    at = F.least(F.lit(bins - 1), F.floor(F.coalesce(F.try_divide(F.col("value") - low, high - low), F.lit(0.0)) * bins)).cast("int")
    counts = pixels.select(*IMAGE, at.alias("bin"), low.alias("low"), high.alias("high")).groupBy(*IMAGE, "bin", "low", "high").agg(F.count("*").alias("n"))
    up = w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    n0, s0, n, s = F.sum("n").over(up), F.sum(F.col("n") * F.col("bin")).over(up), F.sum("n").over(w), F.sum(F.col("n") * F.col("bin")).over(w)
    # The variance between, n0 (n - n0) (s0 / n0 - (s - s0) / (n - n0))^2, as one fraction of whole numbers: equal ones tie.
    whole = lambda c: c.cast("decimal(19,0)")
    apart = whole(s0 * n - s * n0)
    scored = counts.withColumn("between", F.coalesce(F.try_divide(apart * apart, whole(n0 * (n - n0))), F.lit(0).cast("decimal(38,6)")))
    best = scored.groupBy(*IMAGE, "low", "high").agg(F.min_by("bin", F.struct(-F.col("between"), "bin")).alias("bin"))
    return best.select(*IMAGE, (F.col("low") + (F.col("high") - F.col("low")) * (F.col("bin") + 1) / bins).alias("threshold"))


#: Sides of the blocks of an image that are labelled apart.
REGION_BLOCK = 256


def joined_runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of true pixels of each row, in reading order: row, first and last column, and the first run of its region (eight
    neighbours). Runs of neighbouring rows that touch are joined, and each takes the least number around until none changes."""
    edge = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    (row, begin), end = np.nonzero(edge == 1), np.nonzero(edge == -1)[1] - 1
    width = mask.shape[1] + 3
    first = np.searchsorted(row * width + end, (row + 1) * width + begin - 1)  # runs of the next row that end not before it
    after = np.searchsorted(row * width + begin, (row + 1) * width + end + 1, side="right")
    n = np.maximum(after - first, 0)
    a = np.repeat(np.arange(len(row)), n)
    b = np.repeat(first - np.cumsum(n) + n, n) + np.arange(len(a))
    label = np.arange(len(row))
    while (label[a] != label[b]).any():
        least = np.minimum(label[a], label[b])
        for side in (label[a], label[b]):
            np.minimum.at(label, side, least)
        while (label[label] != label).any():
            label = label[label]
    return row, begin, end, label


def regions(binary: DataFrame, height: int, width: int, block: int = REGION_BLOCK) -> DataFrame:
    """Connected regions (eight neighbours) of pixels (position, tp, y, x), labelled 1.. in order of their first pixel;
    regions that touch the border are dropped.

    Blocks of an image are labelled apart, by runs; only pixels along their borders meet, and only regions that cross them
    are joined further.
    """
    square = lambda c: F.floor(F.col(c) / block).cast("int")
    frame = ["position", "tp"]

    def label(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        top, left = key[2] * block, key[3] * block
        mask = np.zeros((block, block), bool)
        mask[part["y"] - top, part["x"] - left] = True
        row, begin, end, root = joined_runs(mask)
        n = end - begin + 1
        x = np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())
        named = lambda i: pd.Series([f"{key[0]}/{key[1]}/{y:06d}/{x:06d}" for y, x in zip((row[i] + top).tolist(), (begin[i] + left).tolist(), strict=True)])
        roots, which = np.unique(root, return_inverse=True)
        return pd.DataFrame({"position": key[0], "tp": key[1], "y": np.repeat(row, n) + top, "x": x + left, "node": named(roots).to_numpy()[np.repeat(which, n)]})

    local = checkpointed(binary.groupBy(*frame, square("y"), square("x")).applyInPandas(label, "position long, tp int, y int, x int, node string"))
    rims = local.where(f"y % {block} IN (0, {block - 1}) OR x % {block} IN (0, {block - 1})")
    moves = F.array(*[F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a, b in ((0, 1), (1, -1), (1, 0), (1, 1))])
    moved = rims.withColumn("m", F.explode(moves)).select(*frame, (F.col("y") + F.col("m.dy")).alias("y"), (F.col("x") + F.col("m.dx")).alias("x"), F.col("node").alias("a"))
    edges = moved.join(rims, [*frame, "y", "x"]).where("a <> node").select("a", F.col("node").alias("b")).distinct()
    border = (F.col("y") == 0) | (F.col("x") == 0) | (F.col("y") == height - 1) | (F.col("x") == width - 1)
    parts = local.groupBy(*frame, "node").agg(F.bool_or(border).alias("_b")).join(components(edges), "node", "left").withColumn("component", F.coalesce("component", "node"))
    whole = parts.groupBy(*frame, "component").agg(F.bool_or("_b").alias("_b")).where("NOT _b")
    labelled = whole.select("component", F.dense_rank().over(Window.partitionBy(*frame).orderBy("component")).alias("label"))
    return local.join(parts.select("node", "component").join(labelled, "component"), "node").select(*frame, "y", "x", "label")


def relabelled(masks: DataFrame, by: list[str]) -> DataFrame:
    """masks with new_label: 1.. in the order of the labels of each group."""
    return masks.withColumn("new_label", F.dense_rank().over(Window.partitionBy(*by).orderBy("label")))


def flattened_labels(masks: DataFrame) -> DataFrame:
    """Labels of a stack (column z), the largest over z, relabelled 1.. per position, tile and tp."""
    flat = masks.groupBy("position", "tile", "tp", "y", "x").agg(F.max("label").alias("label"))
    return relabelled(flat, ["position", "tile", "tp"])


def mean_template(centre: DataFrame, pixels: DataFrame, half: int) -> DataFrame:
    """dy, dx, value: the mean over all crops around the centres (position, tp, y, x) that lie in the image whole."""
    windows = centre.select("position", F.xxhash64("position", "tp", "y", "x").alias("tile"), "tp", (F.col("y") - half).alias("y0"), (F.col("x") - half).alias("x0"), F.lit(2 * half + 1).alias("h"), F.lit(2 * half + 1).alias("w"))
    crops = window_pixels(windows, pixels)
    whole = crops.groupBy("position", "tile", "tp", "c", "z").agg(F.bool_and(F.col("value").isNotNull()).alias("ok")).where("ok")
    return crops.join(whole, ["position", "tile", "tp", "c", "z"], "left_semi").groupBy("dy", "dx").agg(F.avg("value").alias("value"))


def local_maxima(planes: DataFrame, apart: int = 1, border: int = 0) -> DataFrame:
    """Pixels (position, tp, c, y, x, v) that no other within `apart` (in either axis) exceeds, at least `border` from the
    image's edges. Of equal ones that are near each other the first stays. One image is one group."""

    def pick(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        y, x = part["y"].to_numpy(), part["x"].to_numpy()
        image = np.full((y.max() + 1 + 2 * apart, x.max() + 1 + 2 * apart), -np.inf)
        image[y + apart, x + apart] = part["v"]
        around = np.lib.stride_tricks.sliding_window_view(image, (2 * apart + 1, 2 * apart + 1)).max(axis=(2, 3))
        edge = np.minimum.reduce([y, x, y.max() - y, x.max() - x])
        best = part[(part["v"].to_numpy() >= around[y, x]) & (edge >= border)].sort_values(["v", "y", "x"], ascending=[False, True, True])
        taken: list[int] = []
        spots = best[["y", "x"]].to_numpy()
        for i, spot in enumerate(spots):
            if not taken or (np.abs(spots[taken] - spot).max(axis=1) > apart).all():
                taken.append(i)
        return best.iloc[taken]

    return planes.groupBy("position", "tp", "c").applyInPandas(pick, planes.schema)


def ordinal_labels(masks: DataFrame, previous: DataFrame) -> DataFrame:
    """masks with the k-th label of each tile and tp replaced by the k-th of previous (tile, tp, k, new_label)."""
    place = F.dense_rank().over(Window.partitionBy("position", "tile", "tp").orderBy("label"))
    return masks.withColumn("k", place).join(previous, ["tile", "tp", "k"]).drop("k")


def tile_sheet(pixels: DataFrame, height: int, width: int, columns: int, count: int) -> DataFrame:
    """A sheet of tiles cut up: tile, and places within it; places beyond the last tile are dropped."""
    tile = F.floor(F.col("y") / height) * columns + F.floor(F.col("x") / width)
    rows = pixels.withColumn("tile", tile.cast("int")).where(F.col("tile") < count)
    return rows.withColumns({"y": (F.col("y") % height).cast("int"), "x": (F.col("x") % width).cast("int")})


def checked_labels(masks: DataFrame, limit: int = 65_535) -> DataFrame:
    """masks; an error when it is read, if a label reaches the limit of 16 bits."""
    over = F.when(F.col("label") >= limit, F.raise_error(F.lit("labels do not fit 16 bits"))).otherwise(F.col("label"))
    return masks.withColumn("label", over.cast("int"))


def segmented(planes: DataFrame, fn: Callable[[np.ndarray], np.ndarray], c: int) -> DataFrame:
    """position, tile 0, tp, y, x, label by a function from an image to a label image, for planes (position, tp, c, y, x, v)."""

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        image = np.zeros((part["y"].max() + 1, part["x"].max() + 1))
        image[part["y"], part["x"]] = part["v"]
        labels = np.asarray(fn(image))
        y, x = np.nonzero(labels)
        return pd.DataFrame({"position": key[0], "tile": 0, "tp": key[1], "y": y, "x": x, "label": labels[y, x].astype(int)})

    return planes.where(F.col("c") == c).groupBy("position", "tp").applyInPandas(run, "position long, tile int, tp int, y int, x int, label int")


def threshold_labels(image: np.ndarray) -> np.ndarray:
    """A built-in segmenter: pixels over the mean, joined to regions by taking the least number around, step by step."""
    mask = image > image.mean()
    labels = np.where(mask, np.arange(1, mask.size + 1).reshape(mask.shape), 0)
    while True:
        grown = np.pad(labels, 1)
        around = np.stack([grown[1 + a : 1 + a + mask.shape[0], 1 + b : 1 + b + mask.shape[1]] for a in (-1, 0, 1) for b in (-1, 0, 1)])
        new = np.where(mask, np.where(around > 0, around, mask.size + 1).min(axis=0), 0)
        if (new == labels).all():
            return np.unique(labels, return_inverse=True)[1].reshape(mask.shape) if mask.any() else labels
        labels = new
