"""Measurements of drawn shapes, whose values are known, and of odd inputs."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from opalgrid.operators import blocks, features, graphs, profiles, tracks
from opalgrid.sources import catalog, logs
from opalgrid.streaming import frames


def disk(r):
    y, x = np.mgrid[-r - 1 : r + 2, -r - 1 : r + 2]
    return y**2 + x**2 <= r * r


def rows_of(mask, label=1):
    y, x = np.nonzero(mask)
    return [(1, 0, 0, int(a), int(b), label) for a, b in zip(y, x, strict=True)]


MASK = "position long, tile int, tp int, y int, x int, label int"


@pytest.mark.parametrize("r", [5, 10, 20])
def test_disk_axes_and_volume(spark, r):
    short, long = features.axes_of(disk(r))
    assert abs(short - r) <= 1 and abs(long - r) <= 1
    found = features.shape_metrics(spark.createDataFrame(rows_of(disk(r)), MASK)).first()
    assert found.volume == pytest.approx(4 / 3 * math.pi * short**2 * long) and found.eccentricity < 0.7


def test_sizeshape_of_disk_and_ellipse(spark):
    y, x = np.mgrid[-30:31, -30:31]
    ellipse = (y / 12) ** 2 + (x / 24) ** 2 <= 1
    df = spark.createDataFrame(rows_of(disk(15), 1) + rows_of(ellipse, 2), MASK)
    found = {r.label: r for r in features.sizeshape(df).collect()}
    assert found[1].major_axis == pytest.approx(30, rel=0.02) and found[1].eccentricity < 0.1
    assert found[2].major_axis == pytest.approx(48, rel=0.02) and found[2].minor_axis == pytest.approx(24, rel=0.02)
    assert found[2].eccentricity == pytest.approx(math.sqrt(0.75), rel=0.02)
    feret = {r.label: r for r in features.feret(df).collect()}
    assert feret[2].feret_min == pytest.approx(24, abs=1) and feret[2].feret_max == pytest.approx(48, abs=1)


def test_distance_map_forms_agree(spark):
    mask = disk(6)
    d = features.distances(mask)
    found = features.distance_map(spark.createDataFrame(rows_of(mask), MASK)).collect()
    assert all(r.d == pytest.approx(d[r.y, r.x]) for r in found) and len(found) == mask.sum()


def test_fill_outline(spark):
    mask = disk(8)
    d = features.distances(mask)
    rim = mask & (d <= 1)
    found = features.fill_outline(spark.createDataFrame(rows_of(rim), MASK)).collect()
    assert {(r.y, r.x) for r in found} == set(zip(*map(lambda a: a.tolist(), np.nonzero(mask)), strict=True))


def test_metrics_of_constant_and_zero_objects(spark):
    masks = spark.createDataFrame(rows_of(disk(2)), MASK)
    pixels = masks.select("position", "tp", F.lit(0).alias("c"), F.lit(0).alias("z"), "y", "x", F.lit(0.0).alias("value"))
    objects = features.object_pixels(masks, features.reduce_z(pixels, "max"))
    row = features.pixel_metrics(objects, list(features.PIXEL_METRICS)).first()
    assert row.total == 0 and row.std == 0 and row.moment_of_inertia is None
    assert features.top5_median(objects).first().max5px_median is None
    pairs = objects.unionByName(objects.withColumn("c", F.lit(1)))
    assert features.ratio(features.two_channels(pairs, 0, 1)).first().ratio is None
    assert features.pearson(features.two_channels(pairs, 0, 1)).first().pearson is None
    assert features.mask_metrics(masks.limit(0), ["area"]).count() == 0


def test_distances_are_exact_and_fast():
    rng = np.random.default_rng(0)
    for shape in ((1, 1), (1, 9), (9, 1), (13, 17), (20, 8)):
        for share in (0.0, 0.3, 0.9, 1.0):
            mask = rng.random(shape) < share
            out = np.argwhere(~mask)
            want = np.array([[np.sqrt(((out - (y, x)) ** 2).sum(axis=1).min()) if mask[y, x] and len(out) else 0 for x in range(shape[1])] for y in range(shape[0])])
            assert np.allclose(features.distances(mask), want)
    began = time.time()
    assert features.distances(np.pad(disk(500), 1)).max() == pytest.approx(500, abs=2)
    assert time.time() - began < 20  # some seconds on a busy machine


def brute_convolution(image, kernel):
    out = np.zeros(image.shape)
    half = [k // 2 for k in kernel.shape]
    for at in np.ndindex(*image.shape):
        for k in np.ndindex(*kernel.shape):
            src = tuple(a + h - b for a, h, b in zip(at, half, k, strict=True))
            if all(0 <= i < n for i, n in zip(src, image.shape, strict=True)):
                out[at] += image[src] * kernel[k]
    return out


def brute_estimate(image, mask, widths):
    """The formula as it stands: n values not zero, r, sigma, a kernel that sums to one."""
    n = np.count_nonzero(image[mask])
    chi = -2 * math.log(1 - 0.95)
    r = math.sqrt(0.085 * n / math.pi)
    sigma = r / math.sqrt(chi)
    half = math.ceil(2 * r)
    at = np.mgrid[(slice(-half, half + 1),) * image.ndim]
    kernel = np.exp(-sum(g**2 / (2 * w) for g, w in zip(at, widths(sigma), strict=True)))
    kernel[kernel < np.finfo(float).eps * kernel.max()] = 0
    kernel /= kernel.sum()
    own = np.where(mask, image - np.median(image[mask]), 0)
    return brute_convolution(own, kernel).max() / ((kernel**2).sum() * 0.95 * math.pi * chi * sigma**2)


def test_localisation_by_the_formulas(spark):
    rng = np.random.default_rng(1)
    stack = np.round(rng.random((3, 14, 15)), 3) * (rng.random((3, 14, 15)) < 0.9)  # some values are 0
    masks = np.zeros((14, 15), int)
    masks[1:9, 2:9], masks[10:13, 9:15] = 1, 2
    rows = [(1, 0, 0, int(y), int(x), int(masks[y, x])) for y, x in np.argwhere(masks)]
    pixels = [(1, 0, 0, z, y, x, float(stack[z, y, x])) for z in range(3) for y in range(14) for x in range(15)]
    m = spark.createDataFrame(rows, MASK)
    p = spark.createDataFrame(pixels, "position long, tp int, c int, z int, y int, x int, value double")
    flat = {r.label: r for r in features.localisation(m, features.reduce_z(p, "max")).collect()}
    deep = {r.label: r for r in features.localisation_3d(m, p).collect()}
    image = stack.max(axis=0)
    for label in (1, 2):
        mask = masks == label
        r = 3 * 0.025 * np.count_nonzero(image[mask]) / 5
        k = math.ceil(r)
        g = np.mgrid[-k : k + 1, -k : k + 1]
        peaks = brute_convolution(image, ((g**2).sum(axis=0) <= r * r).astype(float))[mask].max()
        assert flat[label].small_peaks_conv == pytest.approx(peaks, abs=1e-9)
        assert flat[label].nuc_est_conv == pytest.approx(brute_estimate(image, mask, lambda s: (s * s, s * s)), abs=1e-9)
        whole = np.broadcast_to(mask, stack.shape)
        assert deep[label].nuc_conv_3d == pytest.approx(brute_estimate(stack, whole, lambda s: (s * 0.6 / 0.23, s, s)), abs=1e-9)


def test_every_family_can_be_asked_for(spark):
    rng = np.random.default_rng(2)
    masks = spark.createDataFrame(rows_of(disk(4), 1) + [(1, 0, 0, 20, 20, 2)], MASK)
    pixels = spark.createDataFrame([(1, 0, c, 0, y, x, float(rng.random())) for c in (0, 1) for y in range(24) for x in range(24)], "position long, tp int, c int, z int, y int, x int, value double")
    asked = [(None, None, "None", "None", m) for m in [*features.MASK_METRICS, *features.MASK_FAMILIES]]
    asked += [(c, None, "None", "max", m) for c in (0, 1) for m in [*features.PIXEL_METRICS, *features.CHANNEL_FAMILIES, "feret", "zernike"]]
    asked += [(0, 1, "None", "max", m) for m in features.PAIR_FAMILIES] + [(0, 1, "add", "max", "mean")]
    found = features.measure(masks, pixels, asked, {"intensity": {"edge_measurements": False}, "zernike": {"degree": 2}, "texture": {"levels": 4}}).collect()
    metrics = {r.metric for r in found}
    assert {r.metric for r in found if r.label == 1} == metrics  # a lone pixel has no texture, and no metric of it
    families = {m.split("/")[-2] for m in metrics}
    assert set(features.MASK_FAMILIES) | set(features.CHANNEL_FAMILIES) | set(features.PAIR_FAMILIES) <= families
    assert "0/max/intensity/mean" in metrics and not any("edge" in m for m in metrics)
    assert "1/max/zernike/zernike_2_2" in metrics and "1/max/zernike/zernike_3_1" not in metrics
    value = {(r.label, r.metric): r.value for r in found}
    assert value[2, "None/None/area"] == 1 and value[2, "(0, 1)/None/max/pearson/pearson"] is None
    assert value[1, "0/max/intensity/mean"] == pytest.approx(value[1, "0/max/mean"])


def test_phase_shift():
    image = np.random.default_rng(0).normal(size=(32, 32))
    assert blocks.phase_shift(image, np.roll(image, (3, -5), (0, 1))) in {(-3, 5), (3, -5)}


def test_padding_rule(spark):
    pixels = spark.createDataFrame([(1, 0, 0, 0, y, x, float(10 * y + x)) for y in range(8) for x in range(8)], "position long, tp int, c int, z int, y int, x int, value double")
    windows = spark.createDataFrame([(1, 0, 0, -1, 0, 4, 4), (1, 1, 0, -2, 0, 4, 4), (1, 2, 0, 2, 2, 4, 4)], "position long, tile int, tp int, y0 int, x0 int, h int, w int")
    out = {(r.tile, r.dy, r.dx): r.value for r in blocks.padded(blocks.window_pixels(windows, pixels)).collect()}
    assert out[0, 0, 0] == 10.0 and out[0, 1, 0] == 0.0  # the median of the column 0, 10, 20
    assert all(out[1, y, x] is None for y in range(4) for x in range(4))
    assert out[2, 3, 3] == 55.0


def test_regions(spark):
    image = ["........", ".##...#.", ".##....#", "....#...", "...##...", "........"]
    rows = [(1, 0, y, x) for y, line in enumerate(image) for x, c in enumerate(line) if c == "#"]
    found = blocks.regions(spark.createDataFrame(rows, "position long, tp int, y int, x int"), 6, 8).collect()
    labels = {}
    for r in found:
        labels.setdefault(r.label, set()).add((r.y, r.x))
    assert sorted(map(len, labels.values())) == [3, 4]  # the region at the right border is gone
    assert blocks.threshold_labels(np.array([[c == "#" for c in line] for line in image], float)).max() == 3


def test_merge_chain_keeps_all_values(spark):
    rows = [("s", 1, c, t, float(c * 100 + t)) for c, times in ((1, (0, 1)), (2, (2, 3)), (3, (4, 5)), (9, (0, 5))) for t in times]
    signals = spark.createDataFrame(rows, "path string, trap int, cell_label int, tp int, value double")
    merges = spark.createDataFrame([(1, 2, 3), (1, 1, 2)], "trap int, left_label int, right_label int")
    out = {(r.cell_label, r.tp): r.value for r in tracks.apply_merges(signals, merges).collect()}
    assert out == {(1, 0): 100.0, (1, 1): 101.0, (1, 2): 202.0, (1, 3): 203.0, (1, 4): 304.0, (1, 5): 305.0, (9, 0): 900.0, (9, 5): 905.0}
    assert {(r.label, r.end) for r in tracks.chain_ends(merges).collect()} == {(1, 3), (2, 3)}
    assert [(r.left_label, r.depth) for r in tracks.chain_order(merges).orderBy("depth").collect()] == [(1, 1), (2, 2)]


def test_merge_lineage(spark):
    lineage = spark.createDataFrame([(1, 5, 1), (1, 5, 2), (1, 6, 3), (1, 2, 7)], "trap int, mother_label int, daughter_label int")
    merges = spark.createDataFrame([(1, 1, 2), (1, 2, 3)], "trap int, left_label int, right_label int")
    assert {tuple(r) for r in tracks.merge_lineage(lineage, merges).collect()} == {(1, 5, 2), (1, 6, 3), (1, 2, 7)}


def test_lineage_validation(spark):
    lineage = spark.createDataFrame([(7, 1, 2), (7, 3, 2), (7, 1, 5), (8, 1, 2)], "trap int, mother_label int, daughter_label int")
    cells = spark.createDataFrame([(7, 1), (7, 2)], "trap int, cell_label int")
    get = lambda how: {tuple(r) for r in tracks.validate_lineage(lineage, cells, how).collect()}
    assert get("families") == {(7, 1, 2)} and get("mothers") == {(7, 1, 2), (7, 1, 5)} and get("daughters") == {(7, 1, 2)}


def test_components_of_paths_and_cycles(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (102, 100)]
    found = {r.node: r.component for r in graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in range(41)} == {0} and {found[i] for i in (100, 101, 102)} == {100}


def test_stream_equals_batch(spark):
    rng = np.random.default_rng(2)
    rows = sorted({(p, 0, t, int(y + t % 2), int(x), k) for p in range(3) for t in range(6) for k, (cy, cx) in enumerate(((2, 2), (2, 8), (8, 4)), 1) for y, x in zip(rng.integers(cy - 1, cy + 2, 14), rng.integers(cx - 1, cx + 2, 14), strict=True)})
    masks = spark.createDataFrame(rows, MASK).dropDuplicates(["position", "tp", "y", "x"])
    source, out, state = (profiles.new_folder(spark, n) for n in ("in", "out", "state"))
    for t in (3, 0, 1, 5, 2, 4):  # out of order
        masks.where(F.col("tp") == t).coalesce(1).write.mode("append").parquet(source)
    frames.run_to_table(frames.tracked_stream(frames.read_masks(spark, source, masks.schema, 2)), out, state)
    key = lambda df: sorted(tuple(r) for r in df.select("position", "tile", "tp", "label", "track").collect())
    assert key(spark.read.schema(frames.TRACKS).parquet(out)) == key(frames.tracked(masks))


def test_hypercube_and_names(spark):
    files = spark.createDataFrame([(f"/d/p{p}_T{t}_C{c}.tif",) for p in (1, 2) for t in (1, 2) for c in (1, 2) if (p, t, c) != (2, 2, 2)] + [("/d/other.txt",)], "path string")
    got = catalog.captures(files, r".*/(p\d)_T(\d)_C(\d)\.tif", "FTC")
    assert {r.position: r.complete for r in catalog.dimensions(got, "FTC").collect()} == {"p1": True, "p2": False}
    assert [len(r.paths) for r in catalog.positions(got, "FTC").orderBy("position").collect()] == [4, 3]
    with pytest.raises(ValueError):
        catalog.captures(files, "nothing", "F", check=True)


def test_log_sections(spark):
    text = ["Run Name: x", "", "interval: 300", "-----Acquisition settings-----", "GFP,GFP,0,30,5,0.6,PIFOC", "frames: 12"]
    lines = spark.createDataFrame([(1, i, t) for i, t in enumerate(text)], "file long, line long, text string")
    assert {tuple(r) for r in logs.general(lines).collect()} == {(1, "run_name", "x"), (1, "interval", "300")}
    row = logs.minimal(lines, ["GFP"]).first()
    assert (row.channels, row.ntimepoints, row.timeinterval) == (["GFP"], 12, 300)
    typed = lines.limit(1).select(logs.typed(F.lit("12"), "int").alias("a"), logs.typed(F.lit("x"), "float").alias("b"), logs.typed(F.lit("01-Jul-2020 12:00"), "datetime:dd-MMM-yyyy HH:mm").alias("c")).first()
    assert (typed.a, typed.b, typed.c) == (12, None, 1593601200)


def test_store_rejects_unknown_columns(spark):
    with pytest.raises(ValueError):
        profiles.append_checked(spark.range(1), profiles.new_folder(spark, "t"), {"id": "int"}, [])
    assert profiles.validated([{"name": "track_a", "needs": ["b"], "retain": 1, "save_interval": 0}]) and not profiles.validated([{"name": "a"}])


def test_local_maxima(spark):
    image = [[0, 0, 0, 0, 0], [0, 9, 5, 0, 0], [0, 0, 0, 0, 7], [0, 0, 0, 7, 0], [3, 0, 0, 0, 0]]
    rows = [(1, 0, 0, y, x, float(v)) for y, line in enumerate(image) for x, v in enumerate(line)]
    planes = spark.createDataFrame(rows, "position long, tp int, c int, y int, x int, v double").where("v > 0")
    assert {(r.y, r.x) for r in blocks.local_maxima(planes).collect()} == {(1, 1), (2, 4), (4, 0)}
    assert {(r.y, r.x) for r in blocks.local_maxima(planes, 1, 1).collect()} == {(1, 1), (3, 3)}


def test_drift_with_missing_pixels(spark):
    image = np.random.default_rng(3).random((16, 16))
    rows = [(1, tp, 0, 0, y, x, float(v)) for tp, plane in enumerate((image, np.roll(image, (2, -3), (0, 1)))) for (y, x), v in np.ndenumerate(plane) if (tp, y, x) not in {(0, 15, 15), (1, 4, 4)}]
    found = blocks.drift(spark.createDataFrame(rows, "position long, tp int, c int, z int, y int, x int, value double")).orderBy("tp").collect()
    assert [(r.dy, r.dx) for r in found] == [(0.0, 0.0), (-2.0, 3.0)]
    short = spark.createDataFrame([(1, 0, 0, 0, 0, 0, 1.0), (1, 1, 0, 0, 3, 2, None)], "position long, tp int, c int, z int, y int, x int, value double")
    assert blocks.drift(short).count() == 2


def test_running_totals_over_ranges(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k"))
    found = {r.k: r.before for r in graphs.running_total(df, ["k"], F.col("k"), "before").collect()}
    assert found == {k: k * (k - 1) // 2 for k in range(1000)}


def test_names_with_many_pieces(spark):
    files = spark.createDataFrame([("/a/img_" + "_".join(["T001"] * 1500) + "_T003_C1.tif",), ("/a/img_T001_C1.tif",)], "path string")
    assert {r.dim: r["size"] for r in catalog.sizes_from_stems(files).collect()} == {"T": 3, "C": 1}
    assert [r.name for r in catalog.matching(files, "img_T00?_C*.tif").collect()] == ["img_T001_C1.tif"]


LOG = """Channels:
Channel name, Exposure time, Camera mode
 GFP , 30, 2
mCherry, 100, 1, extra
short
Syringe pump details: 2 pumps.
late line
Times: 1, 2,3
4,5
Flow post switch: 0.5,1
1.5
a note ends here:END
first words
this line has MARK inside
17 and 18
Notes
plain text
stop now
never read"""


def test_grammar_of_legacy_logs(spark):
    lines = spark.createDataFrame([("f", i, t) for i, t in enumerate(LOG.split("\n"))], "file string, line long, text string")
    grammar = [
        {"name": "channels", "startswith": "Channels:", "kind": "table", "columns": {"Channel name": ("channel", "str"), "Exposure time": ("exposure", "int")}, "default": "int"},
        {"name": "npumps", "startswith": "Syringe pump details:", "kind": "regex", "regex": r"(\d+)\s*pumps", "map": "int", "next_section": "rest"},
        {"name": "rest", "kind": "text"},
        {"name": "times", "startswith": "Times:", "kind": "list", "map": "int"},
        {"name": "flow", "startswith": "Flow post switch:", "kind": "lists", "map": "float"},
        {"name": "end", "endswith": ":END", "kind": "text"},
        {"name": "all", "contains": "MARK", "kind": "regexs", "regex": r"(\d+)", "map": "int"},
        {"name": "notes", "matches": "^Notes?$", "kind": "text"},
        {"name": "over", "startswith": "stop", "kind": "stop"},
    ]
    rows = logs.by_grammar(lines, grammar).orderBy("line", "pos").collect()
    of = lambda name: [(r.key, r.value, r.type) for r in rows if r.section == name]
    assert of("channels") == [("channel", "GFP", "str"), ("exposure", "30", "int"), ("Camera mode", "2", "int"), ("channel", "mCherry", "str"), ("exposure", "100", "int"), ("Camera mode", "1,extra", "int")]
    assert of("npumps") == [("match", "2", "int")] and of("rest") == [("text", "late line", "str")]
    assert [v for _, v, _ in of("times")] == ["1", "2", "3", "4", "5"]
    assert [(k, v) for k, v, _ in of("flow")] == [("0", "0.5"), ("0", "1"), ("1", "1.5")]
    assert of("end") == [("text", "first words", "str")] and [v for _, v, _ in of("all")] == ["17", "18"]
    assert of("notes") == [("text", "plain text", "str")] and not of("over")
    assert logs.by_grammar(lines.limit(0), grammar).count() == 0


def test_windows_equal_whole_images(spark):
    """Objects of a large image, some at its edges: windows give what the whole image gives; a tile counts as the image."""
    rng = np.random.default_rng(7)
    image = np.round(rng.random((150, 200)), 3)
    masks = np.zeros(image.shape, int)
    for k, (cy, cx, r) in enumerate([(3, 4, 6), (70, 80, 30), (149, 199, 12), (60, 128, 5), (64, 190, 9)], 1):
        y, x = np.mgrid[: image.shape[0], : image.shape[1]]
        masks[(y - cy) ** 2 + (x - cx) ** 2 <= r * r] = k
    m = spark.createDataFrame([(1, 0, 0, int(y), int(x), int(masks[y, x])) for y, x in np.argwhere(masks)], MASK)
    p = spark.createDataFrame([(1, 0, 0, int(y), int(x), float(image[y, x])) for y, x in np.ndindex(image.shape)], "position long, tp int, c int, y int, x int, v double")
    whole = {r.label: r for r in features.localisation(m, p).collect()}
    assert len(whole) == 5
    for label, r in whole.items():
        mask = masks == label
        assert r.small_peaks_conv == pytest.approx(features.small_peaks(image, mask), abs=1e-9)
        assert r.nuc_est_conv == pytest.approx(features.nucleus_estimate(image, mask, ((0, 0), (0, 0))), abs=1e-9)
    tiles = spark.createDataFrame([(1, 0, 30, 40, 80, 90)], "position long, tile int, y0 int, x0 int, h int, w int")
    (cut,) = (r for r in features.localisation(m, p, tiles).collect() if r.label == 2)
    own = (slice(30, 110), slice(40, 130))
    assert cut.small_peaks_conv == pytest.approx(features.small_peaks(image[own], masks[own] == 2), abs=1e-9)
    assert cut.nuc_est_conv == pytest.approx(features.nucleus_estimate(image[own], masks[own] == 2, ((0, 0), (0, 0))), abs=1e-9)


def flood(mask):
    """Labels by stepping to all eight sides, pixel by pixel."""
    out, n = np.zeros(mask.shape, int), 0
    for start in map(tuple, np.argwhere(mask)):
        if not out[start]:
            n, todo = n + 1, [start]
            while todo:
                y, x = todo.pop()
                if 0 <= y < mask.shape[0] and 0 <= x < mask.shape[1] and mask[y, x] and not out[y, x]:
                    out[y, x] = n
                    todo += [(y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    return out


@pytest.mark.parametrize("share", [0.3, 0.42])
def test_regions_over_blocks(spark, share):
    rng = np.random.default_rng(int(share * 100))
    mask = rng.random((30, 37)) < share
    mask[15, 3:34] = True  # a region that crosses many blocks
    labels = flood(mask)
    border = np.unique(np.concatenate([labels[0], labels[-1], labels[:, 0], labels[:, -1]]))
    kept = [k for k in range(1, labels.max() + 1) if k not in border]
    want = sorted((1, 0, int(y), int(x), kept.index(labels[y, x]) + 1) for y, x in np.argwhere(mask) if labels[y, x] in kept)
    rows = spark.createDataFrame([(1, 0, int(y), int(x)) for y, x in np.argwhere(mask)], "position long, tp int, y int, x int")
    for block in (8, 256):
        assert sorted(map(tuple, blocks.regions(rows, 30, 37, block).collect())) == want


def test_components_of_stars_and_chains(spark):
    """A hub over the limit, a long chain, a cycle, and a loop."""
    edges = [(1000, k) for k in range(1001, 1400)] + [(k, k + 1) for k in range(40)] + [(500, 501), (501, 502), (502, 500)] + [(7000, 7000)] + [(1200, 9000)]
    edges = edges[::2] + [(b, a) for a, b in edges[1::2]]
    found = {r.node: r.component for r in graphs.components(spark.createDataFrame(edges, "a long, b long"), hub=50).collect()}
    want = {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(1000, 1400), 1000), 9000: 1000, **dict.fromkeys((500, 501, 502), 500), 7000: 7000}
    assert found == want


def test_costes_by_its_definition(spark):
    rng = np.random.default_rng(3)
    rows = []
    for label in range(1, 9):
        a = rng.random(40)
        b = np.where(a > 0.5, a, rng.random(40) * 0.6) if label % 4 else 1 - a + 0.1 * rng.random(40)
        rows += [(1, 0, 0, label, i, 0, float(x), float(y)) for i, (x, y) in enumerate(zip(a, b, strict=True))]
    rows += [(1, 0, 0, 20, 0, 0, 0.5, 0.5), (1, 0, 0, 21, 0, 0, 0.5, 0.1), (1, 0, 0, 21, 1, 0, 0.5, 0.9)]
    pairs = spark.createDataFrame(rows, "position long, tile int, tp int, label int, y int, x int, v0 double, v1 double")
    found = {r.label: r for r in features.costes(pairs).collect()}
    for label in range(1, 9):
        a, b = (np.array([r[k] for r in rows if r[3] == label]) for k in (6, 7))
        cov, gap = np.cov(a, b, bias=True)[0, 1], b.var() - a.var()
        slope = (gap + math.sqrt(gap**2 + 4 * cov**2)) / (2 * cov)
        if cov < 0:
            assert (found[label].threshold, found[label].costes_1) == (a.max(), 0.0)
            continue
        level = np.minimum(a, a.mean() + (b - b.mean()) / slope)
        loose = lambda t, a=a, b=b, level=level: (level < t).sum() < 3 or np.corrcoef(a[level < t], b[level < t])[0, 1] <= 0
        threshold = max([t for t in level if loose(t)] + ([a.max()] if loose(np.inf) else []))
        assert found[label].threshold == pytest.approx(threshold, abs=1e-9)
        assert found[label].costes_1 == pytest.approx(a[level > threshold + 1e-12].sum() / a.sum(), abs=1e-9)
    assert found[20].threshold is None and found[21].threshold is None


def test_mask_store(spark, tmp_path):
    """Runs come back as pixels, and a read of one frame leaves most chunks alone; runs take less room than pixels."""
    mask = disk(40)
    rows = [(p, 0, t, int(y) + 300 * (t % 2), int(x), k) for p in range(3) for t in range(4) for k in (1, 2) for y, x in np.argwhere(mask)[:: 1 if k == 1 else 3]]
    masks = spark.createDataFrame(rows + rows[:50], MASK)
    path = profiles.write_masks(masks, f"{tmp_path}/masks")
    chunks = profiles.read_chunks(spark, path)
    key = lambda df: sorted(map(tuple, df.select("position", "tile", "tp", "y", "x", "label").collect()))
    assert key(profiles.pixels_of(chunks)) == sorted(set(rows))
    some = profiles.pixels_of(chunks.where("position = 1 AND tp = 2"))
    assert key(some) == sorted({r for r in rows if r[0] == 1 and r[2] == 2})
    assert "GreaterThan" in some._jdf.queryExecution().toString() or "EqualTo(position,1)" in some._jdf.queryExecution().toString()
    masks.distinct().repartition(4).write.parquet(f"{tmp_path}/plain")
    size = lambda d: sum(f.stat().st_size for f in (tmp_path / d).glob("*.parquet"))
    assert size("masks") < size("plain")
