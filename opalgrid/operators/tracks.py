"""Tracks of cells over time: lookups, presence, merges, picks, lineage and links between frames.

Signals are long rows (path, trap, cell_label, tp, value); cell information is (trap, cell_label, timepoint, ...).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opalgrid.operators.graphs import components, running_total

CELL = ["trap", "cell_label"]


# Lookups and presence --------------------------------------------------------------------------------------------------


def cell_rows(info: DataFrame, cell: int, trap: int) -> DataFrame:
    return info.where((F.col("cell_label") == cell) & (F.col("trap") == trap))


def at_time(info: DataFrame, tp: int) -> DataFrame:
    """Labels of each trap at a time; traps without cells have an empty list."""
    here = info.where(F.col("timepoint") == tp).groupBy("trap").agg(F.sort_array(F.collect_list("cell_label")).alias("labels"))
    none = F.array().cast("array<int>")
    return info.select("trap").distinct().join(here, "trap", "left").select("trap", F.coalesce("labels", none).alias("labels"))


def retained(signals: DataFrame, cutoff: float) -> DataFrame:
    """Rows of the cells with more values than cutoff times the number of timepoints of their path."""
    times = signals.groupBy("path").agg(F.count_distinct("tp").alias("_times"))
    kept = signals.groupBy("path", *CELL).agg(F.count("value").alias("_n")).join(F.broadcast(times), "path").where(F.col("_n") > F.col("_times") * cutoff)
    return signals.join(kept.select("path", *CELL), ["path", *CELL], "left_semi")


def until_minute(signals: DataFrame, most: float, interval_s: float = 300) -> DataFrame:
    """Rows up to a minute, without the cells that then have no value."""
    rows = with_minutes(signals, interval_s).where(F.col("minute") <= most)
    some = rows.groupBy("path", *CELL).agg(F.count("value").alias("_n")).where("_n > 0")
    return rows.join(some.select("path", *CELL), ["path", *CELL], "left_semi")


def with_minutes(signals: DataFrame, interval_s: float = 300) -> DataFrame:
    """signals with minute: the timepoint times the interval in whole minutes (halves to even)."""
    return signals.withColumn("minute", (F.col("tp") * F.bround(F.lit(interval_s / 60))).cast("int"))


def picked(rows: DataFrame, picks: DataFrame) -> DataFrame:
    """Rows whose cell is picked; without any pick, all rows."""
    return rows.join(picks.select(*CELL).distinct(), CELL, "left_semi") if picks.limit(1).count() else rows


def presence_starts(info: DataFrame, k: int = 15, low: int | None = None, high: int | None = None) -> DataFrame:
    """First timepoints of all runs of k consecutive ones in which a cell is present, low <= start < high."""
    w = Window.partitionBy(*CELL).orderBy("timepoint").rangeBetween(0, k - 1)
    rows = info.select(*CELL, "timepoint").distinct().withColumn("_n", F.count("*").over(w)).where(F.col("_n") == k).drop("_n")
    rows = rows if low is None else rows.where(F.col("timepoint") >= low)
    return rows if high is None else rows.where(F.col("timepoint") < high)


def max_labels(info: DataFrame, until: int | None = None) -> DataFrame:
    """Largest label of each trap, of the rows up to a timepoint; 0 where there is none."""
    rows = info if until is None else info.where(F.col("timepoint") <= until)
    most = rows.groupBy("trap").agg(F.max("cell_label").alias("max_label"))
    return info.select("trap").distinct().join(most, "trap", "left").fillna(0, ["max_label"])


def label_offsets(info: DataFrame) -> DataFrame:
    """Cells of each trap and how many the traps before it have. Ranges of traps are summed apart."""
    n = info.groupBy("trap").agg(F.count_distinct("cell_label").alias("cells"))
    return running_total(n, ["trap"], F.col("cells"), "offset")


def located(index: DataFrame, offsets: DataFrame) -> DataFrame:
    """index (idx from 0) with trap and label. Each trap's numbers are listed, so that they are looked up by equality."""
    last = F.col("offset") + F.col("cells") - 1
    listed = offsets.where("cells > 0").select("trap", "offset", F.explode(F.sequence("offset", last)).alias("idx"))
    return index.join(listed, "idx").select("idx", "trap", (F.col("idx") - F.col("offset") + 1).cast("int").alias("cell_label"))


def last_mothers(info: DataFrame) -> DataFrame:
    return info.groupBy(*CELL).agg(F.max_by("mother_assign_dynamic", "timepoint").alias("mother"))


def mothers_daughters(info: DataFrame) -> DataFrame:
    """(trap, mother, daughter) of each cell with a mother; daughters are numbered by their place in the trap."""
    place = F.row_number().over(Window.partitionBy("trap").orderBy("cell_label"))
    return last_mothers(info).withColumn("daughter", place).where("mother <> 0").select("trap", "mother", "daughter")


def mother_bud_pairs(info: DataFrame) -> DataFrame:
    """Row and column of the true cells of the bud-by-mother matrix, in numbers over all traps."""
    pairs = mothers_daughters(info).join(label_offsets(info), "trap")
    return pairs.select((F.col("offset") + F.col("daughter") - 1).alias("bud"), (F.col("offset") + F.col("mother") - 1).alias("mother_index"))


def presence(info: DataFrame) -> DataFrame:
    """A row for each cell, with a true or false column for each timepoint that occurs."""
    times = sorted(r[0] for r in info.select("timepoint").distinct().collect())  # a few: they become columns
    return info.groupBy(*CELL).pivot("timepoint", times).agg(F.lit(True)).fillna(False)


def info_tree(info: DataFrame) -> DataFrame:
    """trap -> map from timepoint to the sorted labels."""
    by_time = info.groupBy("trap", "timepoint").agg(F.sort_array(F.collect_set("cell_label")).alias("labels"))
    return by_time.groupBy("trap").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("timepoint", "labels")))).alias("tree"))


def consecutives(info: DataFrame, gap: int) -> DataFrame:
    """Pairs of observations of a cell that lie exactly gap + 1 timepoints apart."""
    rows = info.select(*CELL, "timepoint")
    later = rows.select(*CELL, (F.col("timepoint") - gap - 1).alias("timepoint"))
    return rows.join(later, [*CELL, "timepoint"]).select(*CELL, "timepoint", (F.col("timepoint") + gap + 1).alias("later"))


def pairs_over_gaps(info: DataFrame, back: int) -> DataFrame:
    """For each trap the sum, over gaps of 1 to back timepoints, of the products of the numbers of cells."""
    n = info.groupBy("trap", "timepoint").agg(F.count("*").alias("n"))
    gaps = F.explode(F.sequence(F.lit(1), F.lit(back)))
    other = n.withColumn("gap", gaps).select("trap", (F.col("timepoint") - F.col("gap")).alias("timepoint"), F.col("n").alias("m"))
    return n.join(other, ["trap", "timepoint"]).groupBy("trap").agg(F.sum(F.col("n") * F.col("m")).alias("npairs"))


def pairs_over_time(info: DataFrame, back: int) -> DataFrame:
    """How many such pairs each later timepoint adds, and how many there are up to it, in each trap."""
    n = info.groupBy("trap", "timepoint").agg(F.count("*").alias("n"))
    gaps = F.explode(F.sequence(F.lit(1), F.lit(back)))
    before = n.withColumn("gap", gaps).select("trap", (F.col("timepoint") + F.col("gap")).alias("timepoint"), F.col("n").alias("m"))
    added = n.join(before, ["trap", "timepoint"], "left").groupBy("trap", "timepoint").agg(F.coalesce(F.sum(F.col("n") * F.col("m")), F.lit(0)).alias("added"))
    total = F.sum("added").over(Window.partitionBy("trap").orderBy("timepoint"))
    grown = added.withColumn("total", total)
    change = F.col("total") - F.coalesce(F.lag("total").over(Window.partitionBy("trap").orderBy("timepoint")), F.lit(0))
    return grown.select("trap", "timepoint", "total", change.alias("increment"))


def round_robin(rows: DataFrame, key: str, n: int) -> DataFrame:
    """Distinct keys in order, each with a worker: its place modulo n."""
    placed = running_total(rows.select(key).distinct(), [key], F.lit(1), "_place")
    return placed.select(key, F.pmod("_place", F.lit(n)).cast("int").alias("worker"))


# Lineage and membership ------------------------------------------------------------------------------------------------


def is_in(rows: DataFrame, other: DataFrame, negated: bool = False) -> DataFrame:
    """Rows whose (trap, cell_label) occurs in other, or does not."""
    return rows.join(other.select(*CELL).distinct(), CELL, "left_anti" if negated else "left_semi")


def split_known(new: DataFrame, stored: DataFrame) -> DataFrame:
    """New keys with known, and position: the place of the stored key among the stored ones of its trap, from 0."""
    place = (F.row_number().over(Window.partitionBy("trap").orderBy("cell_label")) - 1).alias("position")
    at = stored.select(*CELL).distinct().select(*CELL, place)
    return new.select(*CELL).distinct().join(at, CELL, "left").withColumn("known", F.col("position").isNotNull())


def validate_lineage(lineage: DataFrame, cells: DataFrame, how: str = "families", order: str = "mother_label") -> DataFrame:
    """lineage with only the first mother of each daughter, of the pairs whose mother, daughter, or both are in cells."""
    first = F.row_number().over(Window.partitionBy("trap", "daughter_label").orderBy(order))
    rows = lineage.withColumn("_k", first).where("_k = 1").drop("_k")
    keys = cells.select(*CELL).distinct()
    for end in {"mothers": ["mother_label"], "daughters": ["daughter_label"], "families": ["mother_label", "daughter_label"]}[how]:
        rows = rows.join(keys.withColumnRenamed("cell_label", end), ["trap", end], "left_semi")
    return rows.select(lineage.columns)


def used_in_lineage(cells: DataFrame, lineage: DataFrame) -> DataFrame:
    """cells with used: whether they are an end of any pair."""
    ends = lineage.select("trap", F.col("mother_label").alias("cell_label")).union(lineage.select("trap", "daughter_label")).distinct().withColumn("_u", F.lit(True))
    return cells.join(ends, CELL, "left").withColumn("used", F.coalesce("_u", F.lit(False))).drop("_u")


def with_mother(rows: DataFrame, lineage: DataFrame) -> DataFrame:
    """rows with mother_label, joined by key; 0 without a mother. A daughter with several mothers gets the least."""
    one = lineage.groupBy("trap", F.col("daughter_label").alias("cell_label")).agg(F.min("mother_label").alias("mother_label"))
    return rows.join(one, CELL, "left").fillna(0, ["mother_label"])


# Merges ----------------------------------------------------------------------------------------------------------------


def chain_ends(merges: DataFrame) -> DataFrame:
    """(trap, label, end): the rightmost track of the chain of each left track. Pointers double until none moves."""
    end = merges.groupBy("trap", F.col("left_label").alias("label")).agg(F.min("right_label").alias("end"))
    while True:
        on = end.select("trap", F.col("label").alias("end"), F.col("end").alias("_next"))
        new = _kept(end.join(on, ["trap", "end"], "left").select("trap", "label", "end", F.coalesce("_next", "end").alias("_new")))
        moved = new.where("_new <> end").limit(1).count()
        end = new.select("trap", "label", F.col("_new").alias("end"))
        if not moved:
            return end


def _kept(df: DataFrame) -> DataFrame:
    from opalgrid.operators.graphs import checkpointed

    return checkpointed(df)


def group_merges(merges: DataFrame) -> DataFrame:
    """merges with chained: whether the left track is another's right one, or the right another's left one."""
    lefts, rights = merges.select("trap", F.col("left_label").alias("k")).distinct(), merges.select("trap", F.col("right_label").alias("k")).distinct()
    both = lefts.join(rights, ["trap", "k"], "left_semi").withColumn("_c", F.lit(True))
    a = both.withColumnsRenamed({"k": "left_label", "_c": "_a"})
    b = both.withColumnsRenamed({"k": "right_label", "_c": "_b"})
    rows = merges.join(a, ["trap", "left_label"], "left").join(b, ["trap", "right_label"], "left")
    return rows.select("trap", "left_label", "right_label", F.coalesce("_a", "_b", F.lit(False)).alias("chained"))


def chain_order(merges: DataFrame) -> DataFrame:
    """merges with chain (its end) and depth: 1 for a chain's first merge, so that a chain is consecutive by depth."""
    ends = chain_ends(merges)
    rows = merges.join(ends.withColumnRenamed("label", "left_label"), ["trap", "left_label"]).withColumnRenamed("end", "chain")
    return rows.withColumn("depth", F.row_number().over(Window.partitionBy("trap", "chain").orderBy("left_label")))


def apply_merges(signals: DataFrame, merges: DataFrame) -> DataFrame:
    """signals after splicing: a left track keeps its values up to its last positive one, later ones come from the right
    track, which goes. Chains are spliced from the right, so no value of a middle track is lost.

    Only merges with both tracks in a signal apply. A track takes the least right track if several are given.
    """
    tracks = signals.select("path", *CELL).distinct()
    one = merges.groupBy("trap", "left_label").agg(F.min("right_label").alias("right_label"))
    left = tracks.withColumnRenamed("cell_label", "left_label").join(one, ["trap", "left_label"])
    valid = left.join(tracks.withColumnRenamed("cell_label", "right_label"), ["path", "trap", "right_label"], "left_semi")
    valid = _kept(valid.select("path", "trap", "left_label", "right_label"))
    rows = _kept(signals.withColumn("_origin", F.col("cell_label")))
    # A chain's tracks get the first one's label; where several have a value, the last whose earlier tracks ended counts.
    starts = chain_starts(valid)
    placed = rows.join(starts.withColumnRenamed("label", "cell_label"), ["path", *CELL], "left").withColumn("_start", F.coalesce("start", "cell_label"))
    cut = placed.where("value > 0").groupBy("path", "trap", "_start", "_origin").agg(F.max("tp").alias("_cut"))
    w = Window.partitionBy("path", "trap", "_start").orderBy("_origin").rowsBetween(Window.unboundedPreceding, -1)
    known = placed.select("path", "trap", "_start", "_origin").distinct().join(cut, ["path", "trap", "_start", "_origin"], "left").withColumn("_from", F.max("_cut").over(w))
    last = F.max("_origin").over(Window.partitionBy("path", "trap", "_start"))
    known = known.withColumn("_last", F.col("_origin") == last)
    spliced = placed.join(known, ["path", "trap", "_start", "_origin"])
    ok = (F.col("_from").isNull() | (F.col("tp") > F.col("_from"))) & (F.col("_last") | F.col("_cut").isNull() | (F.col("tp") <= F.col("_cut")))
    return spliced.where(ok).groupBy("path", "trap", F.col("_start").cast("int").alias("cell_label"), "tp").agg(F.max_by("value", "_origin").alias("value"))


def chain_starts(valid: DataFrame) -> DataFrame:
    """(path, trap, label, start): the leftmost track of the chain of each right track."""
    start = valid.select("path", "trap", F.col("right_label").alias("label"), F.col("left_label").alias("start"))
    start = start.groupBy("path", "trap", "label").agg(F.min("start").alias("start"))
    while True:
        on = start.select("path", "trap", F.col("label").alias("start"), F.col("start").alias("_next"))
        new = _kept(start.join(on, ["path", "trap", "start"], "left").select("path", "trap", "label", "start", F.coalesce("_next", "start").alias("_new")))
        moved = new.where("_new <> start").limit(1).count()
        start = new.select("path", "trap", "label", F.col("_new").alias("start"))
        if not moved:
            return start


def merge_lineage(lineage: DataFrame, merges: DataFrame) -> DataFrame:
    """lineage with each left track replaced by the end of its chain. A merge of two daughters of different mothers is
    void. Distinct pairs."""
    mother = lineage.groupBy("trap", "daughter_label").agg(F.min("mother_label").alias("m"))
    sides = merges.join(mother.select("trap", F.col("daughter_label").alias("left_label"), F.col("m").alias("ml")), ["trap", "left_label"], "left")
    sides = sides.join(mother.select("trap", F.col("daughter_label").alias("right_label"), F.col("m").alias("mr")), ["trap", "right_label"], "left")
    valid = _kept(sides.where("ml IS NULL OR mr IS NULL OR ml = mr").select("trap", "left_label", "right_label"))
    ends = chain_ends(valid)
    rows = lineage
    for end in ("mother_label", "daughter_label"):
        rows = rows.join(ends.withColumnsRenamed({"label": end, "end": f"_{end}"}), ["trap", end], "left").withColumn(end, F.coalesce(f"_{end}", end)).drop(f"_{end}")
    return rows.select("trap", "mother_label", "daughter_label").distinct()


# Links between frames --------------------------------------------------------------------------------------------------


def overlap_links(masks: DataFrame, least: float = 0.25) -> DataFrame:
    """Each object's best predecessor by intersection over union with the frame before: position, tile, tp, label,
    previous, iou. Ties go to the smaller label."""
    keys = ["position", "tile", "tp"]
    before = masks.select("position", "tile", (F.col("tp") + 1).alias("tp"), "y", "x", F.col("label").alias("previous"))
    shared = masks.join(before, [*keys, "y", "x"]).groupBy(*keys, "label", "previous").agg(F.count("*").alias("i"))
    size = masks.groupBy(*keys, "label").agg(F.count("*").alias("a"))
    earlier = size.select("position", "tile", (F.col("tp") + 1).alias("tp"), F.col("label").alias("previous"), F.col("a").alias("b"))
    scored = shared.join(size, [*keys, "label"]).join(earlier, [*keys, "previous"]).withColumn("iou", F.col("i") / (F.col("a") + F.col("b") - F.col("i")))
    best = F.row_number().over(Window.partitionBy(*keys, "label").orderBy(F.desc("iou"), "previous"))
    return scored.withColumn("_k", best).where((F.col("_k") == 1) & (F.col("iou") >= least)).select(*keys, "label", "previous", "iou")


def track_ids(masks: DataFrame, least: float = 0.25) -> DataFrame:
    """position, tile, tp, label, track: objects linked over frames; a track is named by its first tp and label. Where two
    objects follow the same one, the better overlap continues the track and the other begins a new one."""
    links = overlap_links(masks, least)
    only = F.row_number().over(Window.partitionBy("position", "tile", "tp", "previous").orderBy(F.desc("iou"), "label"))
    links = links.withColumn("_k", only).where("_k = 1")
    name = lambda tp, label: F.format_string("%d/%d/%06d/%06d", F.col("position"), F.col("tile"), tp, label)
    edges = links.select(name(F.col("tp"), F.col("label")).alias("a"), name(F.col("tp") - 1, F.col("previous")).alias("b"))
    objects = masks.select("position", "tile", "tp", "label").distinct().withColumn("node", name(F.col("tp"), F.col("label")))
    labels = components(edges)
    return objects.join(labels, "node", "left").select("position", "tile", "tp", "label", F.coalesce("component", "node").alias("track"))


def tracking_table(frames: DataFrame) -> DataFrame:
    """tile, tp, cell_label, mother_label: the mother is the label-th of the frame's list, 0 where there is none."""
    rows = frames.select("tile", "tp", F.explode("cell_label").alias("cell_label"), "mother_assign")
    mother = F.when(F.col("cell_label") > 0, F.try_element_at("mother_assign", F.col("cell_label")))
    return rows.select("tile", "tp", "cell_label", F.coalesce(mother, F.lit(0)).alias("mother_label"))


def format_segmentation(frames: DataFrame) -> DataFrame:
    """trap, cell_label, mother_assign_dynamic, timepoint; labels beyond the shorter list are left out."""
    both = F.least(F.size("cell_label"), F.size("mother_assign"))
    rows = frames.select("tile", "tp", "mother_assign", F.posexplode(F.slice("cell_label", F.lit(1), both)).alias("pos", "cell_label"))
    mother = F.coalesce(F.try_element_at("mother_assign", F.col("cell_label")), F.lit(0))
    return rows.select(F.col("tile").alias("trap"), "cell_label", mother.alias("mother_assign_dynamic"), F.col("tp").alias("timepoint"))


def accumulated(frames: DataFrame, column: str) -> DataFrame:
    """Per tile, the lists of all frames in order of time."""
    rows = F.sort_array(F.collect_list(F.struct("tp", column)))
    return frames.groupBy("tile").agg(F.transform(rows, lambda s: s[column]).alias(column))


def latest_labels(frames: DataFrame) -> DataFrame:
    return frames.groupBy("tile").agg(F.max_by("cell_label", "tp").alias("cell_label"))


def state_rows(frames: DataFrame, column: str) -> DataFrame:
    """(tp_back, trap, pos, value) of the nested state; tp_back counts from the newest frame."""
    newest = Window.partitionBy("tile")
    back = (F.max("tp").over(newest) - F.col("tp")).alias("tp_back")
    return frames.select("tile", back, column).select("tp_back", F.col("tile").alias("trap"), F.posexplode(column).alias("pos", "value"))


def states(rows: DataFrame) -> DataFrame:
    """The inverse of state_rows: for each trap the lists, newest first."""
    lists = rows.groupBy("trap", "tp_back").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "value"))), lambda s: s["value"]).alias("v"))
    return lists.groupBy("trap").agg(F.transform(F.sort_array(F.collect_list(F.struct("tp_back", "v"))), lambda s: s["v"]).alias("state"))


def first_where(rows: DataFrame, group: list[str], index: str, condition: Column) -> DataFrame:
    """The first index that meets a condition in each group, -1 if none does."""
    return rows.groupBy(*group).agg(F.coalesce(F.min(F.when(condition, F.col(index))), F.lit(-1)).alias("first"))
