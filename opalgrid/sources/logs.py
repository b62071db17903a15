"""Experiment logs: sections of text lines become typed rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opalgrid.functions.values import epoch, typed
from opalgrid.operators.graphs import checkpointed

__all__ = ["acquisition", "by_grammar", "epoch", "flagged_channels", "flattened", "general", "groups", "minimal", "numbers", "preferred", "read_lines", "sections", "typed"]

#: The line that opens the acquisition part of a sectioned log.
ACQUISITION = "-----Acquisition settings-----"


#: Lines of a range, which one task orders.
RANGE = 100_000


def _ranged(rows: DataFrame) -> DataFrame:
    """rows with _part, ranges in the order of file and line, each in one partition: kept, for a sample draws their bounds."""
    n = -(-rows.count() // RANGE) or 1
    kept = checkpointed(rows.repartitionByRange(n, "file", "line").withColumn("_part", F.spark_partition_id()))
    return kept.repartition(n, "_part")


def _opened(rows: DataFrame) -> DataFrame:
    """Ranged rows with block and section: the number and the last of the file's marks at or before each line. What stands
    before a range is told by one row for each range, so a file of any length is in no single task."""
    within = Window.partitionBy("_part", "file").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    marked = F.col("mark").isNotNull()
    ends = rows.groupBy("_part", "file").agg(F.count("mark").alias("n"), F.max_by("mark", F.when(marked, F.col("line"))).alias("mark"))
    earlier = Window.partitionBy("file").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("_part", F.col("file").alias("_file"), F.sum("n").over(earlier).alias("_n"), F.last("mark", True).over(earlier).alias("_mark"))
    ends = F.broadcast(ends.where("_n > 0"))  # only of the file that a range begins within
    own = F.col("file").eqNullSafe(F.col("_file"))
    out = rows.withColumns({"block": F.count("mark").over(within), "section": F.last("mark", True).over(within)}).join(ends, "_part", "left")
    out = out.withColumns({"block": F.col("block") + F.when(own, F.col("_n")).otherwise(0), "section": F.coalesce("section", F.when(own, F.col("_mark")))})
    return out.drop("_file", "_n", "_mark")


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, line (from 0), text of text files; a file is one row until its lines are numbered."""
    whole = spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("file"), "value")
    return whole.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("line", "text"))


def sections(lines: DataFrame, markers: list[tuple[str, str]]) -> DataFrame:
    """lines with section: the name of the last marker line (name, regex) at or before each, '' before the first.

    Blank lines are left out; marker lines have is_marker true.
    """
    name: Column = F.lit(None).cast("string")
    for section, regex in reversed(markers):
        name = F.when(F.col("text").rlike(regex), F.lit(section)).otherwise(name)
    rows = _opened(_ranged(lines.where(F.trim("text") != "").withColumn("mark", name)))
    return rows.withColumns({"section": F.coalesce("section", F.lit("")), "is_marker": F.col("mark").isNotNull()}).drop("mark", "block", "_part")


def general(lines: DataFrame) -> DataFrame:
    """file, key, value of lines `Key: rest` before the acquisition part; keys in lower case, blanks as underscores. The
    first line of a key counts; a key needs a letter."""
    rows = sections(lines, [("acquisition", f"^{ACQUISITION}")]).where("section = '' AND text LIKE '%:%'")
    key = F.replace(F.lower(F.trim(F.substring_index("text", ":", 1))), F.lit(" "), F.lit("_"))
    rows = rows.select("file", "line", key.alias("key"), F.trim(F.expr("substring(text, instr(text, ':') + 1)")).alias("value"))
    return rows.where(F.col("key").rlike("[a-z]")).groupBy("file", "key").agg(F.min_by("value", "line").alias("value"))


def acquisition(lines: DataFrame, channels: list[str]) -> DataFrame:
    """file, line, channel, exposure, n_z, z_spacing, method of comma-separated rows whose first two fields are channels."""
    f = F.split("text", ",")
    get = lambda i: F.get(f, F.lit(i))
    rows = lines.where(get(0).isin(channels) & get(1).isin(channels))
    number = lambda i, kind: get(i).try_cast(kind)
    return rows.select("file", "line", get(0).alias("channel"), number(3, "int").alias("exposure"), number(4, "int").alias("n_z"), number(5, "double").alias("z_spacing"), get(6).alias("method"))


def groups(lines: DataFrame, regex: str = r"^Group: ([^,]+),\s*([-0-9.]+),\s*([-0-9.]+)") -> DataFrame:
    """file, name, x, y of group lines."""
    rows = lines.where(F.col("text").rlike(regex))
    part = lambda i: F.regexp_extract("text", regex, i)
    return rows.select("file", part(1).alias("name"), part(2).try_cast("double").alias("x"), part(3).try_cast("double").alias("y"))


def numbers(lines: DataFrame, words: list[str]) -> DataFrame:
    """file, word, value: the first integer after `word:`; the first line that has one counts."""
    out = None
    for word in words:
        found = F.regexp_extract("text", rf"{word}:\s*(\d+)", 1)
        rows = lines.select("file", "line", F.lit(word).alias("word"), found.alias("v")).where("v <> ''")
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("file", "word").agg(F.min_by("v", "line").cast("long").alias("value"))


def minimal(lines: DataFrame, channels: list[str]) -> DataFrame:
    """file, channels (in order of their lines), ntimepoints, timeinterval."""
    found = acquisition(lines, channels).groupBy("file").agg(F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct("line", "channel"))), lambda s: s["channel"])).alias("channels"))
    n = numbers(lines, ["frames", "interval"]).groupBy("file").pivot("word", ["frames", "interval"]).agg(F.first("value"))
    return n.join(found, "file", "full_outer").select("file", "channels", F.col("frames").alias("ntimepoints"), F.col("interval").alias("timeinterval"))


#: Kinds of sections whose marker line is left out, and kinds that read what the marker line has beside its marker.
SKIPPED, BESIDE = ("table", "text", "stop"), ("list", "lists", "regex", "regexs")


def _marked(lines: DataFrame, grammar: list[dict]) -> DataFrame:
    """lines (trimmed, not blank) with mark, the section that a line opens, and text without the marker."""
    text = F.trim("text")
    mark, rest = F.lit(None).cast("string"), F.col("text")
    for g in reversed(grammar):
        if "startswith" in g:
            t = g["startswith"]
            hit, left = F.startswith("text", F.lit(t)), F.expr(f"substring(text, {len(t) + 1})")
        elif "endswith" in g:
            t = g["endswith"]
            hit, left = F.endswith("text", F.lit(t)), F.expr(f"substring(text, 1, length(text) - {len(t)})")
        elif "contains" in g:
            hit, left = F.contains("text", F.lit(g["contains"])), F.replace("text", F.lit(g["contains"]), F.lit(""))
        elif "matches" in g:
            hit, left = F.col("text").rlike(g["matches"]), F.regexp_replace("text", g["matches"], "")
        else:
            continue  # reached by next_section only
        mark, rest = F.when(hit, F.lit(g["name"])).otherwise(mark), F.when(hit, left).otherwise(rest)
    rows = lines.select("file", "line", text.alias("text")).where("text <> ''")
    return rows.select("file", "line", mark.alias("mark"), rest.alias("text"))


def _in_sections(rows: DataFrame, grammar: list[dict]) -> DataFrame:
    """rows with section and block: a block begins at a marker; after the first match of a `regex` section its
    next_section goes on, or none."""
    out = _opened(_ranged(rows)).where("section IS NOT NULL")
    for _ in range(1 + sum("next_section" in g for g in grammar)):  # a next section may have a next one
        hit = F.lit(False)
        follows = F.lit(None).cast("string")
        for g in grammar:
            if g["kind"] == "regex":
                own = F.col("section") == g["name"]
                hit = hit | (own & F.col("text").rlike(g.get("regex", "^(.*)$")))
                follows = F.when(own, F.lit(g.get("next_section"))).otherwise(follows)
        # The first match in the range, or in an earlier one that the block reaches back to: there it is the last of its block.
        at = F.when(hit, F.col("line"))
        last = out.groupBy("_part").agg(F.max(F.struct("file", "block")).alias("_end"))
        open_ = out.where(hit).join(F.broadcast(last), "_part").where(F.struct("file", "block").eqNullSafe(F.col("_end")))
        open_ = open_.groupBy(F.col("file").alias("_file"), F.col("block").alias("_block"), F.col("section").alias("_section")).agg(F.min("line").alias("_line"))
        same = F.col("file").eqNullSafe(F.col("_file")) & (F.col("block") == F.col("_block")) & (F.col("section") == F.col("_section"))
        first = F.least(F.min(at).over(Window.partitionBy("_part", "file", "block", "section")), "_line")
        out = out.join(F.broadcast(open_), same, "left").withColumn("_first", first)
        out = out.withColumn("section", F.when(F.col("line") > F.col("_first"), follows).otherwise(F.col("section"))).drop("_first", "_file", "_block", "_section", "_line").where("section IS NOT NULL")
    return out.drop("_part")


def _cells(rows: DataFrame, g: dict) -> DataFrame:
    """A table's fields: columns by a list of (name, type), or by the header's names through a map name -> (name, type)."""
    separator, default, columns = g.get("separator", ","), g.get("default", "str"), g.get("columns", [])
    fields = F.transform(F.split("text", re.escape(separator)), lambda x: F.trim(x))
    rows = rows.select("file", "line", fields.alias("f"))
    if g.get("header", True):
        head = rows.groupBy("file").agg(F.min("line").alias("_head"), F.min_by("f", "line").alias("names"))
        rows = rows.join(head, "file").where("line > _head").drop("_head")
        if isinstance(columns, dict):
            known = F.create_map(*[F.lit(x) for old, (new, kind) in columns.items() for x in (old, F.struct(F.lit(new).alias("name"), F.lit(kind).alias("kind")))]) if columns else None
            one = lambda n, i: F.coalesce(F.try_element_at(known, n), F.struct(n.alias("name"), F.lit(default).alias("kind"))) if known is not None else F.struct(n.alias("name"), F.lit(default).alias("kind"))
        else:
            given = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(k).alias("kind")) for n, k in columns])
            one = lambda n, i: F.struct(F.coalesce(F.get(given, i)["name"], n).alias("name"), F.coalesce(F.get(given, i)["kind"], F.lit(default)).alias("kind"))
        rows = rows.withColumn("names", F.transform("names", one))
    else:
        names = [F.struct(F.lit(n or f"column{i + 1:02d}").alias("name"), F.lit(k or default).alias("kind")) for i, (n, k) in enumerate(columns)]
        rows = rows.withColumn("names", F.array(*names))
    n = F.size("names")
    merged = F.concat(F.slice("f", F.lit(1), n - 1), F.array(F.array_join(F.slice("f", n, F.size("f")), separator)))
    long = rows.where(F.size("f") >= n).select("file", "line", F.posexplode(F.arrays_zip("names", merged.alias("v"))).alias("pos", "x"))
    return long.select("file", F.lit(g["name"]).alias("section"), "line", "pos", F.col("x.names.name").alias("key"), F.col("x.v").alias("value"), F.col("x.names.kind").alias("type"))


def by_grammar(lines: DataFrame, grammar: list[dict]) -> DataFrame:
    """file, section, line, pos, key, value, type of legacy text by a grammar: a list of sections.

    A section has a name, a marker (startswith, endswith, contains, or the regex `matches`; the first in the list counts)
    and a kind. text: each line is a value. table: rows of fields, with a header line (unless header is False), columns and
    a separator; short rows are left out, extra fields are joined into the last. list, lists: separated values, one list
    in all or one for each line (key: the line's number among the section's). regex: the first match of a block, of
    several blocks the last; then the section ends, or next_section goes on. regexs: every match. stop: ends the file.
    map: the type of list and regex values. Blank lines are left out; a line of no section is too.
    """
    rows = _marked(lines, grammar)
    stops = [g["name"] for g in grammar if g["kind"] == "stop"]
    if stops:
        ends = rows.where(F.col("mark").isin(stops)).groupBy(F.col("file").alias("_file")).agg(F.min("line").alias("_end"))
        rows = rows.join(ends, F.col("file").eqNullSafe(F.col("_file")), "left").where("_end IS NULL OR line < _end").drop("_end", "_file")
    rows = checkpointed(_in_sections(rows, grammar))  # read once for each section
    out = None
    for g in (g for g in grammar if g["kind"] != "stop"):
        own = rows.where(F.col("section") == g["name"])
        if g.get("skip", g["kind"] in SKIPPED):
            own = own.where(~F.coalesce(F.col("mark") == g["name"], F.lit(False)))
        own = own.withColumn("text", F.trim("text")).where("text <> ''")
        kind, type_of = g["kind"], F.lit(g.get("map") or "str")
        same = [F.lit(g["name"]).alias("section")]
        if kind == "table":
            part = _cells(own, g)
        elif kind in ("list", "lists"):
            number = F.row_number().over(Window.partitionBy("file").orderBy("line")) - 1
            key = number.cast("string") if kind == "lists" else F.lit("list")
            values = F.transform(F.split("text", re.escape(g.get("separator", ","))), lambda x: F.trim(x))
            part = own.withColumn("key", key).select("file", *same, "line", F.posexplode(values).alias("pos", "value"), "key", type_of.alias("type"))
        elif kind == "regex":
            regex = g.get("regex", "^(.*)$")
            first = own.where(F.col("text").rlike(regex)).groupBy("file", "block").agg(F.min("line").alias("line"), F.min_by("text", "line").alias("text"))
            last = first.groupBy("file").agg(F.max("line").alias("line"), F.max_by("text", "line").alias("text"))
            part = last.select("file", *same, "line", F.lit(0).alias("pos"), F.lit("match").alias("key"), F.regexp_extract("text", regex, 1).alias("value"), type_of.alias("type"))
        elif kind == "regexs":
            found = F.regexp_extract_all("text", F.lit(g.get("regex", "^(.*)$")), F.lit(1))
            part = own.select("file", *same, "line", F.posexplode(found).alias("pos", "value"), F.lit("match").alias("key"), type_of.alias("type"))
        else:
            part = own.select("file", *same, "line", F.lit(0).alias("pos"), F.lit("text").alias("key"), F.col("text").alias("value"), F.lit("str").alias("type"))
        part = part.select("file", "section", "line", "pos", "key", "value", "type")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("a grammar without sections")
    return out


def flattened(parsed: DataFrame) -> DataFrame:
    """file and a map from section/key to value; missing values are '0'. The last value of a key counts."""
    rows = parsed.groupBy("file", F.concat_ws("/", "section", "key").alias("key")).agg(F.max_by("value", F.struct("line", "pos")).alias("value"))
    return rows.groupBy("file").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", F.coalesce("value", F.lit("0")))))).alias("meta"))


def preferred(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key that either has: the second's where it has one, else the first's. Keys may be null."""
    both = first.withColumn("_rank", F.lit(0)).unionByName(second.withColumn("_rank", F.lit(1)))
    rest = [c for c in first.columns if c not in keys]
    return both.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_rank").alias("v")).select(*keys, "v.*")


def flagged_channels(flags: DataFrame, key: str, channels: list[str]) -> DataFrame:
    """key and the channels whose flag is not 0; all channels where none is set."""
    long = flags.unpivot(key, channels, "channel", "flag").where("flag <> 0")
    on = long.groupBy(key).agg(F.sort_array(F.collect_list("channel")).alias("on"))
    return flags.select(key).distinct().join(on, key, "left").select(key, F.coalesce("on", F.lit(sorted(channels))).alias("channels"))
