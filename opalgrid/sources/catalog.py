"""Image collections: listing files, reading their dimensions from names, grouping them into positions."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Letters of dimensions within an image; other letters of a capture order name the position.
IMAGE_DIMENSIONS = "TCZYX"


def scan(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path and length of all files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return files.select("path", "length")


def contents(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path and content of all files below a folder, each whole in one row: of up to 2 GB."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder).select("path", "content")


def captures(files: DataFrame, regex: str, order: str, *, check: bool = False) -> DataFrame:
    """files with a column for each letter of order; names that do not match from their start are left out.

    With check, no match at all is an error.
    """
    rows = files.where(F.col("path").rlike(f"^(?:{regex})"))
    rows = rows.withColumns({letter: F.regexp_extract("path", regex, k + 1) for k, letter in enumerate(order)})
    if check and not rows.limit(1).count():
        raise ValueError(f"no file name matches {regex!r}")
    return rows


def position_key(order: str) -> Column:
    """The groups that are no image dimension, joined by two underscores."""
    return F.concat_ws("__", *[F.col(x) for x in order if x not in IMAGE_DIMENSIONS])


def positions(captured: DataFrame, order: str, *, numeric: bool = False) -> DataFrame:
    """position and paths: the files of each position ordered by T, then C, then Z, as text (or numbers)."""
    dims = [x for x in "TCZ" if x in order]
    keys = [F.col(x).cast("long").alias(x) if numeric else F.col(x) for x in dims]
    entry = F.struct(*keys, "path")
    return captured.groupBy(position_key(order).alias("position")).agg(F.transform(F.sort_array(F.collect_list(entry)), lambda s: s["path"]).alias("paths"))


def dimensions(captured: DataFrame, order: str) -> DataFrame:
    """Sizes of the captured image dimensions of each position, its files, and whether they fill the hypercube."""
    dims = [x for x in order if x in IMAGE_DIMENSIONS]
    sizes = [F.count_distinct(x).alias(f"n_{x}") for x in dims]
    found = captured.groupBy(position_key(order).alias("position")).agg(F.count("*").alias("n_files"), *sizes)
    product = F.lit(1)
    for x in dims:
        product = product * F.col(f"n_{x}")
    return found.withColumn("complete", F.col("n_files") == product)


def sizes_from_stems(files: DataFrame) -> DataFrame:
    """dim and size from names like img_T003_C1: pieces after the first underscore, a letter and a number; max - min + 1.
    A piece that is no letter and number makes all of them missing."""
    stem = F.element_at(F.split(F.regexp_replace("path", r"\.[^./]*$", ""), "/"), -1)
    pieces = F.split(stem, "_")
    parts = files.select(F.explode(F.slice(pieces, F.lit(2), F.size(pieces))).alias("p"))
    rows = parts.select(F.substring("p", 1, 1).alias("dim"), F.expr("try_cast(substring(p, 2) AS INT)").alias("at"))
    bad = rows.agg(F.bool_or(F.col("at").isNull()).alias("bad"))
    return rows.groupBy("dim").agg((F.max("at") - F.min("at") + 1).alias("size")).join(bad).where(~F.col("bad")).drop("bad")


def image_planes(captured: DataFrame, order: str) -> DataFrame:
    """Each file's index in T, C and Z: the rank of its text among the position's; missing dimensions are 0."""
    where = lambda x: F.dense_rank().over(Window.partitionBy("position").orderBy(x)) - 1
    rows = captured.withColumn("position", position_key(order))
    return rows.select("position", "path", *[(where(x) if x in order else F.lit(0)).alias(n) for x, n in (("T", "tp"), ("C", "c"), ("Z", "z"))])


def decoded(files: DataFrame, decode: Callable[[bytes], list[tuple] | pd.DataFrame], schema: str) -> DataFrame:
    """Rows that a decoder makes of each file's content, with its path; the decoder is the caller's.

    It gives a list of rows, or a frame with the schema's columns by place. Null contents have no rows. One file at a time is
    handed on, so a task holds the rows of one file.
    """
    names = [c.split()[0] for c in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                found = decode(bytes(content)) if content is not None else []
                if len(found):
                    rows = found.set_axis(names, axis=1) if isinstance(found, pd.DataFrame) else pd.DataFrame(found, columns=names)
                    yield rows.assign(path=path)

    return files.select("path", "content").mapInPandas(run, f"path string, {schema}")


def aligned(pixels: DataFrame, have: str, want: str = IMAGE_DIMENSIONS) -> DataFrame:
    """Columns of pixels for the wanted dimensions: missing ones are 0; ones that are not wanted must have one value."""
    names = dict(zip("TCZYX", ("tp", "c", "z", "y", "x"), strict=True))
    drop = [names[d] for d in have if d not in want]
    if drop:
        many = pixels.agg(*[F.count_distinct(d).alias(d) for d in drop]).first()
        if any(many[d] > 1 for d in drop):
            raise ValueError("a dimension with several values cannot be dropped")
    return pixels.select("position", *[(F.col(names[d]) if d in have else F.lit(0)).alias(names[d]) for d in want], "value")


def roots(files: DataFrame, root: str) -> DataFrame:
    """Distinct first folders below root: each is a position."""
    rest = F.expr(f"substring(path, {len(root.rstrip('/')) + 2})")
    return files.where(F.startswith("path", F.lit(root.rstrip("/") + "/"))).select(F.substring_index(rest, "/", 1).alias("position")).distinct()


def checksum(files: DataFrame) -> DataFrame:
    """MD5 over the bytes of all files of a position, one after the other, by path. Needs position, path, content."""

    def digest(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        h = hashlib.md5()
        for content in part.sort_values("path")["content"]:
            h.update(bytes(content))
        return pd.DataFrame([(key[0], h.hexdigest())], columns=["position", "md5"])

    return files.groupBy("position").applyInPandas(digest, "position string, md5 string")


def checksum_of_digests(files: DataFrame, value: str) -> DataFrame:
    """MD5 over the MD5 digests of the values of a position, by path: differs from checksum, but moves digests only."""
    digests = files.select("position", "path", F.md5(value).alias("d"))
    return digests.groupBy("position").agg(F.md5(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("path", "d"))), lambda s: s["d"]), "")).alias("md5"))


def first_log(files: DataFrame) -> DataFrame:
    """The log of each folder: the first *.log in order, else the first *.txt; and its kind."""
    kind = F.when(F.col("path").endswith(".log"), 0).when(F.col("path").endswith(".txt"), 1)
    rows = files.select(F.regexp_extract("path", "^(.*)/", 1).alias("folder"), "path", kind.alias("k")).where("k IS NOT NULL")
    best = rows.groupBy("folder").agg(F.min(F.struct("k", "path")).alias("m"))
    return best.select("folder", F.col("m.path").alias("path"), F.when(F.col("m.k") == 0, "sectioned").otherwise("legacy").alias("kind"))


def paired(files: DataFrame, regex: str, kinds: list[str]) -> DataFrame:
    """name and complete: groups <name>_<kind> and whether each has all kinds."""
    rows = files.select(F.regexp_extract("path", regex, 1).alias("name"), F.regexp_extract("path", regex, 2).alias("kind")).where("name <> ''")
    return rows.groupBy("name").agg((F.size(F.array_intersect(F.collect_set("kind"), F.lit(kinds))) == len(kinds)).alias("complete"))


def first_channel(channels: DataFrame, regex: str) -> DataFrame:
    """The first channel (of columns ord, name) whose name matches from its start, without regard to case."""
    return channels.where(F.col("name").rlike(f"(?i)^(?:{regex})")).agg(F.min_by("name", "ord").alias("name"), F.min("ord").alias("ord"))


def stem(path: str = "path") -> Column:
    """A file's name without folders and its last ending."""
    return F.regexp_replace(F.substring_index(F.col(path), "/", -1), r"\.[^.]*$", "")


def matching(files: DataFrame, pattern: str) -> DataFrame:
    """Rows whose file name fits a pattern with * and ?, and name, the path's last part."""
    regex = "".join({"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c)) for c in pattern)
    named = files.withColumn("name", F.element_at(F.split("path", "/"), -1))
    return named.where(F.col("name").rlike(f"^{regex}$"))
