"""Merkle fixity audit of web archives: find damaged records of a replica without comparing all of them.

Records are hashed where they lie. A tree over each archive file binds ranges of offsets: a leaf is a record, a node of
level 1 covers the records that begin in a range of 2^16 bytes, and each further level 16 ranges of the one below; the
top of a file covers all of it. Replicas are compared from the top; only below nodes that differ are the children looked
at. A record that is changed, cut, moved, missing or extra shows up as a leaf of its own offset.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opalgrid.llm.common import cut, text_of

#: Bits of offset that a node of level 1 covers, bits that each further level adds, and levels below a file's root.
RANGE_BITS, FAN_BITS, LEVELS = 16, 4, 4
#: Pages whose ids lie in one range of this many go into one archive file.
PAGES_EACH = 2048


def records(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html", pages_each: int = PAGES_EACH) -> DataFrame:
    """Response records of pages: file, position (among the file's), page_id, url, record (bytes).

    A file holds the pages of one range of ids; rows without id go into a file of their own. Null texts count as empty.
    Pages with equal ids are ordered by their content; repeated rows are records of their own.
    """
    body = F.encode(text_of(html), "UTF-8")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), text_of(url), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    record = F.concat(F.encode(head, "UTF-8"), body, F.encode(F.lit("\r\n\r\n"), "UTF-8"))
    number = F.col(key).cast("long")
    file = F.coalesce(F.floor(number / F.lit(pages_each)), F.lit(-1)).cast("long")
    return pages.select(file.alias("file"), number.alias("page_id"), F.col(url).cast("string").alias("url"), record.alias("record"))


def leaves(rows: DataFrame, *, record: str = "record", beside: list[str] | None = None) -> DataFrame:
    """file, offset, length, page_id, digest: the records hashed in place, each at the sum of the lengths before it.

    Needs the columns file and page_id beside the record; columns named by `beside` are kept. Only digests and lengths are
    shuffled. Lengths are summed within parts of a file (records of one page, by the digest's beginning) and then over the
    parts, and equal records are placed together, so no task holds a file, or all copies of a page.
    """
    kept = beside or []
    hashed = rows.select("file", "page_id", F.octet_length(record).cast("long").alias("length"), F.sha2(record, 256).alias("digest"), *kept)
    part = ["file", "page_id", "_part"]
    once = hashed.groupBy("file", "page_id", "length", "digest", *kept).agg(F.count("*").alias("_n")).withColumn("_part", F.substring("digest", 1, 2))
    sums = once.groupBy(*part).agg(F.sum(F.col("length") * F.col("_n")).alias("_sum"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    firsts = sums.withColumn("_first", F.coalesce(F.sum("_sum").over(before(Window.partitionBy("file").orderBy(F.col("page_id").asc_nulls_first(), "_part"))), F.lit(0))).drop("_sum")
    own = F.coalesce(F.sum(F.col("length") * F.col("_n")).over(before(Window.partitionBy(*part).orderBy("digest", *kept))), F.lit(0))
    placed = once.withColumn("_own", own).alias("o").join(firsts.alias("f"), [F.col(f"o.{c}").eqNullSafe(F.col(f"f.{c}")) for c in part])
    copies = placed.select("o.file", "o.page_id", "o.length", "o.digest", *[f"o.{c}" for c in kept], (F.col("_first") + F.col("_own")).alias("_at"), F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_k"))
    return copies.select("file", "page_id", "length", "digest", *kept, (F.col("_at") + F.col("_k") * F.col("length")).alias("offset"))


def node(level: int) -> Column:
    """Number of the node of a level that an offset falls into."""
    return F.shiftright("offset", RANGE_BITS + FAN_BITS * (level - 1))


def tree(leaf: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda level: level) -> list[DataFrame]:
    """Tables file, node, digest for the levels 1, 2, ... and, last, file and digest of the roots.

    A digest covers the nodes below it in order, with their numbers, so that an empty range differs from a full one. Each
    level is made from the one below, as `keep` returns it.
    """
    line = F.concat_ws(":", "offset", "length", "digest")
    joined = lambda x: F.sha2(F.concat_ws("|", F.transform(F.sort_array(F.collect_list(x)), lambda s: s["line"])), 256)
    levels = [keep(leaf.groupBy("file", node(1).alias("node")).agg(joined(F.struct("offset", line.alias("line"))).alias("digest")))]
    below = F.struct("node", F.concat_ws(":", "node", "digest").alias("line"))
    for _ in range(1, LEVELS):
        levels.append(keep(levels[-1].withColumn("above", F.shiftright("node", FAN_BITS)).groupBy("file", F.col("above").alias("node")).agg(joined(below).alias("digest"))))
    levels.append(keep(levels[-1].groupBy("file").agg(joined(below).alias("digest"))))
    return levels


def _differing(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    left, right = a.withColumnRenamed("digest", "d1"), b.withColumnRenamed("digest", "d2")
    return left.join(right, on, "full_outer").where(~F.col("d1").eqNullSafe(F.col("d2"))).select(*on)


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Records in which two replicas (tables of leaves) differ: file, offset, page_id, damage, and both lengths.

    damage: changed (other bytes), cut (another length), missing (not in the second), extra (only there). Equal replicas
    give no rows. Each level is compared only below the nodes that differ on the level above it.
    """
    a, b = cut(first), cut(second)
    trees = list(zip(tree(a, cut), tree(b, cut), strict=True))  # each level once, from the level below
    suspect = _differing(*trees[-1], ["file"])
    for level in range(LEVELS, 0, -1):
        up = ["file"] if level == LEVELS else ["file", "above"]
        shown = [t.withColumn("above", F.shiftright("node", FAN_BITS)).join(suspect, up, "left_semi").drop("above") for t in trees[level - 1]]
        suspect = cut(_differing(*shown, ["file", "node"]).withColumnRenamed("node", "above"))
    below = [x.withColumn("above", node(1)).join(suspect, ["file", "above"], "left_semi") for x in (a, b)]
    side = lambda x, n: x.select("file", "offset", *[F.col(c).alias(f"{c}_{n}") for c in ("page_id", "length", "digest")])
    both = side(below[0], 1).join(side(below[1], 2), ["file", "offset"], "full_outer").where(~F.col("digest_1").eqNullSafe(F.col("digest_2")))
    kinds = [(F.col("digest_2").isNull(), "missing"), (F.col("digest_1").isNull(), "extra"), (F.col("length_1") != F.col("length_2"), "cut")]
    damage = reduce(lambda rest, k: F.when(k[0], k[1]).otherwise(rest), reversed(kinds), F.lit("changed"))
    return both.select("file", "offset", F.coalesce("page_id_1", "page_id_2").alias("page_id"), damage.alias("damage"), F.col("length_1").alias("length"), F.col("length_2").alias("replica_length"))


def roots(leaf: DataFrame) -> DataFrame:
    """file, digest: the root of each archive file."""
    return tree(leaf)[-1]
