"""Helpers that the text operators share: scratch folder, ordered ranges, chunks, word shingles."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Sort key of a row without id: before every other id.
NO_ID = -(2**63)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share. A temporary one serves only where all run on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        kept = spark.sparkContext._jsc.sc().getCheckpointDir()
        if kept.isEmpty():
            master = spark.sparkContext.master
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
            kept = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = kept.get()
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The rows of df, computed once and kept in the shared folder, so that no later job repeats the work."""
    scratch(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as a Parquet table in the shared folder, and read again: for wide rows."""
    path = f"{scratch(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forgotten(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes tables of stored(), which must not be read again, and has the driver drop what nothing refers to any longer:
    Spark deletes shuffle files and checkpoints only when it collects its garbage."""
    from pyarrow import fs

    for name in {f.rsplit("/", 1)[0] for t in tables for f in t.inputFiles()}:
        store, path = fs.FileSystem.from_uri(name)
        store.delete_dir(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Rows:
    """While it is open, Spark hands so many rows at once to Python: for rows that are large."""

    NAME = "spark.sql.execution.arrow.maxRecordsPerBatch"

    def __init__(self, spark: SparkSession, rows: int) -> None:
        self.spark, self.rows = spark, rows

    def __enter__(self) -> None:
        self.before = self.spark.conf.get(self.NAME)
        self.spark.conf.set(self.NAME, str(self.rows))

    def __exit__(self, *_: object) -> None:
        self.spark.conf.set(self.NAME, self.before)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def by_ranges(df: DataFrame, key: str, rows_each: int = 20_000) -> tuple[DataFrame, list[int]]:
    """df with an int column _range: ascending ranges of the integer column key that hold about as many rows each.

    Null keys count as the smallest. The bounds come from quantiles of all keys; only they reach the driver.
    """
    spark = df.sparkSession
    keyed = df.withColumn("_key", F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)))
    ids = keyed.select(F.col("_key").cast("double").alias("k"))
    n = max(partitions(spark), -(-ids.count() // rows_each))
    found = ids.stat.approxQuantile("k", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else []
    bounds = sorted({int(x) for x in found})
    if not bounds:
        return keyed.withColumn("_range", F.lit(0)), bounds

    @F.pandas_udf("int")
    def place(k):  # noqa: ANN001, ANN202
        return k.__class__(np.searchsorted(np.asarray(bounds, np.int64), k.to_numpy(), side="right").astype(np.int32))

    if len(bounds) <= 400:  # a literal array stays in generated code
        steps = F.lit([int(b) for b in bounds])
        return keyed.withColumn("_range", F.size(F.filter(steps, lambda b: b <= F.col("_key")))), bounds
    return keyed.withColumn("_range", place("_key")), bounds


def dealt_by(df: DataFrame, n: int, column: str) -> DataFrame:
    """One partition for each value 0..n-1 of the int column."""
    if hasattr(df, "repartitionById"):
        return df.repartitionById(n, F.col(column))
    return df.repartition(n, column)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


_caches: dict[str, Callable[[], None]] = {}
_owner = [""]


def claim(owner: str, clear: Callable[[], None] | None = None) -> None:
    """Called by an operator as it begins in a worker process. When another operator has worked there before, its caches are
    emptied and its memory is given back, so that workers that serve one operator after the other hold one at a time.
    clear empties the owner's own cache, later."""
    if owner != _owner[0]:
        for name in [n for n in _caches if n != owner]:
            _caches.pop(name)()
        _powers.clear()
        give_back()
        _owner[0] = owner
    if clear:
        _caches[owner] = clear


def give_back() -> None:
    """Returns memory that is free in this process to the system."""
    import ctypes

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Sets how many rows Spark hands to Python at once: texts are long, and a worker holds several copies of a batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def pieces_of(sizes: Sequence[int], most: int) -> Iterator[slice]:
    """Consecutive slices of rows whose sizes sum to most at the most; a larger row stands alone."""
    begin = total = 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > most:
            yield slice(begin, i)
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public-domain splitmix step), in place where it can."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    kept = _powers.get(base)
    if kept is None or len(kept) < n:
        kept = np.full(max(n, 1 << 20), np.uint64(base), np.uint64)
        kept[0] = 1
        kept = np.multiply.accumulate(kept)
        if n <= 1 << 22:
            _powers[base] = kept
    return kept[:n]


#: Which bytes words consist of: all beyond the blank, or ASCII letters and digits and what is not ASCII.
VISIBLE = np.arange(256) > 32
LETTERS = np.array([b > 127 or chr(b).isalnum() for b in range(256)])


def word_hashes(texts: Sequence[str], of: np.ndarray = VISIBLE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of all texts, one after the other, and the number of words of each text.

    Words are runs of bytes that `of` holds; a word's hash is a polynomial over its bytes, taken from prefix sums.
    """
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    stops = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
    b = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    inside = of[b]
    before = np.concatenate([[False], inside[:-1]])
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(before & ~inside)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTES[b] * _power(_BASE, len(b)), out=sums[1:])
    w = (sums[ends] - sums[starts]) * _power(_INVERSE, len(b))[starts]
    w += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mixed(w), np.bincount(np.searchsorted(stops, starts, side="right"), minlength=len(raw))


def shingle_sets(texts: Sequence[str], size: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text, the distinct hashes of its runs of `size` lower-cased words, ascending, and their counts.

    A text with fewer words is one shingle; without words there is none.
    """
    if not len(texts):
        return []
    w, counts = word_hashes(texts)

    def run(x: np.ndarray, k: int) -> np.ndarray:
        n = max(0, len(x) - k + 1)
        h = np.full(n, np.uint64(k), np.uint64)
        for i in range(k):
            h = h * np.uint64(_BASE) + x[i : i + n]
        return mixed(h)

    whole, out, at = run(w, size), [], 0
    for n in counts.tolist():
        own = whole[at : at + n - size + 1] if n >= size else run(w[at : at + n], n) if n else np.empty(0, np.uint64)
        out.append(np.unique(own, return_counts=True))
        at += n
    return out


def shingles(text: str, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    return shingle_sets([text], size)[0]


def all_shingles(texts: Sequence[str], size: int = 5) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """shingle_sets of any number of texts, in pieces that bound the memory."""
    for s in pieces_of([len(t) for t in texts], 300_000):
        yield from shingle_sets(texts[s], size)


def ranked(df: DataFrame, group: list[str], order: list[Column], name: str, salts: int = 64) -> DataFrame:
    """row_number() - 1 of each row in its group, without a group ever in one task.

    Rows are numbered in salted sub-groups, and the sizes of the sub-groups are summed up before them. The order within
    a group is by sub-group first: any fixed order serves.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    sizes = salted.groupBy(*group, "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy(*group, "_salt").orderBy(*order)
    numbered = salted.withColumn("_k", F.row_number().over(within) - 1)
    return numbered.join(firsts, [*group, "_salt"]).withColumn(name, F.col("_before") + F.col("_k")).drop("_salt", "_before", "_k")
