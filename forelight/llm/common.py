"""Helpers shared by the text operators: scratch tables, Arrow batches, words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forelight.sources import sinks

#: Bytes of text that a Python worker expands into 8-byte hashes at a time.
BLOCK_BYTES = 1 << 20

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PARTITIONS = "spark.sql.shuffle.partitions"
_READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"


class Scratch:
    """Tables written to the shared folder, so that lineage ends there and a lost executor costs nothing.

    ``keep(df, name)`` writes and rereads; shuffle files of that write are
    released as soon as it ends. ``drop(df_name)`` removes a table that no
    later plan reads. Tables that the returned DataFrame still reads stay in
    the shared folder, whose owner clears it as for other checkpoints.
    ``read_rows``: as many rows at most that a task holds of a file it reads,
    where the session's own number of them is too much for rows with long texts.
    """

    def __init__(self, spark: SparkSession, label: str, read_rows: int | None = None):
        self.spark = spark
        self.read_rows = read_rows
        self.base = sinks.folder(spark, label)
        self.kept: set[str] = set()

    def keep(self, df: DataFrame, name: str, parts: int | None = None) -> DataFrame:
        """``parts``: as many shuffle partitions at most, for tables known to be short."""
        path, conf = f"{self.base}/{name}", self.spark.conf
        self.kept.add(name)
        now = {_CLEANUP: "true"}
        for k, most in ((_PARTITIONS, parts), (_READ_ROWS, self.read_rows)):
            if most and most < int(conf.get(k)):
                now[k] = str(most)
        # What the session leaves unset is None here, and is unset again.
        before = {k: conf.get(k, None) for k in now}
        for k, v in now.items():
            conf.set(k, v)
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            for k, v in before.items():
                conf.unset(k) if v is None else conf.set(k, v)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_others(self, *names: str) -> None:
        """Drops every table but those named."""
        self.drop(*(self.kept - set(names)))

    def drop(self, *names: str) -> None:
        self.kept -= set(names)
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
            path.getFileSystem(conf).delete(path, True)


#: Bytes of text that Spark hands to a Python worker at a time.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of this session have at most BATCH_BYTES.

    Operators return plans that run later, so the setting stays; it lowers what
    a worker and its executor hold, and no result depends on it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; null stays null."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def blocks(array: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string array, each of at most ``limit`` bytes or of one row."""
    if not len(array):
        return
    sizes = np.asarray(pc.binary_length(array).fill_null(0), dtype=np.int64)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += int(n)
    yield start, len(sizes)


def flat(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows end to end, and where each begins (one more at the end); nulls are empty."""
    data = pc.fill_null(array.cast(pa.large_string()), "").cast(pa.large_binary())
    data = pa.concat_arrays([data])
    ends = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    body = data.buffers()[2]
    raw = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]] if len(ends) else raw, ends - (ends[0] if len(ends) else 0)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (two multiply-xorshift rounds); uint64 in and out."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value found once, also where lambdas inside of ``use`` read it for each of their elements."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def row_key(*columns: str) -> Column:
    """A 64-bit key of a row; joins on it also compare the id, so that equal keys of different rows don't meet."""
    return F.xxhash64(*columns)


def grams(hashes: Column, n: int) -> Column:
    """Hashes of all runs of n neighbours of an array of hashes; none if it is shorter."""
    return F.when(
        F.size(hashes) >= n,
        F.transform(F.sequence(F.lit(0), F.size(hashes) - n), lambda i: F.xxhash64(*(hashes[i + k] for k in range(n)))),
    ).otherwise(F.array().cast("array<bigint>"))


def least_hashes(df: DataFrame, columns: list[str], limit: int) -> DataFrame:
    """At most ``limit`` distinct rows of df, those with the least hashes of some columns.

    A cut that lets some three times as many rows through comes first, so that
    what tasks send to be ordered doesn't grow with their number. Repeated rows
    count once.
    """
    n = max(1, df.count())
    share = min(1.0, 3 * limit / n)
    h = F.xxhash64(*columns)
    cut = df if share == 1.0 else df.where(h < int(-(1 << 63) + share * (1 << 64)))
    return cut.distinct().orderBy(h, *df.columns).limit(limit)
