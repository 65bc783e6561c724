"""Sinks: partitioned tables, documents, ledgers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def root(spark: SparkSession) -> str:
    """The folder that all executors share, as spark.checkpoint.dir names it; where that is unset, a temporary one on a single machine (tests) and an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='forelight-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def folder(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{root(spark)}/forelight/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame, label: str = "kept") -> DataFrame:
    """df written and read again: for short tables that many later steps read, whose plans would else hold it as often."""
    path = folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """Parquet by partition columns; partitions written before are replaced, others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def new_only(df: DataFrame, path: str, keys: list[str]) -> None:
    """Only rows whose keys the table lacks are added."""
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        df = df.join(spark.read.parquet(path).select(*keys).distinct(), keys, "left_anti")
    df.write.mode("append").parquet(path)


def documents(df: DataFrame, path: str, column: str = "json") -> None:
    """One JSON document per line."""
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def csv(df: DataFrame, path: str) -> None:
    """CSV with a header; times to the microsecond, as Spark's own default cuts them."""
    df.write.mode("overwrite").option("header", "true").options(timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)


def ledger(df: DataFrame, path: str, key: str | None = None) -> int | None:
    """Rows appended to a ledger that others may append to at the same time, in today's columns (see ``sources.commits``)."""
    from forelight.operators.ledger import upgraded
    from forelight.sources import commits

    return commits.append(upgraded(df), path, key)


def with_statistics(df: DataFrame, path: str, by: str, value: str, among: list) -> DataFrame:
    """Like :func:`partitioned` by one column; returns what the write itself has seen, without another pass.

    (by, n_rows, n_known, low, median, p90, status) for each partition named in
    ``among``, some tens, and one with a null for all others together; quantiles are
    values of the sketch's ranks. A partition without any value is written all the
    same and says so.
    """
    from pyspark.sql import Observation

    seen = Observation()
    metrics = []
    for i, m in enumerate([*among, None]):
        mine = F.col(by) == F.lit(m) if m is not None else ~F.coalesce(F.col(by).isin(among), F.lit(False))
        own = F.when(mine, F.col(value))
        metrics += [F.count_if(mine).alias(f"n_rows_{i}"), F.count(own).alias(f"n_known_{i}"), F.min(own).alias(f"low_{i}"), F.percentile_approx(own, [0.5, 0.9], 10_000).alias(f"q_{i}")]
    partitioned(df.observe(seen, *metrics), path, [by])
    got = seen.get
    rows = []
    for i, m in enumerate([*among, None]):
        if got[f"n_rows_{i}"]:
            q = got[f"q_{i}"] or [None, None]
            rows.append((m, got[f"n_rows_{i}"], got[f"n_known_{i}"], got[f"low_{i}"], *q, "written" if got[f"n_known_{i}"] else "all_missing"))
    kinds = df.schema[by].dataType.simpleString(), df.schema[value].dataType.simpleString()
    return df.sparkSession.createDataFrame(rows, f"`{by}` {kinds[0]}, n_rows long, n_known long, low {kinds[1]}, median {kinds[1]}, p90 {kinds[1]}, status string")


def observations(df: DataFrame, path: str, values: list[str]) -> None:
    """Rows with at least one value, as 32-bit numbers."""
    df.na.drop("all", subset=values).withColumns({v: F.col(v).cast("float") for v in values}).write.mode("overwrite").parquet(path)
