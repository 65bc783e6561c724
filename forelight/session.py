"""Sessions as the engine expects them."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(name: str = "forelight", cores: int | str | None = None, **settings: str) -> SparkSession:
    """A local session with the clock at UTC and adaptive plans; on a cluster the master's settings win."""
    cores = cores or os.cpu_count() or 4
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    return SparkSession.builder.appName(name).master(f"local[{cores}]").config(map=base | settings).getOrCreate()
