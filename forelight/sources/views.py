"""The driver's tables seen as forecast, observation and grid tables; the SQL twins are in ``plans.sql``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station observations: stid, variable, ts, value."""
    e = read(spark, sf_dir, "events")
    return e.select(F.concat(F.lit("S"), (F.col("user_id") % 9).cast("string")).alias("stid"), F.col("event_type").alias("variable"), "ts", "value", "event_id")


def forcing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One forecast sample per event: member, valid_time and the four inputs."""
    e = read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        (F.col("user_id") % 31).cast("int").alias("member"),
        F.col("ts").alias("valid_time"),
        "event_id",
        F.least(F.lit(250.0), F.col("value") * 3).alias("snow"),
        (1000 + 0.5 * k).alias("mslp"),
        ((F.col("event_id") % 17) * 0.3).alias("wind"),
        (((F.col("event_id") * 37) % 161) * 5).cast("double").alias("solar"),
    )


def binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast series: member, three-hourly valid_time and the mean of snow; gaps stay gaps."""
    from forelight.functions.times import floor_hours

    f = forcing(spark, sf_dir)
    return f.groupBy("member", floor_hours(F.col("valid_time"), 3).alias("valid_time")).agg(F.avg("snow").alias("value"), F.avg("solar").alias("solar"))


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gridded values: time, lat, lon, value."""
    line = read(spark, sf_dir, "lineitem")
    return line.select(
        F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("time"),
        (39 + (F.col("l_suppkey") % 25) * 0.1).alias("lat"),
        (248 + (F.col("l_partkey") % 40) * 0.1).alias("lon"),
        F.col("l_extendedprice").alias("value"),
        "l_partkey",
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static geography: l_partkey stands for a cell, with its elevation."""
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), (F.col("p_size") * 60.0).alias("elev_m"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine stations with elevations in metres, each at the height of its first supplier."""
    s = read(spark, sf_dir, "supplier")
    return s.groupBy(F.concat(F.lit("S"), ((F.col("s_suppkey") - 1) % 9).cast("string")).alias("stid")).agg((1200 + 20.0 * F.min("s_suppkey")).alias("elev_m"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature vectors, one per member, in ensembles (init) of 31."""
    e = read(spark, sf_dir, "embeddings")
    return e.select((F.col("vec_id") / 31).cast("int").alias("init"), F.col("vec_id").alias("member"), F.col("embedding").cast("array<double>").alias("x"), "label")


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-hourly weather of each member, by runs (init) of fifteen days; values have odd last places, so that none is half a step."""
    from forelight.functions.times import floor_hours

    f = forcing(spark, sf_dir)
    init = F.floor(F.date_diff(F.to_date("valid_time"), F.lit("2023-12-31").cast("date")) / 15).cast("int")
    odd = {"snow": 1.0371, "mslp": 1.00013, "wind": 1.0171, "solar": 1.0117}
    return f.groupBy(init.alias("init"), "member", floor_hours(F.col("valid_time"), 3).alias("valid_time")).agg(*(F.max(F.col(v) * k).alias(v) for v, k in odd.items()))
