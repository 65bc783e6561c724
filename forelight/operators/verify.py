"""Verification of forecasts, and profiles of observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forelight.functions.times import local_date


def scores(pairs: DataFrame, lead: str, forecast: str, observed: str) -> DataFrame:
    """Number, mean bias, mean absolute and root mean square error by lead and, with a null lead, over all.

    Both grains come from one shuffle, by grouping sets.
    """
    both = pairs.where(F.col(forecast).isNotNull() & F.col(observed).isNotNull()).withColumn("_b", F.col(forecast) - F.col(observed))
    sets = both.groupingSets([[F.col(lead)], []], F.col(lead))
    return sets.agg(F.count("*").alias("n"), F.avg("_b").alias("bias"), F.avg(F.abs("_b")).alias("mae"), F.sqrt(F.avg(F.col("_b") * F.col("_b"))).alias("rmse"))


def without_outliers(df: DataFrame, bin_: Column, value: str, deviations: float = 2.0) -> DataFrame:
    """Rows strictly within some sample deviations of their bin's mean; a bin of one row has no deviation and vanishes."""
    w = Window.partitionBy("_bin")
    binned = df.withColumn("_bin", bin_)
    mean, sd = F.avg(value).over(w), F.stddev_samp(value).over(w)
    near = binned.withColumn("_m", mean).withColumn("_s", sd)
    return near.where((F.col(value) > F.col("_m") - deviations * F.col("_s")) & (F.col(value) < F.col("_m") + deviations * F.col("_s"))).drop("_bin", "_m", "_s")


def elevation_bin(elev: Column, low: float, width: float) -> Column:
    """(min, max] bins."""
    return F.ceil((elev - low) / width).cast("int")


def max_profile(obs: DataFrame, stations: DataFrame, ts: str = "ts") -> DataFrame:
    """Largest value per station and local day, with the station's elevation."""
    days = obs.groupBy("stid", local_date(ts).alias("date")).agg(F.max("value").alias("value"))
    return days.join(stations, "stid").where("value is not null and elev_m is not null")


def lapse_rate(profile: DataFrame, keys: list[str]) -> DataFrame:
    """Slope of a value over elevation, per kilometre, and the intercept; null for fewer than two elevations."""
    return profile.groupBy(*keys).agg((F.regr_slope("value", "elev_m") * 1000).alias("slope_per_km"), F.regr_intercept("value", "elev_m").alias("intercept"), F.count("*").alias("n"))


def stations_by_year(obs: DataFrame, ts: str = "ts") -> DataFrame:
    """Distinct stations of each year, and their list."""
    return obs.groupBy(F.year(ts).alias("year"), "variable").agg(F.count_distinct("stid").alias("n"), F.array_join(F.array_sort(F.collect_set("stid")), ",").alias("stids"))


def common_stations(obs: DataFrame, group: str) -> DataFrame:
    """Stations that occur in every group."""
    n = obs.select(group).distinct().count()
    return obs.groupBy("stid").agg(F.count_distinct(group).alias("n")).where(F.col("n") == n).select("stid")
