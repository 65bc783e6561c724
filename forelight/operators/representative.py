"""Representative daily observations from many stations, and the persistence of late solar radiation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forelight.functions.quantile import hazen
from forelight.functions.times import ZONE, local_date, local_hour, next_day_label

#: Ozone outside of this range is an instrument's error.
OZONE_RANGE = (5.0, 140.0)


def two_stage(obs: DataFrame, first: Column, second: Column, day: Column) -> DataFrame:
    """One value per station and day by ``first`` over ``value``, then one per day by ``second`` over these."""
    per_station = obs.groupBy("stid", day.alias("date")).agg(first.alias("value"))
    return per_station.groupBy("date").agg(second.alias("value"))


def mslp(obs: DataFrame) -> DataFrame:
    return two_stage(obs, F.percentile("value", 0.5), F.percentile("value", 0.5), next_day_label("ts"))


def wind(obs: DataFrame) -> DataFrame:
    return two_stage(obs, hazen("value", 0.8, poison=True), hazen("value", 0.75, poison=True), next_day_label("ts"))


def snow(obs: DataFrame) -> DataFrame:
    return two_stage(obs, hazen("value", 0.9, poison=True), hazen("value", 0.9, poison=True), next_day_label("ts"))


def ozone(obs: DataFrame) -> DataFrame:
    low, high = OZONE_RANGE
    kept = obs.withColumn("value", F.when(F.col("value").between(low, high), F.col("value")))
    return two_stage(kept, F.max("value"), F.percentile("value", 0.99), next_day_label("ts"))


def solar(obs: DataFrame, noon_minutes: Column, half_width: int = 120) -> DataFrame:
    """Means around solar noon, then four-row trailing means per station, then the Hazen 0.8 quantile.

    ``noon_minutes``: UTC minutes of solar noon. Days are not moved to the next
    one here. A station's first three rows are missing, and poison their days.
    """
    minute = F.hour("ts") * 60 + F.minute("ts")
    near = obs.where(F.abs(minute - noon_minutes) <= half_width)
    days = near.groupBy("stid", local_date("ts").alias("date")).agg(F.avg("value").alias("value"))
    return trailing_mean(days).groupBy("date").agg(hazen("value", 0.8, poison=True).alias("value"))


def trailing_mean(days: DataFrame, rows: int = 4) -> DataFrame:
    """Mean of the last rows of each station, by row and not by day; missing until there are enough."""
    w = Window.partitionBy("stid").orderBy("date").rowsBetween(1 - rows, 0)
    return days.withColumn("value", F.when(F.count("value").over(w) == rows, F.avg("value").over(w)))


REDUCERS = {"mslp": mslp, "wind": wind, "snow": snow, "ozone": ozone}


def representative(obs: DataFrame, variable: str) -> DataFrame:
    return REDUCERS[variable](obs.where(F.col("variable") == variable))


def solar_persistence(series: DataFrame, keys: list[str], init: Column, last: int = 384, anchor: int = 240, step: int = 3, zone: str = ZONE) -> DataFrame:
    """A value for every ``step`` hours from ``anchor`` + step to ``last``, by the local hour's median up to the anchor.

    An hour that has no median takes that of the cyclically nearest one (of
    equals the smaller), then the overall median, then 0. ``series``: keys,
    valid_time, value.
    """
    early = series.where(F.timestamp_diff("HOUR", init, F.col("valid_time")).between(0, anchor) & (F.col("value") >= 0))
    hours = early.groupBy(*keys, local_hour("valid_time", zone).alias("_h")).agg(F.percentile("value", 0.5).alias("_m"))
    overall = early.groupBy(*keys).agg(F.percentile("value", 0.5).alias("_all"))
    # 24 target hours against at most 24 known ones per key.
    wanted = series.select(*keys).distinct().withColumn("_w", F.explode(F.sequence(F.lit(0), F.lit(23))))
    gap = F.abs(F.col("_w") - F.col("_h"))
    table = wanted.join(hours, keys).groupBy(*keys, "_w").agg(F.min_by("_m", F.struct(F.least(gap, 24 - gap), F.col("_h"))).alias("_m"))
    late = series.select(*keys).distinct().withColumn("fxx", F.explode(F.sequence(F.lit(anchor + step), F.lit(last), F.lit(step))))
    late = late.withColumn("valid_time", F.timestamp_add("HOUR", F.col("fxx"), init)).withColumn("_w", local_hour("valid_time", zone))
    out = late.join(table, [*keys, "_w"], "left").join(overall, keys, "left")
    return out.select(*keys, "fxx", "valid_time", F.coalesce("_m", "_all", F.lit(0.0)).alias("value"))
