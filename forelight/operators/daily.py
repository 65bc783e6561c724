"""Local-day aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forelight.functions.times import ZONE, local_date


def local_daily_max(df: DataFrame, keys: list[str], values: list[str], ts: str = "valid_time", zone: str = ZONE) -> DataFrame:
    """Largest value of each column per key and local day; days without samples are absent."""
    return df.groupBy(*keys, local_date(ts, zone).alias("local_date")).agg(*(F.max(v).alias(v) for v in values))


def with_spine(daily: DataFrame, keys: list[str], day: str = "local_date") -> DataFrame:
    """Every day between a key's first and last one, with nulls on those that have none."""
    span = daily.groupBy(*keys).agg(F.explode(F.sequence(F.min(day), F.max(day))).alias(day))
    return span.join(daily, [*keys, day], "left")


def chunk_medians(rows: DataFrame, keys: list[str], place: str, value: str, chunk: int = 24, q: float = 0.5) -> DataFrame:
    """Medians of consecutive chunks of rows that know their places, from 0 on; missing values are skipped."""
    day = F.floor(F.col(place) / chunk).cast("int")
    return rows.select(*keys, day.alias("day"), F.col(value).alias("_x")).groupBy(*keys, "day").agg(F.percentile("_x", q).alias("value"))


def daily_by_chunks(rows: DataFrame, keys: list[str], order: list[str], value: str, chunk: int = 24, q: float = 0.5) -> DataFrame:
    """Medians of consecutive chunks of each key's rows, by position: what passes for days where series have no times."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return chunk_medians(rows.select(*keys, place.alias("_place"), value), keys, "_place", value, chunk, q)


def daily_by_places(rows: DataFrame, keys: list[str], array: str, chunk: int = 24, q: float = 0.5) -> DataFrame:
    """:func:`daily_by_chunks` of series that are arrays, as documents have them: the places in the array are the order."""
    return chunk_medians(rows.select(*keys, F.posexplode(array).alias("_place", "_value")), keys, "_place", "_value", chunk, q)
