"""Scalar expressions: missing values, units, rounding, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimal places per product variable; fixed values.
PLACES = {"snow": 0, "wind": 1, "temp": 1, "mslp": 1, "solar": 0, "ozone": 1, "possibility": 2, "probability": 2}
#: Local names of forecast variables; fixed values.
SYNONYMS = {
    "snow": ["snow", "sde", "snow_depth"],
    "mslp": ["mslp", "prmsl", "sea_level_pressure"],
    "wind": ["wind", "si10", "wind_speed"],
    "solar": ["solar", "sdswrf", "solar_radiation"],
    "temp": ["temp", "t2m", "air_temp"],
    "ozone": ["ozone", "ozone_concentration"],
}


def nan_to_null(x: Column) -> Column:
    """Aggregates skip nulls but not NaN, so NaN becomes null where data enter."""
    return F.when(~F.isnan(x), x)


def safe_div(a: Column, b: Column) -> Column:
    """a / b, null where b is zero."""
    return F.try_divide(a, b)


def finite(*columns: str) -> Column:
    """All of the columns have a value."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull() & ~F.isnan(c)
    return out


def round_value(x: Column, variable: str) -> Column:
    """Product rounding; without decimal places a whole number. What is half a step to nine places is rounded up."""
    places = PLACES.get(variable, 2)
    x = F.round(x, 9)
    return F.round(x, places) if places else F.round(x).cast("long")


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def shift_longitude(lon: Column) -> Column:
    """0 to 360 degrees to -180 to 180."""
    return F.pmod(lon + 180, F.lit(360)) - 180


def feet_to_metres(x: Column) -> Column:
    """By the factor that station metadata have always been converted with."""
    return x * 0.304


def metres_to_mm(x: Column) -> Column:
    return x * 1000


def kelvin_to_celsius(x: Column) -> Column:
    return x - 273.15


def pascal_to_hectopascal(x: Column) -> Column:
    return x / 100


def mm_to_inches(x: Column) -> Column:
    return x / 25.4


def to_mph(x: Column) -> Column:
    return x * 2.23694


def celsius_to_fahrenheit(x: Column) -> Column:
    return x * 9 / 5 + 32


def offset_floor(x: Column, offset: float) -> Column:
    """Less an instrument's offset, and not below zero."""
    return F.greatest(x - offset, F.lit(0.0))


def member_name(member: Column) -> Column:
    """Three digits: c00 -> 000, p07 -> 007; null if there is no number."""
    digits = F.regexp_extract(member, r"([0-9]+)", 1)
    return F.when(digits != "", F.lpad(digits, 3, "0"))


def variable_of(name: Column) -> Column:
    """The variable that a synonym stands for, null for unknown names."""
    out = None
    for variable, names in SYNONYMS.items():
        out = F.when(F.lower(name).isin(*names), variable) if out is None else out.when(F.lower(name).isin(*names), variable)
    return out


def tick_step(span: Column, candidates: tuple[float, ...] = (1, 2, 5, 10, 20, 50, 100, 200, 500, 1000)) -> Column:
    """The spacing that gives closest to five ticks, the first of equals."""
    choices = F.array(*(F.struct(F.abs(F.floor(span / c) - 5).alias("off"), F.lit(i).alias("i"), F.lit(float(c)).alias("step")) for i, c in enumerate(candidates)))
    return F.array_min(choices)["step"]


def axis_limits(low: Column, high: Column, step: float) -> tuple[Column, Column]:
    return F.floor(low / step) * step, F.ceil(high / step) * step


def size_text(n: Column) -> Column:
    """Bytes as people write them."""
    return (
        F.when(n < 1024, F.concat(n.cast("string"), F.lit(" B")))
        .when(n < 1024**2, F.concat(F.format_number(n / 1024, 1), F.lit(" KB")))
        .when(n < 1024**3, F.concat(F.format_number(n / 1024**2, 1), F.lit(" MB")))
        .otherwise(F.concat(F.format_number(n / 1024**3, 1), F.lit(" GB")))
    )


def duration_text(seconds: Column) -> Column:
    s = seconds.cast("long")
    return F.when(s < 60, F.format_string("%ds", s)).when(s < 3600, F.format_string("%dm %02ds", (s / 60).cast("long"), s % 60)).otherwise(F.format_string("%dh %02dm", (s / 3600).cast("long"), (s % 3600 / 60).cast("long")))


def retryable(exit_code: Column) -> Column:
    """Exit codes that mean: input not there yet."""
    return exit_code.between(75, 79)


def retryable_error(message: Column) -> Column:
    return F.lower(message).rlike(r"keyerror: ?'?(href|range)|timed? ?out|connection")
