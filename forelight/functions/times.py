"""Time expressions. Instants are UTC timestamps without zone; local time knows daylight saving."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "America/Denver"


def local_time(ts: Column | str, zone: str = ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts if isinstance(ts, Column) else F.col(ts))


def local_date(ts: Column | str, zone: str = ZONE) -> Column:
    return F.to_date(local_time(ts, zone))


def local_hour(ts: Column | str, zone: str = ZONE) -> Column:
    return F.hour(local_time(ts, zone))


def next_day_label(ts: Column | str, zone: str = ZONE) -> Column:
    """Observations of one day verify the next day's label."""
    return F.date_add(local_date(ts, zone), 1)


def parse_init(text: Column | str) -> Column:
    """yyyyMMddHH, or yyyyMMdd_HHmmZ, to a timestamp; null for other strings."""
    t = text if isinstance(text, Column) else F.col(text)
    digits = F.regexp_replace(t, r"^([0-9]{8})_?([0-9]{2})(?:00Z)?$", "$1$2")
    return F.when(digits.rlike(r"^[0-9]{10}$"), F.try_to_timestamp(digits, F.lit("yyyyMMddHH")).cast("timestamp_ntz"))


def format_init(ts: Column | str, case: bool = False) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmm'Z'" if case else "yyyyMMddHH")


def valid_init(text: Column | str) -> Column:
    """Ten digits, and an hour of the six-hourly cycle."""
    t = text if isinstance(text, Column) else F.col(text)
    return t.rlike(r"^[0-9]{10}$") & F.substring(t, 9, 2).isin("00", "06", "12", "18") & parse_init(t).isNotNull()


def lead_hours(init: Column, ts: Column) -> Column:
    return F.timestamp_diff("HOUR", init, ts).cast("int")


def lead_day(init: Column, day: Column, zone: str = ZONE) -> Column:
    """Days from the local day of the forecast's start."""
    return F.date_diff(day, local_date(init, zone))


def floor_hours(ts: Column, hours: int) -> Column:
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)
    return F.timestamp_add("SECOND", (F.floor(seconds / (hours * 3600)) * hours * 3600).cast("int"), F.lit("1970-01-01").cast("timestamp_ntz"))


def latest_init(now: Column, delay_hours: int = 8) -> Column:
    """Start of the newest six-hourly run that is out by now."""
    return floor_hours(F.timestamp_add("HOUR", F.lit(-delay_hours), now), 6)


def previous_init(now: Column, steps: int = 1) -> Column:
    """Start of a six-hourly run before the one that a time is in; times without a zone are UTC."""
    return F.timestamp_add("HOUR", F.lit(-6 * steps), floor_hours(now, 6))


def anchor_init(submitted: Column) -> Column:
    """The run that a submission at this time is meant for: four and a half hours back, down to six hours."""
    return floor_hours(F.timestamp_add("MINUTE", F.lit(-270), submitted), 6)


def observation_hour(now: Column) -> Column:
    """The newest full hour whose observations are in, twenty minutes after it."""
    hour = F.date_trunc("hour", now).cast("timestamp_ntz")
    return F.when(F.minute(now) > 20, hour).otherwise(F.timestamp_add("HOUR", F.lit(-1), hour))


def solar_noon(day: Column, lon: float) -> Column:
    """UTC minutes of solar noon, by the equation of time."""
    b = (F.dayofyear(day) - 81) * (2 * 3.141592653589793 / 364)
    equation = 9.87 * F.sin(2 * b) - 7.53 * F.cos(b) - 1.5 * F.sin(b)
    return 720 - 4 * F.lit(lon) - equation


def quantised(ts: Column, minutes: int = 5) -> Column:
    """Down to whole steps of some minutes."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", (F.floor(F.timestamp_diff("SECOND", epoch, ts) / (minutes * 60)) * minutes * 60).cast("int"), epoch)


def title(variable: Column, init: Column, lead: Column) -> Column:
    """A chart's heading."""
    return F.format_string("%s, run of %s, lead %03d h", F.initcap(variable), F.date_format(init, "yyyy-MM-dd HH'Z'"), lead)


def week_marks(day: Column) -> Column:
    """Monday or Friday, between which charts shade; null on other days."""
    return F.when(F.dayofweek(day) == 2, "Monday").when(F.dayofweek(day) == 6, "Friday")
