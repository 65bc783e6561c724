"""Ensemble products: probabilities, percentiles, envelopes, spread."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forelight.functions.quantile import selected, wide

THRESHOLDS = (30, 50, 60, 75)


def exceedance(df: DataFrame, keys: list[str], value: str, thresholds: tuple[int, ...] = THRESHOLDS) -> DataFrame:
    """Share of members above each threshold, of those that have a value; null if none has."""
    above = [F.avg(F.when(F.col(value).isNotNull(), (F.col(value) > t).cast("double"))).alias(f"p_{t}ppb") for t in thresholds]
    return df.groupBy(*keys).agg(*above)


def exceedance_days(probabilities: DataFrame, limits: tuple[float, ...] = (0.2, 0.5), thresholds: tuple[int, ...] = THRESHOLDS) -> DataFrame:
    """Per threshold: days on which its probability is above each limit."""
    long = probabilities.select(F.explode(F.array(*(F.struct(F.lit(t).alias("threshold"), F.col(f"p_{t}ppb").alias("p")) for t in thresholds))).alias("x")).select("x.*")
    return long.groupBy("threshold").agg(*(F.count_if(F.col("p") > c).alias(f"days_above_{round(100 * c)}") for c in limits))


def percentiles(df: DataFrame, keys: list[str], value: str, levels: tuple[int, ...] = (10, 50, 90)) -> DataFrame:
    """Linear percentiles across members, and mean and number of those with a value."""
    q = df.groupBy(*keys).agg(F.percentile(value, [p / 100 for p in levels]).alias("_q"), F.avg(value).alias("mean"), F.count(value).alias("n"))
    return q.select(*keys, *(F.get("_q", F.lit(i)).alias(f"p{p}") for i, p in enumerate(levels)), "mean", "n")


def percentiles_of_many(df: DataFrame, keys: list[str], value: str, levels: tuple[int, ...] = (10, 50, 90)) -> DataFrame:
    """Like :func:`percentiles`, for groups that grow with the data: no task holds all of a group's values."""
    names = {f"p{p}": (value, p / 100) for p in levels}
    q = wide(selected(df, keys, names, hazen=False), keys, list(names))
    rest = df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))
    return rest.join(q, keys).select(*keys, *names, "mean", "n")


def boxes(df: DataFrame, keys: list[str], value: str, levels: tuple[float, ...] = (0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """What a box plot shows of each key: quantiles of the members that have a value, and how many; with other levels, a fan."""
    q = df.groupBy(*keys).agg(F.percentile(value, list(levels)).alias("_q"), F.count(value).alias("n"))
    return q.select(*keys, "n", *(F.get("_q", F.lit(i)).alias(f"q{round(100 * x)}") for i, x in enumerate(levels)))


def union_envelope(df: DataFrame, keys: list[str], low: str = "p10", mid: str = "p50", high: str = "p90") -> DataFrame:
    """The widest band of all members, and the middle of their middles."""
    return df.groupBy(*keys).agg(F.min(low).alias("low"), F.percentile(mid, 0.5).alias("mid"), F.max(high).alias("high"))


def common_times(df: DataFrame, members: str, ts: str, value: str) -> DataFrame:
    """Mean and median over the times at which every member has a value."""
    n = df.select(members).distinct().count()  # a number, for the filter
    return df.where(F.col(value).isNotNull()).groupBy(ts).agg(F.count_distinct(members).alias("n"), F.avg(value).alias("mean"), F.percentile(value, 0.5).alias("median")).where(F.col("n") == n)


def aligned(df: DataFrame, members: list[str], day: str, values: list[str]) -> DataFrame:
    """A row for every member and every day that any member has."""
    return df.select(*members).distinct().crossJoin(df.select(day).distinct()).join(df.select(*members, day, *values), [*members, day], "left")


def high_risk_fraction(df: DataFrame, keys: list[str], limit: float) -> DataFrame:
    """Share of members whose elevated and extreme possibilities together are above a limit; 0 without members."""
    high = F.col("elevated") + F.col("extreme")
    return df.groupBy(*keys).agg(F.coalesce(F.avg(F.when(high.isNotNull(), (high > limit).cast("double"))), F.lit(0.0)).alias("fraction"))


def member_peaks(df: DataFrame, member: str, value: str, low: float, high: float, bins: int = 10) -> DataFrame:
    """Histogram of the members' largest values, in equal bins of a range that includes its end."""
    peak = df.groupBy(member).agg(F.max(value).alias("peak")).where("peak is not null")
    bin_ = F.least(F.width_bucket("peak", F.lit(float(low)), F.lit(float(high)), F.lit(bins)), F.lit(bins)).cast("int")
    return peak.groupBy(bin_.alias("bin")).agg(F.count("*").alias("members"), F.max("peak").alias("highest"))


def most_variable(df: DataFrame, group: str, value: str) -> DataFrame:
    """The group whose values spread most (population deviation; groups without values count as -1), of equals the least."""
    spread = df.groupBy(group).agg(F.coalesce(F.stddev_pop(value), F.lit(-1.0)).alias("spread"))
    return spread.orderBy(F.desc("spread"), group).limit(1)


def weighted_mean(value: str, weight: str):
    both = F.col(value).isNotNull() & F.col(weight).isNotNull()
    return F.try_divide(F.sum(F.when(both, F.col(value) * F.col(weight))), F.sum(F.when(both, F.col(weight))))
