"""Quantiles as plain expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def linear(x: Column | str, q: float | list[float]) -> Column:
    """Linear interpolation between order statistics, missing values skipped."""
    return F.percentile(x, q)


def hazen_of(values: Column, q: float) -> Column:
    """Hazen quantile (plotting positions (i - 0.5) / n) of an array; null if it is empty."""
    v = F.sort_array(values)
    n = F.size(v)
    h = F.least(F.greatest(n * F.lit(q) - 0.5, F.lit(0.0)), (n - 1).cast("double"))
    lo = F.floor(h).cast("int")
    low, high = F.get(v, lo), F.get(v, F.least(lo + 1, n - 1))
    return F.when(n > 0, low + (h - lo) * (high - low))


def hazen(x: Column | str, q: float, poison: bool = False) -> Column:
    """Hazen quantile of a group.

    A group's values are held together, so this is for groups of a bounded
    size (stations, members); :func:`hazen_by_ranks` takes others. With ``poison`` a missing value
    makes the result missing, as NumPy's quantile does; else it is skipped.
    """
    x = F.col(x) if isinstance(x, str) else x
    out = hazen_of(F.collect_list(x), q)
    return F.when(F.count("*") == F.count(x), out) if poison else out


#: Parts of each power of two in which order statistics are looked for.
PARTS = 512


def _part(x: Column, parts: int) -> Column:
    """A whole number that never falls where x rises: parts of equal ratio, wide apart for large values, and one for zero alone."""
    ratio = F.floor((F.log2(F.abs(x)) + 1_100) * parts).cast("long") + 1
    return F.when(x == 0, F.lit(0)).when(x > 0, ratio).otherwise(-ratio).cast("long")


def selected(df: DataFrame, keys: list[str], wanted: dict[str, tuple[str, float]], parts: int = PARTS, hazen: bool = True) -> DataFrame:
    """(keys, name, value, n): the Hazen (or linear) quantile of each named (column, quantile) of each group, and how many values it has; null without any.

    Groups may be of any size, and several columns and quantiles take one scan.
    Equal values are counted where they are read, so a value that most rows share is one row with a
    count. Counts by parts tell which parts hold the two order statistics, and
    only the distinct values of these are ordered. Missing values are skipped. Exact, whatever the parts.
    """
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    # Zeros have one sign here, or they would be two values.
    value = lambda c: F.col(c).cast("double") + F.lit(0.0)
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("_c"), F.when(~F.isnan(value(c)), value(c)).alias("_x")) for c in columns))).alias("_e")
    counts = df.select(*keys, each).groupBy(*keys, F.col("_e._c").alias("_c"), F.col("_e._x").alias("_x")).agg(F.count("*").alias("_m"))
    counts = counts.withColumn("_p", _part(F.col("_x"), parts))

    of = [*keys, "_c"]
    by_part = counts.groupBy(*of, "_p").agg(F.sum("_m").alias("_m"))
    sizes = by_part.groupBy(*of).agg(F.sum(F.when(F.col("_p").isNotNull(), F.col("_m")).otherwise(0)).alias("n"))
    quantiles = F.explode(F.array(*(F.struct(F.lit(name).alias("name"), F.lit(c).alias("c"), F.lit(float(q)).alias("q")) for name, (c, q) in wanted.items()))).alias("_w")
    asked = sizes.select("*", quantiles).where("_c = _w.c").select(*of, "n", "_w.name", "_w.q")
    place = F.col("n") * F.col("q") - 0.5 if hazen else (F.col("n") - 1) * F.col("q")
    h = F.least(F.greatest(place, F.lit(0.0)), (F.col("n") - 1).cast("double"))
    asked = asked.withColumn("_h", h).withColumn("_lo", F.floor("_h")).withColumn("_hi", F.least(F.col("_lo") + 1, F.col("n") - 1))

    before = lambda order: F.sum("_m").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_m")
    starts = by_part.where("_p is not null").withColumn("_b", before(Window.partitionBy(*of).orderBy("_p")))
    holds = lambda rank, low: (low <= rank) & (rank < low + F.col("_m"))
    # Quantiles are few; each finds the one or two parts that hold its order statistics.
    wanted_parts = starts.join(asked.select(*(F.col(c).alias(f"_{c}_") for c in of), "_lo", "_hi"), [F.col(c).eqNullSafe(F.col(f"_{c}_")) for c in of]).where(holds(F.col("_lo"), F.col("_b")) | holds(F.col("_hi"), F.col("_b"))).select(*of, "_p", "_b").distinct()
    match = [F.col(c).eqNullSafe(F.col(f"_{c}_")) for c in [*of, "_p"]]
    inside = counts.where("_x is not null").join(wanted_parts.select(*(F.col(c).alias(f"_{c}_") for c in [*of, "_p"]), "_b"), match).select(*of, "_p", "_b", "_x", "_m")
    ranked = inside.withColumn("_r", F.col("_b") + before(Window.partitionBy(*of, "_p").orderBy("_x")))
    ends = asked.join(ranked.select(*(F.col(c).alias(f"_{c}_") for c in of), "_r", "_x", "_m"), [F.col(c).eqNullSafe(F.col(f"_{c}_")) for c in of], "left")
    at = lambda rank: F.max(F.when(holds(F.col(rank), F.col("_r")), F.col("_x")))
    out = ends.groupBy(*of, "name", "n", "_h", "_lo").agg(at("_lo").alias("_a"), at("_hi").alias("_z"))
    return out.select(*keys, "name", (F.col("_a") + (F.col("_h") - F.col("_lo")) * (F.col("_z") - F.col("_a"))).alias("value"), "n")


def hazen_by_ranks(df: DataFrame, keys: list[str], value: str, q: float, name: str = "value", parts: int = PARTS) -> DataFrame:
    """keys, the Hazen quantile of each group, and ``n``, its values: for groups of any size (see :func:`selected`)."""
    return selected(df, keys, {name: (value, q)}, parts).select(*keys, F.col("value").alias(name), "n")


def wide(found: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """What :func:`selected` gives, with a column for each name."""
    return found.groupBy(*keys).agg(*(F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names))
