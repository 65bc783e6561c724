"""Nearest-in-time joins.

Each key's time is cut into stretches, so that no key with a long series is one
task; in a stretch, window functions give a target the sample before it and the
one after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_EPOCH = "1970-01-01"
#: Tolerances in a stretch of a join within one.
STRETCH = 4


def _seconds(ts: Column) -> Column:
    return F.timestamp_diff("SECOND", F.lit(_EPOCH).cast("timestamp_ntz"), ts)


def nearest(targets: DataFrame, samples: DataFrame, keys: list[str], ts: str, value: str, width: int = 86_400) -> DataFrame:
    """targets with the value of the nearest sample (of equals the later), missing values included.

    Series are cut into buckets of ``width`` seconds, so a key with a long one is
    not one task; each bucket knows the last sample before it and the first one
    after it from a table with a row per bucket.
    """
    t = targets.select(*keys, F.col(ts), F.lit(1).alias("_is_target"), F.lit(None).cast("timestamp_ntz").alias("_at"), F.lit(None).cast(samples.schema[value].dataType).alias("_v"))
    s = samples.select(*keys, F.col(ts), F.lit(0).alias("_is_target"), F.col(ts).alias("_at"), F.col(value).alias("_v"))
    both = t.unionByName(s).withColumn("_k", F.floor(_seconds(F.col(ts)) / width))
    # A struct is never null, so a sample whose value is missing still is the nearest one.
    mark = F.when(F.col("_is_target") == 0, F.struct("_at", "_v"))
    ends = both.groupBy(*keys, "_k").agg(F.max(mark).alias("_last"), F.min(mark).alias("_first"))
    series = Window.partitionBy(*keys).orderBy("_k")
    earlier = F.last("_last", ignorenulls=True).over(series.rowsBetween(Window.unboundedPreceding, -1))
    later = F.first("_first", ignorenulls=True).over(series.rowsBetween(1, Window.unboundedFollowing))
    ends = ends.select(*keys, "_k", earlier.alias("_earlier"), later.alias("_later"))
    bucket = Window.partitionBy(*keys, "_k")
    before = bucket.orderBy(ts, "_is_target").rowsBetween(Window.unboundedPreceding, 0)
    after = bucket.orderBy(F.desc(ts), "_is_target").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("_b", F.last(mark, ignorenulls=True).over(before)).withColumn("_a", F.last(mark, ignorenulls=True).over(after)).where("_is_target = 1")
    both = both.join(ends, [*keys, "_k"]).withColumn("_b", F.coalesce("_b", "_earlier")).withColumn("_a", F.coalesce("_a", "_later"))
    gap_b, gap_a = _seconds(F.col(ts)) - _seconds(F.col("_b._at")), _seconds(F.col("_a._at")) - _seconds(F.col(ts))
    nearer = F.col("_b").isNull() | (F.col("_a").isNotNull() & (gap_a <= gap_b))
    found = F.when(nearer, F.col("_a")).otherwise(F.col("_b"))
    return both.select(*keys, ts, found["_v"].alias(value), found["_at"].alias("sample_time"))


def nearest_within(targets: DataFrame, samples: DataFrame, keys: list[str], ts: str, value: str, tolerance: int, require_value: bool = True) -> DataFrame:
    """targets with the nearest sample at most ``tolerance`` seconds away (of equals the earlier); null if there is none.

    With ``require_value`` samples without one are passed over. Each row is dealt
    once, to its stretch of time; of the stretch before a target's the last sample
    is in reach at most, of the one after it the first, so these come along.
    Targets and samples of a stretch meet by order, so many samples make no pairs.
    """
    width = STRETCH * max(int(tolerance), 1)
    s = samples.select(*keys, F.col(ts).alias("_at"), F.col(value).alias("_v")).na.drop("any", subset=[*keys, "_at"])
    if require_value:
        s = s.where("_v is not null")
    s = s.withColumn("_s", _seconds(F.col("_at"))).withColumn("_k", F.floor(F.col("_s") / width))
    # Samples of one second are equally near, so the earliest of them counts on both sides.
    sample = F.struct("_at", "_v")
    ends = s.groupBy(*keys, "_k").agg(F.min(sample).alias("_first"), F.max("_s").alias("_end"), F.min_by(sample, F.struct(-F.col("_s"), F.col("_at"), F.col("_v"))).alias("_last"))
    borders = ends.select(*keys, F.explode(F.array(F.struct((F.col("_k") - 1).alias("_k"), F.col("_first").alias("_x")), F.struct((F.col("_k") + 1).alias("_k"), F.col("_last").alias("_x")))).alias("_b"))
    borders = borders.select(*keys, "_b._k", "_b._x._at", "_b._x._v")
    rest = [c for c in targets.columns if c not in keys]
    t = targets.select(*keys, F.floor(_seconds(F.col(ts)) / width).alias("_k"), F.struct(*rest).alias("_t"))
    both = s.drop("_s").unionByName(borders).unionByName(t, allowMissingColumns=True)
    # Seconds are told again where the rows meet, so that they don't travel.
    both = both.repartition(*keys, "_k").withColumn("_s", _seconds(F.coalesce("_at", F.col("_t")[ts])))
    mark = F.when(F.col("_at").isNotNull(), sample)
    stretch, is_target = Window.partitionBy(*keys, "_k"), F.col("_at").isNull()
    # Within a second the earliest sample is the last one before the targets, from either side.
    within = (is_target, F.desc("_at"), F.desc("_v"))
    rows = stretch.rowsBetween(Window.unboundedPreceding, 0)
    before, after = (F.last(mark, ignorenulls=True).over(rows.orderBy(side, *within)) for side in (F.asc("_s"), F.desc("_s")))
    both = both.withColumn("_before", before).withColumn("_after", after).where(is_target)
    gap = lambda x: F.abs(_seconds(F.col(f"{x}._at")) - F.col("_s"))
    both = both.withColumn("_a", gap("_after")).withColumn("_b", gap("_before"))
    later = F.col("_b").isNull() | (F.col("_a") < F.col("_b"))
    both = both.withColumn("_gap", F.when(later, F.col("_a")).otherwise(F.col("_b"))).withColumn("_found", F.when(F.col("_gap") <= tolerance, F.when(later, F.col("_after")).otherwise(F.col("_before"))))
    own = [F.col("_t")[c].alias(c) if c in rest else F.col(c) for c in targets.columns]
    return both.select(*own, F.col("_found._v").alias(value), F.when(F.col("_found").isNotNull(), F.col("_gap")).cast("long").alias("gap_seconds"))


def nearest_or_fail(targets: DataFrame, samples: DataFrame, keys: list[str], ts: str, value: str, tolerance: int) -> DataFrame:
    """Like :func:`nearest_within`, but a target without a sample ends the query."""
    out = nearest_within(targets, samples, keys, ts, value, tolerance, require_value=False)
    found = F.col("gap_seconds").isNotNull()
    return out.withColumn(value, F.when(found, F.col(value)).otherwise(F.raise_error(F.lit("no sample within the tolerance")).cast(samples.schema[value].dataType)))
