"""Queries of the forecast side: inference, daily values, ensemble products, grids, joins in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forelight.functions import fuzzy, quantile, scalars, times
from forelight.operators import asof, daily, ensemble, ledger, products, representative, spatial
from forelight.plans import sql
from forelight.plans.base import rounded, r, registry
from forelight.sources import views

QUERIES, ORACLES, query = registry()
SYSTEM = fuzzy.System()
CATEGORIES = products.CATEGORIES
VALUES = ["ozone_10pc", "ozone_50pc", "ozone_90pc", *CATEGORIES]


def inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SYSTEM.infer(views.forcing(spark, sf_dir))


def daily_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.local_daily_max(inference(spark, sf_dir), ["member"], VALUES)


@query(f"WITH {sql.FORCING}, {sql.TERMS} SELECT event_id, {r('negligible', 'sufficient', 'calm', 'breezy', 'p_low', 'p_mid', 'p_high', 's_low', 's_mid', 's_high')} FROM terms")
def fuzzy_membership(spark, sf_dir):
    names = {"negligible": "snow", "sufficient": "snow", "calm": "wind", "breezy": "wind", "p_low": "mslp", "p_mid": "mslp", "p_high": "mslp", "s_low": "solar", "s_mid": "solar", "s_high": "solar"}
    terms = {"p_low": "low", "p_mid": "moderate", "p_high": "high", "s_low": "low", "s_mid": "moderate", "s_high": "high"}
    return rounded(views.forcing(spark, sf_dir).select("event_id", *(SYSTEM.membership(v, terms.get(n, n)).alias(n) for n, v in names.items())))


@query(f"WITH {sql.FORCING}, {sql.TERMS}, {sql.POSSIBLE} SELECT event_id, member, {r(*CATEGORIES)} FROM possible")
def fuzzy_rules(spark, sf_dir):
    return rounded(SYSTEM.possibilities(views.forcing(spark, sf_dir)).select("event_id", "member", *CATEGORIES))


@query(f"""WITH {sql.FORCING}, {sql.TERMS}, {sql.POSSIBLE} SELECT event_id, round(background, 6) + 0.0 AS background, round(greatest(extreme, {sql.rise('wind', 3, 4.5)}, {sql.rise('snow', 60, 90)}), 6) + 0.0 AS extreme, round(0.1 + 0.7 * {sql.trapezoid('mslp', 1000, 1010, 1020, 1040)}, 6) + 0.0 AS dome FROM possible""")
def extended_rules(spark, sf_dir):
    """The frozen system with another term and another rule, and a trapezoid that neither begins at 0 nor ends at 1."""
    more = SYSTEM.with_term("wind", "gale", (fuzzy.rise, 3, 4.5)).with_rule(fuzzy.Rule("extreme", (("wind", "gale"), ("snow", "sufficient")), any_of=True))
    p = more.possibilities(views.forcing(spark, sf_dir))
    return rounded(p.select("event_id", "background", "extreme", fuzzy.trapezoid(F.col("mslp"), 1000, 1010, 1020, 1040, top=0.8, bottom=0.1).alias("dome")))


@query(f"WITH {sql.INFERENCE} SELECT event_id, ozone_10pc, ozone_50pc, ozone_90pc FROM inference")
def fuzzy_percentiles(spark, sf_dir):
    return inference(spark, sf_dir).select("event_id", "ozone_10pc", "ozone_50pc", "ozone_90pc")


@query(f"""WITH {sql.FORCING}, {sql.TERMS}, {sql.POSSIBLE}, m AS (SELECT *, greatest({', '.join(CATEGORIES)}) AS most FROM possible)
SELECT event_id, {', '.join(f'CASE WHEN most > 0 THEN round({c} / most, 6) + 0.0 END AS {c}' for c in CATEGORIES)} FROM m""")
def possibility_normalised(spark, sf_dir):
    return rounded(fuzzy.normalised(SYSTEM.possibilities(views.forcing(spark, sf_dir))).select("event_id", *CATEGORIES))


@query(f"""WITH {sql.FORCING}, far AS (SELECT event_id, snow * 1.5 - 30 AS snow, mslp * 1.2 - 150 AS mslp, wind * 4 - 1 AS wind, CASE WHEN event_id % 10 = 0 THEN NULL ELSE solar * 1.2 END AS solar FROM forcing)
SELECT event_id, {', '.join(f"CASE WHEN {v} IS NULL THEN NULL ELSE round(least(greatest({v}, {a}), {b}), 6) + 0.0 END AS {v}, ({v} IS NULL OR {v} < {a} OR {v} > {b}) AS {v}_clipped" for v, a, b in (('snow', 0, 250), ('mslp', 950, 1070), ('wind', 0, 15), ('solar', 0, 800)))} FROM far""")
def universe_guard_clip(spark, sf_dir):
    f = views.forcing(spark, sf_dir)
    far = f.select("event_id", (F.col("snow") * 1.5 - 30).alias("snow"), (F.col("mslp") * 1.2 - 150).alias("mslp"), (F.col("wind") * 4 - 1).alias("wind"), F.when(F.col("event_id") % 10 != 0, F.col("solar") * 1.2).alias("solar"))
    return rounded(SYSTEM.guarded(far))


@query(f"""WITH {sql.FORCING}, {sql.TERMS}, {sql.POSSIBLE} SELECT member,
{', '.join(f'round(quantile_cont({v}, {q}), 6) + 0.0 AS {v}_p{round(q * 100)}' for v in ('snow', 'mslp', 'wind', 'solar') for q in (0.1, 0.5, 0.9))},
{', '.join(f'round(avg({c}), 6) + 0.0 AS {c}_mean, round(avg(CAST({c} > 0 AS INTEGER)), 6) + 0.0 AS {c}_active' for c in CATEGORIES)} FROM possible GROUP BY member""")
def fis_diagnostics(spark, sf_dir):
    p = SYSTEM.possibilities(views.forcing(spark, sf_dir))
    names = {f"{v}_p{round(q * 100)}": (v, q) for v in ("snow", "mslp", "wind", "solar") for q in (0.1, 0.5, 0.9)}
    quantiles = quantile.wide(quantile.selected(p, ["member"], names, hazen=False), ["member"], list(names))
    shares = [x for c in CATEGORIES for x in (F.avg(c).alias(f"{c}_mean"), F.avg((F.col(c) > 0).cast("double")).alias(f"{c}_active"))]
    return rounded(quantiles.join(p.groupBy("member").agg(*shares), "member"))


@query(f"WITH {sql.DAILY} SELECT member, local_date, {r(*VALUES)} FROM daily", days=("local_date",))
def local_daily_max(spark, sf_dir):
    return rounded(daily_values(spark, sf_dir))


@query(f"""WITH {sql.FORCING}, d AS (SELECT member, {sql.local_date()} AS local_date, max(CASE WHEN (member + day(valid_time)) % 5 <> 0 THEN snow END) AS snow FROM forcing GROUP BY ALL HAVING max(CASE WHEN (member + day(valid_time)) % 5 <> 0 THEN snow END) IS NOT NULL),
s AS (SELECT member, CAST(unnest(generate_series(min(local_date), max(local_date), INTERVAL 1 DAY)) AS DATE) AS local_date FROM d GROUP BY member)
SELECT member, local_date, round(snow, 6) + 0.0 AS snow FROM s LEFT JOIN d USING (member, local_date)""", days=("local_date",))
def local_daily_max_spine(spark, sf_dir):
    # Every fifth day of a member has no value and so no row, until the spine gives it one.
    gap = (F.col("member") + F.dayofmonth("valid_time")) % 5 == 0
    f = views.forcing(spark, sf_dir).withColumn("snow", F.when(~gap, F.col("snow")))
    return rounded(daily.with_spine(daily.local_daily_max(f, ["member"], ["snow"]).where("snow is not null"), ["member"]))


_P = ", ".join(f"avg(CASE WHEN ozone_50pc IS NULL THEN NULL WHEN ozone_50pc > {t} THEN 1.0::DOUBLE ELSE 0 END) AS p_{t}ppb" for t in ensemble.THRESHOLDS)
_NAMES = [f"p_{t}ppb" for t in ensemble.THRESHOLDS]


@query(f"WITH {sql.DAILY}, e AS (SELECT local_date, {_P} FROM daily GROUP BY local_date) SELECT local_date, {r(*_NAMES)} FROM e", days=("local_date",))
def exceedance_probability(spark, sf_dir):
    return rounded(ensemble.exceedance(daily_values(spark, sf_dir), ["local_date"], "ozone_50pc"))


@query(f"""WITH {sql.DAILY}, e AS (SELECT local_date, {_P} FROM daily GROUP BY local_date), u AS (UNPIVOT e ON {', '.join(_NAMES)} INTO NAME n VALUE p)
SELECT CAST(regexp_extract(n, '[0-9]+') AS INTEGER) AS threshold, count(*) FILTER (p > 0.2) AS days_above_20, count(*) FILTER (p > 0.5) AS days_above_50 FROM u GROUP BY n""")
def exceedance_day_counts(spark, sf_dir):
    return ensemble.exceedance_days(ensemble.exceedance(daily_values(spark, sf_dir), ["local_date"], "ozone_50pc"))


@query(f"""WITH {sql.DAILY} SELECT local_date, {', '.join(f'round(quantile_cont(ozone_50pc, {p / 100}), 6) + 0.0 AS p{p}' for p in (10, 50, 90))}, round(avg(ozone_50pc), 6) + 0.0 AS mean, count(ozone_50pc) AS n FROM daily GROUP BY local_date""", days=("local_date",))
def ensemble_percentiles(spark, sf_dir):
    return rounded(ensemble.percentiles(daily_values(spark, sf_dir), ["local_date"], "ozone_50pc"))


@query(f"WITH {sql.DAILY} SELECT local_date, min(ozone_10pc) AS low, round(median(ozone_50pc), 6) + 0.0 AS mid, max(ozone_90pc) AS high FROM daily GROUP BY local_date", days=("local_date",))
def union_envelope(spark, sf_dir):
    return rounded(ensemble.union_envelope(daily_values(spark, sf_dir), ["local_date"], "ozone_10pc", "ozone_50pc", "ozone_90pc"))


@query(f"""WITH {sql.FORCING}, d AS (SELECT member % 5 AS member, {sql.local_date()} AS day, max(snow) AS snow FROM forcing GROUP BY ALL)
SELECT day, count(DISTINCT member) AS n, round(avg(snow), 6) + 0.0 AS mean, round(median(snow), 6) + 0.0 AS median FROM d GROUP BY day HAVING count(DISTINCT member) = (SELECT count(DISTINCT member) FROM d)""", days=("day",))
def ensemble_common_mean(spark, sf_dir):
    f = views.forcing(spark, sf_dir).withColumn("member", F.col("member") % 5)
    d = daily.local_daily_max(f, ["member"], ["snow"]).withColumnRenamed("local_date", "day")
    return rounded(ensemble.common_times(d, "member", "day", "snow"))


@query(f"""WITH {sql.DAILY}, m AS (SELECT DISTINCT member FROM daily), t AS (SELECT DISTINCT local_date FROM daily)
SELECT member, local_date, ozone_50pc FROM (SELECT * FROM m, t) x LEFT JOIN daily USING (member, local_date)""", days=("local_date",))
def ensemble_alignment(spark, sf_dir):
    return ensemble.aligned(daily_values(spark, sf_dir), ["member"], "local_date", ["ozone_50pc"])


@query(f"WITH {sql.DAILY} SELECT member, round(coalesce(avg(CASE WHEN elevated + extreme IS NULL THEN NULL WHEN elevated + extreme > 0.5 THEN 1.0::DOUBLE ELSE 0 END), 0), 6) + 0.0 AS fraction FROM daily GROUP BY member")
def high_risk_fraction(spark, sf_dir):
    return rounded(ensemble.high_risk_fraction(daily_values(spark, sf_dir), ["member"], 0.5))


@query(f"""WITH {sql.DAILY}, p AS (SELECT member, max(ozone_90pc) AS peak FROM daily GROUP BY member HAVING max(ozone_90pc) IS NOT NULL)
SELECT CAST(least(floor((peak - 20) / 12.0) + 1, 10) AS INTEGER) AS bin, count(*) AS members, max(peak) AS highest FROM p GROUP BY 1""")
def member_peak_hist(spark, sf_dir):
    return ensemble.member_peaks(daily_values(spark, sf_dir), "member", "ozone_90pc", 20, 140)


@query(f"WITH {sql.FORCING}, s AS (SELECT member, coalesce(stddev_pop(snow), -1) AS spread FROM forcing GROUP BY member) SELECT member, round(spread, 6) + 0.0 AS spread FROM s ORDER BY spread DESC, member LIMIT 1")
def most_variable_init(spark, sf_dir):
    return rounded(ensemble.most_variable(views.forcing(spark, sf_dir), "member", "snow"))


@query("SELECT l_returnflag, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) + 0.0 AS mean FROM lineitem GROUP BY l_returnflag")
def weighted_mean(spark, sf_dir):
    return rounded(views.read(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(ensemble.weighted_mean("l_extendedprice", "l_quantity").alias("mean")), 4)


# Grids


@query(f"WITH {sql.GRID}, {sql.CELLS} SELECT time, round({sql.hazen('value', 0.75)}, 4) + 0.0 AS value, count(value) AS n_cells FROM grid JOIN cells USING (l_partkey) WHERE elev_m < 2100 GROUP BY time")
def masked_spatial_quantile(spark, sf_dir):
    grid = spatial.masked(views.grid(spark, sf_dir), views.cells(spark, sf_dir), ["l_partkey"])
    return rounded(spatial.spatial_quantile(grid, ["time"], "value", 0.75), 4)


_FIELDS = f"""fields AS (SELECT l_suppkey % 40 AS place, l_shipdate < TIMESTAMP '1995-06-01' AS early, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS solar, CASE WHEN l_discount < 0.06::DOUBLE THEN 0 ELSE l_quantity END AS snow, round(l_tax * 50) - 2 AS wind, 250 + l_partkey % 1000 / 16.0::DOUBLE AS temp FROM lineitem)"""


@query(f"WITH {_FIELDS} SELECT place, early, {', '.join(f'round({sql.hazen(v, q)}, 4) + 0.0 AS {v}, count({v}) AS n_{v}' for v, q in spatial.REPRESENTATIVE.items())} FROM fields GROUP BY ALL")
def representative_quantiles(spark, sf_dir):
    line = views.read(spark, sf_dir, "lineitem")
    fields = line.select(
        (F.col("l_suppkey") % 40).alias("place"),
        (F.col("l_shipdate") < F.lit("1995-06-01").cast("timestamp_ntz")).alias("early"),
        F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice")).alias("solar"),
        F.when(F.col("l_discount") < 0.06, 0.0).otherwise(F.col("l_quantity")).alias("snow"),
        (F.round(F.col("l_tax") * 50) - 2).alias("wind"),
        (250 + F.col("l_partkey") % 1000 / 16.0).alias("temp"),
    )
    return rounded(spatial.representative(fields, ["place", "early"]), 4)


@query(f"WITH {sql.GRID}, s AS (SELECT *, CASE WHEN lon > 180 THEN lon - 360 ELSE lon END AS l2 FROM grid) SELECT time, count(*) AS n, round(min(lat), 6) AS south, round(max(lat), 6) AS north, round(min(l2), 6) AS west, round(max(l2), 6) AS east FROM s WHERE lat BETWEEN 39.4 AND 41.1 AND l2 BETWEEN -110.9 AND -108.5 GROUP BY time")
def bbox_crop(spark, sf_dir):
    # Halves of a cell away from the box's edges, so that rounding in the last place decides nothing.
    g = spatial.crop(views.grid(spark, sf_dir), (39.4, 41.1, -110.9, -108.5))
    return g.groupBy("time").agg(F.count("*").alias("n"), F.round(F.min("lat"), 6).alias("south"), F.round(F.max("lat"), 6).alias("north"), F.round(F.min("lon"), 6).alias("west"), F.round(F.max("lon"), 6).alias("east"))


@query(f"""WITH {sql.GRID}, p(point, q_lat, q_lon) AS (VALUES (1, 40.07, 250.13), (2, 39.0, 248.0), (3, 50.0, 300.0)),
a AS (SELECT point, arg_min(lat, abs(lat - q_lat)) AS lat FROM p, (SELECT DISTINCT lat FROM grid) GROUP BY point), o AS (SELECT point, arg_min(lon, abs(lon - q_lon)) AS lon FROM p, (SELECT DISTINCT lon FROM grid) GROUP BY point)
SELECT point, round(lat, 6) AS lat, round(lon, 6) AS lon, count(*) AS n, round(avg(value), 4) + 0.0 AS value FROM grid JOIN a USING (lat) JOIN o USING (point, lon) GROUP BY ALL""")
def nearest_cell(spark, sf_dir):
    points = spark.createDataFrame([(1, 40.07, 250.13), (2, 39.0, 248.0), (3, 50.0, 300.0)], "point int, q_lat double, q_lon double")
    g = spatial.nearest_cell(views.grid(spark, sf_dir), points)
    return g.groupBy("point", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon")).agg(F.count("*").alias("n"), (F.round(F.avg("value"), 4) + 0.0).alias("value"))


_IJ = "g AS (SELECT l_suppkey % 10 AS i, l_partkey % 12 AS j, avg(l_extendedprice) AS x FROM lineitem GROUP BY ALL)"


@query(f"WITH {_IJ}, m AS (SELECT a.i, a.j, a.x, avg(b.x) AS mean FROM g a LEFT JOIN g b ON abs(a.i - b.i) <= 1 AND abs(a.j - b.j) <= 1 AND NOT (a.i = b.i AND a.j = b.j) GROUP BY ALL) SELECT i, j, round(CASE WHEN mean IS NULL THEN x ELSE (2 * x + mean) / 3 END, 4) + 0.0 AS smoothed FROM m")
def neighbour_smoothing(spark, sf_dir):
    g = views.read(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 10).alias("i"), (F.col("l_partkey") % 12).alias("j")).agg(F.avg("l_extendedprice").alias("x"))
    return rounded(spatial.smooth(g, [], "i", "j", "x").select("i", "j", "smoothed"), 4)


@query(f"WITH {sql.GRID}, n AS (SELECT time, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE value / 100 END AS v FROM grid) SELECT time, round(min(v), 6) + 0.0 AS low, round(max(v), 6) + 0.0 AS high, count(*) FILTER (v IS NULL) AS n_missing FROM n GROUP BY time")
def pressure_field_stats(spark, sf_dir):
    g = views.grid(spark, sf_dir).withColumn("v", F.when(F.col("l_partkey") % 7 != 0, scalars.pascal_to_hectopascal(F.col("value"))))
    return rounded(spatial.field_stats(g, ["time"], "v"))


# Joins in time

_TARGETS = "targets AS (SELECT user_id % 31 AS member, ts AS valid_time FROM events GROUP BY ALL)"
_SPARSE = f"{sql.BINNED}, sparse AS (SELECT member, valid_time, CASE WHEN extract('hour' FROM valid_time) IN (6, 9) THEN NULL ELSE value END AS value FROM binned WHERE extract('hour' FROM valid_time) <> 0)"


def _asof(spark, sf_dir):
    e = views.read(spark, sf_dir, "events")
    targets = e.select((F.col("user_id") % 31).cast("int").alias("member"), F.col("ts").alias("valid_time")).distinct()
    hour = F.hour("valid_time")
    sparse = views.binned(spark, sf_dir).where(hour != 0).select("member", "valid_time", F.when(~hour.isin(6, 9), F.col("value")).alias("value"))
    return targets, sparse


@query(f"""WITH {_TARGETS}, {_SPARSE}, c AS (SELECT t.member, t.valid_time, s.value, s.valid_time AS s_at, row_number() OVER (PARTITION BY t.member, t.valid_time ORDER BY abs(epoch_us(t.valid_time) - epoch_us(s.valid_time)), s.valid_time DESC) AS rn FROM targets t JOIN sparse s USING (member))
SELECT CAST(t.member AS INTEGER) AS member, valid_time, round(value, 6) + 0.0 AS value, s_at AS sample_time FROM targets t LEFT JOIN (SELECT * FROM c WHERE rn = 1) USING (member, valid_time)""")
def asof_nearest(spark, sf_dir):
    return rounded(asof.nearest(*_asof(spark, sf_dir), ["member"], "valid_time", "value"))


def _within(extra: str) -> str:
    gap = "abs(date_diff('second', s.valid_time, t.valid_time))"
    return f"""WITH {_TARGETS}, {_SPARSE}, whole AS (SELECT member, date_trunc('second', valid_time) AS valid_time FROM targets GROUP BY ALL),
c AS (SELECT t.member, t.valid_time, s.value, {gap} AS gap, row_number() OVER (PARTITION BY t.member, t.valid_time ORDER BY {gap}, s.valid_time) AS rn FROM whole t JOIN sparse s USING (member) WHERE {gap} <= 5400 {extra})
SELECT CAST(w.member AS INTEGER) AS member, valid_time, round(value, 6) + 0.0 AS value, gap AS gap_seconds FROM whole w LEFT JOIN (SELECT * FROM c WHERE rn = 1) USING (member, valid_time)"""


def _whole(targets: DataFrame) -> DataFrame:
    return targets.select("member", F.date_trunc("second", "valid_time").cast("timestamp_ntz").alias("valid_time")).distinct()


@query(_within(""))
def asof_nearest_tolerance(spark, sf_dir):
    targets, sparse = _asof(spark, sf_dir)
    return rounded(asof.nearest_within(_whole(targets), sparse, ["member"], "valid_time", "value", 5400, require_value=False))


@query(_within("AND s.value IS NOT NULL"))
def asof_nonnull(spark, sf_dir):
    targets, sparse = _asof(spark, sf_dir)
    return rounded(asof.nearest_within(_whole(targets), sparse, ["member"], "valid_time", "value", 5400))


_INIT = "TIMESTAMP '2024-01-01'"


# Every target is seven minutes after a sample, so none is without one.
@query("""WITH s AS (SELECT user_id % 31 AS member, ts, value FROM events), t AS (SELECT DISTINCT member, ts + INTERVAL 7 MINUTE AS ts FROM s),
p AS (SELECT t.member, t.ts, s.value, abs(epoch(date_trunc('second', s.ts)) - epoch(date_trunc('second', t.ts))) AS gap, s.ts AS seen FROM t JOIN s ON s.member = t.member AND s.ts BETWEEN t.ts - INTERVAL 20 MINUTE AND t.ts + INTERVAL 20 MINUTE)
SELECT member, ts, arg_min(value, {'g': gap, 'a': seen}) AS value, CAST(min(gap) AS BIGINT) AS gap_seconds FROM p WHERE gap <= 900 GROUP BY ALL""")
def asof_required(spark, sf_dir):
    s = views.read(spark, sf_dir, "events").select((F.col("user_id") % 31).alias("member"), "ts", "value")
    targets = s.select("member", (F.col("ts") + F.make_dt_interval(mins=F.lit(7))).alias("ts")).distinct()
    return asof.nearest_or_fail(targets, s, ["member"], "ts", "value", 900).select("member", "ts", "value", "gap_seconds")


@query(f"""WITH {sql.FORCING}, e AS (SELECT member, {sql.local_hour()} AS h, solar FROM forcing WHERE date_diff('hour', {_INIT}, valid_time) BETWEEN 0 AND 240 AND {sql.local_hour()} % 3 <> 1),
h AS (SELECT member, h, median(solar) AS m FROM e GROUP BY ALL), w AS (SELECT DISTINCT member, w FROM forcing, range(24) r(w)),
t AS (SELECT member, w, m FROM (SELECT w.member, w.w, h.m, row_number() OVER (PARTITION BY w.member, w.w ORDER BY least(abs(w.w - h.h), 24 - abs(w.w - h.h)), h.h) AS rn FROM w JOIN h USING (member)) WHERE rn = 1),
l AS (SELECT DISTINCT member, CAST(f AS INTEGER) AS fxx, {_INIT} + to_hours(CAST(f AS INTEGER)) AS valid_time FROM forcing, range(243, 385, 3) r(f))
SELECT l.member, fxx, valid_time, round(coalesce(m, 0), 6) + 0.0 AS value FROM l LEFT JOIN t ON t.member = l.member AND t.w = {sql.local_hour()}""")
def solar_persistence(spark, sf_dir):
    s = views.forcing(spark, sf_dir).select("member", "valid_time", F.col("solar").alias("value"))
    init = F.lit("2024-01-01").cast("timestamp_ntz")
    # Every third local hour is left without samples, so that neighbours step in; the series keeps its members.
    gaps = s.withColumn("value", F.when(times.local_hour("valid_time") % 3 != 1, F.col("value")))
    return rounded(representative.solar_persistence(gaps, ["member"], init))


@query(f"WITH {sql.BINNED}, d AS (SELECT member, date_diff('second', lag(valid_time) OVER (PARTITION BY member ORDER BY valid_time), valid_time) AS s FROM binned) SELECT CAST(member AS INTEGER) AS member, round(median(s), 3) + 0.0 AS step_seconds FROM d WHERE s > 0 GROUP BY 1")
def median_timestep(spark, sf_dir):
    return rounded(ledger.median_step(views.binned(spark, sf_dir), ["member"], "valid_time"), 3)


@query(f"WITH {sql.BINNED} SELECT CAST(member AS INTEGER) AS member, valid_time, CASE WHEN row_number() OVER (PARTITION BY member ORDER BY valid_time) = 1 THEN NULL ELSE round(value, 6) + 0.0 END AS value FROM binned")
def first_row_excluded(spark, sf_dir):
    return rounded(ledger.without_first(views.binned(spark, sf_dir).select("member", "valid_time", "value"), ["member"], "valid_time", ["value"]))


@query(f"WITH {sql.FORCING} SELECT member, CAST(date_diff('hour', {_INIT}, date_trunc('hour', valid_time)) AS INTEGER) AS fxx, count(*) AS n FROM forcing GROUP BY ALL")
def lead_hours(spark, sf_dir):
    f = views.forcing(spark, sf_dir)
    return f.groupBy("member", times.lead_hours(F.lit("2024-01-01").cast("timestamp_ntz"), F.col("valid_time")).alias("fxx")).agg(F.count("*").alias("n"))


# Documents


@query(f"""WITH {sql.DAILY}, g AS (SELECT member, local_date, {', '.join(f'CASE WHEN member % 4 = 0 AND day(local_date) = 5 THEN NULL ELSE {c} END AS {c}' for c in CATEGORIES)} FROM daily), u AS (FROM g UNPIVOT INCLUDE NULLS (v FOR variable IN ({', '.join(CATEGORIES)})))
SELECT member, variable, CAST(local_date AS VARCHAR) AS date, {sql.places("v", 2)} + 0.0 AS value FROM u""")
def product_json_roundtrip(spark, sf_dir):
    d = daily_values(spark, sf_dir)
    gap = (F.col("member") % 4 == 0) & (F.dayofmonth("local_date") == 5)
    d = d.select("member", "local_date", *(F.when(~gap, F.col(c)).alias(c) for c in CATEGORIES))
    documents = products.product(d, ["member"], "local_date", dict.fromkeys(CATEGORIES, "possibility"), "possibility_heatmap")
    return rounded(products.from_json(products.as_json(documents, ["member"]), ["member"]))


@query(f"""WITH {sql.DAILY}, d AS (SELECT member, local_date, CASE WHEN (member + day(local_date)) % 6 = 0 THEN NULL ELSE background END AS b FROM daily)
SELECT member, coalesce(string_agg(CAST(local_date AS VARCHAR), ',' ORDER BY local_date) FILTER (b IS NULL), '') AS missing, count(*) FILTER (b IS NULL) AS num_missing, count(*) AS n_days FROM d GROUP BY member""")
def missing_dates(spark, sf_dir):
    d = daily_values(spark, sf_dir)
    gap = (F.col("member") + F.dayofmonth("local_date")) % 6 == 0
    d = d.select("member", "local_date", *(F.when(~gap, F.col(c)).alias(c) for c in CATEGORIES))
    m = products.missing_dates(d, ["member"], "local_date", list(CATEGORIES))
    return m.select("member", F.array_join("missing_dates", ",").alias("missing"), "num_missing", "n_days")


@query(f"""WITH {sql.FORCING}, o AS (SELECT member, floor((row_number() OVER (PARTITION BY member ORDER BY valid_time, event_id) - 1) / 24) AS day, snow FROM forcing)
SELECT member, CAST(day AS INTEGER) AS day, round(median(snow), 6) + 0.0 AS value FROM o GROUP BY ALL""")
def chunk_medians(spark, sf_dir):
    f = views.forcing(spark, sf_dir)
    return rounded(daily.daily_by_chunks(f, ["member"], ["valid_time", "event_id"], "snow"))


@query(f"""WITH {sql.FORCING}, {sql.TERMS}, {sql.POSSIBLE}, {sql.PERCENTILES} SELECT event_id, first_10, first_90 FROM possible
LEFT JOIN (SELECT event_id, arg_min(x, i) AS first_10 FROM shares WHERE round(f, 9) >= 0.1::DOUBLE GROUP BY 1) USING (event_id) LEFT JOIN (SELECT event_id, arg_min(x, i) AS first_90 FROM shares WHERE round(f, 9) >= 0.9::DOUBLE GROUP BY 1) USING (event_id)""")
def fuzzy_first_points(spark, sf_dir):
    p = SYSTEM.possibilities(views.forcing(spark, sf_dir))
    return SYSTEM.first_points(p, {"first_10": 0.1, "first_90": 0.9}).select("event_id", "first_10", "first_90")


@query(f"""WITH {sql.DAILY}, e AS (SELECT member % 3 AS c, local_date, {_P} FROM daily GROUP BY ALL), u AS (FROM e UNPIVOT (p FOR n IN ({', '.join(_NAMES)})))
SELECT c, CAST(regexp_extract(n, '[0-9]+') AS INTEGER) AS threshold, CAST(row_number() OVER (PARTITION BY c, n ORDER BY local_date) - 1 AS INTEGER) AS day, {sql.places("p", 2)} + 0.0 AS p FROM u""")
def exceedance_json_roundtrip(spark, sf_dir):
    e = ensemble.exceedance(daily_values(spark, sf_dir).withColumn("c", F.col("member") % 3), ["c", "local_date"], "ozone_50pc")
    documents = products.exceedance_document(e, ["c"], "local_date", ensemble.THRESHOLDS)
    return rounded(products.exceedance_json(products.as_json(documents, ["c"]), ["c"]))


@query(f"WITH {sql.BINNED}, w AS (SELECT member, valid_time, count(value) OVER v AS n, avg(value) OVER v AS a FROM binned WINDOW v AS (PARTITION BY member ORDER BY valid_time ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)) SELECT CAST(member AS INTEGER) AS member, valid_time, CASE WHEN n = 3 THEN round(a, 5) + 0.0 END AS smoothed FROM w")
def centred_smoother(spark, sf_dir):
    return rounded(ledger.smoothed(views.binned(spark, sf_dir), ["member"], "valid_time", "value").select("member", "valid_time", "smoothed"), 5)


@query("SELECT CAST(d AS VARCHAR) AS day, CASE dayofweek(d) WHEN 1 THEN 'Monday' WHEN 5 THEN 'Friday' END AS mark FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)")
def week_spans(spark, sf_dir):
    d = views.read(spark, sf_dir, "events").select(F.to_date("ts").alias("d")).distinct()
    return d.select(F.col("d").cast("string").alias("day"), times.week_marks(F.col("d")).alias("mark"))
