"""Queries of the observation side: representative values, profiles, verification."""

from __future__ import annotations

from pyspark.sql import functions as F

from forelight.functions import scalars, times
from forelight.operators import ensemble, products, representative, verify
from forelight.plans import sql
from forelight.plans.base import registry, rounded
from forelight.sources import views

QUERIES, ORACLES, query = registry()
_NEXT = f"{sql.local_date('ts')} + 1"


def _two_stage(first: str, second: str, day: str = _NEXT, source: str = "obs") -> str:
    return f"WITH {sql.OBS}, s AS (SELECT stid, CAST({day} AS DATE) AS date, {first} AS value FROM {source} GROUP BY ALL) SELECT date, round({second}, 4) + 0.0 AS value FROM s GROUP BY date"


#: Every 500th value is missing, so that skipping and poisoning differ.
_GAPPY = "(SELECT stid, ts, CASE WHEN event_id % 500 = 3 THEN NULL ELSE value END AS value FROM obs) o"


def _gappy(spark, sf_dir):
    return views.obs(spark, sf_dir).withColumn("value", F.when(F.col("event_id") % 500 != 3, F.col("value")))


@query(_two_stage("median(value)", "median(value)"), days=("date",))
def repr_mslp(spark, sf_dir):
    return rounded(representative.mslp(views.obs(spark, sf_dir)), 4)


@query(_two_stage(sql.hazen("value", 0.8, True), sql.hazen("value", 0.75, True), source=_GAPPY).replace(", 4) + 0.0", ", 3) + 0.0"), days=("date",))
def repr_wind_hazen(spark, sf_dir):
    return rounded(representative.wind(_gappy(spark, sf_dir)), 3)


@query(_two_stage(sql.hazen("value", 0.9, True), sql.hazen("value", 0.9, True), source=_GAPPY).replace(", 4) + 0.0", ", 3) + 0.0"), days=("date",))
def repr_snow_hazen(spark, sf_dir):
    return rounded(representative.snow(_gappy(spark, sf_dir)), 3)


@query(_two_stage("max(CASE WHEN value BETWEEN 5 AND 140 THEN value END)", "quantile_cont(value, 0.99)"), days=("date",))
def repr_ozone(spark, sf_dir):
    return rounded(representative.ozone(views.obs(spark, sf_dir)), 4)


@query(f"""WITH {sql.OBS}, d AS (SELECT stid, {sql.local_date('ts')} AS date, avg(value) AS value FROM obs WHERE abs(extract('hour' FROM ts) * 60 + extract('minute' FROM ts) - 1160) <= 120 GROUP BY ALL),
m AS (SELECT date, CASE WHEN count(value) OVER w = 4 THEN avg(value) OVER w END AS value FROM d WINDOW w AS (PARTITION BY stid ORDER BY date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))
SELECT date, round({sql.hazen('value', 0.8, True)}, 3) + 0.0 AS value FROM m GROUP BY date""", days=("date",))
def repr_solar_rolling(spark, sf_dir):
    return rounded(representative.solar(views.obs(spark, sf_dir), F.lit(1160)), 3)


@query(f"WITH {sql.OBS} SELECT variable, CAST({_NEXT} AS DATE) AS date, round(quantile_cont(value, 0.5), 4) + 0.0 AS p50, count(*) AS n FROM obs WHERE stid IN ('S1', 'S3', 'S5') GROUP BY ALL", days=("date",))
def station_subset_daily(spark, sf_dir):
    o = views.obs(spark, sf_dir).where(F.col("stid").isin("S1", "S3", "S5"))
    return rounded(o.groupBy("variable", times.next_day_label("ts").alias("date")).agg(F.percentile("value", 0.5).alias("p50"), F.count("*").alias("n")), 4)


@query(f"WITH {sql.OBS}, {sql.STATIONS}, p AS (SELECT stid, {sql.local_date('ts')} AS date, max(value) AS value FROM obs GROUP BY ALL) SELECT stid, date, round(value, 6) + 0.0 AS value, elev_m FROM p JOIN stations USING (stid)", days=("date",))
def max_value_profile(spark, sf_dir):
    return rounded(verify.max_profile(views.obs(spark, sf_dir), views.stations(spark, sf_dir)).select("stid", "date", "value", "elev_m"))


@query(f"""WITH {sql.OBS}, {sql.STATIONS}, p AS (SELECT stid, {sql.local_date('ts')} AS date, max(value) AS value FROM obs GROUP BY ALL)
SELECT date, round(regr_slope(value, elev_m) * 1000, 4) + 0.0 AS slope_per_km, round(regr_intercept(value, elev_m), 4) + 0.0 AS intercept, count(*) AS n FROM p JOIN stations USING (stid) GROUP BY date""", days=("date",))
def lapse_rate_daily(spark, sf_dir):
    return rounded(verify.lapse_rate(verify.max_profile(views.obs(spark, sf_dir), views.stations(spark, sf_dir)), ["date"]), 4)


@query(f"""WITH {sql.OBS}, {sql.STATIONS}, b AS (SELECT event_id, value, ceil((elev_m - 1200) / 50) AS bin FROM obs JOIN stations USING (stid)),
s AS (SELECT *, avg(value) OVER (PARTITION BY bin) AS m, stddev_samp(value) OVER (PARTITION BY bin) AS sd FROM b) SELECT event_id, round(value, 6) + 0.0 AS value FROM s WHERE value > m - 2 * sd AND value < m + 2 * sd""")
def outlier_filter(spark, sf_dir):
    o = views.obs(spark, sf_dir).join(views.stations(spark, sf_dir), "stid")
    return rounded(verify.without_outliers(o, verify.elevation_bin(F.col("elev_m"), 1200, 50), "value").select("event_id", "value"))


_PAIRS = """pairs AS (SELECT o_orderkey, any_value(o_totalprice) AS forecast, sum(l_extendedprice) AS observed, CAST(any_value(o_orderkey) % 16 AS INTEGER) AS lead_day FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey)"""


def _pairs(spark, sf_dir):
    line = views.read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("observed"))
    orders = views.read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("forecast"), (F.col("o_orderkey") % 16).cast("int").alias("lead_day"))
    return orders.join(line, "o_orderkey")


@query(f"WITH {_PAIRS} SELECT lead_day, count(*) AS n, round(avg(forecast - observed), 3) + 0.0 AS bias, round(avg(abs(forecast - observed)), 3) + 0.0 AS mae, round(sqrt(avg((forecast - observed) * (forecast - observed))), 3) + 0.0 AS rmse FROM pairs GROUP BY GROUPING SETS ((lead_day), ())")
def verify_by_lead_grouping_sets(spark, sf_dir):
    return rounded(verify.scores(_pairs(spark, sf_dir), "lead_day", "forecast", "observed"), 3)


@query(f"WITH {_PAIRS}, d AS (SELECT lead_day, forecast FROM pairs) SELECT lead_day, {', '.join(f'round(quantile_cont(forecast, {p / 100}), 4) + 0.0 AS p{p}' for p in (10, 50, 90))}, round(avg(forecast), 4) + 0.0 AS mean, count(*) AS n FROM d GROUP BY lead_day")
def forecast_daily_summary(spark, sf_dir):
    return rounded(ensemble.percentiles_of_many(_pairs(spark, sf_dir), ["lead_day"], "forecast"), 4)


@query(f"WITH {sql.OBS} SELECT year(ts) AS year, variable, count(DISTINCT stid) AS n, array_to_string(list_sort(list_distinct(list(stid))), ',') AS stids FROM obs GROUP BY ALL")
def station_year_counts(spark, sf_dir):
    return verify.stations_by_year(views.obs(spark, sf_dir)).withColumn("year", F.col("year").cast("long"))


@query(f"WITH {sql.OBS} SELECT stid FROM obs WHERE stid <> 'S2' OR variable <> (SELECT min(variable) FROM obs) GROUP BY stid HAVING count(DISTINCT variable) = (SELECT count(DISTINCT variable) FROM obs)")
def common_stations(spark, sf_dir):
    o = views.obs(spark, sf_dir)
    least = o.select(F.min("variable").alias("v"))
    return verify.common_stations(o.join(least, (F.col("stid") != "S2") | (F.col("variable") != F.col("v"))), "variable")


@query("""WITH a AS (SELECT s_nationkey AS level, avg(s_acctbal) AS t FROM supplier GROUP BY 1), b AS (SELECT c_nationkey + 5 AS level, avg(c_acctbal) AS z FROM customer GROUP BY 1)
SELECT level, round(t, 6) + 0.0 AS t, round(z, 6) + 0.0 AS z FROM a FULL JOIN b USING (level)""")
def vertical_profile_outer(spark, sf_dir):
    a = views.read(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("level")).agg(F.avg("s_acctbal").alias("t"))
    b = views.read(spark, sf_dir, "customer").groupBy((F.col("c_nationkey") + 5).alias("level")).agg(F.avg("c_acctbal").alias("z"))
    return rounded(a.join(b, "level", "full_outer"))


@query("""SELECT event_id, round(value * 1000, 4) + 0.0 AS mm, round(value - 273.15, 4) + 0.0 AS celsius, round(value / 100, 6) + 0.0 AS hpa, round(value / 25.4, 6) + 0.0 AS inches, round(value * 2.23694, 6) + 0.0 AS mph,
round(value * 0.304, 6) + 0.0 AS metres, round(greatest(value - 50, 0), 6) + 0.0 AS above_offset, round(sqrt(value * value + (event_id % 7) * (event_id % 7)), 6) + 0.0 AS speed FROM events""")
def unit_conversions(spark, sf_dir):
    v, k = F.col("value"), (F.col("event_id") % 7).cast("double")
    e = views.read(spark, sf_dir, "events")
    out = e.select("event_id", scalars.metres_to_mm(v).alias("mm"), scalars.kelvin_to_celsius(v).alias("celsius"), scalars.pascal_to_hectopascal(v).alias("hpa"), scalars.mm_to_inches(v).alias("inches"), scalars.to_mph(v).alias("mph"), scalars.feet_to_metres(v).alias("metres"), scalars.offset_floor(v, 50).alias("above_offset"), scalars.wind_speed(v, k).alias("speed"))
    return out.select("event_id", *((F.round(c, 4 if c in ("mm", "celsius") else 6) + F.lit(0.0)).alias(c) for c in out.columns[1:]))


@query("""SELECT user_id % 9 AS station, date_trunc('day', ts) AS day, round(avg(value), 6) + 0.0 AS value FROM events WHERE value BETWEEN 5 AND 140 GROUP BY ALL""")
def range_scrub(spark, sf_dir):
    e = views.read(spark, sf_dir, "events").where(F.col("value").between(*representative.OZONE_RANGE))
    return rounded(e.groupBy((F.col("user_id") % 9).alias("station"), F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(F.avg("value").alias("value")))


@query("""SELECT concat('S', user_id % 9) AS stid, date_trunc('second', ts) AS ts, round(value, 2) + 0.0 AS value FROM events WHERE event_id % 50 <> 0""")
def observation_json_scan(spark, sf_dir):
    e = views.read(spark, sf_dir, "events")
    # Responses as a service gives them, one per station and day; some values are no numbers.
    text = F.when(F.col("event_id") % 50 != 0, F.round("value", 2).cast("string")).otherwise("M")
    row = e.select(F.concat(F.lit("S"), (F.col("user_id") % 9).cast("string")).alias("stid"), F.to_date("ts").alias("d"), F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t"), text.alias("v"), "event_id").alias("o"))
    days = row.groupBy("stid", "d").agg(F.array_sort(F.collect_list("o")).alias("o"))
    station = F.struct(F.col("stid").alias("STID"), F.struct(F.transform("o", lambda x: x["t"]).alias("date_time"), F.transform("o", lambda x: x["v"]).alias("value")).alias("OBSERVATIONS"))
    found = products.observation_json(days.select(F.to_json(F.struct(F.array(station).alias("STATION"))).alias("json")))
    return rounded(found.select("stid", F.col("ts").cast("timestamp_ntz").alias("ts"), "value"))


@query("""WITH e AS (SELECT DISTINCT n_nationkey AS k, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE n_nationkey * 1.5::DOUBLE END AS a, n_nationkey * 2.0::DOUBLE AS b FROM nation)
SELECT k, coalesce(a, b) AS value, CASE WHEN a IS NOT NULL THEN 'primary' ELSE 'fallback' END AS source FROM e""")
def fallback_source(spark, sf_dir):
    n = views.read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"))
    a = n.where("k % 4 <> 0").select("k", (F.col("k") * 1.5).alias("a"))
    b = n.select("k", (F.col("k") * 2.0).alias("b"))
    return b.join(a, "k", "left").select("k", F.coalesce("a", "b").alias("value"), F.when(F.col("a").isNotNull(), "primary").otherwise("fallback").alias("source"))
