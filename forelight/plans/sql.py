"""SQL twins of the views in ``sources.views``, for the checks in another engine."""

OBS = "obs AS (SELECT concat('S', user_id % 9) AS stid, event_type AS variable, ts, value, event_id FROM events)"

FORCING = """forcing AS (
  SELECT CAST(user_id % 31 AS INTEGER) AS member, ts AS valid_time, event_id, least(250.0::DOUBLE, value * 3) AS snow,
         1000 + 0.5::DOUBLE * CAST(json_extract_string(props, '$.k') AS INTEGER) AS mslp, (event_id % 17) * 0.3::DOUBLE AS wind,
         CAST(((event_id * 37) % 161) * 5 AS DOUBLE) AS solar FROM events)"""

LOCAL = "CAST(timezone('America/Denver', timezone('UTC', {0})) AS {1})"


def local_date(ts: str = "valid_time") -> str:
    return LOCAL.format(ts, "DATE")


def local_hour(ts: str = "valid_time") -> str:
    return f"extract('hour' FROM {LOCAL.format(ts, 'TIMESTAMP')})"


BIN = "time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '1970-01-01')"
BINNED = f"binned AS (SELECT user_id % 31 AS member, {BIN} AS valid_time, avg(least(250.0::DOUBLE, value * 3)) AS value, avg(CAST(((event_id * 37) % 161) * 5 AS DOUBLE)) AS solar FROM events GROUP BY ALL)"

SERIES = f"""series AS (SELECT CAST((CAST(valid_time AS DATE) - DATE '2023-12-31') // 15 AS INTEGER) AS init, member, {BIN.replace("ts,", "valid_time,")} AS valid_time,
  max(snow * 1.0371::DOUBLE) AS snow, max(mslp * 1.00013::DOUBLE) AS mslp, max(wind * 1.0171::DOUBLE) AS wind, max(solar * 1.0117::DOUBLE) AS solar FROM forcing GROUP BY ALL)"""

GRID = "grid AS (SELECT date_trunc('month', l_shipdate) AS time, 39 + (l_suppkey % 25) * 0.1::DOUBLE AS lat, 248 + (l_partkey % 40) * 0.1::DOUBLE AS lon, l_extendedprice AS value, l_partkey FROM lineitem)"
CELLS = "cells AS (SELECT p_partkey AS l_partkey, p_size * 60.0::DOUBLE AS elev_m FROM part)"
STATIONS = "stations AS (SELECT concat('S', (s_suppkey - 1) % 9) AS stid, 1200 + 20.0::DOUBLE * min(s_suppkey) AS elev_m FROM supplier GROUP BY 1)"


def places(x: str, n: int) -> str:
    """Rounding of product values, by decimals, as engines differ in what they make of halves."""
    return f"CAST(round(CAST(round({x}, 9) AS DECIMAL(18, 9)), {n}) AS DOUBLE)"


def rise(x: str, a: float, b: float) -> str:
    return f"least(1.0::DOUBLE, greatest(0.0::DOUBLE, ({x} - {a}) / {b - a}::DOUBLE))"


def trapezoid(x: str, a: float, b: float, c: float, d: float) -> str:
    return f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, ({x} - {a}) / {b - a}::DOUBLE, ({d} - {x}) / {d - c}::DOUBLE))"


TERMS = f"""terms AS (
  SELECT *, 1 - {rise('snow', 60, 90)} AS negligible, {rise('snow', 60, 90)} AS sufficient, 1 - {rise('wind', 2, 4)} AS calm, {rise('wind', 2, 4)} AS breezy,
         1 - {rise('mslp', 1010, 1015)} AS p_low, {trapezoid('mslp', 1010, 1015, 1030, 1035)} AS p_mid, {rise('mslp', 1025, 1035)} AS p_high,
         1 - {rise('solar', 200, 300)} AS s_low, {trapezoid('solar', 200, 300, 500, 700)} AS s_mid, {rise('solar', 500, 700)} AS s_high FROM forcing)"""
POSSIBLE = """possible AS (
  SELECT member, valid_time, event_id, snow, mslp, wind, solar, greatest(negligible, p_low, breezy) AS background,
         greatest(least(sufficient, p_high, calm, s_low), least(sufficient, p_mid, calm, s_mid)) AS moderate,
         greatest(least(sufficient, p_high, calm, s_mid), least(sufficient, p_mid, calm, s_high)) AS elevated,
         least(sufficient, p_high, calm, s_high) AS extreme FROM terms)"""
_Y = f"greatest(least({trapezoid('x', 20, 30, 40, 50)}, background), least({trapezoid('x', 40, 50, 60, 70)}, moderate), least({trapezoid('x', 50, 60, 75, 90)}, elevated), least({trapezoid('x', 60, 75, 90, 125)}, extreme))"
#: The 241-point universe, its running area, and where a share of it is reached.
PERCENTILES = f"""pts AS (SELECT event_id, i, 20 + i * 0.5::DOUBLE AS x, background, moderate, elevated, extreme FROM possible, range(241) r(i)),
ys AS (SELECT event_id, i, x, {_Y} AS y FROM pts),
pieces AS (SELECT event_id, i, x, CASE WHEN i = 0 THEN 0 ELSE (y + lag(y) OVER (PARTITION BY event_id ORDER BY i)) / 2 * 0.5::DOUBLE END AS a FROM ys),
areas AS (SELECT event_id, i, x, sum(a) OVER (PARTITION BY event_id ORDER BY i) AS s, sum(a) OVER (PARTITION BY event_id) AS total FROM pieces),
shares AS (SELECT event_id, i, x, s / total AS f, lag(s / total) OVER (PARTITION BY event_id ORDER BY i) AS f0 FROM areas WHERE total > 0),
""" + ",\n".join(
    f"q{p} AS (SELECT event_id, round_even(round(arg_min(x - 0.5::DOUBLE + ({p / 100}::DOUBLE - f0) / (f - f0) * 0.5::DOUBLE, i), 9), 0) AS ozone_{p}pc FROM shares WHERE f >= {p / 100}::DOUBLE AND i > 0 GROUP BY event_id)" for p in (10, 50, 90)
)
INFERENCE = f"""{FORCING}, {TERMS}, {POSSIBLE}, {PERCENTILES},
inference AS (SELECT p.*, ozone_10pc, ozone_50pc, ozone_90pc FROM possible p LEFT JOIN q10 USING (event_id) LEFT JOIN q50 USING (event_id) LEFT JOIN q90 USING (event_id))"""
_VALUES = ("ozone_10pc", "ozone_50pc", "ozone_90pc", "background", "moderate", "elevated", "extreme")
DAILY = f"""{INFERENCE},
daily AS (SELECT member, {local_date()} AS local_date, {', '.join(f'max({v}) AS {v}' for v in _VALUES)} FROM inference GROUP BY ALL)"""


def hazen(x: str, q: float, poison: bool = False) -> str:
    """Aggregate: the Hazen quantile of x."""
    v, h = f"list_sort(list({x}) FILTER ({x} IS NOT NULL))", f"least(greatest(count({x}) * {q}::DOUBLE - 0.5::DOUBLE, 0), count({x}) - 1)"
    lo = f"CAST(floor({h}) AS BIGINT)"
    out = f"({v})[{lo} + 1] + ({h} - floor({h})) * (({v})[least({lo} + 2, count({x}))] - ({v})[{lo} + 1])"
    return f"CASE WHEN count(*) = count({x}) THEN {out} END" if poison else f"CASE WHEN count({x}) > 0 THEN {out} END"
