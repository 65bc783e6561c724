"""Queries over gridded forecasts in GRIB messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from forelight.functions import scalars
from forelight.operators import spatial
from forelight.plans.base import registry
from forelight.sources import grib, readers, sinks, views

QUERIES, ORACLES, query = registry()

#: The grid of the test tables: first and last coordinate, and points.
_LATS, _LONS = (39.0, 41.4, 25), (248.0, 251.9, 40)
_FIELDS = """fields AS (SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS init, CASE l_linenumber % 3 WHEN 0 THEN 'c00' ELSE concat('p0', l_linenumber % 3) END AS member, CAST((extract('day' FROM l_shipdate) - 1) // 8 * 90 AS INTEGER) AS fxx,
  l_suppkey % 25 AS j, l_partkey % 40 AS i, max(l_extendedprice) AS value FROM lineitem GROUP BY ALL)"""


def _cells(spark, sf_dir):
    line = views.read(spark, sf_dir, "lineitem")
    init, fxx = F.date_trunc("month", "l_shipdate").cast("timestamp_ntz"), F.floor((F.dayofmonth("l_shipdate") - 1) / 8) * 90
    keys = [init.alias("init"), (F.col("l_linenumber") % 3).alias("member"), fxx.cast("int").alias("fxx"), F.lit("sde").alias("variable"), (F.col("l_suppkey") % 25).alias("j"), (F.col("l_partkey") % 40).alias("i")]
    return line.groupBy(*keys).agg(F.max("l_extendedprice").alias("value"))


def _path():
    return F.concat_ws("/", F.date_format("init", "yyyyMMddHH"), F.col("member").cast("string"), F.col("fxx").cast("string")).alias("path")


@query(f"WITH {_FIELDS} SELECT init, member, 'sde' AS variable, fxx, init + to_hours(fxx) AS valid_time, (390 + j) / 10.0::DOUBLE AS lat, (2480 + i) / 10.0::DOUBLE AS lon, value FROM fields")
def grib_scan(spark, sf_dir):
    files = grib.packed(_cells(spark, sf_dir), _LATS, _LONS).select(_path(), "content")
    return grib.messages(files).where("value is not null").select("init", "member", "variable", "fxx", "valid_time", "lat", "lon", "value")


# Files of a run's messages, written and scanned by the data source; filters on heads leave most data unread.
@query(f"WITH {_FIELDS} SELECT init, member, fxx, (390 + j) / 10.0::DOUBLE AS lat, (2480 + i) / 10.0::DOUBLE AS lon, value FROM fields WHERE member <> 'c00' AND fxx IN (90, 180)")
def grib_source(spark, sf_dir):
    grib.register(spark)
    files = grib.packed(_cells(spark, sf_dir), _LATS, _LONS).withColumn("name", F.concat(F.date_format("init", "yyyy/yyyyMMddHH"), F.lit(".grib2")))
    base = sinks.folder(spark, "grib")
    files.repartition("name").sortWithinPartitions("name", "fxx", "member").select("name", "content").write.format("grib").mode("append").save(base)
    scan = spark.read.format("grib").option("suffix", ".grib2").load(base)
    return scan.where("member in ('p01', 'p02') and fxx in (90, 180) and value is not null").select("init", "member", "fxx", "lat", "lon", "value")


# Every fifth size of a field stands for a transfer that broke off: those have no row of their own and stay visible as nulls.
@query(f"""WITH {_FIELDS}, sums AS (SELECT init, member, fxx, count(*) AS n_cells, max(value) AS high FROM fields GROUP BY ALL), runs AS (SELECT DISTINCT init FROM fields)
SELECT r.init, m.member, h.fxx, CASE WHEN h.fxx > 240 THEN 'atmos.5' ELSE 'atmos.25' END AS product, CASE WHEN n_cells % 5 <> 0 THEN n_cells END AS n_cells, CASE WHEN n_cells % 5 <> 0 THEN high END AS high
FROM runs r CROSS JOIN (VALUES ('c00'), ('p01'), ('p02')) m(member) CROSS JOIN (VALUES (0), (90), (180), (270)) h(fxx) LEFT JOIN sums s ON s.init = r.init AND s.member = m.member AND s.fxx = h.fxx""")
def grib_slices(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    keys = ["init", "member", "fxx"]
    sizes = cells.groupBy(*keys).agg(F.count("*").alias("n"))
    files = grib.packed(cells, _LATS, _LONS).join(sizes, keys)
    files = files.withColumn("content", F.when(F.col("n") % 5 == 0, F.expr("substring(content, 1, octet_length(content) - 20)")).otherwise(F.col("content")))
    got = grib.messages(files.select(_path(), "content")).where("error is null").groupBy(*keys).agg(F.count("value").alias("n_cells"), F.max("value").alias("high"))
    wanted = grib.slices(cells, ["c00", "p01", "p02"], ["sde"], 0, 270, 90).drop("variable")
    return readers.with_expected(got, wanted, keys).select(*keys, "product", "n_cells", "high")


# The point nearest to the place is the twelfth row's and the twenty-second column's; most fields lack it.
@query(f"""WITH {_FIELDS}, runs AS (SELECT DISTINCT init, member FROM fields)
SELECT r.init, r.member, h.fxx, CASE WHEN h.fxx > 240 THEN 'atmos.5' ELSE 'atmos.25' END AS product, r.init + to_hours(h.fxx) AS valid_time, round(value / 100, 6) AS mslp FROM runs r CROSS JOIN (VALUES (0), (90), (180), (240), (270)) h(fxx)
LEFT JOIN (SELECT * FROM fields WHERE j = 11 AND i = 21) f ON f.init = r.init AND f.member = r.member AND f.fxx = h.fxx""")
def pressure_at_point(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    files = grib.packed(cells, _LATS, _LONS).select(_path(), "content")
    field = readers.with_name(grib.messages(files).select("value", "init", "member", "fxx", "lat", "lon"), "pres", ["init", "member", "fxx", "lat", "lon"])
    runs = cells.select("init", F.when(F.col("member") == 0, "c00").otherwise(F.concat(F.lit("p0"), F.col("member").cast("string"))).alias("member"))
    hours = [(f, "atmos.25") for f in (0, 90, 180, 240)] + [(f, "atmos.5") for f in (240, 270)]
    out = spatial.point_series(field, runs, ["init", "member"], 40.07, 250.13, hours, "pres")
    return out.select("init", "member", "fxx", "product", "valid_time", F.round(scalars.pascal_to_hectopascal(F.col("value")), 6).alias("mslp"))
