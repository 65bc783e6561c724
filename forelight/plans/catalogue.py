"""Queries of what runs give out and of the files, bundles and settings around them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from forelight.functions import scalars, times, variant
from forelight.operators import catalog, daily, ensemble, ledger, products
from forelight.plans import forecast, scenarios, sql
from forelight.plans.base import registry, rounded
from forelight.sources import readers, sinks, views

QUERIES, ORACLES, query = registry()
_AT = ["init", "member"]
_SERIES = f"{sql.FORCING}, {sql.SERIES}"
_TIME = "strftime(valid_time, '%Y-%m-%dT%H:%M:%SZ')"
_PLACES = {"snow": 0, "mslp": 1, "wind": 1, "solar": 0}


def _all_products(spark, sf_dir, weather: bool = True):
    days = sinks.kept(scenarios._forecasts(spark, sf_dir))
    above = ensemble.exceedance(days, ["init", "local_date"], "ozone_50pc")
    clusters = scenarios.summaries(spark, sf_dir) if weather else days.select("init").distinct().withColumn("json", F.lit("{}"))
    return products.all_products(days, ["init"], above, clusters, views.series(spark, sf_dir) if weather else None)


@query(f"""WITH {scenarios._DAY}, {sql.SERIES}
SELECT init, 'possibility_heatmap' AS product, member, count(*) AS n FROM days GROUP BY ALL UNION ALL SELECT init, 'percentile_scenarios', member, count(*) FROM days GROUP BY ALL
UNION ALL SELECT init, 'exceedance_probabilities', NULL, count(DISTINCT local_date) FROM days GROUP BY init UNION ALL SELECT init, 'clustering_summary', NULL, count(DISTINCT member) FROM days WHERE member <> 30 GROUP BY init
UNION ALL SELECT init, 'weather_members', member, count(*) FROM series GROUP BY ALL UNION ALL SELECT init, 'weather_percentiles', NULL, count(DISTINCT valid_time) FROM series GROUP BY init""")
def all_products(spark, sf_dir):
    """Every document of every run, told by how many days, times or members it has."""
    dates = F.size(F.from_json("json", "forecast_dates array<string>")["forecast_dates"])
    n = F.coalesce(F.get_json_object("json", "$.n_members").cast("long"), dates.cast("long"))
    return _all_products(spark, sf_dir).select("init", "product", "member", n.alias("n"))


@query(f"WITH {_SERIES} " + " UNION ALL ".join(f"SELECT init, member, '{v}' AS variable, {_TIME} AS date, {sql.places(v, p)} + 0.0 AS value FROM series" for v, p in _PLACES.items()) + f" UNION ALL SELECT init, member, 'temp', {_TIME}, NULL FROM series")
def weather_json_roundtrip(spark, sf_dir):
    return rounded(products.from_json(products.weather_members(views.series(spark, sf_dir), _AT, "valid_time"), _AT))


@query(f"WITH {_SERIES}, p AS (SELECT init, valid_time, " + ", ".join(f"quantile_cont({v}, {q / 100}) AS {v}_p{q}" for v in _PLACES for q in (10, 50, 90)) + " FROM series GROUP BY ALL) " + " UNION ALL ".join(f"SELECT init, '{v}_p{q}' AS variable, {_TIME} AS date, {sql.places(f'{v}_p{q}', p)} + 0.0 AS value FROM p" for v, p in _PLACES.items() for q in (10, 50, 90)))
def weather_percentiles_roundtrip(spark, sf_dir):
    return rounded(products.from_json(products.weather_percentiles(views.series(spark, sf_dir), ["init"], "valid_time"), ["init"]))


@query(f"""WITH {_SERIES}, o AS (SELECT init, member, CAST(floor((row_number() OVER (PARTITION BY init, member ORDER BY valid_time) - 1) / 24) AS INTEGER) AS day, {sql.places('snow', 0)} AS snow FROM series)
SELECT init, member, day, round(median(snow), 6) + 0.0 AS value FROM o GROUP BY ALL""")
def weather_payload_daily(spark, sf_dir):
    payload = products.weather_payload(products.weather_members(views.series(spark, sf_dir), _AT, "valid_time"), _AT)
    return rounded(daily.daily_by_places(payload, _AT, "snow"))


@query(f"""WITH {scenarios._DAY} SELECT concat('202401', lpad(CAST(init + 1 AS VARCHAR), 2, '0'), '_0000Z') AS init, concat('m', lpad(CAST(member AS VARCHAR), 3, '0')) AS member, CAST(local_date AS VARCHAR) AS date,
{', '.join(f'{sql.places(c, 2)} + 0.0 AS {c}' for c in products.CATEGORIES)}, {sql.places('ozone_50pc', 1)} + 0.0 AS p50, {sql.places('ozone_90pc', 1)} + 0.0 AS p90 FROM days""")
def case_loader(spark, sf_dir):
    """Product files by their names, read back as the tables that clustering takes."""
    init = F.concat(F.lit("202401"), F.lpad((F.col("init") + 1).cast("string"), 2, "0"), F.lit("_0000Z"))
    member = F.concat(F.lit("m"), F.lpad(F.col("member").cast("string"), 3, "0"))
    files = _all_products(spark, sf_dir, weather=False).select(F.concat(F.lit("cases/"), catalog.file_name(F.col("product"), member, init)).alias("path"), F.col("json").alias("text"))
    possibilities, percentiles, _ = catalog.case(files)
    return rounded(possibilities.join(percentiles.select("init", "member", "date", "p50", "p90"), ["init", "member", "date"]))


@query(f"WITH {sql.DAILY} SELECT local_date, count(ozone_50pc) AS n, " + ", ".join(f"round(quantile_cont(ozone_50pc, {q / 100}), 6) + 0.0 AS q{q}" for q in (0, 25, 50, 75, 100)) + " FROM daily GROUP BY local_date", days=("local_date",))
def forecast_boxes(spark, sf_dir):
    return rounded(ensemble.boxes(forecast.daily_values(spark, sf_dir), ["local_date"], "ozone_50pc"))


_FILES = "f AS (SELECT concat('out/', source, '/', doc_id, '.json') AS path, concat(source, '/', doc_id % 50) AS target, doc_id % 3 = 0 AS canonical FROM documents), there AS (SELECT DISTINCT concat(source, '/', doc_id % 50) AS target FROM documents WHERE doc_id % 50 < 10)"


@query(f"WITH {_FILES} SELECT path AS source, target FROM f WHERE target NOT IN (SELECT target FROM there) QUALIFY row_number() OVER (PARTITION BY target ORDER BY canonical DESC, path) = 1")
def archive_copies(spark, sf_dir):
    d, k = views.read(spark, sf_dir, "documents"), F.col("doc_id")
    target = F.concat_ws("/", "source", (k % 50).cast("string"))
    files = d.select(F.concat(F.lit("out/"), "source", F.lit("/"), k.cast("string"), F.lit(".json")).alias("path"), target.alias("target"), (k % 3 == 0).alias("canonical"))
    return catalog.copies(files, d.where(k % 50 < 10).select(target.alias("target")))


@query("SELECT source, count(*) AS n_files, CAST(sum(strlen(text)) AS BIGINT) AS bytes, min(concat(source, '/', doc_id)) AS first_path, arg_min(sha256(text), concat(source, '/', doc_id)) AS first_sha256 FROM documents GROUP BY source")
def case_manifest(spark, sf_dir):
    d = views.read(spark, sf_dir, "documents")
    files = d.select("source", F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"), F.octet_length("text").alias("length"), F.sha2("text", 256).alias("sha256"))
    m = catalog.manifest(files, ["source"])
    return m.select("source", "n_files", "bytes", *(F.get_json_object("json", f"$.files[0].{f}").alias(f"first_{f}") for f in ("path", "sha256")))


@query("SELECT lang, string_agg(concat(source, ': ', n), chr(10) ORDER BY concat(source, ': ', n)) AS text FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL) GROUP BY lang")
def case_quicklook(spark, sf_dir):
    counts = views.read(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"))
    return catalog.quicklook(counts, ["lang"], "source", "n")


@query("SELECT n_nationkey, concat('{\"code_commit\":\"', CASE WHEN n_nationkey % 2 = 0 THEN 'abc' ELSE 'unknown' END, '\",\"members\":', n_regionkey, ',\"name\":\"', n_name, '\"}') AS json FROM nation")
def run_summaries(spark, sf_dir):
    n = views.read(spark, sf_dir, "nation")
    runs = n.select("n_nationkey", F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 2 == 0, "abc").otherwise("").alias("code_commit"), F.col("n_regionkey").alias("members"))
    return catalog.run_summary(runs, ["n_nationkey"], "unknown")


@query("""WITH q AS (SELECT concat(CASE WHEN n_nationkey % 2 = 0 THEN 'V' ELSE '' END, n_nationkey % 8, '.1') AS request, concat(n_nationkey % 8, '.1') AS version, n_nationkey FROM nation),
r AS (SELECT r_regionkey AS k, concat(r_regionkey, '.1') AS v, CASE WHEN r_regionkey = 3 THEN NULL ELSE concat('m/', r_regionkey) END AS manifest, r_name FROM region)
SELECT request, version, manifest, CASE WHEN k = 0 THEN 'first' ELSE concat('bundle v', version) END AS label, coalesce(k = 1 AND manifest IS NOT NULL, false) AS qa, CASE WHEN k < 3 THEN concat('p/', k, '.txt') END AS prompt, CASE WHEN k IN (0, 2) THEN sha256(r_name) END AS prompt_sha256,
CASE WHEN k IS NULL THEN 'unknown version' WHEN manifest IS NULL THEN 'no manifest path' WHEN k = 4 THEN 'no manifest' WHEN k = 2 THEN 'another version' WHEN k = 1 THEN 'no prompt' ELSE 'ok' END AS status FROM q LEFT JOIN r ON r.v = q.version""")
def bundle_resolution(spark, sf_dir):
    k = F.col("r_regionkey")
    version = F.concat(k.cast("string"), F.lit(".1"))
    region = views.read(spark, sf_dir, "region")
    requests = views.read(spark, sf_dir, "nation").select(F.concat(F.when(F.col("n_nationkey") % 2 == 0, "V").otherwise(""), (F.col("n_nationkey") % 8).cast("string"), F.lit(".1")).alias("request"))
    path = F.concat(F.lit("m/"), k.cast("string"))
    prompt = F.concat(F.lit("p/"), k.cast("string"), F.lit(".txt"))
    known = region.select(version.alias("version"), F.when(k != 3, path).alias("manifest"))
    held = region.where(k < 3).select(path.alias("manifest"), F.when(k == 2, "9.9").otherwise(version).alias("version"), F.when(k == 0, "first").alias("label"), prompt.alias("prompt"), F.when(k == 1, True).alias("qa"))
    files = region.where(k != 1).select(prompt.alias("path"), F.sha2("r_name", 256).alias("sha256"))
    return catalog.resolved(requests, known, held, files)


@query("SELECT concat('KEY_', n_nationkey % 7) AS key, arg_max(n_name, n_nationkey) AS value FROM nation WHERE n_nationkey % 5 <> 0 GROUP BY 1")
def settings_scan(spark, sf_dir):
    k = F.col("n_nationkey")
    line = F.concat(F.lit("export KEY_"), (k % 7).cast("string"), F.lit(' = "'), "n_name", F.lit('"'))
    rows = views.read(spark, sf_dir, "nation").select(k.alias("n"), F.when(k % 5 == 0, "# nothing here").otherwise(line).alias("value"))
    return catalog.settings(rows)


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, 'none' AS deep FROM events")
def nested_defaults(spark, sf_dir):
    e = views.read(spark, sf_dir, "events")
    return e.select("event_id", catalog.nested(F.col("props"), "$.k", "none").alias("k"), catalog.nested(F.col("props"), "$.a.b", "none").alias("deep"))


@query("SELECT DISTINCT strftime(ts, '%Y%m%d%H') AS init FROM events WHERE strftime(ts, '%Y%m%d%H') <= '2024012012' ORDER BY init DESC LIMIT 8")
def recent_cases(spark, sf_dir):
    cases = views.read(spark, sf_dir, "events").select(F.date_format("ts", "yyyyMMddHH").alias("init")).distinct()
    return catalog.recent(cases, F.lit("2024012012"))


@query("SELECT i AS init, concat('/data/work/', i) AS work, concat('/data/cases/CASE_', substr(i, 1, 8), '_', substr(i, 9, 2), '00Z') AS \"case\", concat('/data/logs/run_', i, '.log') AS log FROM (SELECT DISTINCT strftime(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01'), '%Y%m%d%H') AS i FROM events)")
def replay_paths(spark, sf_dir):
    e = views.read(spark, sf_dir, "events")
    inits = e.select(F.date_format(times.floor_hours(F.col("ts"), 6), "yyyyMMddHH").alias("init")).distinct()
    return catalog.replay_paths(inits, "/data")



@query(f"WITH {sql.OBS} SELECT variable, count(DISTINCT stid) AS n, array_to_string(list_sort(list_distinct(list(stid))), ',') AS stids FROM obs GROUP BY variable")
def observed_stations(spark, sf_dir):
    o = views.obs(spark, sf_dir)
    return o.groupBy("variable").agg(F.count_distinct("stid").alias("n"), F.array_join(F.array_sort(F.collect_set("stid")), ",").alias("stids"))


@query("SELECT event_id, concat(upper(event_type[1]), lower(event_type[2:]), ', run of ', strftime(ts, '%Y-%m-%d %HZ'), ', lead ', lpad(CAST(event_id % 385 AS VARCHAR), 3, '0'), ' h') AS title, time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') AS quantised FROM events")
def plot_titles(spark, sf_dir):
    e = views.read(spark, sf_dir, "events")
    return e.select("event_id", times.title(F.col("event_type"), F.col("ts"), F.col("event_id") % 385).alias("title"), times.quantised(F.col("ts")).alias("quantised"))


@query("SELECT p_partkey AS l_partkey, p_size * 60.0::DOUBLE AS elev_m FROM part")
def elevation_dimension(spark, sf_dir):
    """Built by the first reader, read by the second."""
    path = sinks.folder(spark, "elevations")
    readers.read_or_build(spark, path, lambda: views.cells(spark, sf_dir))
    return readers.read_or_build(spark, path, lambda: views.cells(spark, sf_dir).where("false"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def legacy_scan(spark, sf_dir):
    return readers.legacy(spark, f"{sf_dir}/older_events.parquet", f"{sf_dir}/events.parquet").groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def first_rows(spark, sf_dir):
    return ledger.first_of(views.read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")


@query("""SELECT event_id, round(CASE WHEN event_id % 7 = 0 THEN NULL ELSE value / (event_id % 7) END, 6) + 0.0 AS ratio, floor(value / 25) * 25 AS low, ceil(value / 25) * 25 AS high, round(value * 9 / 5 + 32, 6) AS fahrenheit, event_id % 4 = 0 OR event_id % 4 = 2 AS retry,
round(720 + 4 * 109.5::DOUBLE - (9.87::DOUBLE * sin(2 * b) - 7.53::DOUBLE * cos(b) - 1.5::DOUBLE * sin(b)), 4) AS noon FROM (SELECT *, (dayofyear(ts) - 81) * (2 * pi() / 364) AS b FROM events)""")
def small_scalars(spark, sf_dir):
    k, v = F.col("event_id"), F.col("value")
    e = views.read(spark, sf_dir, "events").where(scalars.finite("value"))
    low, high = scalars.axis_limits(v, v, 25)
    message = F.when(k % 4 == 0, "KeyError: 'href'").when(k % 4 == 1, "ValueError: no").when(k % 4 == 2, "read timed out").otherwise("done")
    out = e.select("event_id", scalars.safe_div(v, k % 7).alias("ratio"), low.cast("double").alias("low"), high.cast("double").alias("high"), scalars.celsius_to_fahrenheit(v).alias("fahrenheit"), scalars.retryable_error(message).alias("retry"), F.round(times.solar_noon(F.to_date("ts"), -109.5), 4).alias("noon"))
    return rounded(out)


# The same entries in a list, in an object, and in layouts that have none.
_LAYOUTS = """d AS (SELECT event_id, event_id % 6 AS layout, replace(props, '}', concat(', "name": "', event_type, '"}')) AS p FROM events)"""


@query(f"""WITH {_LAYOUTS}, e AS (SELECT event_id, unnest(CASE layout WHEN 0 THEN [0, 1] WHEN 1 THEN [0, 2, 3] ELSE [] END) AS pos, layout, p FROM d)
SELECT event_id, CAST(pos AS INTEGER) AS pos, CASE WHEN pos = 1 THEN NULL WHEN pos = 2 THEN 'late' ELSE json_extract_string(p, '$.name') END AS name,
CASE WHEN pos = 1 THEN -0.5::DOUBLE WHEN pos = 2 THEN NULL ELSE CAST(json_extract_string(p, '$.k') AS DOUBLE) END AS low FROM e""")
def bias_layouts(spark, sf_dir):
    p = F.replace("props", F.lit("}"), F.concat(F.lit(', "name": "'), "event_type", F.lit('"}')))
    p = F.replace(p, F.lit('"k"'), F.lit('"low"'))
    i = F.col("event_id") % 6
    text = (
        F.when(i == 0, F.concat(F.lit('{"v": 1, "biases": ['), p, F.lit(', {"low": "-0.5"}, 7]}')))
        .when(i == 1, F.concat(F.lit("["), p, F.lit(', "text", {"name": "late", "low": "none"}, '), p, F.lit("]")))
        .when(i == 2, F.concat(F.lit('{"other": ['), p, F.lit("]}")))
        .when(i == 3, F.concat(F.lit('{"biases": '), p, F.lit("}")))
        .when(i == 4, F.concat(F.lit("broken ["), p))
    )
    return variant.bias_entries(views.read(spark, sf_dir, "events").select("event_id", text.alias("text")), ["event_id"], "text").select("event_id", "pos", "name", "low")


@query("""WITH c AS (SELECT c_nationkey, c_custkey % 5 AS id, count(*) AS n, max(c_acctbal) / 10000 AS high FROM customer GROUP BY ALL), f AS (SELECT *, n / sum(n) OVER (PARTITION BY c_nationkey) AS fraction FROM c)
SELECT c_nationkey, round(coalesce(sum(fraction) FILTER (id IN (0, 3)), 0), 6) + 0.0 AS null_fraction, round(coalesce(sum(fraction) FILTER (id NOT IN (0, 3)), 0), 6) + 0.0 AS non_null_fraction, round(greatest(coalesce(max(high) FILTER (id IN (1, 2)), 0), 0), 6) + 0.0 AS max_non_null_high FROM f GROUP BY c_nationkey""")
def gating_metrics(spark, sf_dir):
    c = views.read(spark, sf_dir, "customer").groupBy("c_nationkey", (F.col("c_custkey") % 5).alias("id")).agg(F.count("*").alias("n"), (F.max("c_acctbal") / 10000).alias("high"))
    c = c.withColumn("fraction", F.col("n") / F.sum("n").over(Window.partitionBy("c_nationkey")))
    # The fourth cluster's profile is missing, the null cluster is told by its number or its kind.
    one = F.struct("id", F.when(F.col("id") == 3, "null").otherwise("scenario").alias("kind"), "fraction", F.when(F.col("id") != 4, F.struct(F.col("high").alias("weighted_high"))).alias("risk_profile"))
    docs = c.groupBy("c_nationkey").agg(F.to_json(F.struct(F.collect_list(one).alias("clusters"))).alias("text"))
    return rounded(variant.cluster_metrics(docs, ["c_nationkey"], "text"))


# Tables that go out to files and come back.
_MEMBER_FILES = "files AS (SELECT strftime(time_bucket(INTERVAL 120 HOUR, ts, TIMESTAMP '1970-01-01'), '%Y%m%d_%H%MZ') AS init, CASE WHEN user_id % 31 = 0 THEN 'c00' ELSE concat('p', lpad(CAST(user_id % 31 AS VARCHAR), 2, '0')) END AS member, value FROM events)"


def _member_files(spark, sf_dir) -> str:
    e = views.read(spark, sf_dir, "events")
    k = F.col("user_id") % 31
    init = F.date_format(times.floor_hours(F.col("ts"), 120), "yyyyMMdd_HHmm'Z'")
    member = F.when(k == 0, "c00").otherwise(F.format_string("p%02d", k))
    base = sinks.folder(spark, "members")
    sinks.partitioned(e.select("ts", "value", F.concat(init, F.lit("_ozone_"), member, F.lit("_df.parquet")).alias("file")), base, ["file"])
    return base


@query(f"WITH {_MEMBER_FILES} SELECT init, member, count(*) AS n, round(max(value), 6) AS high FROM files GROUP BY ALL")
def member_files(spark, sf_dir):
    df = readers.members(readers.parquet(spark, _member_files(spark, sf_dir)), r"_([cp][0-9]{2})_df\.parquet", "file_path")
    init = F.regexp_extract("file", r"^([0-9]{8}_[0-9]{4}Z)", 1).alias("init")
    return rounded(df.groupBy(init, "member").agg(F.count("*").alias("n"), F.max("value").alias("high")))


@query(f"WITH {_MEMBER_FILES} SELECT DISTINCT substr(init, 1, 11) AS init FROM files")
def available_inits(spark, sf_dir):
    return readers.inits(readers.parquet(spark, _member_files(spark, sf_dir)), r"file=([0-9]{8}_[0-9]{2})", "file_path")


@query(f"WITH {sql.OBS} SELECT stid, variable, count(*) AS n, round(min(value), 6) AS low, round(max(value), 6) AS high, min(ts) AS first_seen FROM obs GROUP BY ALL UNION ALL SELECT NULL, variable, count(*), round(min(v), 4), round(max(v), 4), NULL FROM (SELECT variable, CAST(ts AS DATE) AS day, max(value) AS v FROM obs GROUP BY ALL) GROUP BY variable")
def observation_files(spark, sf_dir):
    """Raw observations as CSV, and reduced ones as Parquet with 32-bit values; broken values would be null."""
    obs = views.obs(spark, sf_dir)
    raw, reduced = f"{sinks.folder(spark, 'obs')}/raw.csv", f"{sinks.folder(spark, 'obs')}/reduced"
    sinks.csv(obs.select("stid", "ts", "variable", "value"), raw)
    sinks.observations(obs.groupBy("variable", F.to_date("ts").alias("date")).agg(F.max("value").alias("value")), reduced, ["value"])
    a = readers.observations(spark, raw).groupBy("stid", "variable").agg(F.count("*").alias("n"), F.round(F.min("value"), 6).alias("low"), F.round(F.max("value"), 6).alias("high"), F.min("ts").cast("timestamp_ntz").alias("first_seen"))
    b = readers.observations(spark, reduced).groupBy("variable").agg(F.count("*").alias("n"), F.round(F.min("value"), 4).alias("low"), F.round(F.max("value"), 4).alias("high"))
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT concat('S', s_nationkey) AS stid, CAST(max(s_acctbal) AS VARCHAR) AS elevation, min(s_name) AS name FROM supplier GROUP BY s_nationkey")
def station_metadata(spark, sf_dir):
    """A column for each station, as some services send it, turned into a row for each."""
    s = views.read(spark, sf_dir, "supplier").groupBy(F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("stid")).agg(F.max("s_acctbal").cast("string").alias("elevation"), F.min("s_name").alias("name"))
    s = s.select("stid", F.explode(F.array(*(F.struct(F.lit(c).alias("attribute"), F.col(c).alias("v")) for c in ("elevation", "name")))).alias("x"))
    wide = s.groupBy("x.attribute").pivot("stid").agg(F.first("x.v"))
    return readers.untransposed(wide)


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(avg(l_quantity), 4) AS mean, round(max(l_extendedprice), 2) AS high FROM lineitem GROUP BY ALL")
def csv_outputs(spark, sf_dir):
    line = views.read(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.avg("l_quantity"), 4).alias("mean"), F.round(F.max("l_extendedprice"), 2).alias("high"))
    path = sinks.folder(spark, "csv")
    sinks.csv(line, path)
    return readers.csv(spark, path, schema="l_returnflag string, l_linestatus string, n long, mean double, high double")


_FIGURES = """files AS (SELECT concat('/figs/', ['heatmap/heatmap_UB', 'meteograms/meteogram_UB', 'optim_pessim/meteogram_UB', 'meteograms/map_UB'][event_id % 4 + 1], '_', CASE event_id % 2 WHEN 0 THEN strftime(ts, '%Y%m%d-%H00') ELSE strftime(ts, '%Y%m%d_%H') END, '_', user_id % 31, '.png') AS path, event_id % 4 AS k FROM events
UNION ALL SELECT concat('/cases/CASE_', strftime(ts, '%Y%m%d_%H00Z'), '/llm_text/LLM-OUTLOOK-', user_id % 31, ['.md', '.pdf', '.txt'][event_id % 3 + 1]), 4 + event_id % 3 FROM events)"""


@query(f"""WITH {_FIGURES}, own AS (SELECT DISTINCT path, k, regexp_extract(path, '([^/]*)$', 1) AS name FROM files WHERE contains(path, '20240110-0600') OR contains(path, '20240110_06'))
SELECT min(path) AS path, CASE WHEN k = 0 THEN 'heatmap' WHEN k < 3 THEN 'meteogram' ELSE 'outlook' END AS kind FROM own WHERE k NOT IN (3, 6) GROUP BY kind, name""")
def run_figures(spark, sf_dir):
    e = views.read(spark, sf_dir, "events")
    i = F.col("event_id")
    stem = F.get(F.array(*map(F.lit, ("heatmap/heatmap_UB", "meteograms/meteogram_UB", "optim_pessim/meteogram_UB", "meteograms/map_UB"))), (i % 4).cast("int"))
    when = F.when(i % 2 == 0, F.date_format("ts", "yyyyMMdd-HH'00'")).otherwise(F.date_format("ts", "yyyyMMdd_HH"))
    png = F.concat(F.lit("/figs/"), stem, F.lit("_"), when, F.lit("_"), (F.col("user_id") % 31).cast("string"), F.lit(".png"))
    suffix = F.get(F.array(*map(F.lit, (".md", ".pdf", ".txt"))), (i % 3).cast("int"))
    text = F.concat(F.lit("/cases/CASE_"), F.date_format("ts", "yyyyMMdd_HH'00Z'"), F.lit("/llm_text/LLM-OUTLOOK-"), (F.col("user_id") % 31).cast("string"), suffix)
    files = e.select(F.explode(F.array(png, text)).alias("path")).distinct()
    return readers.figures(files, "20240110_06")
