"""Queries about runs, files and discussion texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from forelight.functions import scalars, text, times
from forelight.operators import ledger, paths
from forelight.plans import sql
from forelight.plans.base import registry, rounded
from forelight.sources import commits, sinks, views
from forelight.streaming import daily as streaming
from forelight.streaming import runs

QUERIES, ORACLES, query = registry()


@query("SELECT strftime(t, '%Y%m%d%H') AS init, strftime(t, '%Y%m%d_%H%MZ') AS case_name, extract('hour' FROM t) AS hour FROM (SELECT unnest(generate_series(time_bucket(INTERVAL 6 HOUR, min(ts), TIMESTAMP '1970-01-01'), time_bucket(INTERVAL 6 HOUR, max(ts), TIMESTAMP '1970-01-01'), INTERVAL 6 HOUR)) AS t FROM events)")
def init_calendar(spark, sf_dir):
    c = ledger.calendar_of(views.read(spark, sf_dir, "events"), "ts")
    return c.select(times.format_init("init").alias("init"), times.format_init("init", case=True).alias("case_name"), F.hour("init").cast("long").alias("hour"))


@query("""WITH s AS (SELECT event_id, strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y%m%d%H') AS i FROM events) SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'bad' ELSE i END AS text, event_id % 5 <> 0 AND substr(i, 9, 2) IN ('00', '06', '12', '18') AS valid FROM s""")
def init_validation(spark, sf_dir):
    e = views.read(spark, sf_dir, "events")
    t = F.when(F.col("event_id") % 5 == 0, "bad").otherwise(F.date_format("ts", "yyyyMMddHH"))
    return e.select("event_id", t.alias("text")).withColumn("valid", times.valid_init("text"))


@query("""SELECT event_id, time_bucket(INTERVAL 6 HOUR, ts - INTERVAL 8 HOUR, TIMESTAMP '1970-01-01') AS latest, time_bucket(INTERVAL 6 HOUR, ts - INTERVAL 270 MINUTE, TIMESTAMP '1970-01-01') AS anchor,
CASE WHEN extract('minute' FROM ts) > 20 THEN date_trunc('hour', ts) ELSE date_trunc('hour', ts) - INTERVAL 1 HOUR END AS observed, CAST(date_diff('day', DATE '2024-01-01', CAST(timezone('America/Denver', timezone('UTC', ts)) AS DATE)) AS INTEGER) + 1 AS lead_day FROM events""")
def run_times(spark, sf_dir):
    e = views.read(spark, sf_dir, "events")
    start = F.lit("2024-01-01").cast("timestamp_ntz")  # the evening of the day before, in local time
    return e.select("event_id", times.latest_init(F.col("ts")).alias("latest"), times.anchor_init(F.col("ts")).alias("anchor"), times.observation_hour(F.col("ts")).alias("observed"), times.lead_day(start, times.local_date("ts")).alias("lead_day"))


_LEDGER = "l AS (SELECT o_orderkey AS init, CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' ELSE 'FAILED' END AS status FROM orders WHERE o_orderkey % 3 = 0)"


@query(f"WITH {_LEDGER} SELECT o_orderkey AS init FROM orders WHERE o_orderkey NOT IN (SELECT init FROM l WHERE status = 'SUCCESS') ORDER BY init LIMIT 500")
def resume_anti_join(spark, sf_dir):
    o = views.read(spark, sf_dir, "orders")
    done = o.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("init"), F.when(F.col("o_orderstatus") == "F", "SUCCESS").otherwise("FAILED").alias("status"))
    return ledger.pending(o.select(F.col("o_orderkey").alias("init")), done, limit=500)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS init, o_orderstatus AS status, '' AS attempts, '' AS note FROM orders")
def ledger_upgrade(spark, sf_dir):
    old = views.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("init"), F.col("o_orderstatus").alias("status"))
    return ledger.upgraded(old).select("init", "status", "attempts", "note")


_NEED = {"possibilities": 3, "percentiles": 2, "weather": 1}


@query("""WITH f AS (SELECT o_custkey AS init, CASE o_orderkey % 3 WHEN 0 THEN 'possibilities' WHEN 1 THEN 'percentiles' ELSE 'weather' END AS product FROM orders),
c AS (SELECT init, count(*) FILTER (product = 'possibilities') AS n_possibilities, count(*) FILTER (product = 'percentiles') AS n_percentiles, count(*) FILTER (product = 'weather') AS n_weather FROM f GROUP BY init)
SELECT *, concat_ws('; ', CASE WHEN n_possibilities < 3 THEN concat('possibilities: ', n_possibilities, ' of 3') END, CASE WHEN n_percentiles < 2 THEN concat('percentiles: ', n_percentiles, ' of 2') END, CASE WHEN n_weather < 1 THEN concat('weather: ', n_weather, ' of 1') END) AS errors,
CASE WHEN n_possibilities >= 3 AND n_percentiles >= 2 AND n_weather >= 1 THEN 'SUCCESS' ELSE 'FAILED' END AS status FROM c""")
def case_completeness(spark, sf_dir):
    k = F.col("o_orderkey") % 3
    f = views.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("init"), F.when(k == 0, "possibilities").when(k == 1, "percentiles").otherwise("weather").alias("product"))
    return ledger.completeness(f, ["init"], "product", _NEED)


@query("SELECT o_orderstatus AS status, count(*) AS n, count(*) FILTER (o_orderkey % 100 BETWEEN 75 AND 79) AS retryable FROM orders GROUP BY 1")
def ledger_status(spark, sf_dir):
    o = views.read(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"), F.count_if(scalars.retryable(F.col("o_orderkey") % 100)).alias("retryable"))


def _files(spark, sf_dir):
    return views.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("case_id"), F.col("o_orderdate").alias("mtime"), F.col("o_orderkey").alias("file"))


_RANKED = "x AS (SELECT o_custkey AS case_id, o_orderdate AS mtime, o_orderkey AS file, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS INTEGER) AS rank FROM orders)"


@query(f"WITH {_RANKED} SELECT case_id, file, rank FROM x WHERE rank <= 3")
def retention_topn(spark, sf_dir):
    return ledger.newest(_files(spark, sf_dir), ["case_id"], "mtime", 3).select("case_id", "file", "rank")


@query(f"WITH {_RANKED} SELECT case_id, count(*) AS removed FROM x WHERE rank > 3 GROUP BY case_id")
def retention_removed(spark, sf_dir):
    return ledger.newest(_files(spark, sf_dir), ["case_id"], "mtime", 3, beyond=True).groupBy("case_id").agg(F.count("*").alias("removed"))


@query("""WITH r AS (SELECT DISTINCT user_id % 9 AS k, date_trunc('minute', ts) AS init FROM events), p AS (SELECT a.k, a.init, b.init AS previous FROM r a JOIN r b ON a.k = b.k AND b.init < a.init AND b.init >= a.init - INTERVAL 18 HOUR),
n AS (SELECT *, CAST(row_number() OVER (PARTITION BY k, init ORDER BY previous DESC) AS INTEGER) AS rank FROM p) SELECT k, init, previous, rank FROM n WHERE rank <= 2""")
def previous_outlooks(spark, sf_dir):
    runs = views.read(spark, sf_dir, "events").select((F.col("user_id") % 9).alias("k"), F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("init")).distinct()
    return ledger.previous_runs(runs, runs, "k", "init")


@query("""WITH b(name, low, high) AS (VALUES ('dry', NULL, 20.0::DOUBLE), ('middle', 20.0, 100.0), ('any', NULL, NULL), ('deep', 100.0, NULL)) SELECT name, count(*) AS n, round(avg(value), 6) + 0.0 AS mean FROM events JOIN b ON (low IS NULL OR value >= low) AND (high IS NULL OR value <= high) GROUP BY name""")
def bias_gating(spark, sf_dir):
    entries = spark.createDataFrame([("dry", None, 20.0), ("middle", 20.0, 100.0), ("any", None, None), ("deep", 100.0, None)], "name string, low double, high double")
    return rounded(ledger.bias_entries(views.read(spark, sf_dir, "events"), entries, "value").groupBy("name").agg(F.count("*").alias("n"), F.avg("value").alias("mean")))


@query("SELECT source, count(*) AS files, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents GROUP BY source")
def cache_totals(spark, sf_dir):
    d = views.read(spark, sf_dir, "documents").select("source", F.octet_length("text").alias("length"))
    return ledger.totals(d, ["source"])


@query("SELECT user_id, event_type FROM events UNION SELECT user_id % 7 AS user_id, event_type FROM events")
def deduplicated_union(spark, sf_dir):
    e = views.read(spark, sf_dir, "events").select("user_id", "event_type")
    return ledger.deduplicated(e, e.withColumn("user_id", F.col("user_id") % 7), ["user_id", "event_type"])


@query(f"""SELECT event_id, lpad(CAST(user_id % 31 AS VARCHAR), 3, '0') AS member, {sql.places('value / 50', 2)} + 0.0 AS poss, CAST({sql.places('value', 0)} AS BIGINT) AS whole FROM events""")
def names_and_rounding(spark, sf_dir):
    e = views.read(spark, sf_dir, "events")
    raw = F.concat(F.when(F.col("user_id") % 31 == 0, "c").otherwise("p"), (F.col("user_id") % 31).cast("string"))
    return rounded(e.select("event_id", scalars.member_name(raw).alias("member"), scalars.round_value(F.col("value") / 50, "possibility").alias("poss"), scalars.round_value(F.col("value"), "solar").alias("whole")))


@query("""WITH s AS (SELECT DISTINCT p_size AS span FROM part), c AS (SELECT span, c, i FROM s, (VALUES (1, 0), (2, 1), (5, 2), (10, 3), (20, 4), (50, 5), (100, 6), (200, 7), (500, 8), (1000, 9)) v(c, i)),
o AS (SELECT span, c, row_number() OVER (PARTITION BY span ORDER BY abs(floor(span / c) - 5), i) AS rn FROM c) SELECT span, c::DOUBLE AS step FROM o WHERE rn = 1""")
def tick_spacing(spark, sf_dir):
    return views.read(spark, sf_dir, "part").select(F.col("p_size").alias("span")).distinct().withColumn("step", scalars.tick_step(F.col("span")))


# Observations under the names that different sources have for their variables.
_ALIAS = """SELECT event_id, user_id, ts, value, ['sde', 'PRMSL', 'si10', 'sdswrf', 't2m', 'nothing'][event_id % 6 + 1] AS name FROM events"""


@query(f"""WITH v AS ({_ALIAS}) SELECT name, CASE lower(name) WHEN 'sde' THEN 'snow' WHEN 'prmsl' THEN 'mslp' WHEN 'si10' THEN 'wind' WHEN 'sdswrf' THEN 'solar' WHEN 't2m' THEN 'temp' END AS variable, count(*) AS n FROM v GROUP BY name""")
def synonym_lookup(spark, sf_dir):
    names = F.array(*map(F.lit, ("sde", "PRMSL", "si10", "sdswrf", "t2m", "nothing")))
    e = views.read(spark, sf_dir, "events").select(F.get(names, (F.col("event_id") % 6).cast("int")).alias("name"))
    return e.withColumn("variable", scalars.variable_of(F.col("name"))).groupBy("name", "variable").agg(F.count("*").alias("n"))


@query("SELECT event_id, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') - INTERVAL 6 HOUR AS previous, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') - INTERVAL 12 HOUR AS before_that FROM events")
def previous_inits(spark, sf_dir):
    e = views.read(spark, sf_dir, "events")
    return e.select("event_id", times.previous_init(F.col("ts")).alias("previous"), times.previous_init(F.col("ts"), 2).alias("before_that"))


# Texts: the prose has no markers, so discussions are put together from it.

_BODY = """d AS (SELECT doc_id, concat('---', chr(10), 'version: ', CASE WHEN doc_id % 4 = 0 THEN 'V1.2' ELSE '1.2' END, chr(10), CASE WHEN doc_id % 3 = 0 THEN '' ELSE concat('ALERT: level ', doc_id % 5, chr(10)) END, 'CONFIDENCE: ', CASE WHEN doc_id % 2 = 0 THEN 'high' ELSE 'low' END, chr(10),
'# Data', chr(10), 'see `out/run', doc_id % 7, '.csv` and `out/run', doc_id % 7, '.csv`', chr(10), '# Notes', chr(10), replace(text, '#', ' ')) AS body, text FROM documents)"""


def _bodies(spark, sf_dir):
    d = views.read(spark, sf_dir, "documents")
    k = F.col("doc_id")
    line = F.lit("\n")
    path = F.concat(F.lit("`out/run"), (k % 7).cast("string"), F.lit(".csv`"))
    body = F.concat(
        F.lit("---\nversion: "), F.when(k % 4 == 0, "V1.2").otherwise("1.2"), line,
        F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("ALERT: level "), (k % 5).cast("string"), line)),
        F.lit("CONFIDENCE: "), F.when(k % 2 == 0, "high").otherwise("low"), F.lit("\n# Data\nsee "), path, F.lit(" and "), path, F.lit("\n# Notes\n"), F.replace(F.col("text"), F.lit("#"), F.lit(" ")),
    )
    return d.select("doc_id", body.alias("body"), "text")


@query(f"WITH {_BODY} SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE concat('level ', doc_id % 5) END AS alert, CASE WHEN doc_id % 2 = 0 THEN 'high' ELSE 'low' END AS confidence, '1.2' AS version, concat('out/run', doc_id % 7, '.csv') AS paths FROM d")
def outlook_extract(spark, sf_dir):
    b = F.col("body")
    return _bodies(spark, sf_dir).select("doc_id", text.field(b, "ALERT").alias("alert"), text.field(b, "CONFIDENCE").alias("confidence"), text.version(text.field(b, "version")).alias("version"), F.array_join(text.paths(b), ",").alias("paths"))


@query(f"WITH {_BODY} SELECT doc_id, concat_ws(',', CASE WHEN doc_id % 3 = 0 THEN 'markers' END, CASE WHEN len(string_split(body, chr(10))) < 20 THEN 'short' END) AS failed FROM d")
def doc_validate(spark, sf_dir):
    found = text.failures(F.col("body"), ["ALERT:", "CONFIDENCE:"], F.lit("v1.2"), least_lines=20)
    return _bodies(spark, sf_dir).select("doc_id", F.array_join(found, ",").alias("failed"))


@query(f"WITH {_BODY} SELECT doc_id, CAST(contains(body, 'ALERT:') AS INTEGER) + CAST(contains(body, 'CONFIDENCE:') AS INTEGER) AS markers, CAST(len(string_split(body, chr(10))) AS INTEGER) AS n_lines, sha256(text) AS digest FROM d")
def outlook_markers(spark, sf_dir):
    marks = sum(F.contains("body", F.lit(m)).cast("int") for m in ("ALERT:", "CONFIDENCE:"))
    return _bodies(spark, sf_dir).select("doc_id", marks.alias("markers"), text.line_count(F.col("body")).alias("n_lines"), F.sha2("text", 256).alias("digest"))


@query("""WITH s AS (SELECT doc_id, trim(array_to_string(regexp_extract_all(text, '[^.!?]+[.!?]+')[1:2], '')) AS first_two FROM documents) SELECT doc_id, CASE WHEN length(first_two) > 300 THEN concat(substr(first_two, 1, 297), '...') ELSE first_two END AS summary FROM s""")
def first_sentences(spark, sf_dir):
    d = views.read(spark, sf_dir, "documents")
    return d.select("doc_id", text.truncated(text.sentences(F.col("text")), 300).alias("summary"))


@query("SELECT conv_id, turn, concat('Dear ', role, ', turn ', turn, ' of ', conv_id, '. ') AS letter FROM conversations")
def template_fill(spark, sf_dir):
    c = views.read(spark, sf_dir, "conversations")
    t = F.lit("Dear {{ROLE}}, turn {{TURN}} of {{CONV}}. {{NONE}}")
    return c.select("conv_id", "turn", text.filled(t, {"ROLE": F.col("role"), "TURN": F.col("turn"), "CONV": F.col("conv_id"), "NONE": F.lit(None).cast("string")}).alias("letter"))


@query()
def unicode_plain(spark, sf_dir):
    """Composed text without invisible characters; composition has no built-in function, the tests check it."""
    d = views.read(spark, sf_dir, "documents")
    return d.select("doc_id", F.sha2(text.plain(F.concat("text", F.lit("​"))), 256).alias("digest"))


@query()
def brace_expansion(spark, sf_dir):
    n = views.read(spark, sf_dir, "nation").select("n_nationkey", F.format_string("run%d/{p10,p50}/{a,b{1,2}}.json", "n_nationkey").alias("path"))
    return n.select("n_nationkey", F.explode(text.expanded("path")).alias("path"))


@query("""WITH d AS (SELECT user_id % 31 AS member, CAST(timezone('America/Denver', timezone('UTC', ts)) AS DATE) AS local_date, max(value) AS value, count(*) AS n FROM events GROUP BY ALL) SELECT member, local_date, round(value, 6) + 0.0 AS value, n FROM d""", days=("local_date",))
def stream_daily_max(spark, sf_dir):
    """The same table by a stream that reads what is there and ends."""
    return rounded(streaming.daily_max(spark, f"{sf_dir}/events.parquet"))


@query("""WITH f AS (SELECT concat('data/s', s_suppkey, '/run', s_suppkey % 40, '.csv') AS path FROM supplier), p AS (SELECT concat('data/s', p_partkey % 120, '/run', p_partkey % 120 % 40, '.csv') AS path, p_partkey AS id FROM part),
n AS (SELECT regexp_extract(path, '([^/]+)$', 1) AS b, count(DISTINCT path) AS n FROM f GROUP BY 1) SELECT id, p.path, p.path IN (SELECT path FROM f) OR coalesce(n = 1, false) AS found FROM p LEFT JOIN n ON regexp_extract(p.path, '([^/]+)$', 1) = b""")
def path_existence(spark, sf_dir):
    s = views.read(spark, sf_dir, "supplier").select(F.format_string("data/s%d/run%d.csv", "s_suppkey", F.col("s_suppkey") % 40).alias("path"))
    k = F.col("p_partkey") % 120
    p = views.read(spark, sf_dir, "part").select(F.format_string("data/s%d/run%d.csv", k, k % 40).alias("path"), F.col("p_partkey").alias("id"))
    return ledger.paths_found(p, s).select("id", "path", "found")


# A run's members come up to 25 hours after its start, by what their events hold; the run waits for 24.
@query("""WITH a AS (SELECT time_bucket(INTERVAL 12 HOUR, ts - to_minutes(15 * CAST(json_extract_string(props, '$.k') AS INTEGER)), TIMESTAMP '1970-01-01') AS init, CAST(user_id % 31 AS INTEGER) AS member, ts AS arrived, value FROM events),
f AS (SELECT init, member, min(arrived) AS arrived, arg_min(value, {'a': arrived, 'v': value}) AS value FROM a WHERE arrived <= init + INTERVAL 24 HOUR GROUP BY ALL),
r AS (SELECT init, CAST(count(*) AS INTEGER) AS n_members FROM f GROUP BY init HAVING count(*) = 31 OR init + INTERVAL 24 HOUR < (SELECT max(ts) FROM events))
SELECT r.init, m.member, f.value, f.arrived, CASE WHEN n_members = 31 THEN 'complete' ELSE 'deadline' END AS status, n_members
FROM r CROSS JOIN (SELECT CAST(unnest(range(31)) AS INTEGER) AS member) m LEFT JOIN f ON f.init = r.init AND f.member = m.member""")
def waiting_runs(spark, sf_dir):
    def arrivals(events):
        delay = F.make_dt_interval(mins=15 * F.get_json_object("props", "$.k").cast("int"))
        return events.select(times.floor_hours(F.col("ts") - delay, 12).alias("init"), (F.col("user_id") % 31).cast("int").alias("member"), F.col("ts").alias("arrived"), "value")

    return runs.run(spark, f"{sf_dir}/events.parquet", arrivals, 31)[0]


# Two writers with other headers, one of them started twice.
@query("""WITH a AS (SELECT CAST(o_orderkey AS VARCHAR) AS init, CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' ELSE 'FAILED' END AS status, CAST(o_custkey AS VARCHAR) AS job_id FROM orders)
SELECT init, status, '' AS attempts, job_id, '' AS note FROM a UNION ALL SELECT init, 'RETRIED', '2', '', '' FROM a WHERE status = 'FAILED'""")
def ledger_commits(spark, sf_dir):
    o = views.read(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "SUCCESS").otherwise("FAILED")
    path = sinks.folder(spark, "ledger")
    commits.append(o.select(F.col("o_orderkey").alias("init"), status.alias("status"), F.col("o_custkey").alias("job_id")), path, "first")
    again = o.where(status == "FAILED").select(F.lit("2").alias("attempts"), F.col("o_orderkey").alias("init"), F.lit("RETRIED").alias("status"))
    for _ in range(2):
        commits.append(again, path, "second")
    return commits.read(spark, path).select("init", "status", "attempts", "job_id", "note")


# Every member whose number is divisible by seven has lost its values.
@query("""WITH f AS (SELECT CAST(user_id % 31 AS INTEGER) AS member, CASE WHEN user_id % 31 % 7 <> 0 THEN 1000 + 0.5::DOUBLE * CAST(json_extract_string(props, '$.k') AS INTEGER) END AS mslp FROM events)
SELECT member, count(*) AS n_rows, count(mslp) AS n_known, min(mslp) AS low, quantile_disc(mslp, 0.5) AS median, quantile_disc(mslp, 0.9) AS p90, CASE WHEN count(mslp) = 0 THEN 'all_missing' ELSE 'written' END AS status, count(*) AS n_read FROM f GROUP BY member""")
def written_statistics(spark, sf_dir):
    f = views.forcing(spark, sf_dir).select("member", "valid_time", F.when(F.col("member") % 7 != 0, F.col("mslp")).alias("mslp"))
    path = sinks.folder(spark, "statistics")
    told = sinks.with_statistics(f, path, "member", "mslp", list(range(31)))
    there = spark.read.parquet(path).groupBy(F.col("member").cast("int").alias("member")).agg(F.count("*").alias("n_read"))
    return told.join(there, "member", "full")


# Documents cite files of their own and of other cases in all the ways that are allowed.
_CITED = """f AS (SELECT concat('/data/json_tests/CASE_', doc_id % 50, '/llm/doc', doc_id, '.md') AS path FROM documents UNION ALL SELECT concat('/data/json_tests/CASE_', doc_id % 50, '/weather/w', doc_id % 97, '.json') FROM documents),
p AS (SELECT DISTINCT path FROM f UNION SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1) FROM f),
c AS (SELECT doc_id, concat('/data/json_tests/CASE_', doc_id % 50) AS home, CAST(doc_id % 6 AS INTEGER) AS kind, CASE doc_id % 6 WHEN 0 THEN concat('doc', doc_id + doc_id % 4, '.md') WHEN 1 THEN concat('weather/w', doc_id % 101, '.json') WHEN 2 THEN concat('llm/doc', doc_id % 13, '*.md')
  WHEN 3 THEN concat('/data/json_tests/CASE_', doc_id % 60, '/llm') WHEN 4 THEN concat('CASE_{', doc_id % 70, ',', doc_id % 65, '}/weather/w?.json') ELSE concat('w', doc_id % 120, '.json') END AS path FROM documents),
w AS (SELECT regexp_extract(path, '([^/]*)$', 1) AS name FROM (SELECT DISTINCT path FROM f) GROUP BY 1 HAVING count(*) = 1)"""


@query(f"""WITH {_CITED} SELECT doc_id, path, CASE kind WHEN 0 THEN concat(home, '/llm/', path) IN (SELECT path FROM p) OR path IN (SELECT name FROM w) WHEN 1 THEN concat(home, '/', path) IN (SELECT path FROM p)
WHEN 2 THEN EXISTS (SELECT 1 FROM p WHERE p.path LIKE concat(home, '/llm/doc', doc_id % 13, '%.md')) WHEN 3 THEN path IN (SELECT path FROM p)
WHEN 4 THEN EXISTS (SELECT 1 FROM p WHERE regexp_full_match(p.path, concat('/data/json_tests/CASE_(', doc_id % 70, '|', doc_id % 65, ')/weather/w.[.]json'))) ELSE path IN (SELECT name FROM w) END AS found FROM c""")
def cited_paths(spark, sf_dir):
    d = views.read(spark, sf_dir, "documents")
    home = F.format_string("/data/json_tests/CASE_%d", F.col("doc_id") % 50)
    files = d.select(F.explode(F.array(F.concat(home, F.format_string("/llm/doc%d.md", "doc_id")), F.concat(home, F.format_string("/weather/w%d.json", F.col("doc_id") % 97)))).alias("path"))
    i = F.col("doc_id")
    path = (
        F.when(i % 6 == 0, F.format_string("doc%d.md", i + i % 4))
        .when(i % 6 == 1, F.format_string("weather/w%d.json", i % 101))
        .when(i % 6 == 2, F.format_string("llm/doc%d*.md", i % 13))
        .when(i % 6 == 3, F.format_string("/data/json_tests/CASE_%d/llm", i % 60))
        .when(i % 6 == 4, F.format_string("CASE_{%d,%d}/weather/w?.json", i % 70, i % 65))
        .otherwise(F.format_string("w%d.json", i % 120))
    )
    cited = d.select("doc_id", F.concat(home, F.lit("/llm/out.md")).alias("outlook"), path.alias("path"))
    return paths.found(cited, files, "/repo").select("doc_id", "path", "found")


@query("""WITH n AS (SELECT doc_id, strlen(text) * (doc_id % 7 + 1) * CASE doc_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 1000 ELSE 1000000 END AS n FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CASE WHEN n < 1024 THEN concat(n, ' B') WHEN n < 1048576 THEN concat(format('{:,.1f}', n / 1024), ' KB') WHEN n < 1073741824 THEN concat(format('{:,.1f}', n / 1048576), ' MB') ELSE concat(format('{:,.1f}', n / 1073741824), ' GB') END AS size,
CASE WHEN n < 60 THEN concat(n, 's') WHEN n < 3600 THEN concat(n // 60, 'm ', lpad(CAST(n % 60 AS VARCHAR), 2, '0'), 's') ELSE concat(n // 3600, 'h ', lpad(CAST(n % 3600 // 60 AS VARCHAR), 2, '0'), 'm') END AS duration FROM n""")
def human_sizes(spark, sf_dir):
    i = F.col("doc_id")
    n = F.octet_length("text").cast("long") * (i % 7 + 1) * F.when(i % 3 == 0, 1).when(i % 3 == 1, 1000).otherwise(1000000)
    d = views.read(spark, sf_dir, "documents").where("text is not null").select("doc_id", n.alias("n"))
    return d.select("doc_id", scalars.size_text(F.col("n")).alias("size"), scalars.duration_text(F.col("n")).alias("duration"))
