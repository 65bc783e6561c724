"""Queries of the scenario side: member metrics, distances, clusters."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from forelight.operators import cluster, ledger, tree
from forelight.plans import forecast, sql
from forelight.plans.base import r, registry, rounded
from forelight.sources import views
from forelight.sources.sinks import kept

QUERIES, ORACLES, query = registry()
_DAY = f"""{sql.DAILY}, days AS (SELECT *, CAST((local_date - DATE '2023-12-31') // 15 AS INTEGER) AS init, CAST((local_date - DATE '2023-12-31') % 15 AS INTEGER) AS day,
background IS NOT NULL AND NOT (member % 7 = 3 AND day(local_date) = 4) AS valid FROM daily)"""
_KEY = ["init", "member"]


def _forecasts(spark, sf_dir):
    """Daily values in runs (init) of fifteen days, with days counted from 0."""
    days = F.date_diff("local_date", F.lit("2023-12-31").cast("date"))
    d = forecast.daily_values(spark, sf_dir)
    return d.withColumns({"init": F.floor(days / 15).cast("int"), "day": (days % 15).cast("int"), "p50": F.col("ozone_50pc"), "p90": F.col("ozone_90pc")})


def _missing():
    """Days that are marked as missing."""
    return (F.col("member") % 7 == 3) & (F.dayofmonth("local_date") == 4)


def _days(spark, sf_dir):
    return cluster.valid_days(_forecasts(spark, sf_dir), _missing())


def _blocks(name: str, x: str) -> str:
    return ", ".join(f"avg(CASE WHEN valid AND day >= {a} {f'AND day < {b}' if b else ''} THEN {x} END) AS {name}_{block}" for block, a, b, _ in cluster.BLOCKS)


def _weighted(name: str) -> str:
    total = " + ".join(f"coalesce({name}_{b} * {w}::DOUBLE, 0)" for b, _, _, w in cluster.BLOCKS)
    weight = " + ".join(f"CASE WHEN {name}_{b} IS NULL THEN 0 ELSE {w}::DOUBLE END" for b, _, _, w in cluster.BLOCKS)
    return f"({total}) / nullif({weight}, 0) AS w_{name}"


_SOURCES = {"moderate": "moderate", "high": "elevated + extreme", "non_background": "moderate + elevated + extreme", "extreme": "extreme", "background": "background"}
_METRICS = f"{_DAY}, bm AS (SELECT init, member, {', '.join(_blocks(n, x) for n, x in _SOURCES.items())} FROM days GROUP BY init, member), metrics AS (SELECT init, member, {', '.join(_weighted(n) for n in _SOURCES)} FROM bm)"


@query(f"WITH {_METRICS} SELECT init, member, {r(*(f'w_{n}' for n in _SOURCES))}, round(w_non_background + 0.6 * w_extreme - 0.3 * w_background, 6) + 0.0 AS null_score FROM metrics")
def block_weighted_means(spark, sf_dir):
    m = cluster.member_metrics(_days(spark, sf_dir), _KEY)
    return rounded(m.select(*_KEY, *(f"w_{n}" for n in _SOURCES), "null_score"))


_SMALL = "events_by AS (SELECT user_id % 9 AS member, CAST(event_id % 15 AS INTEGER) AS day, max(CASE WHEN user_id % 9 IN (2, 5) THEN 0.0::DOUBLE ELSE (event_id % 5) / 5.0::DOUBLE END) AS moderate FROM events GROUP BY ALL), few AS (SELECT member, day, 1 - moderate AS background, moderate, 0.0::DOUBLE AS elevated, 0.0::DOUBLE AS extreme FROM events_by)"


def _few(spark, sf_dir):
    """Nine members of which two stay at the background."""
    e = views.read(spark, sf_dir, "events")
    calm = (F.col("user_id") % 9).isin(2, 5)
    d = e.groupBy((F.col("user_id") % 9).alias("member"), (F.col("event_id") % 15).cast("int").alias("day")).agg(F.max(F.when(calm, 0.0).otherwise((F.col("event_id") % 5) / 5.0)).alias("moderate"))
    d = d.select("member", "day", (1 - F.col("moderate")).alias("background"), "moderate", F.lit(0.0).alias("elevated"), F.lit(0.0).alias("extreme"))
    return cluster.valid_days(d)


@query(f"WITH {_SMALL} SELECT member, bool_and(background >= 1 - 1e-6 AND moderate <= 1e-6 AND elevated <= 1e-6 AND extreme <= 1e-6) AS strict_null FROM few GROUP BY member")
def strict_null_members(spark, sf_dir):
    return cluster.strict_null(_few(spark, sf_dir), ["member"])


@query(f"""WITH {_SMALL}, d AS (SELECT member % 3 AS ens, day, bool_or(moderate > 1e-6) AS active FROM few GROUP BY ALL), n AS (SELECT *, count(*) FILTER (active) OVER (PARTITION BY ens) AS n_active, count(*) OVER (PARTITION BY ens) AS n FROM d)
SELECT ens, day, active, n_active, round(CASE WHEN n_active = 0 THEN 1 / sqrt(n) WHEN active THEN 1 / sqrt(n_active) ELSE 0 END, 6) + 0.0 AS weight FROM n""")
def active_days(spark, sf_dir):
    return rounded(cluster.active_days(_few(spark, sf_dir).withColumn("ens", F.col("member") % 3), ["ens"]))


@query(f"""WITH {_METRICS} SELECT init, member, CASE WHEN w_non_background IS NULL OR w_high IS NULL OR w_extreme IS NULL THEN 'unknown' WHEN w_extreme >= 0.3 THEN 'extreme' WHEN w_high >= 0.5 THEN 'elevated' WHEN w_non_background >= 0.3 THEN 'moderate' ELSE 'background' END AS category,
CASE WHEN w_non_background IS NULL OR w_high IS NULL OR w_extreme IS NULL THEN 'unknown' WHEN w_extreme >= 0.3 THEN 'very high' WHEN w_high >= 0.5 THEN 'high' WHEN w_non_background >= 0.3 THEN 'medium' ELSE 'low' END AS risk FROM metrics""")
def risk_class(spark, sf_dir):
    m = cluster.member_metrics(_days(spark, sf_dir), _KEY)
    return m.select(*_KEY, cluster.risk_class(F.col("w_non_background"), F.col("w_high"), F.col("w_extreme")).alias("c")).select(*_KEY, "c.*")


# Distances between vectors, by ensembles of 31 members; dimension 3 of every eight of every fifth member is missing.

_VEC = "v AS (SELECT CAST(vec_id // 31 AS INTEGER) AS init, vec_id AS member, label, generate_subscripts(embedding, 1) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings)"
_HOLES = "w AS (SELECT init, member, label, dim, CASE WHEN member % 5 = 0 AND dim % 8 = 3 THEN NULL ELSE x END AS x FROM v)"
_Z = "z AS (SELECT init, member, dim, (x - avg(x) OVER d) / (stddev_pop(x) OVER d + 1e-6) AS z FROM w WINDOW d AS (PARTITION BY init, dim))"
_PAIRS = "pairs AS (SELECT a.init, a.member AS a, b.member AS b, coalesce(sqrt(sum((a.z - b.z) * (a.z - b.z))) * sqrt(count(*)::DOUBLE / nullif(count(a.z - b.z), 0)), 0) AS d FROM z a JOIN z b ON a.init = b.init AND a.dim = b.dim AND a.member < b.member GROUP BY ALL)"
_TWO_WAY = "two AS (SELECT init, a, b, d FROM pairs UNION ALL SELECT init, b, a, d FROM pairs)"
_DIST = f"{_VEC}, {_HOLES}, {_Z}, {_PAIRS}, {_TWO_WAY}"


def _vectors(spark, sf_dir):
    v = views.vectors(spark, sf_dir)
    long = v.select(*_KEY, F.posexplode("x").alias("pos", "x")).select(*_KEY, (F.col("pos") + 1).alias("dim"), "x")
    long = long.withColumn("x", F.when(~((F.col("member") % 5 == 0) & (F.col("dim") % 8 == 3)), F.col("x")))
    z = cluster.standardised(long, ["init"], "dim", "x")
    return z.groupBy(*_KEY).agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "z"))), lambda s: s["z"]).alias("x"))


def _distances(spark, sf_dir):
    return cluster.masked_distances(_vectors(spark, sf_dir), ["init"])


@query(f"WITH {_DIST} SELECT init, a, b, round(d, 5) + 0.0 AS d FROM pairs")
def masked_distance_pairs(spark, sf_dir):
    return rounded(_distances(spark, sf_dir), 5)


@query(f"WITH {_DIST} SELECT init, " + ", ".join(f"round(quantile_cont(d, {q}), 4) + 0.0 AS \"{n}\"" for n, q in (("min", 0.0), ("p25", 0.25), ("median", 0.5), ("p75", 0.75), ("max", 1.0))) + " FROM pairs GROUP BY init")
def distance_quantiles(spark, sf_dir):
    return rounded(cluster.distance_quantiles(_distances(spark, sf_dir), ["init"]), 4)


@query(f"WITH {_DIST}, n AS (SELECT init, a AS member, min(d) AS nearest FROM two GROUP BY ALL) SELECT init, member, round(nearest, 5) + 0.0 AS nearest FROM n QUALIFY row_number() OVER (PARTITION BY init ORDER BY n.nearest DESC, member) <= 5")
def nearest_neighbors(spark, sf_dir):
    return rounded(cluster.most_isolated(cluster.nearest_neighbours(_distances(spark, sf_dir), ["init"]), ["init"]), 5)


@query(f"""WITH {_DIST}, l AS (SELECT CAST(vec_id // 31 AS INTEGER) AS init, vec_id AS member, label % 3 AS cluster FROM embeddings), s AS (SELECT x.init, x.cluster, t.a, sum(t.d) AS s FROM two t JOIN l x ON t.a = x.member JOIN l y ON t.b = y.member WHERE x.cluster = y.cluster GROUP BY ALL),
e AS (SELECT l.init, l.cluster, member, coalesce(round(s, 9), 0) AS s FROM l LEFT JOIN s ON s.a = l.member AND s.cluster = l.cluster), o AS (SELECT *, row_number() OVER (PARTITION BY init, cluster ORDER BY s, member) AS rn, count(*) OVER (PARTITION BY init, cluster) AS size FROM e) SELECT init, CAST(cluster AS INTEGER) AS cluster, member AS medoid, size FROM o WHERE rn = 1""")
def medoids(spark, sf_dir):
    labels = views.vectors(spark, sf_dir).select(*_KEY, (F.col("label") % 3).alias("cluster"))
    return cluster.medoids(_distances(spark, sf_dir), labels, ["init"])


# Distances between forecasts


def _feature(kind: int, i: int, x: str) -> str:
    return f"SELECT init, member, day, {kind} AS kind, {i} AS i, CASE WHEN counts THEN {x} * weight END AS x FROM cells"


_FEATURES = f"""{_METRICS}, act AS (SELECT init, day, bool_or(valid AND (moderate > 1e-6 OR elevated > 1e-6 OR extreme > 1e-6)) AS active FROM days GROUP BY ALL),
wt AS (SELECT init, day, CASE WHEN count(*) FILTER (active) OVER w = 0 THEN 1 / sqrt(count(*) OVER w) WHEN active THEN 1 / sqrt(count(*) FILTER (active) OVER w) ELSE 0 END AS weight FROM act WINDOW w AS (PARTITION BY init)),
cells AS (SELECT m.init, m.member, wt.day, weight, moderate, elevated, extreme, ozone_50pc, ozone_90pc, background IS NOT NULL AND weight > 0 AS counts FROM (SELECT DISTINCT init, member FROM days) m JOIN wt USING (init) LEFT JOIN days d ON d.init = m.init AND d.member = m.member AND d.day = wt.day),
f AS ({' UNION ALL '.join(_feature(k, i, x) for i, (k, x) in enumerate(((1, 'moderate'), (1, 'elevated'), (1, 'extreme'), (2, 'ozone_50pc'), (2, 'ozone_90pc'))))}),
fz AS (SELECT init, member, day, kind, i, (x - avg(x) OVER d) / (stddev_pop(x) OVER d + 1e-6) AS z FROM f WINDOW d AS (PARTITION BY init, kind, i, day)),
fp AS (SELECT a.init, a.kind, a.member AS a, b.member AS b, coalesce(sqrt(sum((a.z - b.z) * (a.z - b.z))) * sqrt(count(*)::DOUBLE / nullif(count(a.z - b.z), 0)), 0) AS d FROM fz a JOIN fz b ON a.init = b.init AND a.kind = b.kind AND a.i = b.i AND a.day = b.day AND a.member < b.member GROUP BY ALL),
comb AS (SELECT init, a, b, max(d) FILTER (kind = 1) AS possibility, max(d) FILTER (kind = 2) AS percentile, 0.6::DOUBLE * max(d) FILTER (kind = 1) + 0.4::DOUBLE * max(d) FILTER (kind = 2) AS d FROM fp GROUP BY init, a, b)"""


@query(f"WITH {_FEATURES} SELECT init, a, b, {r('possibility', 'percentile', 'd', places=4)} FROM comb")
def combined_distance(spark, sf_dir):
    return rounded(cluster.scenario_distances(_days(spark, sf_dir), ["init"]), 4)


_SINGLES = f"""{_FEATURES}, ctwo AS (SELECT init, a, b, d FROM comb UNION ALL SELECT init, b, a, d FROM comb),
lab AS (SELECT init, member, CASE WHEN member < 4 THEN member ELSE 4 + member % 3 END AS cluster FROM (SELECT DISTINCT init, member FROM days)),
near AS (SELECT init, a AS member, min(d) AS nearest FROM ctwo GROUP BY ALL), q AS (SELECT init, quantile_cont(nearest, 0.75) AS nn_p75 FROM near GROUP BY init),
alone AS (SELECT * FROM lab QUALIFY count(*) OVER (PARTITION BY init, cluster) = 1),
cm AS (SELECT t.init, t.a AS member, l.cluster AS other, avg(d) AS mean FROM ctwo t JOIN alone s ON s.init = t.init AND s.member = t.a JOIN lab l ON l.init = t.init AND l.member = t.b WHERE l.cluster <> s.cluster GROUP BY ALL),
cl AS (SELECT init, member, other AS nearest_cluster FROM cm QUALIFY row_number() OVER (PARTITION BY init, member ORDER BY mean, other) = 1),
inside AS (SELECT t.init, t.a, t.d, y.cluster FROM ctwo t JOIN lab y ON y.init = t.init AND y.member = t.b),
sums AS (SELECT l.init, l.cluster, l.member, coalesce(round(sum(t.d), 9), 0) AS s FROM lab l LEFT JOIN inside t ON t.init = l.init AND t.a = l.member AND t.cluster = l.cluster GROUP BY ALL),
med AS (SELECT init, cluster, member FROM sums QUALIFY row_number() OVER (PARTITION BY init, cluster ORDER BY s, member) = 1),
pk AS (SELECT init, member, max(CASE WHEN valid THEN ozone_90pc END) AS peak FROM days GROUP BY ALL),
cnb AS (SELECT l.init, l.cluster, avg(w_non_background) AS nb FROM lab l JOIN metrics m ON m.init = l.init AND m.member = l.member GROUP BY ALL),
judged AS (SELECT s.init, s.member, cl.nearest_cluster, coalesce(nearest >= round(nn_p75, 4), false) AS isolated, coalesce(p.peak - mp.peak >= 4, false) AS p90_lift, coalesce(m.w_non_background - nb >= 0.01::DOUBLE, false) AS nb_lift
FROM alone s LEFT JOIN near ON near.init = s.init AND near.member = s.member LEFT JOIN q ON q.init = s.init LEFT JOIN cl ON cl.init = s.init AND cl.member = s.member LEFT JOIN pk p ON p.init = s.init AND p.member = s.member LEFT JOIN metrics m ON m.init = s.init AND m.member = s.member
LEFT JOIN med ON med.init = s.init AND med.cluster = cl.nearest_cluster LEFT JOIN pk mp ON mp.init = s.init AND mp.member = med.member LEFT JOIN cnb ON cnb.init = s.init AND cnb.cluster = cl.nearest_cluster)"""
_PASSED = "CAST(isolated AS INTEGER) + CAST(p90_lift AS INTEGER) + CAST(nb_lift AS INTEGER)"


@query(f"WITH {_SINGLES} SELECT init, member, nearest_cluster, isolated, p90_lift, nb_lift, {_PASSED} AS passed, CASE WHEN {_PASSED} >= 2 THEN 'primary' ELSE 'deemphasized' END AS display FROM judged")
def singleton_evidence(spark, sf_dir):
    """Four members of each run as clusters of their own, among three larger ones."""
    days = kept(_days(spark, sf_dir))
    pairs = kept(cluster.scenario_distances(days, ["init"]))
    m = F.col("member")
    labels = days.select(*_KEY).distinct().withColumn("cluster", F.when(m < 4, m).otherwise(4 + m % 3))
    medoid = cluster.medoids(pairs.select("init", "a", "b", "d"), labels, ["init"])
    singles = cluster.single_members(pairs, labels, medoid, cluster.member_metrics(days, _KEY), cluster.peaks(days, ["init"]), ["init"])
    return cluster.singleton_evidence(singles).select("init", "member", "nearest_cluster", "isolated", "p90_lift", "nb_lift", "passed", "display")


@query(f"WITH {_DAY} SELECT init, member, CAST(i - 1 AS INTEGER) AS i, round(x[i], 6) + 0.0 AS x FROM (SELECT init, member, list_concat(list(coalesce(elevated + extreme, 0) ORDER BY day), list(coalesce(extreme, 0) ORDER BY day)) AS x, unnest(range(1, 2 * count(*) + 1)) AS i FROM days GROUP BY init, member)")
def plain_features(spark, sf_dir):
    return rounded(cluster.plain_features(_days(spark, sf_dir), ["init"]).select(*_KEY, F.posexplode("x").alias("i", "x")))


@query(f"WITH {_DAY} SELECT init, member, CAST(i - 1 AS INTEGER) AS i, x[i] AS x FROM (SELECT init, member, list_concat(list(ozone_50pc ORDER BY day), list(ozone_90pc ORDER BY day)) AS x, unnest(range(1, 2 * count(*) + 1)) AS i FROM days WHERE day >= 5 AND day < 10 GROUP BY init, member HAVING count(*) = count(ozone_50pc + ozone_90pc))")
def window_features(spark, sf_dir):
    return cluster.window_features(_days(spark, sf_dir), ["init"], 5, 10).select(*_KEY, F.posexplode("x").alias("i", "x"))


def _ensembles(spark, sf_dir):
    return views.vectors(spark, sf_dir).select("init", "member", "x")


@query()
def cluster_assign(spark, sf_dir):
    """Average linkage and choice of the count, an ensemble of 31 members at a time; checked against NumPy in the tests."""
    v = _ensembles(spark, sf_dir)
    return cluster.assign(cluster.masked_distances(v, ["init"]), v, ["init"]).select("init", "member", "cluster")


@query()
def silhouette_k(spark, sf_dir):
    v = _ensembles(spark, sf_dir)
    out = cluster.assign(cluster.masked_distances(v, ["init"]), v, ["init"])
    return rounded(out.select("init", "k", "fallback_used", "min_size_guard_relaxed", "silhouette").distinct())


@query()
def dendrogram_merges(spark, sf_dir):
    return rounded(tree.merge_table(_ensembles(spark, sf_dir), ["init"]))


@query()
def dendrogram_leaves(spark, sf_dir):
    return rounded(tree.leaf_order(_ensembles(spark, sf_dir), ["init"], "average"))


@query()
def ward_clusters(spark, sf_dir):
    return cluster.ward_labels(_ensembles(spark, sf_dir), ["init"], 3)


@query(f"""WITH {_METRICS}, m AS (SELECT *, member % 4 AS c FROM metrics), p AS (SELECT init, c, min(member) AS first_member, count(*) AS n, CASE WHEN count(*) = count(w_non_background) THEN avg(w_non_background) END AS w_non_background, avg(w_high) AS w_high, avg(w_extreme) AS w_extreme FROM m GROUP BY init, c)
SELECT init, c, CAST(first_member AS INTEGER) AS first_member, n, round(n / sum(n) OVER (PARTITION BY init), 3) + 0.0 AS fraction, round(w_non_background, 6) + 0.0 AS w_non_background, round(w_high, 6) + 0.0 AS w_high, round(w_extreme, 6) + 0.0 AS w_extreme, CAST(row_number() OVER (PARTITION BY init ORDER BY w_non_background NULLS LAST, w_high NULLS LAST, first_member) AS INTEGER) AS rank FROM p""")
def cluster_profile(spark, sf_dir):
    m = cluster.member_metrics(_days(spark, sf_dir), _KEY).withColumn("c", F.col("member") % 4)
    whole = F.when(F.count("*") == F.count("w_non_background"), F.avg("w_non_background"))
    p = m.groupBy("init", "c").agg(F.min("member").alias("first_member"), F.count("*").alias("n"), whole.alias("w_non_background"), F.avg("w_high").alias("w_high"), F.avg("w_extreme").alias("w_extreme"))
    total = F.sum("n").over(Window.partitionBy("init"))
    return rounded(cluster.by_severity(p, ["init"]).withColumn("fraction", F.round(F.col("n") / total, 3)))


@query(f"""WITH {sql.FORCING}, m AS (SELECT member % 6 AS c, median(CASE WHEN member % 6 = 4 THEN snow / 4 ELSE snow END) / 25.4 AS inches, median(wind * (member % 6)) * 2.24 AS mph FROM forcing GROUP BY 1),
t AS (SELECT *, CASE WHEN inches > 2 THEN 'high' WHEN inches > 1 THEN 'moderate' ELSE 'low' END AS snow_tendency, CASE WHEN mph > 10 THEN 'breezy' WHEN mph > 5 THEN 'light' ELSE 'calm' END AS wind_tendency FROM m)
SELECT c, snow_tendency, wind_tendency, CASE WHEN snow_tendency = 'high' AND wind_tendency = 'calm' THEN 'stagnant cold pool' WHEN snow_tendency = 'low' AND wind_tendency = 'breezy' THEN 'active mixing' WHEN snow_tendency = 'moderate' THEN 'typical winter' ELSE 'variable' END AS pattern, {r('inches', 'mph', places=5)} FROM t""")
def weather_profile_labels(spark, sf_dir):
    f = views.forcing(spark, sf_dir).withColumn("c", F.col("member") % 6)
    f = f.withColumn("snow", F.when(F.col("c") == 4, F.col("snow") / 4).otherwise(F.col("snow"))).withColumn("wind", F.col("wind") * F.col("c"))
    return rounded(cluster.weather_profile(f, ["c"]), 5)


@query(f"WITH {_DAY} SELECT init, member, max(CASE WHEN valid THEN ozone_90pc END) AS peak FROM days GROUP BY ALL")
def p90_peak(spark, sf_dir):
    return cluster.peaks(_days(spark, sf_dir), ["init"])


@query(f"WITH {_DAY} SELECT init, member % 3 AS c, day, {', '.join(f'round(avg({x}), 6) + 0.0 AS {x}' for x in cluster.CATEGORIES)} FROM days GROUP BY ALL")
def cluster_mean_possibility(spark, sf_dir):
    return rounded(_days(spark, sf_dir).groupBy("init", (F.col("member") % 3).alias("c"), "day").agg(*(F.avg(x).alias(x) for x in cluster.CATEGORIES)))


@query("SELECT min(member) AS first, count(*) AS n, CASE WHEN count(*) > 1 THEN concat(min(member), ' (+', count(*) - 1, ' more)') ELSE CAST(min(member) AS VARCHAR) END AS label FROM (SELECT vec_id AS member, embedding FROM embeddings UNION ALL SELECT vec_id + 1000000, embedding FROM embeddings WHERE label < 5) GROUP BY embedding")
def identical_members(spark, sf_dir):
    """No two rows of the table are equal, so rows of some labels have a copy here."""
    e = views.read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("member"), "embedding", "label")
    both = e.unionByName(e.where("label < 5").withColumn("member", F.col("member") + 1_000_000))
    return ledger.identical_groups(both, "embedding", "member")


@query(f"WITH {_METRICS}, k AS (SELECT init, member, coalesce(w_non_background, 0) < 0.55 AS null_kind, w_high FROM metrics) SELECT init, round(avg(CAST(null_kind AS INTEGER)), 6) + 0.0 AS null_fraction, round(1 - avg(CAST(null_kind AS INTEGER)), 6) + 0.0 AS non_null_fraction, round(max(CASE WHEN NOT null_kind THEN w_high END), 6) + 0.0 AS max_high FROM k GROUP BY init")
def null_fractions(spark, sf_dir):
    m = cluster.member_metrics(_days(spark, sf_dir), _KEY)
    return rounded(cluster.calm_fractions(m, ["init"]))


def summaries(spark, sf_dir):
    """The clustering document of each run; the last member's percentiles didn't come in."""
    d = _forecasts(spark, sf_dir)
    weather = views.series(spark, sf_dir).select("init", "member", "snow", "wind")
    return cluster.summary(d, d.where("member <> 30").select(*_KEY, "day", "p50", "p90"), ["init"], weather, _missing())


@query()
def cluster_summary(spark, sf_dir):
    """From forecasts to clusters and their evidence; checked against NumPy in the tests."""
    return summaries(spark, sf_dir)
