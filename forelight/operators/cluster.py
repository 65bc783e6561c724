"""Scenario clustering of ensemble members: a null cluster first, then average linkage on what is left."""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forelight.operators import tree
from forelight.sources.sinks import kept

#: Days of the three blocks, their weights, and the strict background's tolerance.
BLOCKS = (("days_1_5", 0, 5, 0.55), ("days_6_10", 5, 10, 0.30), ("days_11_15", 10, None, 0.15))
TOLERANCE = 1e-6
#: Shares of the two distances, and the cluster counts tried.
POSSIBILITY_SHARE, PERCENTILE_SHARE = 0.60, 0.40
K_TRIED = (2, 3)
#: Evidence that keeps a cluster of one: criteria to pass, and the lifts they ask for.
PASSES, P90_LIFT, NON_BACKGROUND_LIFT = 2, 4.0, 0.01
CATEGORIES = ("background", "moderate", "elevated", "extreme")


def valid_days(df: DataFrame, missing: Column | None = None) -> DataFrame:
    """df with ``finite``: all categories have a value, and ``valid``: so they have, and the day isn't marked as missing."""
    known = F.lit(True)
    for c in CATEGORIES:
        known = known & F.col(c).isNotNull() & ~F.isnan(c)
    return df.withColumn("finite", known).withColumn("valid", known & ~F.coalesce(missing, F.lit(False)) if missing is not None else known)


def block_means(df: DataFrame, keys: list[str], values: dict[str, Column], day: str = "day") -> DataFrame:
    """Mean of each value per block of days (``<name>_<block>``) and weighted over the blocks that have one (``w_<name>``)."""
    aggs = []
    for name, x in values.items():
        for block, low, high, _ in BLOCKS:
            inside = (F.col(day) >= low) & (F.col(day) < high) if high is not None else F.col(day) >= low
            aggs.append(F.avg(F.when(inside, x)).alias(f"{name}_{block}"))
    out = df.groupBy(*keys).agg(*aggs)
    for name in values:
        parts = [(F.col(f"{name}_{b}"), w) for b, _, _, w in BLOCKS]
        weight = sum(F.when(p.isNotNull(), F.lit(w)).otherwise(0.0) for p, w in parts)
        total = sum(F.coalesce(p * w, F.lit(0.0)) for p, w in parts)
        out = out.withColumn(f"w_{name}", F.try_divide(total, weight))
    return out


def member_metrics(df: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted means of each member's possibilities over its valid days, and ``null_score`` (infinite without any)."""
    v = lambda x: F.when(F.col("valid"), x)
    high = F.col("elevated") + F.col("extreme")
    out = block_means(df, keys, {"moderate": v(F.col("moderate")), "high": v(high), "non_background": v(F.col("moderate") + high), "extreme": v(F.col("extreme")), "background": v(F.col("background"))})
    score = F.col("w_non_background") + 0.6 * F.col("w_extreme") - 0.3 * F.col("w_background")  # fixed weights
    return out.withColumn("null_score", F.coalesce(score, F.lit(float("inf"))))


def strict_null(df: DataFrame, keys: list[str]) -> DataFrame:
    """Members that are nothing but background on every valid day, of which they have at least one."""
    calm = (F.col("background") >= 1 - TOLERANCE) & (F.col("moderate") <= TOLERANCE) & (F.col("elevated") <= TOLERANCE) & (F.col("extreme") <= TOLERANCE)
    return df.where("valid").groupBy(*keys).agg(F.every(calm).alias("strict_null"))


def active_days(df: DataFrame, keys: list[str], day: str = "day") -> DataFrame:
    """Days on which any member is more than background; each key has at least all of its days if none is."""
    active = F.col("valid") & ((F.col("moderate") > TOLERANCE) | (F.col("elevated") > TOLERANCE) | (F.col("extreme") > TOLERANCE))
    days = df.groupBy(*keys, day).agg(F.bool_or(active).alias("active"))
    # Counted by groups, or over all, as one row for each; no window puts all days of a table into one task.
    totals = days.groupBy(*keys).agg(F.count_if("active").alias("n_active"), F.count("*").alias("_n"))
    both = days.join(totals, keys) if keys else days.crossJoin(F.broadcast(totals))
    return both.withColumn("weight", F.when(F.col("n_active") == 0, 1 / F.sqrt("_n")).when(F.col("active"), 1 / F.sqrt(F.col("n_active"))).otherwise(0.0)).drop("_n")


def standardised(df: DataFrame, group: list[str], dim: str, value: str) -> DataFrame:
    """z-scores over members of each dimension, by the population deviation and a little; missing ones stay missing."""
    stats = df.groupBy(*group, dim).agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    return df.join(stats, [*group, dim]).withColumn("z", (F.col(value) - F.col("_m")) / (F.col("_s") + 1e-6)).drop("_m", "_s")


def masked_distances(vectors: DataFrame, group: list[str], member: str = "member", x: str = "x") -> DataFrame:
    """(a, b, d) for a < b of each group: Euclidean over the dimensions both have, scaled up for those they lack; 0 if none.

    Pairs are within one ensemble, whose size is the model's number of members.
    """
    left = vectors.select(*group, F.col(member).alias("a"), F.col(x).alias("xa"))
    right = vectors.select(*group, F.col(member).alias("b"), F.col(x).alias("xb"))
    if not group:  # one ensemble, which is one group
        left, right = left.withColumn("_g", F.lit(0)), right.withColumn("_g", F.lit(0))
    pairs = left.join(right, group or "_g").where("a < b")
    gaps = F.filter(F.zip_with("xa", "xb", lambda p, q: (p - q) * (p - q)), lambda g: g.isNotNull())
    total = F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g)
    d = F.when(F.size(gaps) == 0, F.lit(0.0)).otherwise(F.sqrt(total) * F.sqrt(F.try_divide(F.size("xa").cast("double"), F.size(gaps).cast("double"))))
    return pairs.select(*group, "a", "b", d.alias("d"))


def combined(possibility: DataFrame, percentile: DataFrame, group: list[str]) -> DataFrame:
    both = possibility.join(percentile.withColumnRenamed("d", "d2"), [*group, "a", "b"])
    return both.select(*group, "a", "b", (POSSIBILITY_SHARE * F.col("d") + PERCENTILE_SHARE * F.col("d2")).alias("d"))


def distance_quantiles(pairs: DataFrame, group: list[str]) -> DataFrame:
    q = pairs.groupBy(*group).agg(F.percentile("d", [0.0, 0.25, 0.5, 0.75, 1.0]).alias("q"))
    return q.select(*group, *(F.round(F.get("q", F.lit(i)), 4).alias(n) for i, n in enumerate(("min", "p25", "median", "p75", "max"))))


def both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.unionByName(pairs.withColumnRenamed("a", "_t").withColumnRenamed("b", "a").withColumnRenamed("_t", "b").select(*pairs.columns))


def nearest_neighbours(pairs: DataFrame, group: list[str]) -> DataFrame:
    """Per member: the least distance to another one."""
    return both_ways(pairs).groupBy(*group, F.col("a").alias("member")).agg(F.min("d").alias("nearest"))


def most_isolated(nearest: DataFrame, group: list[str], n: int = 5) -> DataFrame:
    """The members of each group that are farthest from their nearest other one."""
    order = Window.partitionBy(*group).orderBy(F.desc("nearest"), "member")
    return nearest.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n).drop("_r")


def medoids(pairs: DataFrame, labels: DataFrame, group: list[str]) -> DataFrame:
    """Per cluster: the member with the least sum of distances to its others, of equals the first."""
    la = labels.select(*group, F.col("member").alias("a"), F.col("cluster"))
    lb = labels.select(*group, F.col("member").alias("b"), F.col("cluster").alias("_c"))
    inside = both_ways(pairs).join(la, [*group, "a"]).join(lb, [*group, "b"]).where(F.col("cluster") == F.col("_c"))
    sums = inside.groupBy(*group, "cluster", "a").agg(F.sum("d").alias("s"))
    every = la.join(sums, [*group, "cluster", "a"], "left").withColumn("s", F.coalesce("s", F.lit(0.0)))
    return every.groupBy(*group, "cluster").agg(F.min_by("a", F.struct(F.round("s", 9), F.col("a"))).alias("medoid"), F.count("*").alias("size"))


def upgma(d: np.ndarray, k: int) -> np.ndarray:
    """Average linkage down to k clusters; labels from 1 in order of first members."""
    return tree.cut(tree.linkage(d, "average"), k)


def ward(x: np.ndarray, k: int) -> np.ndarray:
    """Ward linkage of points down to k clusters; labels from 1 in order of first members."""
    return tree.cut(tree.linkage(np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)), "ward"), k)


def silhouette(d: np.ndarray, labels: np.ndarray) -> float:
    """Mean silhouette; -1 where it says nothing: under three members, one cluster, as many as members, or one of one."""
    sizes = np.bincount(labels)[np.unique(labels)]
    n, k = len(labels), len(sizes)
    if n < 3 or k < 2 or k >= n or sizes.min() < 2:
        return -1.0
    out = []
    for i in range(n):
        means = {c: d[i, labels == c].sum() / ((labels == c).sum() - (labels[i] == c)) for c in np.unique(labels)}
        a = means.pop(labels[i])
        b = min(means.values())
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def choose(d: np.ndarray) -> tuple[np.ndarray, dict]:
    """Labels for the best of the tried counts, and how it was found. Clusters of one are shunned from six members on, unless all counts have one.

    ``scores`` has the silhouette of each count, ``passing`` of those without a cluster that is too small.
    """
    n = len(d)
    how = {"k": 1, "fallback": False, "relaxed": False, "scores": {}, "passing": {}}
    if n <= 2:
        return np.ones(n, int), how
    least = 2 if n >= 6 else 1
    merges = tree.linkage(d, "average")
    tried = {k: tree.cut(merges, k) for k in K_TRIED if k <= n - 1}
    score = {k: silhouette(d, labels) for k, labels in tried.items()}
    passing = {k: score[k] for k, labels in tried.items() if np.bincount(labels)[1:].min() >= least}
    k = max(passing or score, key=lambda k: (score[k], -k))
    return tried[k], how | {"k": k, "fallback": not passing, "relaxed": not passing, "scores": score, "passing": passing}


def assign(pairs: DataFrame, members: DataFrame, group: list[str]) -> DataFrame:
    """Cluster labels of each group's members: one task holds one ensemble's distances, never more."""
    kinds = ", ".join(f"`{g}` {members.schema[g].dataType.simpleString()}" for g in group)
    rows = members.select(*group, F.col("member").alias("a"), F.col("member").alias("b"), F.lit(0.0).alias("d")).unionByName(pairs.select(*group, "a", "b", "d"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        names = sorted(set(pdf["a"]) | set(pdf["b"]))
        place = {m: i for i, m in enumerate(names)}
        d = np.zeros((len(names), len(names)))
        i, j = pdf["a"].map(place), pdf["b"].map(place)
        d[i, j] = d[j, i] = pdf["d"]
        labels, how = choose(d)
        out = pd.DataFrame({"member": names, "cluster": labels, "k": how["k"], "fallback_used": how["fallback"], "min_size_guard_relaxed": how["relaxed"], "silhouette": how["scores"].get(how["k"], -1.0)})
        for name in ("scores", "passing"):
            out[name] = [[{"k": str(k), "score": round(v, 4)} for k, v in how[name].items()]] * len(out)
        for g in group:
            out[g] = pdf[g].iloc[0]
        return out[[*group, *(c for c in out.columns if c not in group)]]

    kind = members.schema["member"].dataType.simpleString()
    return rows.groupBy(*group).applyInPandas(run, f"{kinds}, member {kind}, cluster int, k int, fallback_used boolean, min_size_guard_relaxed boolean, silhouette double, scores array<struct<k: string, score: double>>, passing array<struct<k: string, score: double>>")


def ward_labels(vectors: DataFrame, group: list[str], k: int = 3) -> DataFrame:
    """Ward clusters of each group's vectors."""
    kinds = ", ".join(f"`{g}` {vectors.schema[g].dataType.simpleString()}" for g in group)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("member")
        out = pdf[[*group, "member"]].copy()
        out["cluster"] = ward(np.stack(pdf["x"].map(np.asarray)), k)
        return out

    return vectors.groupBy(*group).applyInPandas(run, f"{kinds}, member {vectors.schema['member'].dataType.simpleString()}, cluster int")


#: Below this weighted non-background a member counts as calm where an ensemble is told by means alone, before it is clustered.
CALM = 0.55


def calm_fractions(metrics: DataFrame, group: list[str], limit: float = CALM) -> DataFrame:
    """(group, null_fraction, non_null_fraction, max_high): shares of calm members and of others, and the others' largest weighted high.

    A quick look at an ensemble by its weighted means; :func:`strict_null` and the clustering document tell by days.
    """
    calm = F.coalesce("w_non_background", F.lit(0.0)) < limit
    share = F.avg(calm.cast("double"))
    return metrics.groupBy(*group).agg(share.alias("null_fraction"), (1 - share).alias("non_null_fraction"), F.max(F.when(~calm, F.col("w_high"))).alias("max_high"))


def by_severity(profile: DataFrame, group: list[str]) -> DataFrame:
    """Clusters numbered from 1 by mean non-background, then mean high, then their first member."""
    w = Window.partitionBy(*group).orderBy(F.asc_nulls_last("w_non_background"), F.asc_nulls_last("w_high"), "first_member")
    return profile.withColumn("rank", F.row_number().over(w))


def risk_class(non_background: Column, high: Column, extreme: Column) -> Column:
    """(dominant category, risk level)."""
    pair = lambda a, b: F.struct(F.lit(a).alias("category"), F.lit(b).alias("risk"))
    return (
        F.when(non_background.isNull() | high.isNull() | extreme.isNull(), pair("unknown", "unknown"))
        .when(extreme >= 0.30, pair("extreme", "very high"))
        .when(high >= 0.50, pair("elevated", "high"))
        .when(non_background >= 0.30, pair("moderate", "medium"))
        .otherwise(pair("background", "low"))
    )


def weather_profile(df: DataFrame, keys: list[str]) -> DataFrame:
    """Median snow (mm) and wind (m/s) of a cluster as words."""
    m = df.groupBy(*keys).agg((F.percentile("snow", 0.5) / 25.4).alias("inches"), (F.percentile("wind", 0.5) * 2.24).alias("mph"))
    snow = F.when(F.col("inches").isNull(), "unknown").when(F.col("inches") > 2, "high").when(F.col("inches") > 1, "moderate").otherwise("low")
    wind = F.when(F.col("mph").isNull(), "unknown").when(F.col("mph") > 10, "breezy").when(F.col("mph") > 5, "light").otherwise("calm")
    pattern = F.when((snow == "high") & (wind == "calm"), "stagnant cold pool").when((snow == "low") & (wind == "breezy"), "active mixing").when(snow == "moderate", "typical winter").otherwise("variable")
    return m.select(*keys, snow.alias("snow_tendency"), wind.alias("wind_tendency"), pattern.alias("pattern"), "inches", "mph")


def singleton_evidence(singles: DataFrame) -> DataFrame:
    """Whether clusters of one are kept: isolation, a lift of p90, a lift of non-background, of which two must hold.

    ``singles``: nearest, nn_p75, p90, neighbour_p90, w_nb, neighbour_w_nb; what is missing passes no test.
    """
    tests = {"isolated": F.col("nearest") >= F.round("nn_p75", 4), "p90_lift": F.col("p90") - F.col("neighbour_p90") >= P90_LIFT, "nb_lift": F.col("w_nb") - F.col("neighbour_w_nb") >= NON_BACKGROUND_LIFT}
    out = singles.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in tests.items()})
    passed = sum(F.col(k).cast("int") for k in tests)
    reasons = F.array_compact(F.array(*(F.when(F.col(k), F.lit(k)) for k in tests)))
    out = out.withColumn("passed", passed).withColumn("display", F.when(F.col("passed") >= PASSES, "primary").otherwise("deemphasized"))
    out = out.withColumn("reason", F.when(F.col("passed") < PASSES, "weak_singleton_evidence"))
    return out.withColumn("reasons", F.when(F.size(reasons) > 0, reasons).otherwise(F.array(F.lit("no_criteria_passed"))))


# From forecasts to scenarios


def features(days: DataFrame, group: list[str], among: DataFrame | None = None) -> DataFrame:
    """(group, kind, member, x): each member's vectors of kind possibility and percentile.

    ``days``: group, member, day, the categories, p50, p90, finite and valid. The
    dimensions are features by all days that any member has; values count on
    the days on which any member is more than background, by one over the root of
    their number, and are standardised over members. Others are missing. ``among``
    (group, member) are the members that get vectors; all decide on the days.
    """
    weights = active_days(days, group).select(*group, "day", "weight")
    members = (days if among is None else among).select(*group, "member").distinct()
    cells = members.join(weights, group).join(days, [*group, "member", "day"], "left")
    # A day marked as missing but with values counts here: only values that aren't there do not.
    counts = F.coalesce("finite", F.lit(False)) & (F.col("weight") > 0)
    named = [("possibility", c) for c in CATEGORIES[1:]] + [("percentile", c) for c in ("p50", "p90")]
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(i).alias("i"), F.when(counts & ~F.isnan(c), F.col(c) * F.col("weight")).alias("v")) for i, (k, c) in enumerate(named))))
    long = cells.select(*group, "member", "day", each.alias("f")).select(*group, "member", "day", "f.*")
    long = long.withColumn("dim", F.struct("i", "day"))
    z = standardised(long, [*group, "kind"], "dim", "v")
    return z.groupBy(*group, "kind", "member").agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "z"))), lambda s: s["z"]).alias("x"))


def plain_features(days: DataFrame, group: list[str]) -> DataFrame:
    """(group, member, x): elevated with extreme, then extreme, by day, missing values as zeros: the older vectors."""
    high = F.coalesce(F.nanvl(F.col("elevated") + F.col("extreme"), F.lit(0.0)), F.lit(0.0))
    extreme = F.coalesce(F.nanvl("extreme", F.lit(0.0)), F.lit(0.0))
    rows = days.groupBy(*group, "member").agg(F.array_sort(F.collect_list(F.struct("day", high.alias("a"), extreme.alias("b")))).alias("r"))
    return rows.select(*group, "member", F.concat(F.col("r")["a"], F.col("r")["b"]).alias("x"))


def window_features(days: DataFrame, group: list[str], first: int, stop: int, columns: tuple[str, ...] = ("p50", "p90")) -> DataFrame:
    """(group, member, x): the columns one after the other over the days from ``first`` to before ``stop``; members with a missing value are dropped."""
    inside = days.where((F.col("day") >= first) & (F.col("day") < stop))
    whole = F.every(F.expr(" AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in columns)))
    rows = inside.groupBy(*group, "member").agg(F.array_sort(F.collect_list(F.struct("day", *columns))).alias("r"), whole.alias("_whole")).where("_whole")
    return rows.select(*group, "member", F.concat(*(F.col("r")[c] for c in columns)).alias("x"))


def scenario_distances(days: DataFrame, group: list[str], among: DataFrame | None = None) -> DataFrame:
    """(group, a, b, d, possibility, percentile): the combined distance of the members, and its two parts."""
    vectors = features(days, group, among)
    parts = [masked_distances(vectors.where(F.col("kind") == k).drop("kind"), group) for k in ("possibility", "percentile")]
    both = parts[0].withColumnRenamed("d", "possibility").join(parts[1].withColumnRenamed("d", "percentile"), [*group, "a", "b"])
    return both.withColumn("d", POSSIBILITY_SHARE * F.col("possibility") + PERCENTILE_SHARE * F.col("percentile"))


def peaks(days: DataFrame, group: list[str]) -> DataFrame:
    """(group, member, peak): the largest p90 of each member's valid days."""
    return days.groupBy(*group, "member").agg(F.max(F.when(F.col("valid") & ~F.isnan("p90"), F.col("p90"))).alias("peak"))


def single_members(pairs: DataFrame, labels: DataFrame, medoid: DataFrame, metrics: DataFrame, peak: DataFrame, group: list[str]) -> DataFrame:
    """What :func:`singleton_evidence` asks of each cluster of one: group, cluster, member, nearest_cluster and its columns.

    ``labels``: group, member, cluster, of scenarios only; ``medoid``: group, cluster, medoid.
    """
    near = nearest_neighbours(pairs, group)
    p75 = near.groupBy(*group).agg(F.percentile("nearest", 0.75).alias("nn_p75"))
    alone = labels.withColumn("_n", F.count("*").over(Window.partitionBy(*group, "cluster"))).where("_n = 1").drop("_n")
    other = labels.select(*group, F.col("member").alias("b"), F.col("cluster").alias("other"))
    apart = both_ways(pairs.select(*group, "a", "b", "d")).join(alone.withColumnRenamed("member", "a"), [*group, "a"]).join(other, [*group, "b"]).where("other <> cluster")
    means = apart.groupBy(*group, F.col("a").alias("member"), "other").agg(F.avg("d").alias("mean"))
    closest = means.groupBy(*group, "member").agg(F.min_by("other", F.struct("mean", "other")).alias("nearest_cluster"))
    nb = metrics.select(*group, "member", "w_non_background")
    cluster_nb = labels.join(nb, [*group, "member"]).groupBy(*group, F.col("cluster").alias("nearest_cluster")).agg(F.avg("w_non_background").alias("neighbour_w_nb"))
    medoid_peak = medoid.select(*group, F.col("cluster").alias("nearest_cluster"), F.col("medoid").alias("member")).join(peak, [*group, "member"]).select(*group, "nearest_cluster", F.col("peak").alias("neighbour_p90"))
    out = alone.join(near, [*group, "member"], "left").join(p75, group, "left").join(closest, [*group, "member"], "left")
    out = out.join(peak.withColumnRenamed("peak", "p90"), [*group, "member"], "left").join(nb.withColumnRenamed("w_non_background", "w_nb"), [*group, "member"], "left")
    return out.join(medoid_peak, [*group, "nearest_cluster"], "left").join(cluster_nb, [*group, "nearest_cluster"], "left")


def _quantile_document(values: str) -> Column:
    q = F.percentile(values, [0.0, 0.25, 0.5, 0.75, 1.0])
    return F.struct(F.count(values).alias("n_pairs"), *(F.round(F.get(q, F.lit(i)), 4).alias(n) for i, n in enumerate(("min", "p25", "median", "p75", "max"))))


def summary(possibility: DataFrame, percentile: DataFrame, group: list[str], weather: DataFrame | None = None, missing: Column | None = None) -> DataFrame:
    """(group, json): one document per ensemble, from daily possibilities and percentiles to clusters and their evidence.

    ``possibility``: group, member, day (from 0) and the categories; ``percentile``:
    group, member, day, p50, p90; ``weather``: group, member, snow, wind;
    ``missing`` marks days of ``possibility`` that only look like values. Members
    that only one of the two has are listed and left out. Members that stay at the
    background are cluster 0; the others are joined by average linkage of the
    combined distance and numbered by severity. A group is an ensemble, some tens of members.
    """
    at = [*group, "member"]
    a = possibility.select(*at).distinct().withColumn("_p", F.lit(True))
    b = percentile.select(*at).distinct().withColumn("_q", F.lit(True))
    known = a.join(b, at, "full_outer")
    dropped = known.groupBy(*group).agg(*(F.array_sort(F.collect_list(F.when(F.col(c).isNull(), F.col("member")))).alias(n) for c, n in (("_q", "missing_percentiles"), ("_p", "missing_possibilities"))))
    members = known.where("_p and _q").select(*at)
    days = valid_days(possibility.drop("p50", "p90"), missing).join(members, at, "left_semi").join(percentile.select(*at, "day", "p50", "p90"), [*at, "day"], "left")
    days = kept(days, "days")
    metrics = kept(member_metrics(days, at), "metrics")
    calm = members.join(strict_null(days, at), at, "left").withColumn("calm", F.coalesce("strict_null", F.lit(False))).select(*at, "calm")
    calm = kept(calm, "calm")
    lively = calm.where("not calm").select(*at)
    pairs = kept(scenario_distances(days, group, lively), "pairs")
    assigned = kept(assign(pairs, lively, group), "assigned")
    raw = assigned.select(*at, F.col("cluster").alias("raw"))
    severity = raw.join(metrics, at).groupBy(*group, "raw").agg(F.avg("w_non_background").alias("w_non_background"), F.avg("w_high").alias("w_high"), F.min("member").alias("first_member"))
    numbered = by_severity(severity, group).select(*group, "raw", F.col("rank").cast("int").alias("cluster"))
    scenarios = kept(raw.join(numbered, [*group, "raw"]).select(*at, "cluster"), "scenarios")
    labels = scenarios.unionByName(calm.where("calm").select(*at, F.lit(0).alias("cluster")))

    calmest = calm.where("calm").join(metrics, at).groupBy(*group).agg(F.lit(0).alias("cluster"), F.min_by("member", F.struct("null_score", "member")).alias("medoid"))
    scenario_medoids = medoids(pairs.select(*group, "a", "b", "d"), scenarios, group).select(*group, "cluster", "medoid")
    evidence = singleton_evidence(single_members(pairs, scenarios, scenario_medoids, metrics, peaks(days, group), group))
    # A lone scenario has nothing to be compared with.
    evidence = evidence.where("nearest is not null")
    criteria = F.struct(*(F.struct(F.col(k).alias("passed"), *(F.round(v, p).alias(v) for v, p in values)).alias(k) for k, values in (("isolated", (("nearest", 4), ("nn_p75", 4))), ("p90_lift", (("p90", 3), ("neighbour_p90", 3))), ("nb_lift", (("w_nb", 4), ("neighbour_w_nb", 4))))))
    evidence = evidence.select(*group, "cluster", F.struct(F.round(F.col("passed") / 3, 3).alias("score"), (F.col("passed") >= PASSES).alias("passed"), "reasons", criteria.alias("criteria"), "nearest_cluster").alias("_e"), "display", "reason")
    evidence = kept(evidence, "evidence")

    whole = lambda c: F.when(F.count("*") == F.count(c), F.avg(c)).alias(c)
    weights = [c for c in metrics.columns if c.startswith("w_")]
    p = labels.join(metrics, at).groupBy(*group, "cluster").agg(F.array_sort(F.collect_list("member")).alias("members"), F.count("*").alias("n"), *(whole(c) for c in weights))
    p = p.join(scenario_medoids.unionByName(calmest.select(*group, "cluster", "medoid")), [*group, "cluster"]).join(evidence, [*group, "cluster"], "left")
    if weather is None:
        p = p.withColumns({c: F.lit("unknown") for c in ("snow_tendency", "wind_tendency")} | {"pattern": F.lit("variable")})
    else:
        told = weather_profile(weather.join(labels, at), [*group, "cluster"]).select(*group, "cluster", "snow_tendency", "wind_tendency", "pattern")
        p = p.join(told, [*group, "cluster"], "left").fillna({"snow_tendency": "unknown", "wind_tendency": "unknown", "pattern": "variable"})
    total = F.sum("n").over(Window.partitionBy(*group))
    scenario = F.col("cluster") > 0
    risk = risk_class(F.col("w_non_background"), F.col("w_high"), F.col("w_extreme"))
    untried = F.array(F.when(scenario, "not_applicable_non_singleton").otherwise("not_applicable_non_scenario"))
    judged = F.struct(F.coalesce("_e.score", F.lit(1.0)).alias("score"), F.coalesce("_e.passed", F.lit(True)).alias("passed"), F.coalesce("_e.reasons", untried).alias("reasons"), F.col("_e.criteria").alias("criteria"), F.col("_e.nearest_cluster").alias("nearest_cluster"))
    p = p.withColumn("fraction", F.round(F.col("n") / total, 3)).withColumn("risk", risk)
    one = F.struct(
        F.col("cluster").alias("id"),
        F.when(scenario, "scenario").otherwise("null").alias("kind"),
        "members",
        "medoid",
        "fraction",
        F.struct(F.col("risk.category").alias("dominant_category"), F.col("risk.risk").alias("risk_level"), *(F.round(w, 3).alias(w) for w in weights)).alias("ozone"),
        F.struct("snow_tendency", "wind_tendency", "pattern").alias("weather"),
        judged.alias("evidence"),
        F.struct(F.coalesce("display", F.lit("primary")).alias("status"), F.col("reason").alias("warning_code")).alias("display"),
    )
    clusters = p.withColumn("doc", one).groupBy(*group).agg(
        F.array_sort(F.collect_list("doc")).alias("clusters"),
        F.transform(F.array_sort(F.collect_list(F.struct("cluster", "medoid"))), lambda x: x["medoid"]).alias("representative_members"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cluster", F.format_string("%s → %s ozone (Cluster %d)", "pattern", "risk.category", "cluster").alias("t")))), lambda x: x["t"]), ". ").alias("_linkage"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cluster", F.format_string("%d%% %s risk", F.round(100 * F.col("fraction")).cast("int"), "risk.risk").alias("t")))), lambda x: x["t"]), ", ").alias("_spread"),
        F.count("*").alias("n_clusters"),
        F.sum("n").alias("n_members"),
        F.sum(F.when(F.col("cluster") == 0, F.col("n")).otherwise(0)).alias("strict_null_members"),
        F.count_if(F.col("display") == "deemphasized").alias("weak_singleton_clusters"),
    )
    chosen = assigned.groupBy(*group).agg(F.max("k").alias("selected_k"), F.bool_or("fallback_used").alias("fallback_used"), F.bool_or("min_size_guard_relaxed").alias("min_size_guard_relaxed"), *(F.map_from_entries(F.array_sort(F.first(c))).alias(n) for c, n in (("scores", "silhouette_scores"), ("passing", "scores_passing_min_size"))))
    window = active_days(days, group).groupBy(*group).agg(F.count_if("active").alias("active_days"), F.count("*").alias("total_days"))
    distances = pairs.groupBy(*group).agg(F.struct(*(_quantile_document(c).alias(n) for c, n in (("possibility", "possibility"), ("percentile", "percentile"), ("d", "combined")))).alias("distance_diagnostics"))
    near = nearest_neighbours(pairs.select(*group, "a", "b", "d"), group)
    top = F.transform(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("nearest")).alias("o"), "member"))), 1, 5), lambda x: F.struct(x["member"].alias("member"), F.round(-x["o"], 4).alias("nearest_distance")))
    near = near.groupBy(*group).agg(F.struct(*(F.round(F.percentile("nearest", q), 4).alias(n) for n, q in (("median", 0.5), ("p75", 0.75), ("max", 1.0))), top.alias("top_members")).alias("nearest_neighbor"))
    assignment = labels.groupBy(*group).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("member").cast("string"), "cluster")))).alias("member_assignment"))
    out = clusters
    for part in (chosen, window, distances, near, assignment, dropped):
        out = out.join(part, group, "left")
    out = out.fillna({"selected_k": 0, "fallback_used": False, "min_size_guard_relaxed": False})
    flags = F.struct(
        # Background is told by days alone, so nothing falls back and the cluster is as large as it is.
        F.lit(False).alias("null_fallback_applied"),
        F.col("strict_null_members").alias("null_selected_by_threshold"),
        F.col("strict_null_members").alias("null_target_size"),
        "strict_null_members",
        (F.col("n_members") - F.col("strict_null_members")).alias("non_null_members"),
        (F.col("n_members") == F.col("strict_null_members")).alias("strict_all_background"),
        F.col("active_days").alias("active_window_days"),
        "min_size_guard_relaxed",
        "weak_singleton_clusters",
        F.col("missing_percentiles").alias("dropped_members_missing_percentiles"),
        F.col("missing_possibilities").alias("dropped_members_missing_possibilities"),
    )
    strict = F.struct(F.lit(1.0).alias("background_target"), F.lit(0.0).alias("other_target"), F.lit(TOLERANCE).alias("tolerance"))
    window_told = F.struct(F.lit("ensemble_non_background_days").alias("name"), "active_days", "total_days")
    first = F.struct(F.lit("strict_background_only").alias("name"), F.lit("ignore_missing_days").alias("missing_data_policy"), strict.alias("strict_all_background"), window_told.alias("active_window"))
    second = F.struct(
        F.lit("agglomerative_average_precomputed_distance").alias("name"),
        F.lit(1).alias("k_min"),
        F.lit(max(K_TRIED)).alias("k_max"),
        "selected_k",
        "silhouette_scores",
        "scores_passing_min_size",
        "min_size_guard_relaxed",
        "fallback_used",
        F.struct(F.lit(POSSIBILITY_SHARE).alias("possibility"), F.lit(PERCENTILE_SHARE).alias("percentile")).alias("distance_weights"),
        "distance_diagnostics",
        "nearest_neighbor",
        F.lit("evidence_gated_lenient").alias("singleton_policy"),
        F.struct(F.lit(PASSES).alias("min_pass_criteria"), F.lit("nearest_distance >= nearest_neighbor_p75").alias("separation_rule"), F.lit(P90_LIFT).alias("p90_lift_ppb"), F.lit(NON_BACKGROUND_LIFT).alias("weighted_non_background_lift")).alias("singleton_evidence_thresholds"),
    )
    blocks = F.struct(F.array(*(F.lit(b) for b, *_ in BLOCKS)).alias("names"), F.array(*(F.lit(w) for *_, w in BLOCKS)).alias("weights"))
    document = F.struct(
        F.lit("1.3").alias("schema_version"),
        *(F.col(g).cast("string").alias(g) for g in group),
        F.struct(first.alias("stage_1"), second.alias("stage_2"), blocks.alias("time_blocks")).alias("method"),
        "n_members",
        "n_clusters",
        "clusters",
        "representative_members",
        "member_assignment",
        F.concat("_linkage", F.lit(".")).alias("linkage_note"),
        F.concat(F.col("n_clusters").cast("string"), F.lit(" clusters; "), F.col("_spread")).alias("spread_summary"),
        flags.alias("quality_flags"),
    )
    return out.select(*group, F.to_json(document, {"ignoreNullFields": "false"}).alias("json"))
