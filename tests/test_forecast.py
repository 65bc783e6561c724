"""Forecast operators on hand-made tables: golden values, missing values, daylight saving, ties."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from forelight.functions import fuzzy, scalars, times
from forelight.functions.quantile import hazen, linear
from forelight.operators import asof, cluster, daily, ensemble, products, representative, spatial, verify

SYSTEM = fuzzy.System()
GOLDEN = [
    ((0, 1020, 1, 500), (1, 0, 0, 0), (26, 35, 44)),
    ((100, 1040, 1, 750), (0, 0, 0, 1), (71, 88, 108)),
    ((100, 1040, 1, 400), (0, 0, 1, 0), (57, 69, 81)),
    ((100, 1040, 1, 100), (0, 1, 0, 0), (46, 55, 64)),
    ((100, 1020, 1, 400), (0, 1, 0, 0), (46, 55, 64)),
    ((100, 1020, 1, 100), (0, 0, 0, 0), (None, None, None)),
    ((75, 1030, 3, 450), (0.5, 0.5, 0.5, 0), (29, 54, 80)),
    ((120, 1032, 2.5, 600), (0.25, 0.5, 0.5, 0.5), (38, 74, 108)),
    ((85, 1012, 1.5, 650), (0.6, 0.25, 0.4, 0), (28, 49, 80)),
    ((None, 1020, 1, 500), (None,) * 4, (None,) * 3),
]


def ts(text):
    return dt.datetime.fromisoformat(text)


def test_golden_inference(spark):
    rows = [(i, *map(lambda v: None if v is None else float(v), x)) for i, (x, _, _) in enumerate(GOLDEN)]
    df = SYSTEM.infer(spark.createDataFrame(rows, "id int, snow double, mslp double, wind double, solar double"))
    for r in df.collect():
        _, poss, pct = GOLDEN[r.id]
        for c, p in zip(fuzzy.OUTPUT, poss, strict=True):
            assert r[c] is None if p is None else r[c] == pytest.approx(p, abs=1e-9)
        assert (r.ozone_10pc, r.ozone_50pc, r.ozone_90pc) == pct


def test_percentiles_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = np.arange(20, 140.1, 0.5)
    shapes = {c: np.interp(x, p, [0, 1, 1, 0], 0, 0) for c, p in fuzzy.OUTPUT.items()}
    rows = [(i, *map(float, rng.random(4) * (rng.random(4) > 0.4))) for i in range(200)]
    out = SYSTEM.percentiles(spark.createDataFrame(rows, "id int, background double, moderate double, elevated double, extreme double")).collect()
    for r in out:
        y = np.max([np.minimum(shapes[c], r[c]) for c in shapes], axis=0)
        area = np.concatenate([[0], np.cumsum((y[1:] + y[:-1]) / 2 * 0.5)])
        got = (r.ozone_10pc, r.ozone_50pc, r.ozone_90pc)
        if area[-1] == 0:
            assert got == (None, None, None)
            continue
        for p, g in zip((0.1, 0.5, 0.9), got, strict=True):
            assert abs(np.interp(p, area / area[-1], x) - g) <= 0.5 + 1e-6
        assert got[0] <= got[1] <= got[2]


def test_guard_keeps_missing_and_flags(spark):
    df = spark.createDataFrame([(300.0, 900.0, None, 5.0)], "snow double, mslp double, wind double, solar double")
    r = SYSTEM.guarded(df).head()
    assert (r.snow, r.mslp, r.wind, r.solar) == (250.0, 950.0, None, 5.0)
    assert (r.snow_clipped, r.mslp_clipped, r.wind_clipped, r.solar_clipped) == (True, True, True, False)


def test_rules_can_be_added(spark):
    more = SYSTEM.with_rule(fuzzy.Rule("background", (("snow", "sufficient"), ("mslp", "moderate"), ("wind", "calm"), ("solar", "low"))))
    df = spark.createDataFrame([(100.0, 1020.0, 1.0, 100.0)], "snow double, mslp double, wind double, solar double")
    assert more.possibilities(df).head().background == 1.0
    with pytest.raises(ValueError):
        fuzzy.rise(F.lit(1.0), 3, 3)


@pytest.mark.parametrize("q", [0.5, 0.75, 0.8, 0.9, 0.0, 1.0])
def test_hazen_is_numpys(spark, q):
    rng = np.random.default_rng(2)
    groups = {g: rng.random(g) for g in range(1, 30)}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g int, v double")
    for r in df.groupBy("g").agg(hazen("v", q).alias("h"), linear("v", q).alias("l")).collect():
        assert r.h == pytest.approx(np.quantile(groups[r.g], q, method="hazen"), abs=1e-12)
        assert r.l == pytest.approx(np.quantile(groups[r.g], q), abs=1e-12)


def test_missing_values_poison_or_are_skipped(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (2, 3.0), (3, None)], "g int, v double")
    got = {r.g: (r.a, r.b) for r in df.groupBy("g").agg(hazen("v", 0.9).alias("a"), hazen("v", 0.9, poison=True).alias("b")).collect()}
    assert got == {1: (1.0, None), 2: (3.0, 3.0), 3: (None, None)}


def test_local_days_over_daylight_saving(spark):
    rows = [("a", ts("2026-03-08T06:30:00"), 1.0), ("a", ts("2026-03-08T08:59:00"), 2.0), ("a", ts("2026-03-09T05:59:00"), 5.0), ("a", ts("2026-03-09T06:00:00"), 3.0), ("a", ts("2026-03-11T20:00:00"), None)]
    d = daily.local_daily_max(spark.createDataFrame(rows, "m string, valid_time timestamp_ntz, v double"), ["m"], ["v"])
    got = {str(r.local_date): r.v for r in daily.with_spine(d, ["m"]).collect()}
    assert got == {"2026-03-07": 1.0, "2026-03-08": 5.0, "2026-03-09": 3.0, "2026-03-10": None, "2026-03-11": None}


SERIES = [(ts(f"2024-01-01T0{h}:00:00"), v) for h, v in enumerate([None, 2.0, None, 4.0, 5.0])]


def test_asof_with_tolerance(spark):
    s = spark.createDataFrame([(1, *r) for r in SERIES], "k int, t timestamp_ntz, v double")
    q = spark.createDataFrame([(1, ts("2024-01-01T02:10:00"))], "k int, t timestamp_ntz")
    assert asof.nearest_within(q, s, ["k"], "t", "v", 90 * 60).head().v == 4.0
    early = spark.createDataFrame([(1, ts("2024-01-01T01:50:00"))], "k int, t timestamp_ntz")
    assert asof.nearest_within(early, s, ["k"], "t", "v", 90 * 60).head().v == 2.0
    assert asof.nearest_within(q, s, ["k"], "t", "v", 60).head().v is None
    assert asof.nearest(q, s, ["k"], "t", "v").head().v is None
    tie = spark.createDataFrame([(1, ts("2024-01-01T03:30:00"))], "k int, t timestamp_ntz")
    assert asof.nearest(tie, s, ["k"], "t", "v").head().v == 5.0
    assert asof.nearest_within(tie, s, ["k"], "t", "v", 3600).head().v == 4.0


def test_asof_that_must_find(spark):
    s = spark.createDataFrame([(1, ts("2024-01-01T00:00:00"), 1.0)], "k int, t timestamp_ntz, v double")
    q = spark.createDataFrame([(1, ts("2024-01-01T00:10:00"))], "k int, t timestamp_ntz")
    assert asof.nearest_or_fail(q, s, ["k"], "t", "v", 45 * 60).head().v == 1.0
    with pytest.raises(Exception, match="no sample"):
        asof.nearest_or_fail(q, s, ["k"], "t", "v", 5 * 60).collect()


def test_chunks_of_series_that_are_arrays(spark):
    # The second document's series is empty, the third's last chunk is short and misses a value.
    rows = [("a", [5.0, 1.0, 3.0, 9.0]), ("b", []), ("c", [2.0, 4.0, 8.0, None, 7.0])]
    out = daily.daily_by_places(spark.createDataFrame(rows, "k string, x array<double>"), ["k"], "x", chunk=3)
    assert sorted((r.k, r.day, r.value) for r in out.collect()) == [("a", 0, 3.0), ("a", 1, 9.0), ("c", 0, 4.0), ("c", 1, 7.0)]


def _solar(spark, change=lambda h, i: h * 10.0):
    zone = __import__("zoneinfo").ZoneInfo("America/Denver")
    start = ts("2026-02-27T00:00:00")
    rows = []
    for i in range(81):
        t = start + dt.timedelta(hours=3 * i)
        h = t.replace(tzinfo=dt.timezone.utc).astimezone(zone).hour
        rows.append((1, t, float(change(h, i))))
    return spark.createDataFrame(rows, "k int, valid_time timestamp_ntz, value double"), F.lit("2026-02-27").cast("timestamp_ntz"), zone


def test_solar_persists_by_local_hour(spark):
    series, init, zone = _solar(spark)
    out = representative.solar_persistence(series, ["k"], init).collect()
    assert len(out) == 48 and min(r.fxx for r in out) == 243
    known = {t.replace(tzinfo=dt.timezone.utc).astimezone(zone).hour for t in (r.valid_time for r in series.collect())}
    for r in out:
        h = r.valid_time.replace(tzinfo=dt.timezone.utc).astimezone(zone).hour
        want = min(known, key=lambda k: (min(abs(k - h), 24 - abs(k - h)), k))
        assert r.value == want * 10


def test_solar_anchor_is_the_median_of_plausible_values(spark):
    series, init, _ = _solar(spark, lambda h, i: -999 if i == 0 else h * 10)
    assert min(r.value for r in representative.solar_persistence(series, ["k"], init).collect()) >= 0


def test_trailing_mean_needs_four_rows(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, d), float(d)) for d in (1, 2, 5, 9, 20)], "stid string, date date, value double")
    assert [r.value for r in representative.trailing_mean(df).orderBy("date").collect()] == [None, None, None, 4.25, 9.0]


def test_ozone_scrub_and_next_day(spark):
    rows = [("a", ts("2024-01-05T20:00:00"), 200.0), ("a", ts("2024-01-05T21:00:00"), 60.0), ("b", ts("2024-01-05T21:00:00"), 2.0)]
    out = representative.ozone(spark.createDataFrame(rows, "stid string, ts timestamp_ntz, value double")).collect()
    assert [(str(r.date), r.value) for r in out] == [("2024-01-06", 60.0)]


def test_exceedance_is_strict_and_skips_missing(spark):
    df = spark.createDataFrame([(1, 30.0), (1, 31.0), (1, None), (2, None)], "d int, ozone_50pc double")
    got = {r.d: (r.p_30ppb, r.p_50ppb) for r in ensemble.exceedance(df, ["d"], "ozone_50pc").collect()}
    assert got == {1: (0.5, 0.0), 2: (None, None)}


def test_verification_grains(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0), (0, 3.0, 2.0), (1, 5.0, 2.0), (1, None, 2.0)], "lead int, f double, o double")
    got = {r.lead: (r.n, r.bias, r.mae, r.rmse) for r in verify.scores(df, "lead", "f", "o").collect()}
    assert got[0] == (2, 0.0, 1.0, 1.0) and got[1] == (1, 3.0, 3.0, 3.0)
    assert got[None][0] == 3 and got[None][1] == pytest.approx(1.0)


def test_outlier_bins_of_one_vanish(spark):
    df = spark.createDataFrame([(1, 10.0)] + [(2, float(v)) for v in (1, 1, 1, 1, 1, 1, 9)], "b int, v double")
    assert sorted(r.v for r in verify.without_outliers(df, F.col("b"), "v").collect()) == [1.0] * 6


def test_nearest_cell_ties_and_crop(spark):
    g = spark.createDataFrame([(39.5, 250.0, 1.0), (40.5, 250.0, 2.0), (40.5, 251.0, 3.0)], "lat double, lon double, value double")
    p = spark.createDataFrame([(1, 40.0, 250.2)], "point int, q_lat double, q_lon double")
    assert [r.value for r in spatial.nearest_cell(g, p).collect()] == [1.0]
    assert sorted(r.lon for r in spatial.crop(g).collect()) == [-110.0, -110.0, -109.0]


def test_product_documents_keep_gaps(spark):
    rows = [("m", dt.date(2024, 1, d), None if d == 2 else d / 7, float("nan") if d == 3 else 1.0) for d in (3, 1, 2)]
    df = spark.createDataFrame(rows, "member string, day date, a double, b double")
    doc = products.product(df, ["member"], "day", {"a": "possibility", "b": "temp"}, "x")
    back = {(r.variable, r.date): r.value for r in products.from_json(products.as_json(doc, ["member"]), ["member"]).collect()}
    assert back == {("a", "2024-01-01"): 0.14, ("a", "2024-01-02"): None, ("a", "2024-01-03"): 0.43, ("b", "2024-01-01"): 1.0, ("b", "2024-01-02"): 1.0, ("b", "2024-01-03"): None}


def test_times(spark):
    df = spark.createDataFrame([("2024010106",), ("20240101_0600Z",), ("2024010107",), ("2024013106x",), ("2024133106",)], "s string")
    out = df.select("s", times.parse_init("s").alias("t"), times.valid_init("s").alias("v")).collect()
    assert [str(r.t) for r in out] == ["2024-01-01 06:00:00", "2024-01-01 06:00:00", "2024-01-01 07:00:00", "None", "None"]
    assert [bool(r.v) for r in out] == [True, False, False, False, False]
    now = F.lit("2024-01-01 13:59:00").cast("timestamp_ntz")
    r = spark.range(1).select(times.latest_init(now).alias("a"), times.anchor_init(now).alias("b"), times.observation_hour(now).alias("c")).head()
    assert (str(r.a), str(r.b), str(r.c)) == ("2024-01-01 00:00:00", "2024-01-01 06:00:00", "2024-01-01 13:00:00")


def test_scalars(spark):
    df = spark.createDataFrame([("c00", 1500, 75), ("p07", 50, 3700), ("x", 5_000_000, 80)], "m string, n long, s long")
    out = df.select(scalars.member_name(F.col("m")).alias("m"), scalars.size_text(F.col("n")).alias("n"), scalars.duration_text(F.col("s")).alias("s"), scalars.retryable(F.col("s")).alias("r")).collect()
    assert [tuple(r) for r in out] == [("000", "1.5 KB", "1m 15s", True), ("007", "50 B", "1h 01m", False), (None, "4.8 MB", "1m 20s", False)]


# Scenarios


def scenario(spark, members, missing=()):
    rows = [(m, d, 1 - sum(x), *x) for m, f in members.items() for d in range(15) for x in [f(d)]]
    return cluster.valid_days(spark.createDataFrame([(m, d, *map(float, x)) for m, d, *x in rows], "member string, day int, background double, moderate double, elevated double, extreme double"), F.struct("member", "day").isin([]) if not missing else F.col("member").isin(*missing) & (F.col("day") == 0))


CALM = lambda d: (0, 0, 0)


def test_strict_null_comes_first(spark):
    late = lambda d: (0.4 if d >= 13 else 0, 0, 0)
    df = scenario(spark, {"a": CALM, "b": CALM, "c": late, "d": late, "e": lambda d: (0, 0.5, 0)})
    assert sorted(r.member for r in cluster.strict_null(df, ["member"]).where("strict_null").collect()) == ["a", "b"]
    days = cluster.active_days(scenario(spark, {"c": late, "a": CALM}), [])
    assert sum(r.active for r in days.collect()) == 2 and {r.n_active for r in days.collect()} == {2}


def test_missing_days_dont_hide_the_null_cluster(spark):
    odd = lambda d: (0.9 if d == 0 else 0, 0, 0)
    df = scenario(spark, {"a": odd, "b": odd, "c": odd}, missing=("a", "b"))
    assert sorted(r.member for r in cluster.strict_null(df, ["member"]).where("strict_null").collect()) == ["a", "b"]


def test_block_weights_are_renormalised(spark):
    df = spark.createDataFrame([("a", d, 1.0 if d < 5 else None) for d in range(15)] + [("b", d, float(d >= 10)) for d in range(15)], "member string, day int, x double")
    got = {r.member: r.w_x for r in cluster.block_means(df, ["member"], {"x": F.col("x")}).collect()}
    assert got["a"] == pytest.approx(1.0) and got["b"] == pytest.approx(0.15)


def test_masked_distance_counts_missing_dimensions(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0, None, 0.0]), (2, [3.0, 4.0, 1.0, None]), (3, [None] * 4)], "member int, x array<double>")
    got = {(r.a, r.b): r.d for r in cluster.masked_distances(df, []).collect()}
    assert got[1, 2] == pytest.approx(5 * np.sqrt(2)) and got[1, 3] == 0.0


def test_linkage_and_choice():
    x = np.array([0, 0.1, 0.2, 5, 5.1, 5.2, 20.0])
    d = np.abs(x[:, None] - x[None, :])
    assert cluster.upgma(d, 3).tolist() == [1, 1, 1, 2, 2, 2, 3]
    labels, how = cluster.choose(d)
    assert how["fallback"] and how["relaxed"] and np.bincount(labels)[1:].min() == 1
    labels, how = cluster.choose(d[:6, :6])
    assert {c: how[c] for c in ("k", "fallback", "relaxed")} == {"k": 2, "fallback": False, "relaxed": False} and labels.tolist() == [1, 1, 1, 2, 2, 2]
    assert cluster.choose(d[:2, :2])[1]["k"] == 1
    assert cluster.silhouette(d, np.array([1, 1, 1, 2, 2, 2, 3])) == -1.0
    assert cluster.ward(x[:, None], 3).tolist() == [1, 1, 1, 2, 2, 2, 3]


def test_assignment_by_ensemble(spark):
    df = spark.createDataFrame([(g, f"m{i}", [float(v), 0.0]) for g in (1, 2) for i, v in enumerate([0, 0.1, 0.2, 9, 9.1, 9.2])], "init int, member string, x array<double>")
    out = cluster.assign(cluster.masked_distances(df, ["init"]), df, ["init"]).collect()
    assert len(out) == 12 and {(r.member < "m3", r.cluster) for r in out} == {(True, 1), (False, 2)}
    pairs = cluster.masked_distances(df, ["init"])
    near = cluster.nearest_neighbours(pairs, ["init"]).collect()
    assert len(near) == 12 and max(r.nearest for r in near) == pytest.approx(0.1, abs=1e-9)
    meds = cluster.medoids(pairs, cluster.assign(pairs, df, ["init"]), ["init"]).collect()
    assert {(r.cluster, r.medoid) for r in meds} == {(1, "m1"), (2, "m4")}


def test_weak_singletons_are_deemphasized(spark):
    df = spark.createDataFrame([(9.0, 5.0, 70.0, 60.0, 0.5, 0.1), (1.0, 5.0, 61.0, 60.0, 0.5, 0.1)], "nearest double, nn_p75 double, p90 double, neighbour_p90 double, w_nb double, neighbour_w_nb double")
    out = cluster.singleton_evidence(df).collect()
    assert [(r.passed, r.display, r.reason) for r in out] == [(3, "primary", None), (1, "deemphasized", "weak_singleton_evidence")]


def numpy_nearest(targets, samples):
    return [min(samples, key=lambda s: (abs((s - t).total_seconds()), -s.timestamp())) for t in targets]


def test_asof_over_buckets_is_brute_force(spark):
    rng = np.random.default_rng(5)
    at = lambda n: sorted({ts("2024-01-01T00:00:00") + dt.timedelta(seconds=int(x)) for x in rng.integers(0, 40 * 86_400, n)})
    samples, targets = at(25), at(300)
    s = spark.createDataFrame([(1, t, None if i % 4 == 0 else float(i)) for i, t in enumerate(samples)], "k int, t timestamp_ntz, v double")
    q = spark.createDataFrame([(1, t) for t in targets] + [(2, targets[0])], "k int, t timestamp_ntz")
    for width in (86_400, 3_600, 10**9):
        out = asof.nearest(q, s, ["k"], "t", "v", width).orderBy("k", "t").collect()
        assert [r.sample_time for r in out] == [*numpy_nearest(targets, samples), None]


def test_asof_within_a_tolerance_is_brute_force(spark):
    rng = np.random.default_rng(6)
    at = lambda n: [ts("2024-01-01T00:00:00") + dt.timedelta(milliseconds=int(x)) for x in rng.integers(0, 30_000_000, n)]
    samples, targets = sorted({*at(150)}), at(400)
    s = spark.createDataFrame([(1, t, float(i)) for i, t in enumerate(samples)] + [(None, samples[0], -1.0), (1, None, -2.0)], "k int, t timestamp_ntz, v double")
    rows = [(1, t, "x") for t in [*targets, targets[0], *samples[:9]]]
    q = spark.createDataFrame([*rows, (2, targets[0], "y"), (None, samples[0], "z"), (1, None, "z")], "k int, t timestamp_ntz, more string")
    whole = lambda t: int((t - ts("1970-01-01T00:00:00")).total_seconds())
    for tolerance in (0, 1, 60, 900):
        want = []
        for _, t, _ in rows:
            gap, _, i = min((abs(whole(x) - whole(t)), x, i) for i, x in enumerate(samples))
            want.append((t, float(i), gap) if gap <= tolerance else (t, None, None))
        out = asof.nearest_within(q, s, ["k"], "t", "v", tolerance).collect()
        assert sorted((r.t, r.v, r.gap_seconds) for r in out if r.more == "x") == sorted(want)
        assert [(r.v, r.gap_seconds) for r in out if r.more != "x"] == [(None, None)] * 3


def test_asof_makes_no_pairs(spark, capsys):
    # 4,000 targets and samples within one tolerance: a join of them would have 16,000,000 rows.
    s = spark.range(4000).select(F.lit(1).alias("k"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id / 8)").alias("t"), F.col("id").cast("double").alias("v"))
    out = asof.nearest_within(s.select("k", "t"), s, ["k"], "t", "v", 900)
    assert out.count() == 4000 and out.where("gap_seconds <> 0").isEmpty()
    out.explain()
    plan = capsys.readouterr().out
    assert "Window" in plan and "Join" not in plan


@pytest.mark.parametrize("parts", [1, 7, 1024])
def test_hazen_by_ranks_is_numpys(spark, parts):
    from forelight.functions.quantile import hazen_by_ranks

    rng = np.random.default_rng(4)
    groups = {g: np.round(rng.lognormal(size=g), 1) for g in range(1, 40)} | {50: np.full(9, 3.0)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [(1, None), (60, None)]
    out = hazen_by_ranks(spark.createDataFrame(rows, "g int, v double"), ["g"], "v", 0.75, parts=parts).collect()
    got = {r.g: (r.value, r.n) for r in out}
    assert got.pop(60) == (None, 0) and set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g][0] == pytest.approx(np.quantile(vs, 0.75, method="hazen"), abs=1e-12) and got[g][1] == len(vs)


# Whole summaries


def document(spark, members, p50=lambda m, d: 40.0, p90=lambda m, d: 50.0, missing=None, without=(), weather=None):
    import json

    rows = [("r", m, d, *((None,) * 4 if x is None else (float(1 - sum(x)), *map(float, x)))) for m, f in members.items() for d in range(15) for x in [f(d)]]
    poss = spark.createDataFrame(rows, "init string, member string, day int, background double, moderate double, elevated double, extreme double")
    pct = spark.createDataFrame([("r", m, d, float(p50(m, d)), float(p90(m, d))) for m in members if m not in without for d in range(15)], "init string, member string, day int, p50 double, p90 double")
    out = cluster.summary(poss, pct, ["init"], weather, missing).collect()
    assert len(out) == 1
    return json.loads(out[0].json)


STEADY = lambda a: lambda d: (a, 0, 0)


def test_summary_puts_the_calm_first_and_drops_what_is_half(spark):
    doc = document(spark, {"a": CALM, "b": CALM, "c": STEADY(0.4), "d": STEADY(0.45), "e": lambda d: (0.1, 0.5, 0.2), "f": STEADY(0.3)}, without=("f",))
    assert doc["clusters"][0]["members"] == ["a", "b"] and doc["clusters"][0]["kind"] == "null"
    assert {m for m, c in doc["member_assignment"].items() if c == 0} == {"a", "b"}
    flags = doc["quality_flags"]
    assert flags["dropped_members_missing_percentiles"] == ["f"] and "f" not in doc["member_assignment"]
    assert flags["strict_null_members"] == 2 and flags["non_null_members"] == 3 and not flags["strict_all_background"]
    assert doc["n_members"] == 5 and doc["n_clusters"] == len(doc["clusters"]) == len(doc["representative_members"])
    assert [c["id"] for c in doc["clusters"]] == list(range(len(doc["clusters"])))


def test_summary_counts_active_days_only(spark):
    late = lambda a: lambda d: (a if d >= 13 else 0, 0, 0)
    doc = document(spark, {"a": CALM, "b": late(0.4), "c": late(0.5), "d": late(0.2)})
    assert doc["quality_flags"]["active_window_days"] == 2
    second, flags = doc["method"]["stage_2"], doc["quality_flags"]
    assert second["singleton_policy"] == "evidence_gated_lenient" and second["k_min"] == 1 and set(second["scores_passing_min_size"]) <= set(second["silhouette_scores"])
    assert doc["method"]["stage_1"]["strict_all_background"] == {"background_target": 1.0, "other_target": 0.0, "tolerance": 1e-6}
    assert (flags["null_fallback_applied"], flags["null_selected_by_threshold"], flags["null_target_size"]) == (False, flags["strict_null_members"], flags["strict_null_members"])
    assert "init" in doc and second["singleton_evidence_thresholds"]["separation_rule"]
    assert doc["method"]["stage_1"]["active_window"] == {"name": "ensemble_non_background_days", "active_days": 2, "total_days": 15}


def test_summary_with_nothing_but_calm(spark):
    doc = document(spark, {"a": CALM, "b": CALM})
    assert doc["quality_flags"]["strict_all_background"] and doc["n_clusters"] == 1
    assert doc["method"]["stage_2"]["selected_k"] == 0 and doc["clusters"][0]["ozone"]["risk_level"] == "low"
    assert doc["spread_summary"] == "1 clusters; 100% low risk"


def test_missing_days_are_not_held_against_a_member(spark):
    odd = lambda d: (0.9 if d == 0 else 0, 0, 0)
    doc = document(spark, {"a": odd, "b": odd, "c": odd}, missing=F.col("member").isin("a", "b") & (F.col("day") == 0))
    assert doc["quality_flags"]["strict_null_members"] == 2


def test_a_strong_outlier_stays_a_cluster_of_one(spark):
    members = {f"m{i}": STEADY(0.30 + 0.01 * i) for i in range(5)} | {"out": lambda d: (0.0, 0.1, 0.9)}
    doc = document(spark, members, p50=lambda m, d: 90 if m == "out" else 40, p90=lambda m, d: 110 if m == "out" else 50)
    flags, second = doc["quality_flags"], doc["method"]["stage_2"]
    assert second["fallback_used"] and flags["min_size_guard_relaxed"]
    alone = next(c for c in doc["clusters"] if c["members"] == ["out"])
    assert alone["evidence"]["passed"] and alone["display"] == {"status": "primary", "warning_code": None}
    assert alone["evidence"]["criteria"]["p90_lift"] == {"passed": True, "p90": 110.0, "neighbour_p90": 50.0}
    assert flags["weak_singleton_clusters"] == 0 and alone["ozone"]["dominant_category"] == "extreme"


def test_a_weak_outlier_is_deemphasized(spark):
    members = {f"m{i}": lambda d, i=i: (0.3 + 0.002 * i if d < 8 else 0, 0, 0) for i in range(6)} | {"late": lambda d: (0.3 if d >= 7 else 0, 0, 0)}
    doc = document(spark, members)
    alone = [c for c in doc["clusters"] if c["members"] == ["late"]]
    assert alone and alone[0]["display"] == {"status": "deemphasized", "warning_code": "weak_singleton_evidence"}
    assert doc["quality_flags"]["weak_singleton_clusters"] == 1


def numpy_distance(values, weight, members):
    z = []
    for f in range(values.shape[1]):
        for d in range(values.shape[2]):
            x = values[:, f, d] * weight[d]
            ok = ~np.isnan(x) & (weight[d] > 0)
            out = np.full(len(members), np.nan)
            if ok.any():
                out[ok] = (x[ok] - x[ok].mean()) / (x[ok].std() + 1e-6)
            z.append(out)
    z = np.array(z).T
    found = {}
    for i in range(len(members)):
        for j in range(i + 1, len(members)):
            both = ~np.isnan(z[i]) & ~np.isnan(z[j])
            found[members[i], members[j]] = np.sqrt(((z[i] - z[j])[both] ** 2).sum() * z.shape[1] / both.sum()) if both.any() else 0.0
    return found


def test_scenario_distances_against_numpy(spark):
    rng = np.random.default_rng(8)
    members = [f"m{i}" for i in range(7)]
    x = rng.random((7, 3, 15)) * (rng.random(15) > 0.4)
    pct = rng.random((7, 2, 15)) * 60
    gone = rng.random((7, 15)) < 0.1
    rows = [(m, d, *((None,) * 4 if gone[i, d] else (float(1 - x[i, :, d].sum()), *map(float, x[i, :, d]))), *map(float, pct[i, :, d])) for i, m in enumerate(members) for d in range(15)]
    days = cluster.valid_days(spark.createDataFrame([("r", *r) for r in rows], "init string, member string, day int, background double, moderate double, elevated double, extreme double, p50 double, p90 double"))
    x[np.broadcast_to(gone[:, None, :], x.shape)] = np.nan
    pct[np.broadcast_to(gone[:, None, :], pct.shape)] = np.nan
    active = np.nansum(x, axis=(0, 1)) > 0
    weight = np.where(active, 1 / np.sqrt(active.sum()), 0)
    a, b = numpy_distance(x, weight, members), numpy_distance(pct, weight, members)
    got = {(r.a, r.b): r for r in cluster.scenario_distances(days, ["init"]).collect()}
    assert set(got) == set(a)
    for p, r in got.items():
        assert r.possibility == pytest.approx(a[p]) and r.percentile == pytest.approx(b[p]) and r.d == pytest.approx(0.6 * a[p] + 0.4 * b[p])


def test_window_features_drop_members_with_gaps(spark):
    rows = [("r", m, d, None if m == "b" and d == 6 else float(d), 2.0 * d) for m in "ab" for d in range(15)]
    df = spark.createDataFrame(rows, "init string, member string, day int, p50 double, p90 double")
    out = cluster.window_features(df, ["init"], 5, 8).collect()
    assert [(r.member, r.x) for r in out] == [("a", [5.0, 6.0, 7.0, 10.0, 12.0, 14.0])]
