"""Ledgers, texts, sources and sinks, and streams."""

import datetime as dt

from pyspark.sql import functions as F

from forelight.functions import text
from forelight.operators import ledger
from forelight.sources import readers, sinks
from forelight.streaming import daily as streaming


def test_calendar_and_resume(spark):
    c = ledger.calendar(spark, "2025-12-01", "2026-03-15 18:00:00")
    assert c.count() == 420
    done = spark.createDataFrame([("2025-12-01 00:00:00", "SUCCESS"), ("2025-12-01 06:00:00", "FAILED")], "init string, status string").withColumn("init", F.col("init").cast("timestamp_ntz"))
    left = ledger.pending(c, done, limit=2).collect()
    assert [str(r.init) for r in left] == ["2025-12-01 06:00:00", "2025-12-01 12:00:00"]


def test_old_ledgers_get_new_columns(spark):
    old = spark.createDataFrame([("x", 3)], "init string, extra int")
    row = ledger.upgraded(old).head()
    assert row.init == "x" and row.status == "" and "extra" not in row


def test_completeness(spark):
    files = spark.createDataFrame([(1, "a")] * 2 + [(1, "b"), (2, "a")], "init int, product string")
    got = {r.init: (r.status, r.errors) for r in ledger.completeness(files, ["init"], "product", {"a": 2, "b": 1}).collect()}
    assert got == {1: ("SUCCESS", ""), 2: ("FAILED", "a: 1 of 2; b: 0 of 1")}


def test_discussion_fields(spark):
    body = "---\nversion: V1.2\n**ALERT:** high\nconfidence: low\n# Data\nsee `out/a.csv`, `out/b.csv` and `out/a.csv`\n# Notes\nOne. Two! Three?"
    r = spark.createDataFrame([(body,)], "b string").select(text.field(F.col("b"), "ALERT").alias("a"), text.field(F.col("b"), "none").alias("n"), text.version(text.field(F.col("b"), "version")).alias("v"), text.paths(F.col("b")).alias("p"), text.section(F.col("b"), "Notes").alias("s"), text.sentences(text.section(F.col("b"), "Notes")).alias("two")).head()
    assert (r.n, r.v, r.p, r.s, r.two) == (None, "1.2", ["out/a.csv", "out/b.csv"], "One. Two! Three?", "One. Two!")
    assert r.a in ("high", "** high")


def test_discussion_checks(spark):
    good = "---\nversion: 1.0\nALERT: x\n" + "line\n" * 50
    rows = [(good,), (good.replace("---\n", ""),), (good.replace("1.0", "2.0"),), ("",), (good + "As an AI I think",)]
    out = spark.createDataFrame(rows, "b string").select(text.failures(F.col("b"), ["ALERT:"], F.lit("v1.0")).alias("f")).collect()
    assert [r.f for r in out[:3]] == [[], ["front matter"], ["version"]]
    assert "empty" in out[3].f and out[4].f == ["meta"]


def test_unicode_and_braces(spark):
    df = spark.createDataFrame([("é​x", "r/{a,b{1,2}}/{c}"), (None, None)], "t string, p string")
    out = df.select(text.plain("t").alias("t"), text.expanded("p").alias("p")).collect()
    assert out[0].t == "éx" and out[0].p == ["r/a/c", "r/b1/c", "r/b2/c"] and out[1].t is None and out[1].p is None


def test_sources_turn_nan_into_null(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, 3.0)], "i int, x double")
    df.write.parquet(f"{tmp_path}/t")
    assert readers.parquet(spark, f"{tmp_path}/t").agg(F.max("x")).head()[0] == 3.0
    sinks.csv(df, f"{tmp_path}/c")
    assert readers.csv(spark, f"{tmp_path}/c", schema="i int, x double").where("x is null").count() == 1


def test_partitioned_sink_replaces_only_its_partitions(spark, tmp_path):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    sinks.partitioned(spark.createDataFrame([(1, "a"), (2, "b")], "init int, v string"), f"{tmp_path}/t", ["init"])
    sinks.partitioned(spark.createDataFrame([(2, "c")], "init int, v string"), f"{tmp_path}/t", ["init"])
    assert sorted((r.init, r.v) for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [(1, "a"), (2, "c")]
    sinks.new_only(spark.createDataFrame([(2, "x"), (3, "d")], "init int, v string"), f"{tmp_path}/n", ["init"])
    sinks.new_only(spark.createDataFrame([(2, "y"), (4, "e")], "init int, v string"), f"{tmp_path}/n", ["init"])
    assert sorted((r.init, r.v) for r in spark.read.parquet(f"{tmp_path}/n").collect()) == [(2, "x"), (3, "d"), (4, "e")]


def test_members_and_inits_from_file_names(spark, tmp_path):
    for name in ("run_2024010100_p01", "run_20240101_06_c00"):
        spark.range(1).coalesce(1).write.parquet(f"{tmp_path}/x/{name}")
    (tmp_path / "flat").mkdir()
    for d in (tmp_path / "x").iterdir():
        part = next(d.glob("*.parquet"))
        part.rename(tmp_path / "flat" / f"{d.name}.parquet")
    df = spark.read.parquet(f"{tmp_path}/flat")
    assert sorted(r.member for r in readers.members(df).select("member").collect()) == ["c00", "p01"]
    assert [r.init for r in readers.inits(df).collect()] == ["2024010100", "20240101_06"]


def test_grid_files_are_validated(spark, tmp_path):
    (tmp_path / "a.grib2").write_bytes(b"GRIB" + b"0" * 2000)
    (tmp_path / "b.grib2").write_bytes(b"GRIB")
    (tmp_path / "c.grib2").write_bytes(b"HTML" + b"0" * 2000)
    out = readers.grib_files(spark, f"{tmp_path}/*.grib2").orderBy("path").collect()
    assert [r.valid for r in out] == [True, False, False]
    late = readers.with_expected(spark.createDataFrame([(1, 2.0)], "fxx int, v double"), spark.createDataFrame([(1,), (2,)], "fxx int"), ["fxx"])
    assert {r.fxx: r.v for r in late.collect()} == {1: 2.0, 2: None}


def test_station_metadata_by_station(spark):
    df = spark.createDataFrame([("elev_ft", 5000.0, 6000.0), ("lat", 40.0, 41.0)], "attribute string, `K-1` double, B double")
    got = {r.stid: (r.elev_ft, r.lat) for r in readers.untransposed(df).collect()}
    assert got == {"K-1": ("5000.0", "40.0"), "B": ("6000.0", "41.0")}


def test_braces():
    assert text.braces("a{b}c") == ["abc"] and text.braces("a{b{c}") == ["a{b{c}"] and text.braces("x{}y") == ["xy"] and text.braces("") == [""]
    assert text.braces("{a,b}{c,}") == ["ac", "a", "bc", "b"]


def test_late_rows_are_dropped_and_old_days_leave_the_state(spark, tmp_path):
    kind = "event_id long, ts timestamp_ntz, user_id long, value double"
    at = lambda day, i: (i, dt.datetime(2024, 1, day, 18), 1, float(i))
    held = []
    (tmp_path / "in").mkdir()
    run = streaming.windowed(spark.readStream.schema(kind).parquet(f"{tmp_path}/in")).writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/cp").foreachBatch(lambda df, n: held.append({(str(r.local_date), r.n) for r in df.collect()}))
    for k, rows in enumerate([[at(2, 1), at(3, 2)], [at(20, 3)], [at(2, 4), at(19, 5)], [at(21, 6)]]):
        spark.createDataFrame(rows, kind).coalesce(1).write.parquet(f"{tmp_path}/in", mode="append")
        stream = run.trigger(availableNow=True).start()
        stream.awaitTermination()
    state = stream.lastProgress["stateOperators"][0]
    assert ("2024-01-19", 1) in set().union(*held) and ("2024-01-02", 2) not in set().union(*held)
    assert state["numRowsTotal"] <= 3


def test_stream_equals_table(spark, tmp_path):
    rows = [(i, dt.datetime(2024, 1, 1 + i // 10, i % 24), i % 4, float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, value double")
    df.repartition(20).write.parquet(f"{tmp_path}/events")
    # The files are in no order, so lateness is the whole span.
    a = {tuple(r) for r in streaming.daily_max(spark, f"{tmp_path}/events", late="30 days").collect()}
    b = {tuple(r) for r in streaming.windowed(df).collect()}
    assert a == b and len(a) > 10
