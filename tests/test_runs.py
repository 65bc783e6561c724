"""Runs that are waited for: over several files and several starts, against the table that holds all of it."""

import random
from datetime import datetime, timedelta

import pytest

from forelight.streaming import runs

START = datetime(2024, 3, 1)
SCHEMA = "init timestamp_ntz, member int, arrived timestamp_ntz, value double"


def as_is(df):
    return df.select("init", "member", "arrived", "value")


def write(spark, rows, path, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}-{name}")
    import glob
    import os
    import shutil

    os.makedirs(path, exist_ok=True)
    shutil.copy(glob.glob(f"{path}-{name}/*.parquet")[0], f"{path}/{name}.parquet")
    # Files are read in order of their times.
    os.utime(f"{path}/{name}.parquet", (1_700_000_000 + 60 * name, 1_700_000_000 + 60 * name))


def rows_of(df):
    return sorted(map(str, df.collect()))


def arrivals(seed, n_runs=12, members=5):
    r = random.Random(seed)
    out = []
    for k in range(n_runs):
        init = START + timedelta(hours=12 * k)
        for member in range(members):
            for _ in range(r.choice([0, 1, 1, 1, 2])):
                out.append((init, member, init + timedelta(minutes=r.randint(1, 36 * 60)), r.choice([None, r.random()])))
        out.append((init, 77, init + timedelta(hours=1), 1.0))  # nobody waits for that one
    return sorted(out, key=lambda x: x[2])


@pytest.fixture(scope="module")
def fed(spark, tmp_path_factory):
    """All files of a stream read in two starts, and what its state holds."""
    base = tmp_path_factory.mktemp("runs")
    rows = arrivals(1) + [(START + timedelta(days=40), 0, START + timedelta(days=40), 1.0)]
    third = len(rows) // 6
    parts = [rows[i : i + third] for i in range(0, len(rows), third)]
    path, out = str(base / "in"), str(base / "out")
    for k, part in enumerate(parts[:3]):
        write(spark, part, path, k)
    first, _ = runs.run(spark, path, as_is, 5, base=out, files=1)
    early = rows_of(first)
    for k, part in enumerate(parts[3:], 3):
        write(spark, part, path, k)
    last, progress = runs.run(spark, path, as_is, 5, base=out, files=1)
    return rows, early, rows_of(last), progress, last.columns


def test_as_if_all_had_come_at_once(spark, fed):
    rows, early, late, _, columns = fed
    once = runs.waited_at_once(spark.createDataFrame(rows, SCHEMA), 5)
    assert columns == once.columns
    assert late == rows_of(once)
    assert early and set(early) < set(late)


def test_each_run_goes_out_once_with_all_members(fed):
    _, _, late, _, _ = fed
    assert len(late) == len(set(late)) == 12 * 5


def test_the_state_is_empty_but_for_the_last_run(fed):
    _, _, _, progress, _ = fed
    # One member of the run that still waits, its timer, and nothing else.
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] <= 3


def test_complete_runs_do_not_wait(spark, tmp_path):
    rows = [(START, m, START + timedelta(hours=m), float(m)) for m in range(3)]
    write(spark, rows, str(tmp_path / "in"), 0)
    out, _ = runs.run(spark, str(tmp_path / "in"), as_is, 3)
    assert [(r.member, r.value, r.status, r.n_members) for r in out.orderBy("member").collect()] == [(m, float(m), "complete", 3) for m in range(3)]


def test_late_rows_change_nothing(spark, tmp_path):
    hours = lambda h: START + timedelta(hours=h)
    first = [(START, 0, hours(1), 1.0), (START, 1, hours(24), 2.0), (START, 2, hours(24) + timedelta(microseconds=1), 3.0), (START, 1, hours(24), 9.0), (hours(24), 0, hours(30), 4.0)]
    write(spark, first, str(tmp_path / "in"), 0)
    write(spark, [(START, 2, hours(3), 5.0), (START, 0, hours(31), 6.0)], str(tmp_path / "in"), 1)
    out, _ = runs.run(spark, str(tmp_path / "in"), as_is, 3, files=1)
    assert [(r.init, r.member, r.value, r.status, r.n_members) for r in out.orderBy("member").collect()] == [(START, 0, 1.0, "deadline", 2), (START, 1, 2.0, "deadline", 2), (START, 2, None, "deadline", 2)]


def test_an_empty_folder_of_rows(spark, tmp_path):
    write(spark, [], str(tmp_path / "in"), 0)
    out, _ = runs.run(spark, str(tmp_path / "in"), as_is, 3)
    assert out.count() == 0
