"""Ledgers with several writers, and statistics that a write takes of itself."""

import json
from concurrent.futures import ThreadPoolExecutor

import pytest

from forelight.operators.ledger import LEDGER
from forelight.sources import commits, sinks


def rows(spark, inits, **more):
    return spark.createDataFrame([(i, "SUCCESS", *more.values()) for i in inits], ", ".join(f"{c} string" for c in ("init", "status", *more)))


def inits(spark, path):
    return sorted(r.init for r in commits.read(spark, path).collect())


@pytest.fixture
def path(tmp_path):
    return f"file://{tmp_path}/ledger"


def test_two_writers_lose_nothing(spark, path):
    names = [[f"{w}{k}" for k in range(6)] for w in "abc"]

    def write(own):
        for name in own:
            commits.append(rows(spark, [name]), path)

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(write, names))
    assert inits(spark, path) == sorted(sum(names, []))
    assert [c["number"] for c in commits.commits(spark, path)] == list(range(18))


def test_a_taken_number_is_not_written_over(spark, path):
    folder, fs = commits._folder(spark, f"{path}/commits")
    assert commits._created(spark, folder, fs, "0000000000.json", json.dumps({"parts": [], "columns": []}))
    assert not commits._created(spark, folder, fs, "0000000000.json", "{}")
    assert commits.commits(spark, path) == [{"parts": [], "columns": [], "number": 0}]
    assert commits.append(rows(spark, ["x"]), path) == 1 and inits(spark, path) == ["x"]


def test_one_winner_for_each_number(spark, path):
    folder, fs = commits._folder(spark, f"{path}/commits")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: commits._created(spark, folder, fs, f"{k // 8:010d}.json", str(k)), range(80)))
    assert [sum(won[i : i + 8]) for i in range(0, 80, 8)] == [1] * 10


def test_a_repeated_key_adds_nothing(spark, path):
    assert commits.append(rows(spark, ["a"]), path, "k") == 0
    assert commits.append(rows(spark, ["a"]), path, "k") is None
    with ThreadPoolExecutor(4) as pool:
        assert sorted(pool.map(lambda _: commits.append(rows(spark, ["b"]), path, "m"), range(4)), key=str) == [1, None, None, None]
    assert inits(spark, path) == ["a", "b"]


def test_older_headers_are_upgraded(spark, path):
    commits.append(rows(spark, ["old"]), path)
    commits.append(rows(spark, ["new"], attempts="3", extra="gone"), path)
    sinks.ledger(rows(spark, ["now"], note="n"), path)
    out = {r.init: r for r in commits.read(spark, path).collect()}
    assert commits.read(spark, path).columns == list(LEDGER)
    assert (out["old"].attempts, out["new"].attempts, out["now"].note, out["now"].attempts) == ("", "3", "n", "")


def test_rewriting_keeps_rows_keys_and_what_comes_meanwhile(spark, path):
    for k in range(3):
        commits.append(rows(spark, [f"a{k}"]), path, f"a{k}")
    assert commits.rewritten(spark, path) == 3
    commits.append(rows(spark, ["b"]), path)
    assert inits(spark, path) == ["a0", "a1", "a2", "b"]
    assert [c["number"] for c in commits._live(commits.commits(spark, path))] == [3, 4]
    assert commits.append(rows(spark, ["a1"]), path, "a1") is None
    # A commit that came between the reading and the rewrite's own commit.
    before = commits.commits(spark, path)
    commits.append(rows(spark, ["late"]), path)
    commits.rewritten(spark, path)
    assert inits(spark, path) == ["a0", "a1", "a2", "b", "late"]
    told = {"parts": before[3]["parts"], "columns": before[3]["columns"], "stands_for": 3}
    live = commits._live([*before, {"parts": ["x"], "columns": [], "number": 5}, told | {"number": 6}])
    assert [c["number"] for c in live] == [4, 5, 6]


def test_an_empty_ledger(spark, path):
    assert commits.read(spark, path).count() == 0 and commits.rewritten(spark, path) is None


def test_statistics_of_a_write(spark, tmp_path):
    data = [("c00", float(v)) for v in range(1, 11)] + [("p01", None)] * 3 + [("p02", 5.0), ("p02", None), ("x", 1.0), (None, 2.0)]
    df = spark.createDataFrame(data, "member string, v double")
    out = {r.member: tuple(r)[1:] for r in sinks.with_statistics(df, str(tmp_path / "t"), "member", "v", ["c00", "p01", "p02", "p03"]).collect()}
    assert out == {"c00": (10, 10, 1.0, 5.0, 9.0, "written"), "p01": (3, 0, None, None, None, "all_missing"), "p02": (2, 1, 5.0, 5.0, 5.0, "written"), None: (2, 2, 1.0, 1.0, 2.0, "written")}
    assert spark.read.parquet(str(tmp_path / "t")).count() == len(data)
