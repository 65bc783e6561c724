"""Cited paths: against the file system's own answers, for files that are really there."""

import fnmatch
import glob
import os
import random
import re
from pathlib import Path

import pytest

from forelight.functions.text import braces
from forelight.operators import paths

FILES = [
    "repo/docs/guide.md", "repo/a[1].txt", "x/json_tests/CASE_1/llm/out.md", "x/json_tests/CASE_1/llm/notes.md", "x/json_tests/CASE_1/weather/w1.json", "x/json_tests/CASE_1/weather/w12.json",
    "x/json_tests/CASE_2/llm/out.md", "x/json_tests/CASE_2/weather/w1.json", "x/json_tests/CASE_2/weather/.hidden.json", "x/json_tests/CASE_2/only.csv", "x/json_tests/shared.json", "x/other/free.csv", "x/json_tests/CASE_2/b{c}.txt",
]
CITED = [
    "notes.md", "llm/notes.md", "CASE_1/llm/notes.md", "../weather/w1.json", "weather/w?.json", "weather/w*.json", "weather/*", "weather/.h*", "weather/[w]1.json", "weather/[!w]1.json", "weather/w[0-9].json", "CASE_{1,3}/weather/w1*.json", "CASE_{1,3}/weather/w1.json",
    "CASE_{3,4}/weather/w1*.json", "weather", "weather/", "nowhere", "nowhere.md", "only.csv", "free.csv", "w1.json", "w12.json", "w*.json", "docs/guide.md", "docs/*.md", "d*/g*.md", "./llm/./out.md", "../../x", "*/llm/*", "**/w12.json", "shared.json", "a[1].txt", "a[[]1].txt", "b{c}.txt",
    "weather/w1.json/more", "*", "?", "[", "weather/[", "CASE_*/{weather,llm}/{w1,n*}.*", "", "{", "{a,b}",
]


def by_hand(raw, outlook, repo, top):
    path = Path(raw)
    roots = [outlook.parent, outlook.parent.parent, outlook.parent.parent.parent, repo]
    places = [path] if path.is_absolute() else [Path(os.path.normpath(r / path)) for r in roots]
    for place in places:
        if place.exists():
            return True
        for pattern in braces(str(place)):
            if any(c in pattern for c in "*?[]") and glob.glob(pattern):
                return True
    if "/" not in raw and path.suffix and not re.search(r"[*?\[\]]", raw):
        above = [a for a in outlook.parents if a.name == "json_tests"]
        return bool(above) and sum(p.is_file() and p.name == raw for p in above[0].rglob("*")) == 1
    return False


@pytest.fixture(scope="module")
def there(tmp_path_factory):
    base = tmp_path_factory.mktemp("cases")
    for f in FILES:
        (base / f).parent.mkdir(parents=True, exist_ok=True)
        (base / f).write_text("x")
    return base


def test_against_the_file_system(spark, there):
    outlooks = [f"{there}/x/json_tests/CASE_{k}/llm/out.md" for k in (1, 2)]
    raws = [*CITED, f"{there}/x/other/free.csv", f"{there}/x/other", f"{there}/x/*/free.csv", f"{there}/x/nothing"]
    cited = [(o, r, i) for o in outlooks for i, r in enumerate(raws)]
    files = spark.createDataFrame([(f"{there}/{f}",) for f in FILES], "path string")
    out = paths.found(spark.createDataFrame(cited, "outlook string, path string, i int"), files, f"{there}/repo").collect()
    got = {(r.outlook, r.path): r.found for r in out}
    want = {(o, r): by_hand(r, Path(o), there / "repo", there) for o, r, _ in cited}
    assert {k: (got[k], want[k]) for k in want if got[k] != want[k]} == {}
    assert len(out) == len(cited)


def test_wildcards_are_those_of_a_shell():
    r = random.Random(4)
    for _ in range(4000):
        name, text = "".join(r.choice("ab*?[]!^-.") for _ in range(r.randint(1, 6))), "".join(r.choice("ab!^-.") for _ in range(r.randint(1, 5)))
        rule = paths.regex(name)
        if rule is None:
            assert not re.search(r"[*?\[\]]", name)
            continue
        hidden = text.startswith(".") and not name.startswith(".")
        try:
            want = bool(re.match(fnmatch.translate(name), text)) and not hidden
        except re.error:
            continue
        assert bool(re.match(rule, text)) == want, (name, text, rule)


def test_the_table_function_in_sql(spark):
    paths.register(spark)
    spark.createDataFrame([("a{b,c{d,e}}f/*.x",), ("plain",), (None,)], "path string").createOrReplaceTempView("cited_here")
    out = spark.sql("SELECT c.path, p.pattern, p.regexes FROM cited_here c, LATERAL patterns(c.path) p").collect()
    assert sorted(r.pattern for r in out) == ["abf/*.x", "acdf/*.x", "acef/*.x", "plain"]
    assert {r.regexes[0] for r in out} == {None}


def test_missing_paths_of_texts(spark, there):
    docs = spark.createDataFrame([("/t/json_tests/C/llm/a.md", ["b.md", "gone.md", "*.md", "gone/*"]), ("/t/json_tests/C/llm/b.md", []), ("/t/json_tests/C/llm/c.md", None)], "outlook string, paths array<string>")
    files = spark.createDataFrame([("/t/json_tests/C/llm/b.md",)], "path string")
    out = {r.outlook[-4:]: (r.n_paths, r.missing) for r in paths.missing(docs, files, "/repo").collect()}
    assert out == {"a.md": (4, ["gone.md", "gone/*"]), "b.md": (0, []), "c.md": (0, [])}


def test_an_empty_listing(spark):
    cited = spark.createDataFrame([("/a/b/c.md", "x*"), ("/a/b/c.md", "x.md")], "outlook string, path string")
    assert not any(r.found for r in paths.found(cited, spark.createDataFrame([], "path string"), "/repo").collect())


def test_all_checks_of_a_text(spark):
    files = spark.createDataFrame([("/t/json_tests/C/llm/b.md",)], "path string")
    body = "---\nversion: v1.0\nALERT: none\n"
    docs = [("/t/json_tests/C/llm/a.md", body + "`./b.md` `llm/*.md`"), ("/t/json_tests/C/llm/c.md", body + "`./c.md`"), ("/t/json_tests/C/llm/d.md", "no paths")]
    from pyspark.sql import functions as F

    out = paths.failures(spark.createDataFrame(docs, "outlook string, text string"), files, "/repo", ["ALERT:"], F.lit("1.0"), least_lines=3).collect()
    assert {r.outlook[-4]: r.failed for r in out} == {"a": [], "c": ["paths"], "d": ["front matter", "version", "markers", "short", "paths"]}
