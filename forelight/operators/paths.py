"""Paths that texts cite, against a listing of files: roots, globs, braces, bare names.

A listing is seen as a tree of names. A cited path is tried below each of its
roots; as it stands it is there if the tree has it, file or folder. A path with
braces is expanded by a table function, and those of its expansions that have
wildcards go down the tree level by level: a plain name by an equality, a
wildcard among the names of the folder reached, so a pattern never meets files of other
folders. There are as many steps as the longest pattern has names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from forelight.functions import text
from forelight.functions.text import braces
from forelight.sources.sinks import folder

#: The folder below which a bare name may stand anywhere, if it does so once; a fixed value.
TREE = "json_tests"
_WILD = re.compile(r"[*?\[\]]")


def regex(name: str) -> str | None:
    """A wildcard name as a regular expression, null for a plain one. A leading wildcard doesn't match a leading dot."""
    if not _WILD.search(name):
        return None
    out, i = "" if name[0] == "." else r"(?!\.)", 0
    while i < len(name):
        c, i = name[i], i + 1
        if c == "*":
            out += ".*"
        elif c == "?":
            out += "."
        elif c == "[" and (end := name.find("]", i + 1 + (name[i : i + 1] == "!"))) > 0:
            body = name[i:end]
            not_ = body[0] == "!"
            out += "[" + "^" * not_ + re.sub(r"([\\\[\]^&~|])", r"\\\1", body[not_:]) + "]"
            i = end + 1
        else:
            out += re.escape(c)
    return f"(?s)^{out}$"


@udtf(returnType="pattern string, names array<string>, regexes array<string>")
class Patterns:
    """A row for each brace expansion of a path, with its names and, for wildcards, their regular expressions."""

    def eval(self, path: str) -> Iterator[tuple]:
        if path is not None:
            for pattern in braces(path):
                names = [n for n in pattern.split("/") if n]
                yield pattern, names, [regex(n) for n in names]


def register(spark: SparkSession) -> None:
    """Makes ``patterns(path)`` known to SQL: ``SELECT ... FROM t, LATERAL patterns(t.path)``."""
    spark.udtf.register("patterns", Patterns)


def resolved(path: Column) -> Column:
    """An absolute path without empty names, ``.`` and ``..``."""
    names = F.filter(F.split(path, "/"), lambda n: ~n.isin("", "."))
    up = F.aggregate(names, F.array().cast("array<string>"), lambda acc, n: F.when(n == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.array_append(acc, n)))
    return F.concat(F.lit("/"), F.array_join(up, "/"))


def _parent(path: Column, steps: int) -> Column:
    names = F.split(F.regexp_replace(path, "^/", ""), "/")
    return F.concat(F.lit("/"), F.array_join(F.slice(names, 1, F.greatest(F.size(names) - steps, F.lit(0))), "/"))


def candidates(cited: DataFrame, home: str) -> DataFrame:
    """cited (outlook, path) with each place where a path may be: an absolute one itself, others below the text's folder, the two folders above it, and ``home``."""
    roots = F.array(*(_parent(F.col("outlook"), k) for k in (1, 2, 3)), F.lit(home))
    places = F.when(F.startswith("path", F.lit("/")), F.array(F.col("path"))).otherwise(F.transform(roots, lambda r: F.concat(r, F.lit("/"), F.col("path"))))
    return cited.select("outlook", "path").distinct().select("*", F.explode(F.array_distinct(F.transform(places, resolved))).alias("place"))


def tree(files: DataFrame) -> DataFrame:
    """(place, parent, name) of each file of a listing (path) and of each folder above one."""
    names = F.split(F.regexp_replace(resolved(F.col("path")), "^/", ""), "/")
    each = files.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(names)), lambda k: F.concat(F.lit("/"), F.array_join(F.slice(names, 1, k), "/")))).alias("place"))
    return each.distinct().select("place", F.when(F.instr(F.substring(F.col("place"), 2, 1 << 30), "/") > 0, F.regexp_extract("place", r"(?s)^(.*)/[^/]*$", 1)).otherwise("").alias("parent"), F.regexp_extract("place", r"(?s)([^/]*)$", 1).alias("name"))


def globbed(patterns: DataFrame, places: DataFrame) -> DataFrame:
    """The patterns (pattern, names, regexes) that something in the tree matches."""
    spark = patterns.sparkSession
    wanted = patterns.distinct().withColumn("at", F.lit(""))
    deepest = wanted.agg(F.max(F.size("names"))).head()[0] or 0
    done = []
    for k in range(deepest):
        own, rule = F.get("names", F.lit(k)), F.get("regexes", F.lit(k))
        here = places.select(F.col("parent").alias("at"), "name", "place")
        by_name = wanted.where(rule.isNull()).join(here.withColumnRenamed("at", "_at"), (F.col("at") == F.col("_at")) & (own == F.col("name")))
        by_rule = wanted.where(rule.isNotNull()).join(here.withColumnRenamed("at", "_at"), F.col("at") == F.col("_at")).where(F.expr(f"rlike(name, regexes[{k}])"))
        reached = by_name.unionByName(by_rule).select("pattern", "names", "regexes", F.col("place").alias("at")).distinct()
        # Written for each level: the next one starts from what was reached and not from the whole chain of joins.
        path = folder(spark, "globs")
        reached.write.parquet(path)
        reached = spark.read.schema(reached.schema).parquet(path)
        done.append(reached.where(F.size("names") == k + 1).select("pattern").distinct())
        wanted = reached.where(F.size("names") > k + 1)
    out = done[0] if done else patterns.select("pattern").limit(0)
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def found(cited: DataFrame, files: DataFrame, home: str, tree_name: str = TREE) -> DataFrame:
    """cited (outlook, path and what else it has) with ``found``.

    True if a place has it as it stands; if a place's brace expansion with
    wildcards matches something; or, for a bare name with a suffix, if exactly
    one file below the nearest folder of that name above the text is called so.
    """
    places = tree(files)
    tried = candidates(cited, home)
    plain = tried.join(places.select("place"), "place", "left_semi").select("outlook", "path")
    wild = tried.where(F.col("place").rlike(r"[*?\[\]]"))
    # LATERAL: the table function's rows beside the row that it is called for.
    patterns = wild.select("place").distinct().lateralJoin(Patterns(F.col("place").outer())).where("exists(regexes, r -> r is not null)")
    matched = globbed(patterns.select("pattern", "names", "regexes"), places)
    by_glob = wild.join(patterns.select("place", "pattern").join(matched, "pattern", "left_semi").select("place").distinct(), "place", "left_semi").select("outlook", "path")

    # Names below each folder that is called so, counted before they meet the texts.
    root = lambda c: F.regexp_extract(c, rf"(?s)^((?:.*)/{tree_name})/", 1)
    names = F.split(F.regexp_replace(resolved(F.col("path")), "^/", ""), "/")
    each = files.select(resolved(F.col("path")).alias("file"), F.explode(F.transform(F.filter(F.sequence(F.lit(1), F.size(names) - 1), lambda k: F.get(names, (k - 1).cast("int")) == tree_name), lambda k: F.concat(F.lit("/"), F.array_join(F.slice(names, 1, k), "/")))).alias("root"))
    once = each.distinct().groupBy("root", F.regexp_extract("file", r"(?s)([^/]*)$", 1).alias("name")).agg(F.count("*").alias("n")).where("n = 1")
    bare = cited.select("outlook", "path").distinct().where(F.col("path").rlike(r"^[^/\\]+\.[^/\\.]+$")).withColumn("root", root(F.col("outlook")))
    by_name = bare.join(once, (bare["root"] == once["root"]) & (F.col("path") == F.col("name")), "left_semi").select("outlook", "path")

    there = plain.unionByName(by_glob).unionByName(by_name).distinct().withColumn("found", F.lit(True))
    return cited.join(there, ["outlook", "path"], "left").withColumn("found", F.coalesce("found", F.lit(False)))


def missing(docs: DataFrame, files: DataFrame, home: str, tree_name: str = TREE) -> DataFrame:
    """(outlook, n_paths, missing): how many paths each text (outlook, paths) cites, and in order those that aren't there. A text without paths fails the check as well."""
    each = docs.select("outlook", F.posexplode_outer("paths").alias("i", "path"))
    told = found(each.where("path is not null"), files, home, tree_name)
    lost = told.groupBy("outlook").agg(F.count("*").alias("n_paths"), F.array_sort(F.collect_list(F.when(~F.col("found"), F.struct("i", "path")))).alias("m"))
    out = docs.select("outlook").distinct().join(lost, "outlook", "left")
    return out.select("outlook", F.coalesce("n_paths", F.lit(0)).cast("long").alias("n_paths"), F.coalesce(F.transform("m", lambda x: x["path"]), F.array().cast("array<string>")).alias("missing"))


def failures(docs: DataFrame, files: DataFrame, home: str, markers: list[str], expected_version: Column, least_lines: int = 50) -> DataFrame:
    """(outlook, failed): the names of all checks that each text (outlook, text) fails; ``paths`` is one of them, for a path that isn't there or none at all."""
    own = text.failures(F.col("text"), markers, expected_version, least_lines)
    lost = missing(docs.select("outlook", text.paths(F.col("text")).alias("paths")), files, home)
    bad = lost.where("n_paths = 0 or size(missing) > 0").select("outlook", F.array(F.lit("paths")).alias("_lost"))
    return docs.select("outlook", own.alias("failed")).join(bad, "outlook", "left").select("outlook", F.concat("failed", F.coalesce("_lost", F.array().cast("array<string>"))).alias("failed"))
