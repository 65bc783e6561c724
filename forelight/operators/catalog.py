"""Runs, files and bundles as tables: cases, copies, manifests, registries, run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forelight.functions.text import version

#: File names of the products: forecast_<product>[_<member>]_<init>.json; fixed format.
FILE = r"forecast_([a-z_]+?)(?:_(m[0-9]{3}))?_([0-9]{8}_[0-9]{4}Z)\.json$"


def file_name(product: Column, member: Column, init: Column) -> Column:
    return F.concat(F.lit("forecast_"), F.concat_ws("_", product, member, init), F.lit(".json"))


def case_files(documents: DataFrame) -> DataFrame:
    """(path, text) of product files as (init, product, member, json); other files are passed over."""
    part = lambda k: F.regexp_extract("path", FILE, k)
    out = documents.select(part(3).alias("init"), part(1).alias("product"), F.nullif(part(2), F.lit("")).alias("member"), F.col("text").alias("json"))
    return out.where("product <> ''")


def case(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Possibilities, percentiles and weather of cases, from their files: (init, member, date or time, a column per variable)."""
    files = case_files(documents)
    kind = "forecast_dates array<string>, values map<string, array<double>>"
    found = []
    for product, columns in (("possibility_heatmap", ("background", "moderate", "elevated", "extreme")), ("percentile_scenarios", ("p10", "p50", "p90")), ("weather_members", ("snow", "wind"))):
        doc = files.where(F.col("product") == product).select("init", "member", F.from_json("json", kind).alias("d"))
        # A variable that a file lacks is an empty series.
        zipped = F.arrays_zip("d.forecast_dates", *(F.coalesce(F.col("d.values")[c], F.array().cast("array<double>")) for c in columns))
        rows = doc.select("init", "member", F.explode(zipped).alias("x"))
        found.append(rows.select("init", "member", *(F.col("x").getField(n).alias(a) for n, a in zip(["forecast_dates", *map(str, range(1, len(columns) + 1))], ["date", *columns], strict=True))))
    return tuple(found)


def copies(files: DataFrame, there: DataFrame, overwrite: bool = False) -> DataFrame:
    """(source, target): what an archive still has to take.

    ``files``: path, target, canonical (whether the name is the one that files have today). Of
    files for one target the one with the canonical name is taken, then the first by path; targets
    that are ``there`` (target) are passed over unless they are to be overwritten.
    """
    first = Window.partitionBy("target").orderBy(F.desc("canonical"), "path")
    out = files.withColumn("_r", F.row_number().over(first)).where("_r = 1")
    if not overwrite:
        out = out.join(there.select("target").distinct(), "target", "left_anti")
    return out.select(F.col("path").alias("source"), "target")


def manifest(files: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n_files, bytes, json): the files (path, length, sha256) of each key in order of their paths."""
    rows = files.groupBy(*keys).agg(F.count("*").alias("n_files"), F.sum("length").alias("bytes"), F.array_sort(F.collect_list(F.struct("path", "length", "sha256"))).alias("files"))
    return rows.select(*keys, "n_files", "bytes", F.to_json(F.struct("n_files", "bytes", "files")).alias("json"))


def quicklook(counts: DataFrame, keys: list[str], product: str, n: str) -> DataFrame:
    """(keys, text): a line for each product and its number of files."""
    line = F.format_string("%s: %d", product, n)
    return counts.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("text"))


def run_summary(runs: DataFrame, keys: list[str], commit: str = "") -> DataFrame:
    """(keys, json): all other columns of a run in order of their names, and the commit of the code where the run lacks one."""
    fields = {c: F.col(c) for c in runs.columns if c not in keys}
    fields["code_commit"] = F.coalesce(F.nullif(fields["code_commit"], F.lit("")), F.lit(commit)) if "code_commit" in fields else F.lit(commit)
    return runs.select(*keys, F.to_json(F.struct(*(fields[c].alias(c) for c in sorted(fields)))).alias("json"))


def resolved(requests: DataFrame, registry: DataFrame, manifests: DataFrame, files: DataFrame) -> DataFrame:
    """(request, version, manifest, label, qa, prompt, prompt_sha256, status): which bundle each request means.

    ``requests``: request (a version in any spelling); ``registry``: version,
    manifest; ``manifests``: manifest, version, label, prompt, qa; ``files``: path, sha256. The
    status is ok, or what is amiss: unknown version, no manifest path, no manifest, another version, no prompt.
    """
    asked = requests.select("request", version(F.col("request")).alias("version"))
    known = registry.select(version(F.col("version")).alias("_v"), F.col("manifest").alias("_path"), F.lit(True).alias("_known"))
    held = manifests.select(F.col("manifest").alias("_m"), version(F.col("version")).alias("_mv"), "label", "prompt", "qa")
    there = files.select(F.col("path").alias("_f"), F.col("sha256").alias("prompt_sha256"))
    out = asked.join(known, F.col("version") == F.col("_v"), "left").join(held, F.col("_path") == F.col("_m"), "left").join(there, F.col("prompt") == F.col("_f"), "left")
    status = F.when(F.col("_known").isNull(), "unknown version").when(F.col("_path").isNull(), "no manifest path").when(F.col("_m").isNull(), "no manifest").when(~F.col("_mv").eqNullSafe(F.col("version")), "another version").when(F.col("_f").isNull(), "no prompt").otherwise("ok")
    label = F.coalesce("label", F.concat(F.lit("bundle v"), F.col("version")))
    return out.select("request", "version", F.col("_path").alias("manifest"), label.alias("label"), F.coalesce("qa", F.lit(False)).alias("qa"), "prompt", "prompt_sha256", status.alias("status"))


def settings(lines: DataFrame, column: str = "value") -> DataFrame:
    """(key, value) of lines such as KEY="value"; comments and other lines are passed over, of a repeated key the last one by ``n`` counts."""
    pattern = r"^\s*(?:export\s+)?([A-Za-z_][A-Za-z0-9_]*)\s*=\s*(.*?)\s*$"
    rows = lines.select("n", F.regexp_extract(column, pattern, 1).alias("key"), F.regexp_replace(F.regexp_extract(column, pattern, 2), r"""^(["'])(.*)\1$""", "$2").alias("value")).where("key <> ''")
    return rows.groupBy("key").agg(F.max_by("value", "n").alias("value"))


def nested(json: Column, path: str, default: str) -> Column:
    """What a document has at a path, or else a default."""
    return F.coalesce(F.get_json_object(json, path), F.lit(default))


def recent(cases: DataFrame, current: Column, limit: int = 8) -> DataFrame:
    """The last cases (init) that are not after the current one, the newest first."""
    return cases.where(F.col("init") <= current).orderBy(F.desc("init")).limit(limit)


def replay_paths(inits: DataFrame, root: str) -> DataFrame:
    """Where a run of the replay reads and writes: work, case and log paths by its init (yyyyMMddHH)."""
    name = F.concat(F.substring("init", 1, 8), F.lit("_"), F.substring("init", 9, 2), F.lit("00Z"))
    return inits.select("init", F.concat(F.lit(f"{root}/work/"), "init").alias("work"), F.concat(F.lit(f"{root}/cases/CASE_"), name).alias("case"), F.concat(F.lit(f"{root}/logs/run_"), "init", F.lit(".log")).alias("log"))
