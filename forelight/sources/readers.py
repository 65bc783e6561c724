"""Readers: what comes in, with missing values as nulls from the start."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The engine's tables; timestamps are UTC without zone.
SCHEMAS = {
    "grid": "init timestamp_ntz, member string, variable string, fxx int, valid_time timestamp_ntz, lat double, lon double, value double",
    "cell": "res string, lat double, lon double, elev_m float, low_terrain boolean",
    "forcing": "init timestamp_ntz, member string, valid_time timestamp_ntz, fxx int, snow double, mslp double, wind double, solar double, temp double",
    "obs": "stid string, ts timestamp, variable string, value double",
    "station": "stid string, lat double, lon double, elev_ft double",
    "representative_obs": "date date, variable string, value double",
}


def without_nan(df: DataFrame) -> DataFrame:
    """NaN is null from here on: aggregates skip nulls, not NaN."""
    fix = {f.name: F.when(~F.isnan(f.name), F.col(f.name)) for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(fix) if fix else df


def parquet(spark: SparkSession, *paths: str, schema: str | None = None, skip_corrupt: bool = False) -> DataFrame:
    """Parquet files; with ``skip_corrupt`` unreadable ones are left out."""
    reader = spark.read.option("ignoreCorruptFiles", str(skip_corrupt).lower())
    return without_nan((reader.schema(schema) if schema else reader).parquet(*paths))


def csv(spark: SparkSession, *paths: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("header", "true")
    return without_nan((reader.schema(schema) if schema else reader).csv(list(paths)))


def json(spark: SparkSession, *paths: str, schema: str | None = None) -> DataFrame:
    """One document per line; a malformed one ends the query."""
    reader = spark.read.option("mode", "FAILFAST")
    return without_nan((reader.schema(schema) if schema else reader).json(list(paths)))


def documents(spark: SparkSession, *paths: str) -> DataFrame:
    """Whole text files: path and text."""
    return spark.read.option("wholetext", "true").text(list(paths)).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def members(df: DataFrame, pattern: str = r"([cp][0-9]{2})", part: str = "file_name") -> DataFrame:
    """A frame read from files, with the member that the file's name gives; with ``file_path`` as ``part`` that of its folders."""
    name = F.regexp_extract(F.col(f"_metadata.{part}"), pattern, 1)
    return df.withColumn("member", F.when(name != "", name))


def inits(df: DataFrame, pattern: str = r"([0-9]{8}_?[0-9]{2})", part: str = "file_name") -> DataFrame:
    """The runs that file names are about, in order."""
    name = F.regexp_extract(F.col(f"_metadata.{part}"), pattern, 1)
    return df.select(name.alias("init")).where("init <> ''").distinct().orderBy("init")


def with_name(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """A field whose variable is called ``name``: if none is, the first column that is no key."""
    if name in df.columns:
        return df
    first = next(c for c in df.columns if c not in keys)
    return df.withColumnRenamed(first, name)


def figures(files: DataFrame, init: str) -> DataFrame:
    """(path, kind) of the figures (path) of one run (yyyyMMdd_HH): heatmaps by their folder, meteograms by their name, of equal names the first folder's; outlook texts by the run's case."""
    day, hour = init.split("_")
    name, folder = F.regexp_extract("path", r"([^/]*)$", 1), F.regexp_extract("path", r"([^/]*)/[^/]*$", 1)
    own = F.contains(name, F.lit(f"{day}-{hour}00")) | F.contains(name, F.lit(f"{day}_{hour}"))
    case = F.regexp_extract("path", r"([^/]*)/[^/]*/[^/]*$", 1)
    meteogram_folders = ["meteograms", "optim_pessim", f"{day}_{hour}00Z"]
    kind = (
        F.when((folder == "heatmap") & F.endswith(name, F.lit(".png")) & own, "heatmap")
        .when(~folder.isin("heatmap", "llm_text") & F.endswith(name, F.lit(".png")) & F.contains(F.lower(name), F.lit("meteogram")) & own, "meteogram")
        .when((folder == "llm_text") & (case == f"CASE_{day}_{hour}00Z") & name.rlike(r"^LLM-OUTLOOK-.*\.(pdf|md)$"), "outlook")
    )
    rank = sum(((F.lit(i + 1) * (folder == f).cast("int")) for i, f in enumerate(meteogram_folders)), F.lit(0))
    found = files.select("path", kind.alias("kind"), name.alias("_name"), rank.alias("_rank")).where("kind is not null")
    # A meteogram that stands in several folders counts once.
    twins = F.row_number().over(Window.partitionBy("kind", F.when(F.col("kind") == "meteogram", F.col("_name")).otherwise(F.col("path"))).orderBy("_rank", "path"))
    return found.withColumn("_r", twins).where("_r = 1").select("path", "kind")


def grib_files(spark: SparkSession, path: str, least: int = 1000) -> DataFrame:
    """Grid files and whether they are whole: of some size, and beginning as they should."""
    files = spark.read.format("binaryFile").load(path)
    good = (F.col("length") >= least) & (F.substring("content", 1, 4) == F.encode(F.lit("GRIB"), "utf-8"))
    return files.select("path", "length", "modificationTime", good.alias("valid"))


def checksums(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"))


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def legacy(spark: SparkSession, *paths: str) -> DataFrame:
    """The files of older layouts that are there, whichever columns each has; an error if none is."""
    found = [p for p in paths if exists(spark, p)]
    if not found:
        raise FileNotFoundError(", ".join(paths))
    out = parquet(spark, found[0])
    for p in found[1:]:
        out = out.unionByName(parquet(spark, p), allowMissingColumns=True)
    return out


def read_or_build(spark: SparkSession, path: str, build) -> DataFrame:
    """A table that is built once: ``build()`` is written to the path if nothing is there, and read from then on."""
    if not exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return parquet(spark, path)


def with_expected(df: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each expected key, null where nothing came: what is late or failed stays visible."""
    return expected.join(df, keys, "left")


def observations(spark: SparkSession, path: str) -> DataFrame:
    """Observations from CSV or Parquet, raw (stid, ts, variable, value) or reduced (date, variable, value)."""
    df = csv(spark, path) if path.endswith(".csv") else parquet(spark, path)
    if "stid" in df.columns:
        return df.select("stid", F.col("ts").cast("timestamp").alias("ts"), "variable", F.expr("try_cast(value as double)").alias("value"))
    return df.select(F.col("date").cast("date").alias("date"), "variable", F.expr("try_cast(value as double)").alias("value"))


def untransposed(df: DataFrame, attribute: str = "attribute") -> DataFrame:
    """Metadata with a column per station and a row per attribute, as a row per station."""
    names = [c for c in df.columns if c != attribute]
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("stid"), F.col(f"`{n}`").cast("string").alias("v")) for n in names)))
    return df.select(attribute, pairs.alias("x")).groupBy("x.stid").pivot(attribute).agg(F.first("x.v"))
