"""Run calendars, ledgers, completeness and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forelight.functions.times import floor_hours

#: The ledger's columns; fixed values, all strings.
LEDGER = ("init", "status", "attempts", "job_id", "exit_code", "started", "finished", "seconds", "errors", "note")


def calendar(spark: SparkSession, first: str, last: str, hours: int = 6) -> DataFrame:
    """Starts of runs from first to last, both included (timestamps as text)."""
    a, b = (F.lit(x).cast("timestamp_ntz") for x in (first, last))
    return spark.range(1).select(F.explode(F.sequence(a, b, F.expr(f"interval {hours} hours"))).alias("init"))


def calendar_of(df: DataFrame, ts: str, hours: int = 6) -> DataFrame:
    """Starts of all runs from the first to the last that a table has times of, whether anything happened in them or not."""
    ends = df.agg(F.min(ts).alias("a"), F.max(ts).alias("b")).where("a is not null")
    return ends.select(F.explode(F.sequence(floor_hours(F.col("a"), hours), floor_hours(F.col("b"), hours), F.expr(f"interval {hours} hours"))).alias("init"))


def pending(inits: DataFrame, ledger: DataFrame, on: str = "init", limit: int | None = None) -> DataFrame:
    """Runs that no successful entry of the ledger is about, the earliest first; at most ``limit`` if given."""
    done = ledger.where(F.col("status") == "SUCCESS").select(on).distinct()
    out = inits.join(done, on, "left_anti").orderBy(on)
    return out.limit(limit) if limit is not None else out


def upgraded(ledger: DataFrame, columns: tuple[str, ...] = LEDGER) -> DataFrame:
    """A ledger with an older header, with all of today's columns; those it lacks are empty."""
    return ledger.select(*((F.col(c).cast("string") if c in ledger.columns else F.lit("")).alias(c) for c in columns))


def completeness(files: DataFrame, keys: list[str], product: str, required: dict[str, int]) -> DataFrame:
    """Per key: files of each product, errors for those that are too few, and the status."""
    counts = files.groupBy(*keys).agg(*(F.count_if(F.col(product) == p).alias(f"n_{p}") for p in required))
    errors = F.array_compact(F.array(*(F.when(F.col(f"n_{p}") < n, F.concat(F.lit(f"{p}: "), F.col(f"n_{p}").cast("string"), F.lit(f" of {n}"))) for p, n in required.items())))
    out = counts.withColumn("errors", F.array_join(errors, "; "))
    return out.withColumn("status", F.when(F.col("errors") == "", "SUCCESS").otherwise("FAILED"))


def newest(df: DataFrame, keys: list[str], order: str, n: int, beyond: bool = False) -> DataFrame:
    """The newest n rows of each group, or those beyond them, which retention removes."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order), *(c for c in df.columns if c not in keys and c != order))
    ranked = df.withColumn("rank", F.row_number().over(w))
    return ranked.where(F.col("rank") > n) if beyond else ranked.where(F.col("rank") <= n)


def previous_runs(df: DataFrame, others: DataFrame, key: str, init: str, hours: int = 18, n: int = 2) -> DataFrame:
    """For each run, the newest n earlier ones of its key within some hours."""
    # Runs and targets of a key go by time; a target looks back on the last n runs before it, and keeps those that are young enough.
    runs = others.select(F.col(key).alias("_k"), F.col(init).alias("_t")).distinct().withColumn("_run", F.lit(1))
    wanted = df.select(F.col(key).alias("_k"), F.col(init).alias("_t")).withColumn("_run", F.lit(0))
    both = wanted.unionByName(runs)
    # At one time the target comes first, so that a run of its own time isn't before it.
    order = Window.partitionBy("_k").orderBy("_t", "_run")
    so_far = F.count_if(F.col("_run") == 1).over(order.rowsBetween(Window.unboundedPreceding, 0))
    both = both.withColumn("_n", so_far)
    by_number = runs.withColumn("_n", F.row_number().over(Window.partitionBy("_k").orderBy("_t"))).select(F.col("_k").alias("_o"), F.col("_t").alias("previous"), F.col("_n").alias("_m"))
    back = both.where("_run = 0").select("_k", "_t", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("rank"), "_n").where("_n >= rank")
    found = back.join(by_number, (F.col("_k") == F.col("_o")) & (F.col("_n") - F.col("rank") + 1 == F.col("_m")))
    return found.where(F.timestamp_diff("MINUTE", F.col("previous"), F.col("_t")) <= hours * 60).select(F.col("_k").alias(key), F.col("_t").alias(init), "previous", "rank")


#: Entries of a configuration that may meet every row.
MOST_ENTRIES = 1_000


def bias_entries(df: DataFrame, entries: DataFrame, value: str) -> DataFrame:
    """Rows with every entry whose optional limits (low, high) they meet. Entries are a configuration table; more than MOST_ENTRIES are an error."""
    if entries.limit(MOST_ENTRIES + 1).count() > MOST_ENTRIES:
        raise ValueError(f"more than {MOST_ENTRIES} entries")
    fits = (F.col("low").isNull() | (F.col(value) >= F.col("low"))) & (F.col("high").isNull() | (F.col(value) <= F.col("high")))
    return df.join(entries, fits)


def totals(files: DataFrame, keys: list[str]) -> DataFrame:
    return files.groupBy(*keys).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def deduplicated(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True).dropDuplicates(columns)


def identical_groups(df: DataFrame, vector: str, member: str) -> DataFrame:
    """Members with equal vectors, as the first one's name and how many more."""
    g = df.groupBy(vector).agg(F.min(member).alias("first"), F.count("*").alias("n"))
    return g.select("first", "n", F.when(F.col("n") > 1, F.concat(F.col("first").cast("string"), F.lit(" (+"), (F.col("n") - 1).cast("string"), F.lit(" more)"))).otherwise(F.col("first").cast("string")).alias("label"))


def first_of(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def without_first(df: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """df with the values of each key's first row missing, as inference starts from the second step."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) == 1
    return df.withColumn("_f", first).withColumns({v: F.when(~F.col("_f"), F.col(v)) for v in values}).drop("_f")


def median_step(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Median seconds between a key's consecutive times, repeats left out."""
    w = Window.partitionBy(*keys).orderBy(ts)
    steps = df.withColumn("_s", F.timestamp_diff("SECOND", F.lag(ts).over(w), F.col(ts))).where("_s > 0")
    return steps.groupBy(*keys).agg(F.percentile("_s", 0.5).alias("step_seconds"))


def paths_found(paths: DataFrame, files: DataFrame) -> DataFrame:
    """Each path with whether a file has it whole, or else exactly one has its last part."""
    base = lambda c: F.regexp_extract(c, r"([^/]+)$", 1)
    whole = files.select(F.col("path").alias("_p")).distinct().withColumn("_whole", F.lit(True))
    named = files.select("path").distinct().groupBy(base(F.col("path")).alias("_b")).agg(F.count("*").alias("_n"))
    out = paths.join(whole, F.col("path") == F.col("_p"), "left").join(named, base(F.col("path")) == F.col("_b"), "left")
    return out.select(*paths.columns, (F.coalesce("_whole", F.lit(False)) | F.coalesce(F.col("_n") == 1, F.lit(False))).alias("found"))


def smoothed(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Mean of each row and its two neighbours; missing at the ends."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-1, 1)
    return df.withColumn("smoothed", F.when(F.count(value).over(w) == 3, F.avg(value).over(w)))
