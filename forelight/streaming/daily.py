"""Daily maxima of a growing folder of event files.

The reference time is the event's local wall-clock time. Rows are taken until
they are so late that the watermark has passed their day; a day that it has
passed leaves the state. The checkpoint remembers which files were read, as a ledger would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forelight.functions.times import ZONE
from forelight.sources.sinks import folder


def windowed(events: DataFrame, zone: str = ZONE, late: str = "2 days") -> DataFrame:
    """Largest value, and rows, per member and local day of a stream or a table of events."""
    # Days are windows of the column that has the watermark, or Spark would keep them for ever.
    # Local wall-clock time is an instant here, as if clocks stood at UTC, whatever the session's zone.
    clock = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col("ts"))
    local = events.withColumn("at", F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), clock))).withWatermark("at", late)
    days = local.groupBy((F.col("user_id") % 31).alias("member"), F.window("at", "1 day").alias("w")).agg(F.max("value").alias("value"), F.count("*").alias("n"))
    return days.select("member", F.date_from_unix_date(F.floor(F.unix_seconds("w.start") / 86_400).cast("int")).alias("local_date"), "value", "n")


def daily_max(spark: SparkSession, path: str, late: str = "2 days") -> DataFrame:
    """What :func:`windowed` gives once a stream over the path has read all that is there.

    Files that are read in another order than their events' need a ``late`` of
    the time that they span.
    """
    base = folder(spark, "stream")
    schema = spark.read.parquet(path).schema
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 8)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory():
        # Streams read folders: the one that the file is in, and of it that file.
        reader, path = reader.option("pathGlobFilter", where.getName()), str(where.getParent().toString())
    stream = reader.parquet(path)

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    run = windowed(stream, late=late).writeStream.outputMode("update").option("checkpointLocation", f"{base}/checkpoint").foreachBatch(keep).trigger(availableNow=True).start()
    run.awaitTermination()
    rows = spark.read.parquet(f"{base}/out")
    # An updated day replaces what earlier batches said of it.
    return rows.groupBy("member", "local_date").agg(F.max_by("value", "batch").alias("value"), F.max_by("n", "batch").alias("n"))
