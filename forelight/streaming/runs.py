"""Runs that are waited for: a run goes out once all of its members are there, or with what there is when its deadline has passed.

Each run's members are kept in the state until then, one row for each, and a
timer of event time stands at the deadline. What arrives after the deadline, or
for a run that is out, is late and changes nothing. A run that is out is remembered up
to its deadline, so that it goes out once; from then on the watermark keeps late rows
away, and its state is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StructType

from forelight.sources.sinks import folder

#: Hours after a run's start up to which members are waited for.
DEADLINE = 24
_OUT = "init long, member int, value double, arrived long, status string, n_members int"


class Waiting(StatefulProcessor):
    """One run. Times are microseconds since 1970, as they don't depend on anybody's time zone."""

    def __init__(self, members: int, deadline: int):
        self.members, self.wait = members, deadline * 3_600_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.there = handle.getMapState("there", StructType().add("member", IntegerType()), StructType().add("arrived", LongType()).add("value", DoubleType()))
        self.out = handle.getValueState("out", StructType().add("out", BooleanType()))

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator[Row]:
        (init,) = key
        deadline = init + self.wait
        found: dict[int, tuple] = {}
        for r in rows:
            if r.arrived <= deadline and 0 <= r.member < self.members:
                offer = (r.arrived, r.value is not None, r.value)
                found[r.member] = min(found.get(r.member, offer), offer)
        # Where the watermark has passed the deadline, the timer goes off after this batch's rows; they are late all the same.
        if not found or self.out.exists() or timerValues.getCurrentWatermarkInMs() > deadline // 1000:
            return
        if not self.there.exists():
            # Timers go off once the watermark has reached them; a row of the deadline's own moment is in time.
            self.handle.registerTimer(deadline // 1000 + 1)
        for member, offer in found.items():
            known = self.there.getValue((member,)) if self.there.containsKey((member,)) else None
            if known is None or offer[0] < known[0]:
                self.there.updateValue((member,), (offer[0], offer[2]))
        rows_there = dict((k[0], v) for k, v in self.there.iterator())
        if len(rows_there) == self.members:
            yield from self._rows(init, rows_there, "complete")
            self.there.clear()
            self.out.update((True,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.out.exists():
            yield from self._rows(key[0], dict((k[0], v) for k, v in self.there.iterator()), "deadline")
        self.there.clear()
        self.out.clear()

    def _rows(self, init: int, there: dict, status: str) -> Iterator[Row]:
        for member in range(self.members):
            arrived, value = there.get(member, (None, None))
            yield Row(init=init, member=member, value=value, arrived=arrived, status=status, n_members=len(there))


def _micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)


def _moment(micros: str) -> Column:
    return (F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col(micros) / 1_000_000).cast("decimal(18,6)"))).alias(micros)


def waited(arrivals: DataFrame, members: int, deadline: int = DEADLINE, late: str = "0 seconds") -> DataFrame:
    """A row for each member of each run that is out (init, member, value, arrived, status, n_members; null where it didn't come), of a stream (init, member, arrived, value)."""
    rows = arrivals.select(_micros(F.col("init")).alias("init"), F.col("member").cast("int").alias("member"), _micros(F.col("arrived")).alias("arrived"), F.col("value").cast("double").alias("value"))
    # The watermark needs an instant; the wall-clock time is taken as if clocks stood at UTC.
    rows = rows.withColumn("at", F.timestamp_micros("arrived")).withWatermark("at", late)
    return rows.groupBy("init").transformWithState(statefulProcessor=Waiting(members, deadline), outputStructType=_OUT, outputMode="Append", timeMode="EventTime")


def run(spark: SparkSession, path: str, arrivals, members: int, deadline: int = DEADLINE, late: str = "0 seconds", base: str | None = None, files: int = 8) -> tuple[DataFrame, list[dict]]:
    """All rows that a stream over a folder (or file) of Parquet has given out, and its progress. Called again with the same ``base``, it goes on with what has come since.

    ``arrivals`` makes (init, member, arrived, value) of what is read. The state
    is held in RocksDB on the executors and saved with the checkpoint.
    """
    base = base or folder(spark, "runs")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory():
        reader, path = reader.option("pathGlobFilter", where.getName()), str(where.getParent().toString())
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def keep(batch: DataFrame, number: int) -> None:
        # A batch that is repeated after a failure replaces itself.
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    try:
        stream = waited(arrivals(reader.parquet(path)), members, deadline, late).writeStream.outputMode("append").option("checkpointLocation", f"{base}/checkpoint").foreachBatch(keep).trigger(availableNow=True).start()
        stream.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(provider)
        else:
            spark.conf.set(provider, before)
    rows = spark.read.schema(f"{_OUT}, batch int").parquet(f"{base}/out").drop("batch")
    return rows.select(_moment("init"), "member", "value", _moment("arrived"), "status", "n_members"), list(stream.recentProgress)


def waited_at_once(arrivals: DataFrame, members: int, deadline: int = DEADLINE) -> DataFrame:
    """What :func:`waited` gives out of a table whose arrivals have all come, by a join: runs that wait at its last arrival aren't out."""
    in_time = arrivals.where((F.col("arrived") <= F.col("init") + F.make_dt_interval(hours=F.lit(deadline))) & F.col("member").between(0, members - 1))
    first = in_time.groupBy("init", "member").agg(F.min(F.struct("arrived", F.col("value").isNotNull().alias("known"), "value")).alias("x"))
    last = arrivals.agg(F.max("arrived").alias("last"))
    sizes = first.groupBy("init").agg(F.count("*").cast("int").alias("n_members"))
    # One row of one number meets all runs.
    out = sizes.crossJoin(F.broadcast(last)).where((F.col("n_members") == members) | (F.col("init") + F.make_dt_interval(hours=F.lit(deadline)) < F.col("last")))
    status = F.when(F.col("n_members") == members, "complete").otherwise("deadline").alias("status")
    every = out.select("init", "n_members", status, F.explode(F.sequence(F.lit(0), F.lit(members - 1))).alias("member"))
    return every.join(first, ["init", "member"], "left").select("init", "member", F.col("x.value").alias("value"), F.col("x.arrived").alias("arrived"), "status", "n_members")
