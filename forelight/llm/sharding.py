"""Sharding by balanced label propagation.

Documents with equal texts are linked. Every linked document starts in the shard
of its id's hash. In each round linked documents propose to move to the shard
where most of their neighbours are, of those that have room, if it has more of
them than their own; proposals are taken in the order of a hash for as long as
the shard's quota has room, in the last round as in the first. Documents without
links have no neighbour to follow, so they wait, and fill up the shards at the end.
Members of a group are alike to the propagation, so its state has a row for
each group and block of id hashes, not for each link; groups that are large
against a quota move block by block, and fill one shard after the other.

A linked document's shard is its label. Only where a label holds more rows than
its shard may at the end (by the last row, or where nearly all rows are linked,
by the quota's slack) do its last ones go to shards that hold fewer, as documents
without links do.

Defined results: null counts as the empty text; texts that are equal byte by
byte are linked; null ids come first among their group. Long texts count like
others, by their hash. Repeated rows and other ties are ranked one after the
other; which of two equal rows gets which slot can't be told. An empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forelight.llm.common import Scratch, table

SHARDS, ROUNDS, BLOCKS = 24, 24, 1024
#: Room above the mean that quotas leave where nearly all documents are linked; proposals are taken by so many slots of their hash.
SLACK, SLOTS = 0.05, 512
#: Groups of more than this share of a quota move block by block; shards with less room than one in FULL of a quota count as full.
LARGE, FULL = 0.125, 16

_GROUP = ["g", "crc", "size"]


def _of(values: list[int], place: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v).cast("long") for v in values)), place.cast("int") + 1)


def _held(state: DataFrame, shards: int) -> list[int]:
    held = dict.fromkeys(range(shards), 0) | {r[0]: r[1] for r in state.groupBy("label").agg(F.sum("n")).collect()}
    return [held[s] for s in range(shards)]


def _limits(asked: dict[int, dict[int, int]], room: list[int]) -> list[int]:
    """Per shard, the slot before which all proposals are taken: they fit its room."""
    out = []
    for s, free in enumerate(room):
        limit = 0
        for limit in range(SLOTS + 1):
            free -= asked.get(s, {}).get(limit, 0)
            if free < 0:
                break
        out.append(limit)
    return out


def propagated(units: DataFrame, total: int, shards: int, rounds: int, scratch: Scratch) -> DataFrame:
    """(group, block, label) of groups with links; ``units`` has a row per document: the group's columns and the block."""
    counts = units.groupBy(*_GROUP, "block").agg(F.count("*").alias("n"))
    linked = scratch.keep(counts.groupBy(*_GROUP).agg(F.sum("n").alias("all")).where(F.col("all") > 1), "linked")
    state = scratch.keep(counts.join(linked, _GROUP).withColumn("label", F.expr(f"cast(block % {shards} as int)")), "labels-0")
    held = _held(state, shards)
    quota = max(1, total // shards, int(sum(held) * (1 + SLACK)) // shards)
    for k in range(rounds):
        room = [quota - h if (quota - h) * FULL > quota else 0 for h in held]
        near = state.groupBy(*_GROUP, "label").agg(F.sum("n").alias("m")).withColumn("rank", F.struct("m", F.xxhash64(*_GROUP, "label"), "label"))
        best = near.groupBy(*_GROUP).agg(F.max(F.when(_of(room, F.col("label")) > 0, F.col("rank"))).alias("best"))
        moves = near.join(best, _GROUP).where("best > rank").select(*_GROUP, "label", F.col("best.label").alias("to"))
        # What moves as one has one slot.
        unit = F.when(F.col("all") > LARGE * quota, F.col("block")).otherwise(-1)
        wish = state.join(moves, [*_GROUP, "label"], "left").withColumn("slot", F.pmod(F.xxhash64(*_GROUP, unit, F.lit(k)), F.lit(SLOTS)).cast("int"))
        wish = scratch.keep(wish, f"wish-{k}")
        # A row for each shard and slot.
        asked: dict[int, dict[int, int]] = {}
        for r in wish.where("to is not null").groupBy("to", "slot").agg(F.sum("n").alias("n")).collect():
            asked.setdefault(r["to"], {})[r["slot"]] = r["n"]
        if not asked:
            scratch.drop(f"wish-{k}")
            break
        goes = F.col("to").isNotNull() & (F.col("slot") < _of(_limits(asked, room), F.col("to")))
        state = scratch.keep(wish.withColumn("label", F.when(goes, F.col("to")).otherwise(F.col("label"))).drop("to", "slot"), f"labels-{k + 1}")
        held = _held(state, shards)
        scratch.drop(f"labels-{k}", f"wish-{k}")
    return state.select(*_GROUP, "block", "label")


def ranked(df: DataFrame, order: list[Column], scratch: Scratch) -> DataFrame:
    """df with ``rank``, gapless from 0 in the given order.

    Rows are dealt by ranges and numbered within them; only a count per range
    reaches the driver.
    """
    spark = df.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    numbered = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_n", F.monotonically_increasing_id())
    numbered = scratch.keep(numbered, "numbered")
    sizes = {r["p"]: r["count"] for r in numbered.groupBy(F.shiftright("_n", 33).alias("p")).count().collect()}
    starts = [0, *accumulate(sizes.get(p, 0) for p in range(max(sizes, default=0) + 1))]
    return numbered.withColumn("rank", _of(starts, F.shiftright("_n", 33)) + F.col("_n").bitwiseAND((1 << 33) - 1)).drop("_n")


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, size, text_crc32, shard, slot, the group's key, and its label by propagation (null without links)."""
    scratch = Scratch(docs.sparkSession, "shards")
    text = F.coalesce(F.col(text_col), F.lit(""))
    units = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text).alias("g"),
        F.crc32(text).alias("crc"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.pmod(F.xxhash64(F.lit(1), F.col(id_col)), F.lit(BLOCKS)).cast("int").alias("block"),
    )
    units = scratch.keep(units, "units")
    n = units.count()
    labels = propagated(units, n, shards, rounds, scratch)
    placed = units.join(labels, [*_GROUP, "block"], "left").withColumn("start", F.coalesce("label", F.expr(f"cast(block % {shards} as int)")))
    # Documents with links come first in their shard, so others make room.
    order = [F.col("start"), F.col("label").isNull(), F.col("g"), F.col("crc"), F.col("size"), F.col("doc_id").asc_nulls_first()]
    out = ranked(placed, order, scratch)
    have, linked = [0] * shards, [0] * shards
    for r in out.groupBy("start", F.col("label").isNull().alias("alone")).count().collect():
        have[r["start"]] += r["count"]
        linked[r["start"]] += 0 if r["alone"] else r["count"]
    # The rows that don't divide go where most linked documents are.
    more = set(sorted(range(shards), key=lambda s: (-linked[s], s))[: n % shards])
    target = [n // shards + (s in more) for s in range(shards)]
    first = [0, *accumulate(have)]
    leave = [0, *accumulate(max(0, h - t) for h, t in zip(have, target, strict=True))]
    lack = [0, *accumulate(max(0, t - h) for h, t in zip(have, target, strict=True))]
    place = F.col("rank") - _of(first, F.col("start"))
    turn = _of(leave, F.col("start")) + place - _of(target, F.col("start"))
    out = out.withColumn("_place", place).withColumn("_turn", F.when(place >= _of(target, F.col("start")), turn))
    ends = F.array(*(F.lit(e).cast("long") for e in lack[1:]))
    out = out.withColumn("shard", F.when(F.col("_turn").isNull(), F.col("start")).otherwise(F.size(F.filter(ends, lambda e: e <= F.col("_turn")))))
    kept = [min(h, t) for h, t in zip(have, target, strict=True)]
    slot = F.when(F.col("_turn").isNull(), F.col("_place")).otherwise(_of(kept, F.col("shard")) + F.col("_turn") - _of(lack, F.col("shard")))
    scratch.drop_others("numbered")
    return out.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.col("shard").cast("int").alias("shard"), slot.cast("long").alias("slot"), F.col("g").alias("group_key"), "label")


def op3_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "group_key", "label")
