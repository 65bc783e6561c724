"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame operations only.

The sketch of a text is the K least of the distinct 48-bit hashes of its
5-word shingles (ASCII case folded, words split at ASCII white space); a text
of fewer words is one shingle. Two sketches estimate resemblance and
containment, one estimates the number of distinct shingles, and the sketch of
a union is the K least hashes of its parts' sketches.

Defined results: null counts as the empty text; texts without words have an
empty sketch; two empty sketches are alike (1), an empty and another one are
not (0). Rows equal in id and text count each. A single document is its own
next one. Null ids come first. Empty tables give empty results. Other columns
of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forelight.llm.common import grams, lower_ascii, table

K, SHINGLE, BITS = 128, 5, 48

_NONE = "array<bigint>"


def shingles(text: Column) -> Column:
    """Array of the distinct shingle hashes."""
    words = F.array_remove(F.split(lower_ascii(text), r"[\x20\x09-\x0D]+"), "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return hashes


def _sketch(hashes: Column) -> Column:
    # One shingle for short texts: the hash of all of the words' hashes.
    all_of = F.aggregate(hashes, F.lit(SHINGLE).cast("bigint"), lambda a, x: F.xxhash64(a, x))
    found = F.when(F.size(hashes) >= SHINGLE, grams(hashes, SHINGLE)).when(F.size(hashes) > 0, F.array(all_of)).otherwise(F.array().cast(_NONE))
    return F.slice(F.sort_array(F.array_distinct(F.transform(found, lambda h: F.shiftrightunsigned(h, 64 - BITS)))), 1, K)


def with_sketch(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """df and the sketch of a text column, as an ascending array of longs."""
    return df.withColumn("_h", shingles(F.coalesce(F.col(text_col), F.lit("")))).withColumn(name, _sketch(F.col("_h"))).drop("_h")


def resemblance(a: Column, b: Column) -> Column:
    """Estimated share of shingles that both have among those that either has."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, K)
    both = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.greatest(F.size(union), F.lit(1)))


def distinct_count(a: Column) -> Column:
    """Estimated number of distinct shingles; exact below K."""
    return F.when(F.size(a) < K, F.size(a).cast("double")).otherwise(F.lit(float((K - 1) << BITS)) / F.element_at(a, -1))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has."""
    r = resemblance(a, b)
    either = (distinct_count(a) + distinct_count(b)) / (1 + r)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), r * either / F.greatest(distinct_count(a), F.lit(1.0))))


def merged(df: DataFrame, by: list[str], sketch: str) -> DataFrame:
    """Sketches of unions, one per group.

    Parts are merged where they lie first, then across; a task holds no more
    than K hashes for each part of a group, however large that is.
    """
    part = df.withColumn("_p", F.spark_partition_id() % 64)
    rows = part.select(*by, "_p", F.explode(sketch).alias("_x")).distinct()
    within = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*by, "_p").orderBy("_x"))).where(F.col("_r") <= K)
    return within.groupBy(*by).agg(F.slice(F.sort_array(F.collect_set("_x")), 1, K).alias(sketch))


def as_text(sketch: Column) -> Column:
    """Twelve hex digits for each hash, in ascending order."""
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.lower(F.hex(x)), BITS // 4, "0")), "")


def with_next(docs: DataFrame, columns: list[str], id_col: str = "doc_id") -> DataFrame:
    """docs, and for each row ``next_<column>`` of the row next in order of the id (after the last: the first).

    Rows are dealt by ranges of the id; a copy of each range's first row also
    goes to the end of the range before, so that no task needs its neighbour.
    Ranges come from approximate quantiles and don't affect the result.
    """
    spark = docs.sparkSession
    parts = min(4096, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = docs.select(F.percentile_approx(id_col, [i / parts for i in range(1, parts)] or [0.5], 10_000)).head()[0]
    cuts = F.lit(sorted(set(cuts))) if cuts else F.array().cast("array<bigint>")
    order = [id_col, *columns]
    at = F.coalesce(F.size(F.filter(cuts, lambda c: c <= F.col(id_col))), F.lit(0))
    dealt = docs.withColumn("_at", at)
    # One row per range: its least id. The driver sees ranges, not documents.
    firsts = [tuple(r) for r in dealt.groupBy("_at").agg(F.min(id_col), F.count(F.when(F.col(id_col).isNull(), 1))).orderBy("_at").collect()]
    if not firsts:
        return dealt.drop("_at").select("*", *(F.col(c).alias(f"next_{c}") for c in columns))
    before = {at: firsts[i - 1][0] for i, (at, *_) in enumerate(firsts)}
    first_ids = {at: None if nulls else low for at, low, nulls in firsts}
    moves = spark.createDataFrame([(at, first_ids[at], before[at]) for at in before], f"_a int, _first {docs.schema[id_col].dataType.simpleString()}, _to int")
    ghosts = dealt.join(F.broadcast(moves), (F.col("_at") == F.col("_a")) & F.col(id_col).eqNullSafe(F.col("_first")))  # as many rows as ranges, 4096 at most
    # Of rows that share a range's least id only the first in order is the next one.
    ghosts = ghosts.withColumn("_at", F.col("_to")).withColumn("_ghost", F.lit(1)).select(*dealt.columns, "_ghost")
    both = dealt.withColumn("_ghost", F.lit(0)).unionByName(ghosts)
    w = Window.partitionBy("_at").orderBy("_ghost", *(F.asc_nulls_first(c) for c in order))
    for c in columns:
        both = both.withColumn(f"next_{c}", F.lead(c).over(w))
    return both.where("_ghost = 0").drop("_at", "_ghost")


def op7_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = with_next(with_sketch(docs, "text", "sketch"), ["text", "sketch"])
    n, moved = F.col("n_chars"), F.col("n_chars") - F.floor(F.col("n_chars") / 4)
    docs = docs.withColumn("n_chars", F.char_length("text").cast("long"))
    docs = docs.withColumn("edited", F.concat(F.substring("text", F.lit(1), moved.cast("int")), F.substring("next_text", F.lit(1), (n - moved).cast("int"))))
    docs = with_sketch(docs.drop("text", "next_text"), "edited", "edited_sketch")
    a, b, c = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return docs.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(a).alias("fingerprint"),
        as_text(b).alias("edited_fingerprint"),
        resemblance(a, b).alias("near_edited"),
        resemblance(a, c).alias("near_next"),
        distinct_count(a).alias("n_shingles_estimate"),
        containment(a, b).alias("held_by_edited"),
    )
