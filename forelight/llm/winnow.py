"""Benchmark decontamination by winnowing, in DataFrame operations only.

Each text's 5-word grams are hashed; of every 6 neighbouring grams the least
hash is kept. Ten words that stand in both a document and a benchmark item
contain the same six grams, hence the same least hash, so no shared run of ten
words is missed. Documents that share a kept hash with the benchmark are
candidates; their windows are then compared with the items' word by word and
hits extended to the union of all matching windows.

Items of 1 to 9 words are one window of their own length; winnowing promises
nothing for these, so documents' grams of exactly such lengths are looked up.

Defined results: a null or empty text has no words, no hits and is not
contaminated; an item without words matches nothing. Long texts are read whole.
Repeated rows, and rows that share an id, come out as often as they go in.
Repeated items count by their ids, null ids not at all; items that tie for a
window all count. Empty tables give empty results or no hits. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forelight.llm.common import Scratch, grams, lower_ascii, row_key, table

#: Words of a window, of a hashed gram, and grams among which the least is kept.
WINDOW, GRAM = 10, 5
KEEP_OF = WINDOW - GRAM + 1

_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _GAPS), "")


def winnowed(gram_hashes: Column) -> Column:
    """Distinct least hashes of all runs of KEEP_OF grams."""
    return F.when(
        F.size(gram_hashes) >= KEEP_OF,
        F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(gram_hashes) - KEEP_OF + 1), lambda i: F.array_min(F.slice(gram_hashes, i, KEEP_OF)))),
    ).otherwise(F.array().cast("array<bigint>"))


def _windows(word_array: Column, n: Column | int) -> Column:
    """(window, where it starts) for all runs of n words."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.when(
        (n > 0) & (F.size(word_array) >= n),
        F.transform(F.sequence(F.lit(1), F.size(word_array) - n + 1), lambda i: F.struct(F.array_join(F.slice(word_array, i, n), " ").alias("win"), i.alias("at"))),
    )


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, text key, n_words, n_hit, item ids whose windows occur (sorted as strings), hit starts."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "winnow")
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("k"))

    items = bench.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).where("item is not null and size(w) > 0")
    items = items.withColumn("n", F.least(F.size("w"), F.lit(WINDOW))).withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    # Small as a rule; once written, its size is known and decides between a broadcast and a shuffled join.
    item_windows = scratch.keep(items.select("item", "n", F.explode(_windows(F.col("w"), F.col("n"))).alias("x")).groupBy("n", "x.win").agg(F.collect_set("item").alias("items")), "windows")
    prints = items.where(F.col("n") == WINDOW).select(F.explode(winnowed(grams(F.col("h"), GRAM))).alias("f"))
    short = [r[0] for r in item_windows.where(F.col("n") < WINDOW).select("n").distinct().orderBy("n").collect()]  # at most nine
    for n in short:
        prints = prints.unionByName(items.where(F.col("n") == n).select(F.explode(grams(F.col("h"), n)).alias("f")))
    prints = scratch.keep(prints.distinct().withColumn("found", F.lit(1)), "prints")

    hashed = docs.select("k", "doc_id", F.transform(words(F.col("text")), lambda x: F.xxhash64(x)).alias("h"))
    wanted = winnowed(F.col("g"))
    for n in short:
        wanted = F.array_union(wanted, grams(F.col("h"), n))
    kept = hashed.withColumn("g", grams(F.col("h"), GRAM)).select("k", "doc_id", F.size("h").cast("long").alias("n_words"), F.posexplode_outer(wanted).alias("p", "f"))
    # The map side folds a document's rows into one, so the shuffle carries a short row per document.
    # Documents without hashes get a key of their own, so that they don't all go to one task. A row's first hash, or none, counts the row.
    kept = kept.withColumn("key", F.coalesce("f", "k"))
    once = F.count_if(F.col("p").isNull() | (F.col("p") == 0)).alias("copies")
    seen = kept.join(prints.withColumnRenamed("f", "key"), "key", "left").groupBy("k", "doc_id").agg(F.max("n_words").alias("n_words"), F.max(F.when(F.col("f").isNotNull(), F.col("found"))).alias("found"), once)
    seen = scratch.keep(seen, "seen")

    # Written for its size: few candidates are broadcast, many are joined by a shuffle.
    wanted_docs = scratch.keep(seen.where("found = 1").select(F.col("k").alias("ck"), F.col("doc_id").alias("cid")), "candidates")
    candidates = docs.join(wanted_docs, (F.col("k") == F.col("ck")) & F.col("doc_id").eqNullSafe(F.col("cid")), "left_semi").select("k", "doc_id", words(F.col("text")).alias("w"))
    runs = None
    for n in [*short, WINDOW]:
        found = candidates.select("k", "doc_id", F.lit(n).alias("n"), F.explode(_windows(F.col("w"), n)).alias("x")).select("k", "doc_id", "n", "x.win", "x.at")
        runs = found if runs is None else runs.unionByName(found)
    hits = (
        runs.join(item_windows, ["n", "win"])
        .groupBy("k", "doc_id")
        .agg(F.array_distinct(F.flatten(F.collect_list(F.transform(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1), lambda i: i)))).alias("hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    )
    hits = scratch.keep(hits.select(F.col("k").alias("hk"), F.col("doc_id").alias("hid"), F.size("hit").cast("long").alias("hit_words"), F.array_sort("hit").alias("hit"), "items"), "hits")
    scratch.drop_others("seen", "hits")
    out = seen.join(hits, (F.col("k") == F.col("hk")) & F.col("doc_id").eqNullSafe(F.col("hid")), "left")
    none = F.array().cast("array<string>")
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.select("doc_id", "k", "n_words", F.coalesce("hit_words", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"), F.coalesce("hit", F.array().cast("array<int>")).alias("hit_positions"))


def decontaminate(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The documents without a hit, with all their columns."""
    hit = contamination(docs, bench).where("n_hit > 0").select(F.col("k").alias("hk"), F.col("doc_id").alias("hid")).distinct()
    hit = Scratch(docs.sparkSession, "winnow-hit").keep(hit, "hit")
    # The row travels as one column, so that no name of its own clashes.
    rows = docs.select(row_key("doc_id", "text").alias("_k"), F.col("doc_id").alias("_id"), F.struct("*").alias("_whole"))
    return rows.join(hit, (F.col("_k") == F.col("hk")) & F.col("_id").eqNullSafe(F.col("hid")), "left_anti").select("_whole.*")


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP8_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iwin AS (
  SELECT DISTINCT item, n, array_to_string(w[s0:s0 + n - 1], ' ') AS win
  FROM (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s0 FROM iw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM iwin),
dwin AS (
  SELECT doc_id, n, s0, array_to_string(w[s0:s0 + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s0 FROM dw, lens WHERE len(w) >= n)),
hits AS (SELECT doc_id, s0, n, item FROM dwin JOIN iwin USING (n, win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s0, s0 + n)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
