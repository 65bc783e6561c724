"""Documents whose layout isn't known beforehand, as variants: no schema, and nothing lost that another layout has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def kind(value: Column) -> Column:
    """OBJECT, ARRAY or the name of a plain type, null for what isn't there."""
    return F.regexp_extract(F.schema_of_variant(value), r"^([A-Z]+)", 1)


def elements(df: DataFrame, keys: list[str], text: str, member: str) -> DataFrame:
    """(keys, pos, entry): the objects in each document's list, with their places in it.

    A document is a list, or an object that has the list as ``member``. Anything
    else, another layout, broken text or no text, has no entries; neither have
    elements of the list that are no objects.
    """
    docs = df.select(*keys, F.try_parse_json(F.col(text)).alias("_doc"))
    # A path is looked for in objects only; in a list it finds nothing.
    at = F.when(kind(F.col("_doc")) == "ARRAY", F.col("_doc")).when(kind(F.col("_doc")) == "OBJECT", F.try_variant_get("_doc", f"$.{member}", "variant"))
    lists = docs.withColumn("_list", at).where(kind(F.col("_list")) == "ARRAY").select(*keys, "_list")
    each = lists.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_list").outer()))
    return each.where(kind(F.col("value")) == "OBJECT").select(*keys, "pos", F.col("value").alias("entry"))


def layouts(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, layout, n, unreadable): the one schema that all documents of a group fit, and how many are no JSON."""
    docs = df.select(*keys, F.col(text).alias("_t"), F.try_parse_json(F.col(text)).alias("_doc"))
    return docs.groupBy(*keys).agg(F.schema_of_variant_agg("_doc").alias("layout"), F.count("_doc").alias("n"), F.count_if(F.col("_t").isNotNull() & F.col("_doc").isNull()).alias("unreadable"))


def bias_entries(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, pos, name, low, high, note): short-term bias notes with the optional limits within which they hold. A limit that is no number is none."""
    number = lambda c: F.try_variant_get("entry", f"$.{c}", "double").alias(c)
    return elements(df, keys, text, "biases").select(*keys, "pos", F.try_variant_get("entry", "$.name", "string").alias("name"), number("low"), number("high"), F.try_variant_get("entry", "$.note", "string").alias("note"))


def cluster_metrics(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, null_fraction, non_null_fraction, max_non_null_high) of clustering documents, by which notes are gated.

    The null cluster is the one of that kind, or number 0. What a cluster lacks counts as 0, and so does a document without clusters.
    """
    found = elements(df, keys, text, "clusters")
    get = lambda path, kind: F.try_variant_get("entry", path, kind)
    calm = (F.coalesce(get("$.kind", "string"), F.lit("")) == "null") | (F.coalesce(get("$.id", "int"), F.lit(-1)) == 0)
    part, high = F.coalesce(get("$.fraction", "double"), F.lit(0.0)), F.coalesce(get("$.risk_profile.weighted_high", "double"), F.lit(0.0))
    sums = found.groupBy(*keys).agg(
        F.sum(F.when(calm, part).otherwise(0.0)).alias("null_fraction"), F.sum(F.when(~calm, part).otherwise(0.0)).alias("non_null_fraction"), F.greatest(F.max(F.when(~calm, high)), F.lit(0.0)).alias("max_non_null_high")
    )
    out = df.select(*keys).join(sums, keys, "left")
    return out.select(*keys, *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("null_fraction", "non_null_fraction", "max_non_null_high")))
