"""A corpus from raw documents to token digests: five stages, each over all that the one before kept.

1. quality: documents that the weakly supervised scorer holds for junk go.
2. lines: of equal and similar lines the first in order of doc_id stays; a
   document that loses all its lines goes.
3. near_duplicates: of documents whose five-word shingles are similar by 0.8 or
   more, directly or in a chain, the one with the least doc_id stays.
4. decontamination: documents with a run of ten words of a benchmark item go.
5. encoding: what is left is encoded and digested.

Null texts pass the first four stages (nothing speaks against them) and have no
tokens; so do empty and blank ones. Long texts are read whole. Of repeated rows with one id
every stage treats each alike; rows with equal texts and other ids lose their
lines to the least id, and ties go to the least text hash. An empty table of documents gives an empty result,
an empty benchmark removes nothing. The first four stages keep all columns, whatever
their names. Every stage's result is written to the shared folder as Parquet.

Near copies share most of their lines, so the second stage has taken these from
all but one of them, and leaves the third those whose lines all differ a little more than
similar ones do: it finds few on this input, and all that there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forelight.llm import bpe, lines, quality, superminhash, winnow
from forelight.llm.common import Scratch, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = lines.without_similar_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return superminhash.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return winnow.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(docs, bpe.public_file())


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("encoding", encoding_stage),
]

#: Trained models, similar lines and byte-pair merges are beyond SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    scratch.drop_others(STAGES[-1][0])
    return docs
