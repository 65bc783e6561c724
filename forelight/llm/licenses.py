"""License scans: an exact set-similarity join of texts with templates, in DataFrame operations only.

A template is a set of words with a threshold: a block of a text, as many words
as the template has and a quarter more, matches if it holds so many per cent of
the template's different words. Phrases are templates that must stand word for
word; their blocks are as long as they are and hold all their words.

Words are ordered by how many texts of the corpus have them. A block that holds
o of a template's s words holds at least one of its s - o + 1 rarest, its
prefix; texts without a word of any prefix are passed over where they are read.
Of the others, a text of fewer than o words can't hold a template (length), and
words that are farther from a word of the prefix than a block is long are in no
matching block (position). For what is left the number of different template
words in the block that ends at each place is found exactly: an occurrence adds
one from its place until the block has moved past it or the next occurrence of
the same word comes, so the count is a running sum over these steps.
Phrases are then compared word by word inside of matching blocks.

Nothing is dealt out by word or template: a word that stands in every text, or a
notice that a third of the texts carry, is counted text by text.

Defined results: a null or empty text has no words and no blocks. Long texts are
read whole. Rows are told apart, so repeated rows and rows that share an id or have none
come out as often as they go in. Words that tie in frequency are ordered by
their letters, blocks that tie for the score all count. An empty table gives an empty result. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forelight.llm.common import Scratch, table
from forelight.llm.winnow import words


class Template(NamedTuple):
    """A phrase (``least`` None: word for word) or a notice of which a block must hold ``least`` per cent."""

    label: str
    text: str
    least: int | None = 80

    @property
    def words(self) -> list[str]:
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", self.text)

    @property
    def width(self) -> int:
        return len(self.words) if self.least is None else len(self.words) * 5 // 4

    @property
    def needed(self) -> int:
        size = len(set(self.words))
        return size if self.least is None else -(-self.least * size // 100)


# Phrases that name a license.
PHRASES = [
    Template("gpl", "gnu general public license", None),
    Template("apache", "apache license", None),
    Template("cc-by", "cc by", None),
    Template("mit", "mit license", None),
]
# The usual notices, in lower case, without marks.
NOTICES = [
    Template("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation"),
    Template("apache", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license"),
    Template("artistic", "you may redistribute it and or modify it under the terms of the artistic license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("bsl", "distributed under the boost software license version 1 0"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    Template("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    Template("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    Template("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license"),
    Template("odbl", "this database is made available under the open database license"),
    Template("rights-reserved", "all rights reserved no part of this publication may be reproduced distributed or transmitted in any form or by any means"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages"),
]


def _ranked(docs: DataFrame, templates: list[Template], text_col: str) -> list[tuple[int, str, bool]]:
    """(template, word, whether it is in the template's prefix), by the words' frequency in all texts. As many rows as the templates have words."""
    known = sorted({w for t in templates for w in t.words})
    held = docs.select(F.explode(F.array_intersect(words(F.col(text_col)), F.array(*map(F.lit, known)))).alias("word"))
    count = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    out = []
    for i, t in enumerate(templates):
        order = sorted(set(t.words), key=lambda w: (count.get(w, 0), w))
        prefix = len(order) - t.needed + 1
        out += [(i, w, k < prefix) for k, w in enumerate(order)]
    return out


def matches(docs: DataFrame, templates: list[Template], scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables.

    Texts (row, id, n_words); blocks (row, template, start, end, share): runs of
    matching blocks as word ranges, end exclusive, with the highest share of the
    template's words in one block; places (row, template, start): where phrases stand.
    """
    spark = docs.sparkSession
    ranked = _ranked(docs, templates, text_col)
    prefixes = sorted({w for _, w, prefix in ranked if prefix})
    known = sorted({w for _, w, _ in ranked})
    w = words(F.col(text_col))
    seen = docs.select(F.col(id_col).alias("id"), w.alias("w")).select("id", F.size("w").cast("long").alias("n_words"), F.when(F.arrays_overlap("w", F.array(*map(F.lit, prefixes))), F.col("w")).alias("w"))
    hits = F.filter(F.transform("w", lambda x, i: F.struct(i.cast("long").alias("pos"), x.alias("word"))), lambda x: x["word"].isin(known))
    seen = scratch.keep(seen.select("id", "n_words", hits.alias("hits")).withColumn("row", F.monotonically_increasing_id()), "seen")

    # One row for each template and word: as short as the templates.
    rules = spark.createDataFrame([(i, x, p, templates[i].width, templates[i].needed, len(set(templates[i].words))) for i, x, p in ranked], "template int, word string, prefix boolean, width int, needed int, size int")
    found = seen.where("hits is not null").select("row", "n_words", F.explode("hits").alias("x")).select("row", "n_words", "x.pos", "x.word")
    found = found.join(F.broadcast(rules), "word").where("n_words >= needed")

    # A text's words of one template are together from here on.
    of, by = ["row", "template"], Window.partitionBy("row", "template")
    before = F.max(F.when(F.col("prefix"), F.col("pos"))).over(by.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    after = F.min(F.when(F.col("prefix"), F.col("pos"))).over(by.orderBy("pos").rowsBetween(0, Window.unboundedFollowing))
    near = found.repartition(*of).withColumns({"before": before, "after": after}).where("pos - before < width or after - pos < width")
    again = F.lead("pos").over(Window.partitionBy("row", "template", "word").orderBy("pos"))
    ends = near.withColumn("until", F.least(F.col("pos") + F.col("width"), again))
    steps = ends.select(*of, "n_words", "width", "needed", "size", F.explode(F.array(F.struct(F.col("pos").alias("at"), F.lit(1).alias("by")), F.struct(F.col("until").alias("at"), F.lit(-1).alias("by")))).alias("x"))
    steps = steps.groupBy(*of, "n_words", "width", "needed", "size", F.col("x.at").alias("at")).agg(F.sum("x.by").alias("by"))
    held = steps.withColumns({"held": F.sum("by").over(by.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)), "next": F.lead("at").over(by.orderBy("at"))})
    opens = (F.col("held") >= F.col("needed")) & ~F.coalesce(F.lag("held").over(by.orderBy("at")) >= F.col("needed"), F.lit(False))
    runs = held.withColumn("run", F.sum(opens.cast("int")).over(by.orderBy("at").rowsBetween(Window.unboundedPreceding, 0))).where("held >= needed")
    start, end = F.greatest(F.min("at") - F.first("width") + 1, F.lit(0)), F.least(F.max("next"), F.first("n_words"))
    blocks = runs.groupBy(*of, "run").agg(start.alias("start"), end.alias("end"), (F.max("held") / F.first("size")).alias("share")).drop("run")
    blocks = scratch.keep(blocks, "blocks")

    # A phrase stands where its words' places, less their places in the phrase, are the same.
    spelt = [(i, x, k, len(t.words)) for i, t in enumerate(templates) if t.least is None for k, x in enumerate(t.words)]
    spelt = spark.createDataFrame(spelt, "template int, word string, k int, n int")
    spots = seen.where("hits is not null").select("row", F.explode("hits").alias("x")).join(F.broadcast(spelt), F.col("x.word") == F.col("word"))
    spots = spots.select("row", "template", "n", (F.col("x.pos") - F.col("k")).alias("start"))
    places = spots.join(blocks.select(*of).distinct(), of, "left_semi").groupBy(*of, "start", "n").agg(F.count("*").alias("c")).where("c = n").select(*of, "start")
    return seen.select("row", "id", "n_words"), blocks, places


def licenses(docs: DataFrame, phrases: list[Template] | None = None, notices: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_words, places and blocks (label, start, end, share), each in order; a phrase's place has no share of its own."""
    scratch = Scratch(docs.sparkSession, "licenses")
    phrases, notices = PHRASES if phrases is None else phrases, NOTICES if notices is None else notices
    templates = [*phrases, *notices]
    texts, blocks, places = matches(docs, templates, scratch, id_col, text_col)
    names = docs.sparkSession.createDataFrame([(i, t.label, len(t.words)) for i, t in enumerate(templates)], "template int, label string, n int")
    places = places.join(F.broadcast(names), "template").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", (F.col("start") + F.col("n")).alias("end"), "label"))).alias("places"))
    blocks = blocks.where(F.col("template") >= len(phrases)).join(F.broadcast(names), "template")
    blocks = blocks.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "label", "share"))).alias("blocks"))
    found = scratch.keep(places.join(blocks, "row", "full").withColumnRenamed("row", "_row"), "found")
    scratch.drop_others("seen", "found")
    none = lambda c: F.coalesce(c, F.array()).alias(c)
    return texts.join(found, F.col("row") == F.col("_row"), "left").select(F.col("id").alias(id_col), "n_words", none("places"), none("blocks"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses(table(spark, sf_dir, "documents"))
    text = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    base, own = F.col("places.label"), F.col("blocks.label")
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"),
        F.array_max("places.start").alias("last_word"),
        text(base).alias("base_labels"),
        text(F.concat(base, own)).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("blocks.share"), F.lit(0.0))).alias("score"),
        F.size("blocks").cast("long").alias("n_blocks"),
    )


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


# All windows of all texts, without prefixes or filters.
OP11_SQL = rf"""
WITH t(t, label, phrase, width, needed, size) AS (VALUES {_values([(i, x.label, x.least is None, x.width, x.needed, len(set(x.words))) for i, x in enumerate([*PHRASES, *NOTICES])])}),
tw(t, k, word) AS (VALUES {_values([(i, k, w) for i, x in enumerate([*PHRASES, *NOTICES]) for k, w in enumerate(x.words)])}),
d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
x AS (SELECT row, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d),
p AS (SELECT row, t, pos - k AS start FROM x JOIN tw USING (word) JOIN t USING (t) WHERE phrase GROUP BY row, t, pos - k, size HAVING count(*) = size),
base AS (SELECT row, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM p JOIN t USING (t) GROUP BY row),
o AS (SELECT row, t, pos, width, needed, size, least(pos + width, lead(pos) OVER (PARTITION BY row, t, word ORDER BY pos)) AS until FROM x JOIN (SELECT DISTINCT t, word FROM tw) USING (word) JOIN t USING (t) WHERE NOT phrase),
s AS (SELECT row, t, width, needed, size, spot, sum(step) AS step FROM (SELECT row, t, width, needed, size, pos AS spot, 1 AS step FROM o UNION ALL SELECT row, t, width, needed, size, until, -1 FROM o) GROUP BY ALL),
h AS (SELECT *, sum(step) OVER (PARTITION BY row, t ORDER BY spot) AS held FROM s),
r AS (SELECT *, held >= needed AND NOT coalesce(lag(held) OVER (PARTITION BY row, t ORDER BY spot) >= needed, false) AS opens FROM h),
b AS (SELECT row, label, held / r.size AS share, opens FROM r JOIN t USING (t) WHERE held >= r.needed),
own AS (SELECT row, max(share) AS share, count(*) FILTER (opens) AS n_blocks FROM b GROUP BY row),
named AS (SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT row, label FROM b UNION ALL SELECT row, label FROM p JOIN t USING (t)) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, CAST(CASE WHEN n_base > 0 THEN 1 ELSE coalesce(share, 0) END AS DOUBLE) AS score, CAST(coalesce(n_blocks, 0) AS BIGINT) AS n_blocks
FROM d LEFT JOIN base USING (row) LEFT JOIN own USING (row) LEFT JOIN named USING (row)
"""
