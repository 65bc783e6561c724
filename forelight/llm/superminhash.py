"""Near-duplicate documents by SuperMinHash.

A document's set is its distinct word shingles. Of each element a pseudo-random
permutation of the signature's places is drawn: at the j-th step the element
offers j plus a fraction to the place that its permutation has j-th, and each
place keeps the least offer. A document's later steps are left out once none
can lower a place. Documents with equal sets form a class with one
representative. Signatures are banded; in each bucket of a band, members are
linked to two of them, and links whose signatures agree too little wait. Inside each component of these candidate links the sets
themselves are compared, with no pair left out but those already connected, and
components of the confirmed links are found. Then come the buckets of more than
three members that are not one component by now: all their members are
compared in the same way, whatever their signatures, so every pair that shares
such a bucket is settled exactly.

With 42 bands of 5 places, two sets of similarity 0.8 share no bucket with a
probability of 1e-7; their signatures agree in so few places that a link to a
hub waits with one of 1e-9, which is final in buckets of two or three. Shingles
are compared by 128 bits.

Defined results: a null text, or one without words, has an empty set, is linked
with nothing and is its own component. Long texts are read whole. Rows with equal ids are one node of the
link graph; rows with a null id never link others, but learn of their class.
Repeated rows come out as often as they go in; of documents that tie the one with
the least id names the component. Empty tables give empty results;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forelight.llm import shingle
from forelight.llm.common import Scratch, blocks, flat, mix, table, small_batches
from forelight.llm.components import components

BANDS, ROWS = 42, 5
#: Places of a signature: a prime, so that i -> a * i + b permutes them.
PLACES = 211
#: Signatures of sets with similarity 0.8 agree in fewer places than this with a probability of 1e-9.
LEAST_AGREED = 0.62
#: Orders by which buckets choose hubs.
ORDERS = 3
#: Shingles compared in one task; larger candidate components are split into blocks, and pairs of blocks into tasks.
TASK_SHINGLES = 400_000
#: Rows that a task reads at a time. Spark's 4,096 are whole texts, and those of all tasks of an executor share its heap.
READ_ROWS = 512

U = np.uint64


def signatures(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of PLACES values for each set; places of empty sets hold the largest value."""
    rows = len(offsets) - 1
    out = np.full(rows * PLACES, np.iinfo(np.uint64).max, np.uint64)
    row = np.repeat(np.arange(rows), np.diff(offsets))
    seed = hashes
    step = (mix(seed ^ U(0xA5A5A5A5A5A5A5A5)) % U(PLACES - 1)).astype(np.int64) + 1
    place = (mix(seed + U(0x632BE59BD9B4E019)) % U(PLACES)).astype(np.int64)
    for j in range(PLACES):
        if not len(row):
            break
        offer = (U(j) << U(32)) | (mix(seed + U((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) >> U(32))
        np.minimum.at(out, row * PLACES + place, offer)
        # A row goes on while one of its places holds what the next step could lower.
        open_rows = (out.reshape(rows, PLACES).max(axis=1) >> U(32)) > j
        if not open_rows.all():
            going = open_rows[row]
            row, seed, step, place = row[going], seed[going], step[going], place[going]
        place = place + step
        place[place >= PLACES] -= PLACES
    return out.reshape(rows, PLACES)


def _describe(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in blocks(batch.column(2)):
                part = batch.slice(low, high - low)
                hashes, checks, offsets = shingle.sets(*flat(part.column(2)), size)
                count = np.diff(offsets)
                sums = []
                for values, salt in ((hashes, U(0x243F6A8885A308D3)), (checks, U(0x13198A2E03707344))):
                    total = np.zeros(len(values) + 1, np.uint64)
                    np.cumsum(mix(values ^ salt), out=total[1:])
                    sums.append((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64))
                places = signatures(hashes, offsets)
                bands = np.empty((len(count), BANDS), np.uint64)
                for b in range(BANDS):
                    key = np.full(len(count), U(b + 1), np.uint64)
                    for k in range(ROWS):
                        key = mix(key * U(0x9E3779B97F4A7C15) + places[:, b * ROWS + k])
                    bands[:, b] = key
                short = (mix(places) >> U(48)).astype(np.uint16).view(np.int16)
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, a.size + 1, a.shape[1]), pa.int32()), pa.array(a.ravel())) for a in (bands.view(np.int64), np.ascontiguousarray(short))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(count), *map(pa.array, sums), *lists], names=["doc_id", "k", "n", "s1", "s2", "bands", "places"])

    return run


def _linked(rows: list[np.ndarray], checks: list[np.ndarray], least: int) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) that span the components of sets with at least ``least`` per cent in common; shingles are equal if both their numbers are."""
    left = np.arange(len(rows))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            top = queue.pop()
            u, v = rows[top], checks[top]
            sizes = np.array([len(rows[i]) for i in left])
            # Sizes alone rule out most pairs.
            fits = np.flatnonzero((100 * sizes >= least * len(u)) & (100 * len(u) >= least * sizes))
            if not len(fits):
                continue
            joined = np.concatenate([rows[i] for i in left[fits]])
            found = np.minimum(np.searchsorted(u, joined), len(u) - 1)
            equal = (u[found] == joined) & (v[found] == np.concatenate([checks[i] for i in left[fits]]))
            starts = np.zeros(len(fits), np.int64)
            np.cumsum(sizes[fits][:-1], out=starts[1:])
            both = np.add.reduceat(equal.astype(np.int64), starts)
            near = fits[100 * both >= least * (len(u) + sizes[fits] - both)]
            if len(near):
                root = left[near]
                yield from ((int(i), -1) for i in root)
                queue += list(root)
                left = np.delete(left, near)
        yield (-1, -1)


def _confirm(size: int, least: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids, comps = group.column("node").to_numpy(), group.column("component").to_numpy()
        texts = group.column("text").chunk(0) if group.num_rows else pa.array([], pa.string())
        found: list[np.ndarray] = []
        seconds: list[np.ndarray] = []
        for low, high in blocks(texts):
            h, g, o = shingle.sets(*flat(texts.slice(low, high - low)), size)
            found += [h[o[i] : o[i + 1]] for i in range(len(o) - 1)]
            seconds += [g[o[i] : o[i + 1]] for i in range(len(o) - 1)]
        a, b = [], []
        order = np.argsort(comps, kind="stable")
        cuts = np.flatnonzero(np.diff(comps[order])) + 1
        for members in np.split(order, cuts):
            # Largest ids last, so a component's first member is its least.
            members = members[np.argsort(ids[members], kind="stable")]
            rest = set(range(len(members)))
            for head, group_of in _spans([found[i] for i in members], [seconds[i] for i in members], least, rest):
                for i in group_of:
                    a.append(ids[members[head]])
                    b.append(ids[members[i]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _spans(rows: list[np.ndarray], checks: list[np.ndarray], least: int, rest: set[int]) -> Iterator[tuple[int, list[int]]]:
    """(first member, other members) of each component of the given sets."""
    head, members = (min(rest), []) if rest else (-1, [])
    for i, _ in _linked(rows, checks, least):
        if i < 0:
            yield head, members
            rest -= {head, *members}
            head, members = (min(rest), []) if rest else (-1, [])
        else:
            members.append(i)
    if members:
        yield head, members


def _compared(links: DataFrame, texts: DataFrame, reps: DataFrame, size: int, least: int, scratch: Scratch, name: str) -> DataFrame:
    """(a, b): confirmed pairs that connect all similar members of each component of the candidate links; reps has (node, doc_id, k, n)."""
    candidates = scratch.keep(components(links, scratch, f"{name}-candidates"), f"{name}-nodes")
    # Each node goes to one task, or, in components too large for one, to a task for every other block.
    sized = candidates.join(reps.withColumnsRenamed({"doc_id": "rep", "k": "rep_k"}), "node")
    totals = sized.groupBy("component").agg(F.sum("n").alias("total")).withColumn("parts", F.ceil(F.col("total") / TASK_SHINGLES).cast("int"))
    total = totals.select(F.sum("total")).head()[0]
    bins = max(1, -(-(total or 0) * 2 // TASK_SHINGLES))
    placed = sized.join(totals, "component").withColumn("part", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("node"), F.col("parts"))).otherwise(0))
    task = F.when(F.col("parts") == 1, F.array(F.struct(F.pmod(F.xxhash64("component"), F.lit(bins)).alias("x"), F.lit(-1).cast("long").alias("i"), F.lit(-1).cast("long").alias("j")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda q: F.struct(F.col("component").alias("x"), F.least(q, F.col("part")).cast("long").alias("i"), F.greatest(q, F.col("part")).cast("long").alias("j")))
    )
    placed = scratch.keep(placed.select("node", "rep", "rep_k", "component", F.explode(task).alias("task")).select("node", "rep", "rep_k", "component", "task.*"), f"{name}-placed")
    near = texts.join(placed, (F.col("doc_id") == F.col("rep")) & (F.col("rep_k").isNull() | (F.col("k") == F.col("rep_k"))))
    confirmed = near.select("node", "component", "text", "x", "i", "j").groupBy("x", "i", "j").applyInArrow(_confirm(size, least), "a long, b long")
    return scratch.keep(confirmed, f"{name}-links")


def near_duplicates(docs: DataFrame, size: int = 5, least: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least id reachable), kept, class_id (least id with an equal set)."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    scratch = Scratch(spark, "near", READ_ROWS)
    # Rows are told apart by id and a key of the text, as an id may have several.
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("k"), F.col(text_col).alias("text"))
    seen = scratch.keep(texts.mapInArrow(_describe(size), "doc_id long, k long, n long, s1 long, s2 long, bands array<long>, places array<short>"), "seen")

    # A class is all rows with an equal set; it has a number, and its least id and one of that id's texts stand for it.
    key = ["n", "s1", "s2"]
    classes = scratch.keep(seen.where("n > 0").groupBy(*key).agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "k"))).alias("rep")).withColumn("node", F.monotonically_increasing_id()), "classes")
    marked = classes.where("rep is not null").select("node", F.col("rep.doc_id").alias("rep"), F.col("rep.k").alias("rep_k"), *(F.col(c).alias(f"_{c}") for c in key))
    same = F.expr("doc_id = rep and k = rep_k and n = _n and s1 = _s1 and s2 = _s2")
    reps = scratch.keep(seen.join(marked, same).select("node", "doc_id", "k", "n", "bands", "places").dropDuplicates(["node"]), "reps")

    # Buckets choose their hubs by one of a few orders of all nodes: members of several buckets mostly find the same hubs
    # in them, so a large group has few links for each of its members, and a pair that shares buckets has a few chances to meet.
    keys = reps.select("node", F.explode("bands").alias("key"))
    turn = F.xxhash64("node", F.pmod("key", F.lit(ORDERS)))
    hubs = keys.groupBy("key").agg(F.min_by("node", turn).alias("low"), F.max_by("node", turn).alias("high")).where("low <> high")
    members = scratch.keep(keys.join(hubs, "key").select("key", "node", "low", "high"), "members")
    pairs = members.select(F.col("low").alias("a"), F.col("node").alias("b")).unionByName(members.select(F.col("node").alias("a"), F.col("high").alias("b"))).where("a <> b").distinct()
    pairs = scratch.keep(pairs, "pairs")
    places = reps.select("node", "n", "places")
    pairs = pairs.join(places.toDF("a", "na", "pa"), "a").join(places.toDF("b", "nb", "pb"), "b")
    agreed = F.size(F.filter(F.zip_with("pa", "pb", lambda x, y: x == y), lambda x: x))
    links = pairs.where((100 * F.col("na") >= least * F.col("nb")) & (100 * F.col("nb") >= least * F.col("na")))
    links = links.where(agreed >= int(LEAST_AGREED * PLACES)).select("a", "b")
    # Few ids have several texts; only theirs are told apart, so that what the texts are joined with stays short.
    several = seen.where("doc_id is not null").groupBy("doc_id").agg(F.min("k").alias("k0"), F.max("k").alias("k1")).where("k0 <> k1").select(F.col("doc_id").alias("_id"))
    several = scratch.keep(several, "several")
    short = reps.join(several, F.col("doc_id") == F.col("_id"), "left").select("node", "doc_id", F.when(F.col("_id").isNotNull(), F.col("k")).alias("k"), "n")
    short = scratch.keep(short, "short")
    near = _compared(links, texts, short, size, least, scratch, "near")
    found = scratch.keep(components(near, scratch, "first"), "first")

    of = members.join(found, "node", "left").withColumn("c", F.coalesce("component", "node"))
    opened = of.groupBy("key").agg(F.count("*").alias("m"), F.min("c").alias("c0"), F.max("c").alias("c1")).where("m > 3 and c0 <> c1").select("key")
    rest = scratch.keep(members.join(opened, "key").select(F.col("low").alias("a"), F.col("node").alias("b")).where("a <> b").distinct(), "open")
    again = not rest.isEmpty()
    if again:
        near = near.unionByName(_compared(rest, texts, short, size, least, scratch, "rest"))

    # Different texts under one id are one node of the link graph: their classes are linked.
    taken = seen.where("n > 0").join(several, F.col("doc_id") == F.col("_id")).select("doc_id", *key).join(classes.select(*key, "node"), key).select("doc_id", "node").distinct()
    joined = scratch.keep(taken.join(taken.groupBy("doc_id").agg(F.min("node").alias("a")), "doc_id").select("a", F.col("node").alias("b")).where("a <> b"), "taken")
    if again or not joined.isEmpty():
        found = scratch.keep(components(near.unionByName(joined), scratch, "found"), "all")

    named = classes.join(found, "node", "left").withColumn("c", F.coalesce("component", "node"))
    least_ids = named.groupBy("c").agg(F.min("rep.doc_id").alias("component"))
    named = named.select("c", F.col("rep.doc_id").alias("rep"), *(F.col(c).alias(f"_{c}") for c in key)).join(least_ids, "c").drop("c")
    named = scratch.keep(named, "named")
    scratch.drop_others("seen", "named")
    out = seen.select("doc_id", *key).join(named, F.expr("n = _n and s1 = _s1 and s2 = _s2"), "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"), F.coalesce("rep", "doc_id").alias("class_id"))


def one_of_each(docs: DataFrame, size: int = 5) -> DataFrame:
    """The documents that are the least of their component, with all their columns."""
    scratch = Scratch(docs.sparkSession, "near-kept")
    gone = scratch.keep(near_duplicates(docs, size).where("not kept").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    # The row travels as one column, so that no name of its own clashes.
    return docs.select(F.col("doc_id").alias("_id"), F.struct("*").alias("_whole")).join(gone, F.col("_id") == F.col("_gone"), "left_anti").select("_whole.*")


def op6_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=2)


OP6_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest(CASE WHEN len(w) < 2 THEN w ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS sh FROM w)),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(sh, chr(10) ORDER BY sh)) AS whole FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.node),
m AS (SELECT node AS doc_id, min(c) AS component_id FROM r GROUP BY node),
k AS (SELECT whole, min(doc_id) AS class_id FROM n GROUP BY whole)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, component_id = doc_id AS kept, coalesce(class_id, doc_id) AS class_id
FROM m LEFT JOIN n USING (doc_id) LEFT JOIN k USING (whole)
"""
