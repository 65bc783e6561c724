"""Removal of long repeats by prefix-free parsing.

A rolling hash over TRIGGER bytes is computed everywhere; the leftmost least one
of each stretch of LENGTH bytes is that stretch's trigger, so equal stretches
have equal triggers at equal places. Triggers end phrases: text up to a trigger
is a phrase of the dictionary, what follows it the parse. Phrases with their
continuation are dealt to tasks by the trigger's hash, so all places at which a
stretch occurs meet in one task, whatever their documents. There two sparse
suffix arrays are built with their common-prefix lengths: of the dictionary, whose
phrases are read backwards from their triggers, so that one sort gives the classes of
phrase suffixes of every length; and of the parse, whose continuations are read
forwards. A suffix's class in the one and a continuation's in the other together
give its rank in the order of the corpus, and places of equal rank in the first
LENGTH bytes hold the same stretch. The least doc_id of each rank is the first to have it.

This is the method as far as stretches of LENGTH bytes need it: ranks are those
of one task's triggers and look no further than such a stretch, and no suffix array of the
whole dictionary or parse is ever put together.

Only LENGTH bytes of context travel with each trigger, so no task holds the
corpus, a document or a suffix array of it. Equal phrases of a map task travel
once, for the least document that has them; in larger ones they are known to
repeat, as their bytes are compared. Of triggers that are very frequent (estimated from a sample, which
decides on nothing but the way) each stretch is a phrase of its own, dealt by
all its bytes, so no task gets all places of a common trigger.

Defined results: null counts as the empty text; texts shorter than LENGTH bytes
lose nothing; long texts are parsed in overlapping parts, with the same result.
Rows with a null id count as larger than all ids, and not as smaller than one
another. Rows that share an id, with equal texts or others, never remove each
other's bytes; each loses what smaller ids have. Empty tables give empty
results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forelight.llm.common import BLOCK_BYTES, Scratch, mix, table, small_batches
from forelight.llm.shingle import _CODES, _P, powers

LENGTH, TRIGGER = 50, 16
STEPS = LENGTH - TRIGGER + 1
#: Bytes of text whose phrases one task sorts, and that a map task parses before it sends phrases off.
BUCKET_BYTES, SEND_BYTES = 2 << 20, 8 << 20
#: Places from which on a trigger is split; documents of which one is looked at to find such triggers; how many at most are told to all tasks.
HOT_PLACES, HOT_SAMPLE, HOT_TRIGGERS = 200_000, 64, 10_000

U = np.uint64
_LAST = (1 << 63) - 1
_PLACE = U((1 << 24) - 1)


def _segments(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, starts with an end, numbers of the rows, offsets in the text) of documents or overlapping parts of long ones."""
    parts, starts, own, offs, total = [], [0], [], [], 0
    for doc, text in enumerate(texts):
        raw = np.frombuffer(text.as_buffer() or b"", np.uint8) if text.is_valid else np.zeros(0, np.uint8)
        for at in range(0, max(1, len(raw) - LENGTH + 1), BLOCK_BYTES):
            piece = raw[at : at + BLOCK_BYTES + LENGTH - 1]
            if len(piece) < LENGTH:
                continue
            if total and total + len(piece) > BLOCK_BYTES:
                yield np.concatenate(parts), np.array(starts), np.array(own, np.int64), np.array(offs, np.int64)
                parts, starts, own, offs, total = [], [0], [], [], 0
            parts.append(piece)
            own.append(doc)
            offs.append(at)
            total += len(piece)
            starts.append(total)
    if total:
        yield np.concatenate(parts), np.array(starts), np.array(own, np.int64), np.array(offs, np.int64)


def parse(raw: np.ndarray, starts: np.ndarray, hot: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Phrases with their continuations.

    Per phrase: where its first stretch begins, how many stretches have its
    trigger in common, the trigger's place, the hash it is dealt by (the
    trigger's, or for ``hot`` triggers the stretch's), and a hash of
    all bytes from the first stretch's begin to the last one's end.
    """
    n = len(raw)
    h, step = _CODES[raw], 1
    while step < TRIGGER:
        h = h[:-step] * U(pow(int(_P), step, 1 << 64)) + h[step:]
        step *= 2
    h = mix(h)
    least = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    step = 1
    while step * 2 <= STEPS:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < STEPS:
        least = np.minimum(least[: len(least) - (STEPS - step)], least[STEPS - step :])
    trigger = (least & _PLACE).astype(np.int64)  # of the stretch that begins at each place
    valid = np.zeros(n + 1, np.int32)
    valid[starts[:-1]] += 1
    np.add.at(valid, np.maximum(starts[1:] - LENGTH + 1, starts[:-1]), -1)
    valid = np.cumsum(valid)[: len(trigger)] > 0
    new = valid.copy()
    new[1:] &= (trigger[1:] != trigger[:-1]) | ~valid[:-1]
    doc_start = starts[:-1][starts[:-1] < len(new)]
    new[doc_start] |= valid[doc_start]
    first = np.flatnonzero(new)
    if hot is not None and len(hot):
        common = np.zeros(len(new) + 1, np.int32)
        split = first[np.isin(h[trigger[first]], hot)]
        common[split] = 1
        common[first[~np.isin(first, split)]] = -1
        new |= valid & (_carried(common[:-1]) > 0)
        first = np.flatnonzero(new)
    ends = valid.copy()
    ends[:-1] &= new[1:] | ~valid[1:]
    last = np.flatnonzero(ends)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODES[raw] * powers(n), out=sums[1:])
    inverse = U(pow(int(_P), -(n - 1), 1 << 64))
    value = (sums[last + LENGTH] - sums[first]) * powers(n)[n - 1 - first] * inverse
    count, place = last - first + 1, trigger[first]
    key = mix(value + (place - first).astype(np.uint64) * U(0x94D049BB133111EB) + count.astype(np.uint64))
    deal = h[place]
    if hot is not None and len(hot):
        deal = np.where(np.isin(deal, hot), mix(key), deal)
    return first, count, place, deal, key


def _carried(marks: np.ndarray) -> np.ndarray:
    """The last mark that isn't zero, at each place."""
    at = np.where(marks != 0, np.arange(len(marks)), 0)
    return marks[np.maximum.accumulate(at)]


def hot_triggers(docs: DataFrame) -> np.ndarray:
    """Hashes of triggers that many places have, by a sample of the documents; docs has ``text`` in bytes and what tells rows apart."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, starts, _, _ in _segments(batch.column(0)):
                trig, n = np.unique(parse(raw, starts)[3], return_counts=True)
                # Triggers met once in a block are not the common ones.
                yield pa.RecordBatch.from_pydict({"t": trig[n > 1].view(np.int64), "n": n[n > 1].astype(np.int64)})

    # By row and not by text, or all copies of a text would be in the sample or none.
    few = docs.where(F.pmod(F.xxhash64(*docs.columns), F.lit(HOT_SAMPLE)) == 0).select("text")
    counts = few.mapInArrow(count, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).where(F.col("n") * HOT_SAMPLE > HOT_PLACES)
    rows = counts.orderBy(F.desc("n"), "t").limit(HOT_TRIGGERS).collect()
    return np.array([r["t"] for r in rows], np.int64).view(np.uint64)


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(a) for a in arrays], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


_KINDS = (np.int64, np.int64, np.uint32, np.uint32, np.uint8, np.uint8, np.uint8)


def _unpack(blob: bytes) -> list[np.ndarray]:
    data, out = zstandard.ZstdDecompressor().decompress(blob), []
    at = 8 * len(_KINDS)
    for n, kind in zip(np.frombuffer(data, np.int64, len(_KINDS)), _KINDS, strict=True):
        out.append(np.frombuffer(data, kind, n, at))
        at += int(n) * np.dtype(kind).itemsize
    return out


def _apart(raw: np.ndarray, begin: np.ndarray, count: np.ndarray, new: np.ndarray) -> None:
    """Marks as new what has the key of the phrase before it but other bytes: equal keys alone don't make a repeat."""
    view = np.lib.stride_tricks.sliding_window_view(raw, LENGTH + STEPS - 1)
    again = np.flatnonzero(~new)
    for at in range(0, len(again), 1 << 16):
        i = again[at : at + (1 << 16)]
        beyond = np.arange(LENGTH + STEPS - 1)[None, :] >= (count[i] + LENGTH - 1)[:, None]
        same = (view[begin[i]] == view[begin[i - 1]]) | beyond
        new[i] = ~same.all(axis=1) | (count[i] != count[i - 1])


def _send(buckets: int, hot: np.ndarray):
    """Map side: rows (bucket, phrases) and, with bucket -1, rows of spans known to repeat."""

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        raw = np.concatenate([*(x[0] for x in held), np.zeros(2 * LENGTH, np.uint8)])
        base = np.cumsum([0, *(len(x[0]) for x in held)])
        begin, count, place, trig, key, doc, row, pos = (np.concatenate([x[i] + (b if i in (1, 3) else 0) for x, b in zip(held, base, strict=False)]) for i in range(1, 9))
        held.clear()
        order = np.lexsort((pos, row, doc, key))
        new = np.ones(len(order), bool)
        new[1:] = key[order][1:] != key[order][:-1]
        _apart(raw, begin[order], count[order], new)
        group = np.cumsum(new) - 1
        ours = doc[order] == doc[order[new]][group]  # places in the least document that has the phrase
        again = order[~ours]
        if len(again):
            yield from _rows(doc[again], row[again], pos[again], count[again])
        order, group = order[ours], group[ours]
        new = np.ones(len(order), bool)
        new[1:] = (group[1:] != group[:-1]) | (row[order][1:] != row[order][:-1])
        heads, places = order[new], pos[order]
        uses = np.diff(np.append(np.flatnonzero(new), len(order)))
        bucket = (trig[heads] % U(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        firsts = np.zeros(len(heads) + 1, np.int64)
        np.cumsum(uses, out=firsts[1:])
        view = np.lib.stride_tricks.sliding_window_view(raw, LENGTH + STEPS - 1)
        names, blobs = [], []
        for part in np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1):
            e = heads[part]
            size = count[e] + LENGTH - 1
            body = view[begin[e]][np.arange(LENGTH + STEPS - 1)[None, :] < size[:, None]]
            at = np.concatenate([places[firsts[i] : firsts[i + 1]] for i in part]) if (uses[part] > 1).any() else places[firsts[part]]
            blobs.append(_pack(doc[e], row[e], at.astype(np.uint32), uses[part].astype(np.uint32), count[e].astype(np.uint8), (place[e] - begin[e]).astype(np.uint8), body))
            names.append(int(bucket[part[0]]))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(blobs, pa.binary()), *(pa.nulls(len(names), pa.int64()) for _ in range(2)), pa.nulls(len(names), pa.list_(pa.int64()))], names=_SENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            docs, rows = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for raw, starts, own, offs in _segments(batch.column(2)):
                first, count, place, trig, key = parse(raw, starts, hot)
                seg = np.searchsorted(starts, first, side="right") - 1
                held.append((raw, first, count, place, trig, key, docs[own[seg]], rows[own[seg]], first - starts[seg] + offs[seg]))
                size += len(raw)
                if size >= SEND_BYTES:
                    yield from flush(held)
                    size = 0
        if held:
            yield from flush(held)

    return run


_SENT = ["bucket", "phrases", "doc", "row", "spans"]


def _runs(doc: np.ndarray, row: np.ndarray, pos: np.ndarray, count: np.ndarray) -> list[pa.Array]:
    """doc, row and, of each, the runs of stretches' begins, joined where they touch: begin and number in turn."""
    order = np.lexsort((pos, row, doc))
    doc, row, pos, stop = doc[order], row[order], pos[order].astype(np.int64), (pos[order].astype(np.int64) + count[order])
    other = np.ones(len(doc), bool)
    other[1:] = (doc[1:] != doc[:-1]) | (row[1:] != row[:-1])
    apart = other.copy()
    apart[1:] |= pos[1:] > stop[:-1]  # stretches of one phrase never nest, so stops ascend
    heads = np.flatnonzero(apart)
    tails = np.append(heads[1:], len(doc)) - 1
    pairs = np.empty(2 * len(heads), np.int64)
    pairs[0::2], pairs[1::2] = pos[heads], stop[tails] - pos[heads]
    begins = np.flatnonzero(other[heads])
    owners = heads[begins]
    return [pa.array(doc[owners]), pa.array(row[owners]), pa.ListArray.from_arrays(pa.array(2 * np.append(begins, len(heads)), pa.int32()), pa.array(pairs))]


def _rows(doc: np.ndarray, row: np.ndarray, pos: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
    found = _runs(doc, row, pos, count)
    n = len(found[0])
    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, -1), pa.int64()), pa.nulls(n, pa.binary()), *found], names=_SENT)


def _suffix_array(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of suffixes (a row of bytes each), and how many leading bytes each shares with the one before it in that order."""
    n, width = rows.shape
    wide = np.zeros((n, -(-width // 8) * 8), np.uint8)
    wide[:, :width] = rows
    columns = wide.view(">u8").astype(np.uint64)
    order = np.lexsort(columns.T[::-1])
    sorted_rows = rows[order]
    differ = sorted_rows[1:] != sorted_rows[:-1]
    shared = np.zeros(n, np.int64)
    shared[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, shared


def _class_at(order: np.ndarray, shared: np.ndarray, depth: int) -> np.ndarray:
    """Of each suffix the number of its class, in order: suffixes with equal first ``depth`` bytes are one."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(shared < depth)
    return out


def repeats(doc: np.ndarray, count: np.ndarray, left: np.ndarray, body: np.ndarray) -> np.ndarray:
    """Which of each phrase's stretches also begin in a smaller document: rows of phrases, columns of stretches."""
    n, tail = len(doc), LENGTH - TRIGGER
    size = count.astype(np.int64) + LENGTH - 1
    left = left.astype(np.int64)
    start = np.cumsum(size) - size
    flat = np.concatenate([np.zeros(LENGTH, np.uint8), body, np.zeros(LENGTH, np.uint8)])
    stop = start + LENGTH + left + TRIGGER  # just behind the trigger
    phrase = np.lib.stride_tricks.sliding_window_view(flat, LENGTH)[stop - LENGTH][:, ::-1].copy()
    phrase[np.arange(LENGTH)[None, :] >= (left + TRIGGER)[:, None]] = 0
    after = np.lib.stride_tricks.sliding_window_view(flat, tail)[stop].copy()
    after[np.arange(tail)[None, :] >= (size - left - TRIGGER)[:, None]] = 0
    dictionary, continuation = _suffix_array(phrase), _suffix_array(after)
    out = np.zeros((n, STEPS), bool)
    for before in range(STEPS):  # bytes of the stretch in front of the trigger
        which = np.flatnonzero((left >= before) & (left - count.astype(np.int64) < before))
        if len(which) < 2:
            continue
        rank = _class_at(*dictionary, before + TRIGGER)[which] * (n + 1) + _class_at(*continuation, tail - before)[which]
        order = np.argsort(rank, kind="stable")
        ranked, owner = rank[order], doc[which][order]
        heads = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
        if len(heads) == len(order):
            continue
        least = np.repeat(np.minimum.reduceat(owner, heads), np.diff(np.append(heads, len(order))))
        e = which[order][owner > least]
        out[e, left[e] - before] = True
    return out


def _find(group: pa.Table) -> pa.Table:
    blobs = group.column("phrases").to_pylist()
    columns = [np.concatenate(c) for c in zip(*map(_unpack, blobs), strict=True)]
    doc, row, at, uses, count, left, body = columns
    found = repeats(doc, count, left, body)
    # Runs of marked stretches; a phrase's places all have the same.
    edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    e, s = np.nonzero(edge == 1)
    _, t = np.nonzero(edge == -1)
    if not len(e):
        return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.list_(pa.int64()))], names=_SENT[2:])
    firsts = np.cumsum(uses.astype(np.int64)) - uses
    many = uses[e].astype(np.int64)
    which = np.repeat(np.arange(len(e)), many)
    place = at[np.repeat(firsts[e], many) + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)]
    return pa.table(_runs(doc[e][which], row[e][which], place + s[which], (t - s)[which]), names=_SENT[2:])


def _keyed(docs: DataFrame, id_col: str, text_col: str, scratch: Scratch) -> DataFrame:
    """(doc_id, doc, row, text): ``doc`` is the order of ids; ``row`` tells rows of one id apart by their texts."""
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"), F.col(text_col).cast("binary").alias("text"))
    many = scratch.keep(ids.groupBy("doc").count().where("count > 1").select(F.col("doc").alias("again")), "many")
    row = F.when(F.col("again").isNull(), F.lit(0)).otherwise(F.xxhash64("text")).cast("long")
    return ids.join(many, F.col("doc") == F.col("again"), "left").select("doc_id", "doc", row.alias("row"), "text")


def repeated(keyed: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc, row, spans): begins of stretches that also begin in a smaller document, as runs: begin and number in turn; takes what _keyed gives."""
    small_batches(keyed.sparkSession)
    docs = keyed.select("doc", "row", "text")
    total = docs.select(F.sum(F.length("text"))).head()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))
    sent = docs.mapInArrow(_send(buckets, hot_triggers(docs)), "bucket long, phrases binary, doc long, row long, spans array<long>")
    # What is known to repeat takes the same way, spread by its document.
    sent = sent.withColumn("bucket", F.when(F.col("bucket") >= 0, F.col("bucket")).otherwise(F.pmod(F.xxhash64("doc", "row"), F.lit(buckets))))

    def find(group: pa.Table) -> pa.Table:
        known = group.filter(pc.is_valid(group.column("doc"))).select(_SENT[2:])
        phrases = group.filter(pc.is_null(group.column("doc")))
        return pa.concat_tables([known, _find(phrases)]) if phrases.num_rows else known

    found = sent.groupBy("bucket").applyInArrow(lambda group: find(group), "doc long, row long, spans array<long>")
    found = scratch.keep(found, "found")
    return found.groupBy("doc", "row").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _cut(text: bytes, spans: np.ndarray | None) -> tuple[bytes, int, int]:
    """What is left of a text, bytes removed, and maximal removed runs."""
    if spans is None or not len(spans):
        return text, 0, 0
    begin, stop = spans[0::2], spans[0::2] + spans[1::2] + LENGTH - 1
    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, stop, -1)
    gone = np.cumsum(edge)[:-1] > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def _finish(digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                raw = (text.as_py() if text.is_valid else None) or b""
                kept, removed, runs = _cut(raw, spans.values.to_numpy() if spans.is_valid else None)
                out.append((len(raw), removed, runs, hashlib.sha256(kept).hexdigest() if digest else kept))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            kinds = [pa.int64()] * 3 + [pa.string() if digest else pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256" if digest else "kept"])

    return run


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans and ``kept`` (bytes), or their digest."""
    scratch = Scratch(docs.sparkSession, "pfp")
    keyed = _keyed(docs, id_col, text_col, scratch)
    spans = scratch.keep(repeated(keyed, scratch).select(F.col("doc").alias("_doc"), F.col("row").alias("_row"), "spans"), "spans")
    scratch.drop_others("many", "spans")
    both = keyed.join(spans, (F.col("doc") == F.col("_doc")) & (F.col("row") == F.col("_row")), "left").select("doc_id", "text", "spans")
    return both.mapInArrow(_finish(digest), "doc_id long, n_bytes long, n_removed long, n_spans long, " + ("kept_sha256 string" if digest else "kept binary"))


def op2_prefix_free_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), digest=True)


OP2_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 100)) AS k FROM (SELECT doc_id, h, unnest(range(0, greatest(n - 49, 0))) AS i FROM d)),
f AS (SELECT k, min(doc_id) AS m FROM w GROUP BY k),
c AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p FROM w JOIN f USING (k) WHERE doc_id > m)),
g AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (prev IS NULL OR prev < p - 1) AS n_spans FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS prev FROM c) GROUP BY doc_id),
b AS (SELECT doc_id, p, substr(h, 2 * p + 1, 2) AS x FROM (SELECT doc_id, h, unnest(range(0, n)) AS p FROM d)),
t AS (SELECT doc_id, string_agg(x, '' ORDER BY p) AS kept FROM b ANTI JOIN c USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id) LEFT JOIN t USING (doc_id)
"""
