"""Alignment of two tokenizers' tokens over the same bytes.

A bit is set where a token ends, one packed bitset per tokenizer. Their AND
holds the cuts that both share, which part a text into groups; a running count
of set bits (rank) leads from a cut to the tokens before it, and the set bits'
places (select) lead back. Each set bit of the OR closes one link: the pair of
tokens that hold this byte. So links are as many as set bits, and nothing is
compared pair by pair.

A space between two characters that are no white space always opens a token in
both vocabularies, whatever stands around. Texts are therefore cut there into
units, and a worker aligns each unit it meets once; units it knows are looked
up. What :func:`links` returns goes on to the corpus-wide counts of id pairs:
pairs that hold at least one in HEAVY of all links are HEAVY at most, so they
are broadcast, and the others, none of which is frequent, are joined by a
shuffle.

Defined results: null and empty texts have no tokens, nor have those that one
of the two vocabularies doesn't give back byte by byte: all counts are 0 and
the digest is ''. Special tokens' strings in a text are plain text. Long texts
are read whole. Repeated rows, and rows that share an id or have none, are
counted and returned one by one; pairs that tie for an id's highest count are
all best. An empty table gives an empty result. Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forelight.llm.common import Scratch, blocks, small_batches, table
from forelight.llm.bpe import _BYTES as BYTE_OF_LETTER

#: Units that a worker remembers; it forgets all of them at once.
KNOWN_UNITS = 300_000
#: Pairs with at least one in so many of all links are broadcast; there can't be more than this many.
HEAVY = 1 << 16
#: An id pair is one number: the first id times this, plus the second.
SECOND = 1 << 32

#: A space that opens a token in both vocabularies.
_CUT = re.compile(r"(?<=\S) (?=\S)")


class Bits:
    """A bitset of n places, packed into 64-bit words, with the count of set bits before each word."""

    def __init__(self, words: np.ndarray, n: int):
        self.words, self.n = words, n
        self.before = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])

    @classmethod
    def at(cls, places: np.ndarray, n: int) -> Bits:
        flags = np.zeros(-(-n // 64) * 64, bool)
        flags[places] = True
        return cls(np.packbits(flags, bitorder="little").view(np.uint64), n)

    def __and__(self, other: Bits) -> Bits:
        return Bits(self.words & other.words, self.n)

    def __or__(self, other: Bits) -> Bits:
        return Bits(self.words | other.words, self.n)

    def rank(self, places: np.ndarray) -> np.ndarray:
        """How many set bits stand before each place."""
        word = places >> 6
        inside = np.bitwise_count(np.append(self.words, np.uint64(0))[word] & ((np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)))
        return self.before[word] + inside

    def select(self) -> np.ndarray:
        """The places of all set bits, in order."""
        return np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))


class Vocabularies:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, first: str, second: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(first)
        self.first.encode_special_tokens = True
        self.first.no_truncation()
        self.first.no_padding()
        names = self.first.get_vocab(with_added_tokens=True)
        self.first_bytes = [b""] * (max(names.values()) + 1)
        for letters, i in names.items():
            self.first_bytes[i] = bytes(BYTE_OF_LETTER[c] for c in letters) if all(c in BYTE_OF_LETTER for c in letters) else letters.encode()
        self.second = sentencepiece.SentencePieceProcessor(model_file=second)
        pieces = [(i, self.second.id_to_piece(i)) for i in range(self.second.get_piece_size())]
        self.second_bytes = [bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        self.first_size, self.second_size = (np.array([len(b) for b in v], np.int64) for v in (self.first_bytes, self.second_bytes))

    def encode(self, text: str) -> tuple[list[int], list[int], int] | None:
        """Both id sequences and the bytes of a space and the text; None where a vocabulary doesn't give these bytes back."""
        raw = (" " + text).encode()
        a, b = self.first.encode(" " + text, add_special_tokens=False).ids, self.second.encode(text)
        same = b"".join(map(self.first_bytes.__getitem__, a)) == raw and b"".join(map(self.second_bytes.__getitem__, b)) == raw
        return (a, b, len(raw)) if same else None


@lru_cache(maxsize=2)
def vocabularies(first: str, second: str) -> Vocabularies:
    return Vocabularies(first, second)


class Units:
    """The units that a worker has met, each aligned once.

    Of unit u: ``counts[u]`` holds its tokens in both vocabularies, its groups
    and its links, ``shown[u]`` its groups as text (None: not given back byte by
    byte), and its id pairs stand in ``pairs`` from ``begin[u]`` on.
    """

    def __init__(self, both: Vocabularies):
        self.both = both
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.shown: list[str | None] = []
        self._counts, self._pairs = [np.zeros((0, 4), np.int64)], [np.zeros(0, np.int64)]

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self._counts, self._pairs = [np.concatenate(self._counts)], [np.concatenate(self._pairs)]
        begin = np.zeros(len(self.shown) + 1, np.int64)
        np.cumsum(self._counts[0][:, 3], out=begin[1:])
        return self._counts[0], begin, self._pairs[0]

    def _add(self, units: list[str], shown: list[str | None], counts: np.ndarray, pairs: np.ndarray) -> None:
        for u in units:
            self.index[u] = len(self.index)
        self.shown += shown
        self._counts.append(counts)
        self._pairs.append(pairs)

    def learn(self, units: list[str]) -> None:
        """Aligns units of which none is known."""
        solid = [u for u in units if not (u[0].isspace() or u[-1].isspace())]
        if solid:
            self._joined(solid)
        for u in units:
            if u[0].isspace() or u[-1].isspace():
                self._joined([u])

    def _joined(self, units: list[str]) -> None:
        # Units are encoded as one text. One that isn't given back spoils it; halves are tried until it stands alone.
        got = self.both.encode(" ".join(units))
        found = got and align(*(np.array(x, np.int64) for x in got[:2]), self.both, np.cumsum([len(u.encode()) + 1 for u in units]) - 1)
        if found:
            self._add(units, *found)
        elif len(units) == 1:
            self._add(units, [None], np.zeros((1, 4), np.int64), np.zeros(0, np.int64))
        else:
            half = len(units) // 2
            self._joined(units[:half])
            self._joined(units[half:])


def align(a: np.ndarray, b: np.ndarray, both: Vocabularies, last: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray] | None:
    """Groups as text, counts and id pairs of units whose last bytes are given; None if a unit's end is no shared cut."""
    n = int(last[-1]) + 1
    ends_a, ends_b = (Bits.at(np.cumsum(size[ids]) - 1, n) for ids, size in ((a, both.first_size), (b, both.second_size)))
    shared, either = ends_a & ends_b, ends_a | ends_b
    after = last + 1
    totals = np.stack([x.rank(after) for x in (ends_a, ends_b, shared, either)], axis=1)
    if not (shared.rank(after) > shared.rank(last)).all():
        return None
    closing = either.select()
    pairs = a[ends_a.rank(closing)] * SECOND + b[ends_b.rank(closing)]
    cuts = shared.select() + 1
    to_a, to_b = ends_a.rank(cuts).tolist(), ends_b.rank(cuts).tolist()
    names_a, names_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
    groups = [f"{','.join(names_a[i:j])}|{','.join(names_b[k:m])}" for i, j, k, m in zip([0, *to_a], to_a, [0, *to_b], to_b, strict=False)]
    bounds = totals[:, 2].tolist()
    shown = [";".join(groups[i:j]) for i, j in zip([0, *bounds], bounds, strict=False)]
    return shown, np.diff(totals, axis=0, prepend=0), pairs


def _aligned(first: str, second: str, texts_too: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Units(vocabularies(first, second))
        for batch in batches:
            for low, high in blocks(batch.column(1)):
                part = batch.slice(low, high - low)
                units = [_CUT.split(t) if t else [] for t in part.column(1).to_pylist()]
                if len(known.index) > KNOWN_UNITS:
                    known.clear()
                known.learn(sorted(set().union(*units) - known.index.keys()))
                yield _documents(part.column(0), units, known, texts_too)

    return run


def _documents(ids: pa.Array, units: list[list[str]], known: Units, texts_too: bool) -> pa.RecordBatch:
    counts, begin, pairs = known.arrays()
    index, shown = known.index, known.shown
    at = [list(map(index.__getitem__, us)) for us in units]
    groups = [[shown[u] for u in us] for us in at]
    whole = [bool(g) and None not in g for g in groups]
    at = [us if ok else [] for us, ok in zip(at, whole, strict=True)]
    joined = [";".join(g) if ok else "" for g, ok in zip(groups, whole, strict=True)]
    digests = [hashlib.sha256(g.encode()).hexdigest() if ok else "" for g, ok in zip(joined, whole, strict=True)]

    doc = np.repeat(np.arange(len(at)), [len(us) for us in at])
    unit = np.array([u for us in at for u in us], np.int64)
    totals = np.zeros((len(at), 4), np.int64)
    for k in range(4):
        totals[:, k] = np.bincount(doc, counts[unit, k], len(at)).astype(np.int64)
    # All units' pairs end to end: the place in the result, less that of the unit's first pair, counts on from where these begin.
    size = counts[unit, 3]
    first = np.cumsum(size) - size
    found = pairs[np.arange(int(size.sum())) - np.repeat(first, size) + np.repeat(begin[unit], size)]
    owner = np.repeat(doc, size)
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(new)
    times = np.diff(np.append(starts, len(found)))
    offsets = np.zeros(len(at) + 1, np.int32)
    np.cumsum(np.bincount(owner[starts], minlength=len(at)), out=offsets[1:])
    columns = {"id": ids, **{c: pa.array(totals[:, k]) for k, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))}, "groups_sha256": pa.array(digests, pa.string())}
    if texts_too:
        columns["groups"] = pa.array(joined, pa.string())
    columns["pairs"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found[starts]))
    columns["times"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(times.astype(np.int32)))
    return pa.RecordBatch.from_pydict(columns)


def links(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text", texts_too: bool = False) -> DataFrame:
    """Per document: id, n_a, n_b, n_groups, n_links, groups_sha256, its id pairs (``id_a * 2**32 + id_b``) and how many links hold each.

    ``first`` and ``second`` are the files of a byte-level and of a piece
    vocabulary. With ``texts_too`` also ``groups``, as ``a1,a2|b1;a3|b2,b3``.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    groups = " groups string," if texts_too else ""
    return docs.select(id_col, text_col).mapInArrow(
        _aligned(first, second, texts_too), f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,{groups} pairs array<long>, times array<int>"
    )


def pair_counts(linked: DataFrame) -> DataFrame:
    """(id_a, id_b, n, best): how many links hold the pair, and whether no other pair of id_b has more."""
    pairs = linked.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("n"))
    return _with_best(pairs).select((F.col("pair") / SECOND).cast("long").alias("id_a"), (F.col("pair") % SECOND).alias("id_b"), "n", "best")


def _with_best(pairs: DataFrame) -> DataFrame:
    # An id has at most as many partners as the other vocabulary has ids, and there are as many groups as ids.
    top = pairs.groupBy((F.col("pair") % SECOND).alias("b")).agg(F.max("n").alias("top"))
    return pairs.join(top, F.col("pair") % SECOND == F.col("b")).select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def alignment(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    scratch = Scratch(docs.sparkSession, "alignment")
    linked = scratch.keep(links(docs, first, second, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "linked")
    each = linked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    pairs = scratch.keep(each.groupBy("pair").agg(F.sum("times").alias("n")), "pairs")
    known = scratch.keep(_with_best(pairs), "known")
    total = known.agg(F.sum("n")).head()[0] or 0
    heavy = known.where(F.col("n") * HEAVY >= total)
    # At most HEAVY rows, as each of them holds at least one in HEAVY of all links.
    marked = each.join(F.broadcast(heavy), "pair", "left")
    sums = [F.sum(F.col("times") * F.col("n")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best")]
    frequent = marked.where("n is not null").groupBy("row").agg(*sums)
    rare = marked.where("n is null").select("row", "pair", "times").join(known.where(F.col("n") * HEAVY < total), "pair").groupBy("row").agg(*sums)
    both = frequent.unionByName(rare).groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    both = scratch.keep(both.withColumnRenamed("row", "_row"), "sums")
    scratch.drop_others("linked", "sums")
    of = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    out = linked.join(both, F.col("row") == F.col("_row"), "left")
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", of("n_best"), of("count_sum"), "groups_sha256")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
