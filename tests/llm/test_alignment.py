"""Alignment of two vocabularies: against the libraries and links found one by one, and the bitset by itself."""

import hashlib
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forelight.llm import alignment

from .conftest import frame, prose

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def by_hand(text):
    """(ids a, ids b, groups, linked id pairs) of one whole text, None without tokens."""
    both = alignment.vocabularies(FIRST, SECOND)
    if not text:
        return None
    a, b = both.first.encode(" " + text, add_special_tokens=False).ids, both.second.encode(text)
    shown_a = b"".join(both.first_bytes[i] for i in a)
    shown_b = b"".join(both.second_bytes[i] for i in b)
    if not shown_a == shown_b == (" " + text).encode():
        return None
    ends_a, ends_b = (list(accumulate(len(v[i]) for i in ids)) for v, ids in ((both.first_bytes, a), (both.second_bytes, b)))
    groups, i, k = [], 0, 0
    for cut in sorted({*ends_a} & {*ends_b}):
        j, m = bisect_right(ends_a, cut), bisect_right(ends_b, cut)
        groups.append(",".join(map(str, a[i:j])) + "|" + ",".join(map(str, b[k:m])))
        i, k = j, m
    spans_a, spans_b = list(zip([0, *ends_a], ends_a, a, strict=False)), list(zip([0, *ends_b], ends_b, b, strict=False))
    links, low = [], 0
    for start, end, x in spans_a:
        while spans_b[low][1] <= start:
            low += 1
        k = low
        while k < len(spans_b) and spans_b[k][0] < end:
            links.append((x, spans_b[k][2]))
            k += 1
    return a, b, ";".join(groups), links


def expected(rows):
    found = [(i, by_hand(t)) for i, t in rows]
    n = Counter(p for _, f in found if f for p in f[3])
    top = {}
    for (_, b), c in n.items():
        top[b] = max(top.get(b, 0), c)
    return Counter(
        (i, 0, 0, 0, 0, 0, 0, "")
        if f is None
        else (i, len(f[0]), len(f[1]), f[2].count(";") + 1, len(f[3]), sum(n[p] == top[p[1]] for p in f[3]), sum(n[p] for p in f[3]), hashlib.sha256(f[2].encode()).hexdigest())
        for i, f in found
    )


ODD = ["a  b", " lead", "trail ", "\n\n x\ty", " ", "   ", "<s> <unk> </s> <|endoftext|> <0x0A>", "▁ is lost", "good words ▁ and a bad one", "ﬁ ½ é é  x", "a\x00b \x1f c", "日本語の 文章 です", "😀 👩‍👩‍👧 x", "x" * 3000, "ab " * 900, "\r\n", "don't  'S 's", " wide　space \x85 end"]


def got(spark, rows):
    out = alignment.alignment(frame(spark, rows), FIRST, SECOND)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return Counter(map(tuple, out.collect()))


def test_against_the_libraries(spark, corpus):
    rows = [*corpus, *((900 + i, t) for i, t in enumerate(ODD)), (None, None), (77, "another under a taken id")]
    assert got(spark, rows) == expected(rows)


def test_rare_pairs_are_joined_by_a_shuffle(spark, corpus, monkeypatch):
    # With so few heavy pairs nearly all go the other way.
    monkeypatch.setattr(alignment, "HEAVY", 3)
    assert got(spark, corpus) == expected(corpus)


def test_a_worker_that_forgets(monkeypatch):
    monkeypatch.setattr(alignment, "KNOWN_UNITS", 5)
    import pyarrow as pa

    texts = [prose(i, 30) for i in range(6)] + ODD
    batches = [pa.RecordBatch.from_pydict({"id": [i], "text": [t]}) for i, t in enumerate(texts)]
    for batch in alignment._aligned(FIRST, SECOND, True)(iter(batches)):
        row = batch.to_pylist()[0]
        want = by_hand(texts[row["id"]])
        assert row["groups"] == (want[2] if want else "")
        if want:
            assert Counter(dict(zip(row["pairs"], row["times"], strict=True))) == Counter(a * alignment.SECOND + b for a, b in want[3])


def test_pair_counts(spark, corpus):
    n = Counter(p for _, t in corpus for p in (by_hand(t) or [[]] * 4)[3])
    top = Counter()
    for (_, b), c in n.items():
        top[b] = max(top[b], c)
    out = alignment.pair_counts(alignment.links(frame(spark, corpus), FIRST, SECOND)).collect()
    assert {(r.id_a, r.id_b): (r.n, r.best) for r in out} == {p: (c, c == top[p[1]]) for p, c in n.items()}


def test_empty(spark):
    assert not got(spark, [])


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 299)), st.lists(st.integers(0, 300), max_size=20))
def test_rank_and_select(places, asked):
    bits = alignment.Bits.at(np.array(sorted(places), np.int64), 300)
    assert bits.select().tolist() == sorted(places)
    assert bits.rank(np.array(asked, np.int64)).tolist() == [sum(p < q for p in places) for q in asked]


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\tab.é▁'"), st.characters(exclude_categories=["Cs"])), min_size=1, max_size=40))
def test_units_add_up_to_the_text(text):
    known = alignment.Units(alignment.vocabularies(FIRST, SECOND))
    units = alignment._CUT.split(text)
    known.learn(sorted(set(units)))
    shown = [known.shown[known.index[u]] for u in units]
    want = by_hand(text)
    assert (None if None in shown else ";".join(shown)) == (want[2] if want else None)


@pytest.mark.parametrize("name", ["op12_alignment"])
def test_the_query(spark, tmp_path, corpus, name):
    from forelight.llm import registry

    frame(spark, corpus).write.parquet(f"{tmp_path}/documents.parquet")
    assert Counter(map(tuple, registry.QUERIES[name](spark, str(tmp_path)).collect())) == expected(corpus)
