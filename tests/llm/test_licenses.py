"""License scans: against all windows of all texts, one by one, and against SQL."""

import random
import re
from collections import Counter

import duckdb
import pytest

from forelight.llm import licenses, registry
from forelight.llm.licenses import NOTICES, PHRASES, Template

from .conftest import frame, prose

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def by_hand(text, phrases=PHRASES, notices=NOTICES):
    """(words, places, blocks) of one text, by looking at every window."""
    w = split(text)
    places = sorted((i, i + len(p.words), p.label) for p in phrases for i in range(len(w)) if w[i : i + len(p.words)] == p.words)
    blocks = []
    for t in notices:
        known, run = set(t.words), None
        for end in range(1, len(w) + t.width):
            held = len(known & set(w[max(0, end - t.width) : end]))
            if held >= t.needed:
                run = run or [max(0, end - t.width), 0, 0]
                run[1:] = [min(end, len(w)), max(run[2], held)]
            if run and (held < t.needed or end == len(w) + t.width - 1):
                blocks.append((run[0], run[1], t.label, run[2] / len(known)))
                run = None
    return len(w), places, sorted(blocks)


def query_row(i, text):
    n, places, blocks = by_hand(text)
    starts, base = [p[0] for p in places], {p[2] for p in places}
    score = 1.0 if places else max((b[3] for b in blocks), default=0.0)
    return (i, n, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | {b[2] for b in blocks})), score, len(blocks))


def spoilt(text, seed, least=0.0):
    """A notice with words lost, swapped and put in."""
    r = random.Random(seed)
    w = [x for x in text.split() if r.random() > least]
    for _ in range(r.randint(0, 3)):
        w.insert(r.randint(0, len(w)), r.choice(["foo", "the", "BAR", "license"]))
    if seed % 3 == 0:
        r.shuffle(w)
    return r.choice([" ", "\n", ", "]).join(w)


@pytest.fixture(scope="module")
def texts(corpus):
    rows = list(corpus)
    rows += [(1000 + i, prose(i, i % 50) + " " + spoilt(t.text, i + 31 * k, k / 12) + " " + prose(i + 7, 20)) for i, t in enumerate(NOTICES) for k in range(4)]
    rows += [
        (2000, "MIT License, mit-license; THE MIT LICENSE"),
        (2001, "license MIT"),
        (2002, "CC BY CC CC BY by"),
        (2003, "GNU General Public"),
        (2004, "License GNU General\nPublic\tLicense, the Apache License (Apache license)."),
        (2005, NOTICES[1].text),
        (2006, (NOTICES[1].text + " ") * 5 + prose(4, 300) + " " + NOTICES[1].text),
        (2007, "gnu gnu general public public license"),
        (2008, "the " * 3000 + "mit license" + " of" * 3000),
        (2000, "MIT License, mit-license; THE MIT LICENSE"),
        (None, "under the MIT license"),
        (None, "under the MIT license"),
    ]
    return rows


def test_against_every_window(spark, texts):
    out = licenses.licenses(frame(spark, texts)).collect()
    got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.places)), tuple(map(tuple, r.blocks))) for r in out)
    want = Counter()
    for i, t in texts:
        n, places, blocks = by_hand(t)
        want[i, n, tuple(places), tuple(blocks)] += 1
    assert got == want


def test_templates_of_ones_own(spark):
    phrases = [Template("twice", "to be or not to be", None), Template("one", "word", None)]
    notices = [Template("half", "alpha beta gamma delta alpha", 50), Template("all", "beta gamma", 100)]
    texts = ["to be or not to be or not to be", "to be or to not be", "word word", "alpha x x gamma", "beta x gamma", "gamma beta alpha delta", "x", None, "beta gamma", "delta"]
    out = licenses.licenses(frame(spark, enumerate(texts)), phrases, notices).collect()
    for r in out:
        assert (r.n_words, list(map(tuple, r.places)), list(map(tuple, r.blocks))) == by_hand(texts[r.doc_id], phrases, notices), texts[r.doc_id]


def test_the_query_and_its_twin(spark, tmp_path, texts):
    rows = [r for r in texts if r[0] is not None]
    frame(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = registry.QUERIES["op11_license_scan"](spark, str(tmp_path))
    got = Counter(map(tuple, out.collect()))
    assert got == Counter(query_row(*r) for r in rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(registry.ORACLES["op11_license_scan"])
    assert out.columns == [d[0] for d in want.description]
    assert got == Counter(want.fetchall())


def test_words_that_are_everywhere(spark):
    """A prefix of words that all texts hold still loses nothing."""
    t = NOTICES[1]
    rows = [(i, " ".join(t.words) if i % 3 == 0 else " ".join(reversed(t.words)) if i % 3 == 1 else " ".join(t.words[: i % 15])) for i in range(60)]
    out = {r.doc_id: (r.n_words, list(map(tuple, r.places)), list(map(tuple, r.blocks))) for r in licenses.licenses(frame(spark, rows)).collect()}
    assert out == {i: by_hand(x) for i, x in rows}


def test_empty(spark):
    assert licenses.licenses(frame(spark, [])).count() == 0
