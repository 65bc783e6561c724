"""Operators that learn, and line dedup, whose candidate search is probabilistic."""

import random

import numpy as np
from pyspark.sql import functions as F

from forelight.llm import lines, quality, toxicity, weak
from forelight.llm.common import least_hashes

from .conftest import CLASHES, frame, prose


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.3
    accuracy = [0.9, 0.8, 0.7, 0.6]
    votes = np.stack([np.where(rng.random(4000) < a, truth, ~truth) * 2 - 1 for a in accuracy], axis=1)
    votes[rng.random(votes.shape) < 0.2] = 0
    model = weak.fit(votes, np.ones(4000), prior=0.4)
    assert np.abs(model.accuracy - accuracy).max() < 0.08
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.88
    copies = weak.fit(np.hstack([votes, votes[:, [3]], votes[:, [3]], votes[:, [3]]]), np.ones(4000), prior=0.4)
    assert copies.correlation[3, 4] > 0.9
    assert np.abs(copies.log_odds[3]).max() < np.abs(model.log_odds[3]).max() + 0.3


def test_label_model_without_rows():
    assert weak.fit(np.zeros((0, 3), int), np.zeros(0)).posterior(np.zeros((1, 3), int))[0] == 0.5


def junk(seed):
    r = random.Random(seed)
    words = prose(seed, 80).split()
    return r.choice([" ".join(w.upper() + "!!" for w in words), " ".join(w + r.choice(["***", "$$$", "%%%"]) for w in words), " | ".join(words), " ".join(words[:1] * 80)])


def test_quality_keeps_the_clean_and_drops_junk(spark, corpus):
    good = [r for r in corpus if r[1] is None or len(r[1]) < 4000]
    rows = good + [(1000 + i, junk(i)) for i in range(30)]
    docs = frame(spark, rows)
    kept = quality.accepted(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None and i < 50) == list(range(44))
    assert sum(i is not None and i >= 1000 for i in ids) <= 1
    assert {70, 71, 72, 73} <= set(ids) and None in ids


def test_long_texts_are_fitted_and_judged(spark, corpus):
    rows = [r for r in corpus if r[0] is not None and len(r[1] or "") < 4000] + [(2000, prose(50, 8000)), (2001, " ".join(w.upper() + "!!" for w in prose(51, 8000).split()))]
    kept = {r.doc_id for r in quality.accepted(frame(spark, rows)).collect()}
    assert 2000 in kept and 2001 not in kept


def test_quality_of_no_documents(spark):
    assert quality.accepted(frame(spark, [])).count() == 0


def test_toxicity_is_learned_from_the_labels_it_may_see(spark):
    r = random.Random(5)
    bad = ["grobnak", "snarvel", "quibbert"]
    rows, labels = [], []
    for i in range(900):
        words = prose(i, 40).split()
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words[r.randrange(len(words))] = r.choice(bad)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    rows += [(2000, None), (2001, ""), (2001, ""), (None, "grobnak snarvel")]
    docs = frame(spark, rows)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    reads, y, parts = toxicity.training_rows(docs, table)
    import zlib

    assert len(reads) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(900))
    model = toxicity.fit(reads, y, parts)
    out = toxicity.scores(docs, model).collect()
    assert len(out) == len(rows)
    score = {x.doc_id: x.score for x in out}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all((score[i] >= 0.3) == (i % 6 == 0) for i in held)
    assert score[None] > 0.3 and score[2000] == score[2001] < 0.3
    assert {f"={b}" for b in bad} & set(model.lexicon)


def test_toxicity_without_labels(spark):
    docs = frame(spark, [(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.scores(docs, toxicity.fit(*toxicity.training_rows(docs, none))).collect()
    assert [round(r.score, 6) for r in out] == [0.5, 0.5]


def test_least_hashes_is_bounded(spark):
    df = spark.range(10_000)
    a = {r.id for r in least_hashes(df.union(df), ["id"], 100).collect()}
    b = {r.id for r in df.orderBy(F.xxhash64("id"), "id").limit(100).collect()}
    assert a == b


def test_lines(spark):
    shared = prose(1, 35).replace("\n", " ")
    words = shared.split(" ")
    similar = " ".join(words[:12] + ["altered"] + words[13:])
    rows = [
        (1, "\n".join(["first own line of it", shared, "", "first own line of it"])),
        (2, "\n".join([shared, "second own line", similar])),
        (3, similar),
        (4, None),
        (5, ""),
        (6, " \n\n "),
        (7, "ab\nab\nabc"),
        (8, "ab"),
        (None, "no id\n" + shared),
        (9, "last"),
        (9, "last"),
    ]
    docs = frame(spark, rows)
    out = lines.deduplicated(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed_lines"]
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts == {1: "\n".join(["first own line of it", shared, ""]), 2: "second own line", 3: "", 4: None, 5: "", 6: " \n\n ", 7: "ab\nabc", 8: "", None: "no id", 9: "last"}
    left = lines.without_similar_lines(docs)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(map(str, [1, 2, 4, 5, 6, 7, None, 9, 9]))
    assert all(r[c] == 7 for r in left.collect() for c in CLASHES)


def test_lines_of_no_documents(spark):
    assert lines.deduplicated(frame(spark, [])).count() == 0


def test_many_similar_lines_are_one_component(spark):
    base = prose(5, 60).replace("\n", " ").split(" ")
    rows = [(i, " ".join(base[: 5 + i] + ["altered"] + base[6 + i :])) for i in range(30)]
    out = lines.deduplicated(frame(spark, rows)).collect()
    assert [r.doc_id for r in out if r.text] == [0]
