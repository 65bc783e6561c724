"""Near duplicates: words that polynomials can't tell apart, and ids with several texts."""

import numpy as np

from forelight.llm import shingle, superminhash
from forelight.llm.common import flat

from .conftest import frame, prose


def thue_morse(n, zero="a", one="b"):
    return "".join(one if bin(i).count("1") % 2 else zero for i in range(n))


def found(spark, rows, size=2, partitions=2):
    out = superminhash.near_duplicates(frame(spark, rows).repartition(partitions), size=size)
    return sorted((r.doc_id, r.component_id, r.kept) for r in out.collect())


def test_words_that_differ_everywhere(spark):
    rows, want = [], []
    for k, n in enumerate((64, 65, 1024, 2048)):
        one, two = thue_morse(n), thue_morse(n, "b", "a")
        texts = [one, two, f"left {one} right", f"left {two} right", f"{one} {prose(k, 40)}", f"{two} {prose(k, 40)}", one.upper()]
        rows += [(10 * k + i, t) for i, t in enumerate(texts)]
        want += [(10 * k + i, 10 * k + c, i == c) for i, c in enumerate((0, 1, 2, 3, 4, 4, 0))]
    assert found(spark, rows) == want


def test_word_hashes_tell_words_apart():
    import pyarrow as pa

    words = [thue_morse(n, a, b) for n in (1, 7, 8, 9, 16, 63, 64, 65, 200, 4096) for a, b in ("ab", "ba", "bb")]
    words = sorted(set(words))
    for seed in (0, 1):
        h, row = shingle.words(*flat(pa.array([" ".join(words), *words])), seed)
        assert len(set(h.tolist())) == len(words)
        assert (h[: len(words)] == h[len(words) :]).all() and (row[len(words) :] == np.arange(1, len(words) + 1)).all()
    # What surrounds a word says nothing of it.
    a, _ = shingle.words(*flat(pa.array(["xyz word", "word", "wordword word tail"])))
    assert a[1] == a[2] == a[4]


def near_copy(text, k):
    w = text.split(" ")
    return " ".join([*w[:k], "changed", *w[k + 1 :]])


def test_two_texts_under_one_id(spark):
    a, b = prose(11, 80), prose(12, 80)
    rows = [(3, a), (3, b), (5, near_copy(b, 20)), (6, near_copy(a, 30)), (9, prose(13, 80))]
    assert found(spark, rows) == [(3, 3, True), (3, 3, True), (5, 3, False), (6, 3, False), (9, 9, True)]


def test_ids_join_what_only_they_share(spark):
    a, b, c = prose(21, 60), prose(22, 60), prose(23, 60)
    rows = [(7, a), (8, a), (8, b), (4, b), (4, c), (2, c), (2, None), (1, ""), (None, a), (7, a)]
    assert found(spark, [r for r in rows if r[0] is not None]) == sorted([(7, 2, False), (8, 2, False), (8, 2, False), (4, 2, False), (4, 2, False), (2, 2, True), (2, 2, True), (1, 1, True), (7, 2, False)])


def test_large_groups_have_few_links(spark, monkeypatch):
    text, links = prose(77, 200), {}
    real = superminhash.components

    def counted(df, scratch, name="cc"):
        links[name] = df.count()
        return real(df, scratch, name)

    monkeypatch.setattr(superminhash, "components", counted)
    rows = [(k, near_copy(text, k)) for k in range(150)]
    assert found(spark, rows) == [(k, 0, k == 0) for k in range(150)]
    assert links["near-candidates"] <= 30 * 150


def test_sessions_that_leave_partitions_unset(spark):
    name, text = "spark.sql.shuffle.partitions", prose(31, 80)
    before = spark.conf.get(name)
    spark.conf.unset(name)
    try:
        unset = spark.conf.get(name)
        assert found(spark, [(4, text), (2, near_copy(text, 30)), (8, prose(32, 80))]) == [(2, 2, True), (4, 2, False), (8, 8, True)]
        assert spark.conf.get(name) == unset
    finally:
        spark.conf.set(name, before)


def test_tasks_read_few_texts_at_a_time(spark, tmp_path, monkeypatch):
    name, rows = "spark.sql.parquet.columnarReaderBatchSize", {}
    frame(spark, [(k, prose(k, 40)) for k in range(8)]).write.parquet(path := f"{tmp_path}/documents.parquet")
    before, docs = spark.conf.get(name), spark.read.parquet(path)
    real = type(docs.write).parquet

    def noted(self, path, *args, **kwargs):
        rows[path.rsplit("/", 1)[1]] = int(spark.conf.get(name))
        return real(self, path, *args, **kwargs)

    monkeypatch.setattr(type(docs.write), "parquet", noted)
    assert superminhash.near_duplicates(docs, size=2).where("kept").count() == 8
    assert {rows[table] for table in ("seen", "near-links")} == {superminhash.READ_ROWS}
    assert spark.conf.get(name) == before
