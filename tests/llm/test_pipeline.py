"""The pipeline against its stages done by hand on a small corpus."""

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from .conftest import CLASHES, frame, prose  # noqa: E402
from .test_learned import junk  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("tables")
    good = [(i, prose(i, 90)) for i in range(30)]
    words = prose(3, 90).split(" ")
    leak = prose(5, 90).split("\n")[0]
    rows = [
        *good,
        (100, good[2][1]),  # a copy: loses all its lines
        (101, " ".join(words[:40] + ["altered"] + words[41:])),  # a near copy
        (102, prose(77, 40) + "\n" + good[4][1].split("\n")[0]),  # shares one line
        *((200 + i, junk(i)) for i in range(8)),
        (300, None),
    ]
    docs = frame(spark, rows, clashes=False)
    docs.coalesce(2).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(1, leak), (2, prose(555, 60))], "item_id long, text string").coalesce(1).write.parquet(f"{base}/benchmark.parquet")
    return str(base), docs


def test_stages(spark, folder):
    base, docs = folder
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, base)
        if name != "encoding":
            assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen[name] = {r.doc_id: r for r in docs.collect()}
    assert set(range(30)) | {100, 101, 102, 300} <= set(seen["quality"])
    assert len(set(seen["quality"]) & set(range(200, 208))) <= 1
    assert 100 not in seen["lines"]
    assert seen["lines"][102].text == prose(77, 40) and seen["lines"][102].n_chars == len(prose(77, 40))
    assert seen["lines"][7].text == prose(7, 90)
    assert set(seen["near_duplicates"]) <= set(seen["lines"])
    assert 5 in seen["near_duplicates"] and 5 not in seen["decontamination"]
    assert set(range(30)) - {5} <= set(seen["decontamination"])
    from tokenizers import Tokenizer

    from forelight.llm import bpe

    library = Tokenizer.from_str(bpe.public_file().decode())
    for i, r in seen["encoding"].items():
        assert r.n_tokens == len(library.encode(seen["decontamination"][i].text or "", add_special_tokens=False).ids)
    assert seen["encoding"][300].n_tokens == 0


def test_run(spark, folder):
    base, _ = folder
    out = corpus_pipeline.run(spark, base)
    ids = {r.doc_id for r in out.collect()}
    assert 5 not in ids and 100 not in ids and set(range(30)) - {5} <= ids


def write(spark, base, rows, items):
    frame(spark, rows).coalesce(1).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{base}/benchmark.parquet")
    return str(base)


def test_run_on_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, write(spark, tmp_path, [], [])).count() == 0


def test_run_with_clashing_columns_repeated_rows_and_odd_ids(spark, tmp_path):
    rows = [(i, prose(i, 90)) for i in range(12)] + [(3, prose(3, 90)), (3, prose(60, 80)), (None, prose(61, 80)), (None, None), (50, ""), (51, " \n"), (52, prose(70, 6000))]
    base = write(spark, tmp_path, rows, [])
    docs = spark.read.parquet(f"{base}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, base)
        assert out.columns == docs.columns and all(r[c] == 7 for r in out.collect() for c in CLASHES)
        docs = out
    ids = sorted(str(r.doc_id) for r in corpus_pipeline.run(spark, base).collect())
    assert ids == sorted(str(i) for i, _ in rows)


def test_near_duplicates_go_within_a_stage(spark):
    words = prose(3, 90).split(" ")
    rows = [(4, " ".join(words)), (2, " ".join(words[:80] + ["altered"] + words[81:])), (9, prose(8, 60)), (11, None), (12, "")]
    out = corpus_pipeline.near_duplicate_stage(spark, frame(spark, rows), "")
    assert sorted(r.doc_id for r in out.collect()) == [2, 9, 11, 12]
