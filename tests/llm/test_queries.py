"""Every query of the text operators as the driver calls it, on tables with nulls, blanks, long texts, ties and repeated rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash

from forelight.llm import bpe, fingerprint, lines, registry, sharding

from .conftest import frame, prose
from .test_exact import FOLD, base_spans, removed, sha

#: Queries over documents; that over conversations is in test_repair.py, and the twin that gives nulls in test_licenses.py.
NAMES = sorted(q for q in registry.QUERIES if q != "op13_repair")
TWINS = sorted(q for q in registry.ORACLES if q not in ("op11_license_scan", "op13_repair"))
ITEMS = [(1, prose(999, 60)[20:200]), (2, prose(7, 90)[10:120]), (3, "one two"), (4, None), (5, ""), (6, "words that stand in none of the documents at all, not even once"), (6, "one two"), (None, prose(8, 80))]


def tables(spark, base, rows, items=ITEMS, labels=()):
    frame(spark, rows).coalesce(2).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(*r, 7, 7) for r in items], "item_id long, text string, doc_id int, k int").coalesce(1).write.parquet(f"{base}/benchmark.parquet")
    spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, text string").coalesce(1).write.parquet(f"{base}/labels.parquet")
    return str(base)


def labelled(rows):
    return [(i, i % 3 and 1, int(i % 5 == 0)) for i, _ in rows if i is not None and i < 40]


@pytest.fixture(scope="module")
def edge(spark, corpus, tmp_path_factory):
    rows = corpus + [(77, "another text under an id that is taken"), (None, "a second text without an id"), (None, None), (500, prose(31, 9000)), (501, prose(31, 9000)), (502, "line\n" * 4000)]
    return tables(spark, tmp_path_factory.mktemp("edge"), rows, labels=labelled(rows)), rows


@pytest.fixture(scope="module")
def unique(spark, corpus, tmp_path_factory):
    """The same without null and repeated ids, which SQL twins don't tell apart."""
    rows = list({i: (i, t) for i, t in corpus if i is not None}.values())
    items = [r for r in ITEMS if r[0] is not None]
    return tables(spark, tmp_path_factory.mktemp("unique"), rows, items, labelled(rows)), rows


def run(spark, name, base):
    return registry.QUERIES[name](spark, base)


@pytest.mark.parametrize("name", NAMES)
def test_a_row_per_row(spark, edge, name):
    base, rows = edge
    out = run(spark, name, base).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in rows)


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, tmp_path, name):
    base = tables(spark, tmp_path, [], [], [])
    assert run(spark, name, base).count() == 0


@pytest.mark.parametrize("name", [n for n in NAMES if n.startswith(("op8", "op9"))])
def test_documents_but_nothing_else(spark, tmp_path, name):
    base = tables(spark, tmp_path, [(1, prose(1, 30)), (2, None)], [], [])
    assert sorted(r.doc_id for r in run(spark, name, base).collect()) == [1, 2]


def plain(v):
    return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.parametrize("name", TWINS)
def test_sql_twins(spark, unique, name):
    base, _ = unique
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{base}/{t}.parquet/*.parquet'")
    got, want = run(spark, name, base).toPandas(), con.execute(registry.ORACLES[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert sorted(tuple(map(plain, r)) for r in got[columns].itertuples(index=False)) == sorted(tuple(map(plain, r)) for r in want[columns].itertuples(index=False))


def test_op1_tells_what_the_label_model_tells(spark, unique):
    from forelight.llm import quality

    base, rows = unique
    weights, model = quality.fit(spark.read.parquet(f"{base}/documents.parquet"))
    out = {r.doc_id: r for r in run(spark, "op1_quality_classifier", base).collect()}
    for i, t in rows:
        words, shapes = (t or "").split(), quality.forms(t or "")
        margin = weights[-1] + sum(v * weights[k] for k, v in quality.features(words, shapes).items())
        assert out[i].score == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-9)
        assert out[i].predicted == int(out[i].score >= 0.5)
        if len(words) >= 20:
            assert out[i].predicted == int(model.posterior([quality.votes(words, shapes)])[0] >= 0.5)


def test_op2_against_brute_force(spark, edge):
    base, rows = edge
    want = Counter(removed(rows))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in run(spark, "op2_prefix_free_parsing", base).collect()) == want


def test_op3_holds_its_law(spark, edge):
    base, rows = edge
    out = run(spark, "op3_label_propagation", base).collect()
    counts = Counter(r["shard"] for r in out)
    assert max(counts.values()) - min(counts[s] for s in range(sharding.SHARDS)) <= 1 and {r.law for r in out} == {"rows"}
    assert Counter((r["shard"], r.slot) for r in out) == Counter((s, k) for s, n in counts.items() for k in range(n))
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)


def test_op4_against_brute_force(spark, edge):
    base, rows = edge
    got = Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in run(spark, "op4_personal_data", base).collect())
    want = Counter()
    for i, t in rows:
        spans = base_spans(t or "")
        want[i, *(sum(s.startswith(f"{k}:") for s in spans) for k in ("email", "ip", "card", "phone")), sha(",".join(spans))] += 1
    assert got == want


def test_op5_is_the_librarys(spark, edge):
    from tokenizers import Tokenizer

    base, rows = edge
    library = Tokenizer.from_str(bpe.public_file().decode())
    want = Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in run(spark, "op5_bpe_lexicon", base).collect()) == want


def spark_hash(*parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64(p if isinstance(p, bytes) else p.to_bytes(8, "little"), seed=seed).intdigest()
    return seed


def sketch(text):
    words = [spark_hash(w.encode()) for w in re.findall("[^\x20\x09-\x0d]+", text.translate(FOLD))]
    n = fingerprint.SHINGLE
    if len(words) >= n:
        found = {spark_hash(*words[i : i + n]) for i in range(len(words) - n + 1)}
    else:
        one = n
        for w in words:
            one = spark_hash(one, w)
        found = {one} if words else set()
    return sorted({h >> (64 - fingerprint.BITS) for h in found})[: fingerprint.K]


def likeness(a, b):
    union = sorted({*a, *b})[: fingerprint.K]
    return len({*a} & {*b} & {*union}) / len(union) if union else 1.0


def test_op7_against_brute_force(spark, unique):
    base, rows = unique
    rows = sorted((i, t or "") for i, t in rows)
    out = {r.doc_id: r for r in run(spark, "op7_bottom_k", base).collect()}
    assert all(0 <= r.held_by_edited <= 1 for r in out.values())
    text = lambda s: "".join(f"{x:0{fingerprint.BITS // 4}x}" for x in s)
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        n = len(t) // 4
        edited = t[: len(t) - n] + after[:n]
        a, b, c = sketch(t), sketch(edited), sketch(after)
        r = out[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t), sha(edited), text(a), text(b)), i
        assert r.near_edited == pytest.approx(likeness(a, b)) and r.near_next == pytest.approx(likeness(a, c))


def test_op9_reads_no_held_out_label(spark, edge, unique, tmp_path):
    base, rows = unique
    out = {r.doc_id: r for r in run(spark, "op9_toxicity", base).collect()}
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert {i for i, r in out.items() if r.held_out} == held
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out.values())
    turned = [(i, q, 1 - t) if i in held else (i, q, t) for i, q, t in labelled(rows)]
    other = {r.doc_id: r.score for r in run(spark, "op9_toxicity", tables(spark, tmp_path, rows, labels=turned)).collect()}
    assert other == {i: r.score for i, r in out.items()}


def brute_lines(rows, least=lines.LEAST, k=lines.SHINGLE):
    """(n_lines, n_removed, what is left) of each row, by comparing all pairs of lines that share a shingle of their rarest."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first = {}
    for d, t in order:
        for p, x in enumerate((t or "").split("\n")):
            if x.strip(" ") and x not in first:
                first[x] = (d is None, d or 0, p)
    texts = list(first)
    sets = [frozenset(x[i : i + k] for i in range(len(x) - k + 1)) for x in texts]
    often = Counter(x for s in sets for x in s)
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = defaultdict(list)
    for i, s in enumerate(sets):
        near = set()
        for x in sorted(s, key=lambda x: (often[x], x))[: len(s) - -(-least * len(s) // 100) + 1]:
            near.update(index[x])
            index[x].append(i)
        for j in near:
            both = len(s & sets[j])
            if 100 * both >= least * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for i, x in enumerate(texts):
        groups[find(i)].append(x)
    winners = {min(g, key=first.get) for g in groups.values()}
    out = []
    for d, t in rows:
        kept, seen = [], set()
        for x in (t or "").split("\n") if t is not None else []:
            if not x.strip(" "):
                kept.append(x)
            elif x not in seen:
                seen.add(x)
                if x in winners and first[x][:2] == (d is None, d or 0):
                    kept.append(x)
        n = len(t.split("\n")) if t is not None else 0
        out.append((n, n - len(kept), "\n".join(kept) if t is not None else ""))
    return out


def test_op10_against_brute_force(spark, unique):
    base, rows = unique
    out = {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in run(spark, "op10_fuzzy_lines", base).collect()}
    assert out == {i: (n, m, sha(left)) for (i, _), (n, m, left) in zip(rows, brute_lines(rows))}


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_op10_finds_all_merges_of_the_tables(spark, sf_dir):
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    out = {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in run(spark, "op10_fuzzy_lines", sf_dir).collect()}
    want = {i: (n, m, hashlib.sha256(left.encode()).hexdigest()) for (i, _), (n, m, left) in zip(rows, brute_lines(rows))}
    wrong = [i for i in want if out[i] != want[i]]
    assert wrong == []
