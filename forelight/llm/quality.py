"""Quality classifier by weak labels, without any given ones.

Overlapping heuristics (share of capitals, of symbols, of repeats, of marks, and
so on) vote good, bad or abstain on every document. Counts of vote patterns over
all documents go into expectation-maximisation, which estimates each heuristic's
accuracy; posterior labels of a bounded sample train a linear scorer over hashed
word forms (letters as a, capitals as A, digits as 0, marks as they are), pairs
of neighbouring forms, and repeats.

Defined results: null and empty texts have no words; heuristics abstain on them
and their score is the scorer's bias alone, which is that of an average document.
Long texts take part with all they have, in voting, fitting and scoring. Repeated
rows are each scored, and fitted once; equal texts have equal scores, so nothing
hangs on the order of ties. Other columns, whatever their names, are never read.
An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forelight.llm import weak
from forelight.llm.common import Scratch, least_hashes, table, small_batches

#: Documents from which the scorer is trained: those of the least hashes of id and text.
FIT_ROWS = 4_000
DIMS = 1 << 12
#: Added to a text's words when shares of them are taken.
FEW_WORDS = 8
THRESHOLD = 0.5

_LOWER, _UPPER, _DIGITS = re.compile("[a-z]+"), re.compile("[A-Z]+"), re.compile("0+")
_SYMBOLS = re.compile(r"[#$%&*|<>{}~^_=\\]")


class _Letters(dict):
    """Form of each character, found when first met."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        out = self[code] = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isnumeric() else c
        return out


_FORMS = _Letters()


def forms(text: str) -> list[str]:
    """The forms of a text's words: The -> Aa, 2024, -> 0, and so on."""
    shown = text.translate(_FORMS)
    return _DIGITS.sub("0", _UPPER.sub("A", _LOWER.sub("a", shown))).split()


#: The heuristics, in the order of their votes.
HEURISTICS = ("capitals", "symbols", "variety", "stutter", "commonest", "marks", "sentences", "letters", "prose")


def votes(words: list[str], shapes: list[str]) -> list[int]:
    n = len(words)
    if not n:
        return [0] * len(HEURISTICS)
    count = Counter(words)
    kinds = Counter(shapes)
    capital = sum([c for s, c in kinds.items() if s[:1] == "A" and "a" not in s and s != "A"]) / n
    symbol = sum([c for s, c in kinds.items() if _SYMBOLS.search(s)]) / n
    marks = sum([c for s, c in kinds.items() if "!!" in s or "??" in s]) / n
    ends = sum([c for s, c in kinds.items() if s[-1] in ".!?:"]) / n
    wordy = sum([c for s, c in kinds.items() if "a" in s or "A" in s]) / n
    stutter = sum(map(str.__eq__, words, words[1:])) / n
    variety, common = len(count) / n, max(count.values()) / n

    def bad(x: float, most: float) -> int:
        return -1 if x > most else 0

    # Junk of one sort looks well to all heuristics but its own, so that only a text of ordinary sentences gets a good vote.
    long = n >= 20
    # Few words say little: short texts pass unless they show a fault.
    shares = (0.005 < ends <= 0.6 and wordy >= 0.8) if long else wordy >= 0.4
    prose = shares and capital <= 0.1 and symbol <= 0.02 and stutter <= 0.1
    return [
        bad(capital, 0.15),
        bad(symbol, 0.03),
        bad(-variety, -0.4) if long else 0,
        bad(stutter, 0.1) if n >= 4 else 0,
        bad(common, 0.3) if long else 0,
        bad(marks, 0.05),
        bad(-ends, -0.005) if n >= 60 else 0,
        bad(-wordy, -0.6),
        1 if prose else 0,
    ]


def _bucket(name: str, cache: dict[str, int] = {}) -> int:  # noqa: B006
    if len(cache) > 100_000:
        cache.clear()
    return cache[name] if name in cache else cache.setdefault(name, zlib.crc32(name.encode()) % DIMS)


def features(words: list[str], shapes: list[str]) -> dict[int, float]:
    """Shares of hashed forms, pairs of forms and repeats; those of texts of a few words are drawn towards none."""
    if not words:
        return {}
    n = len(words) + FEW_WORDS
    out: dict[int, float] = {}

    def add(name: str, value: float) -> None:
        k = _bucket(name)
        out[k] = out.get(k, 0.0) + value

    for shape, c in Counter(shapes).items():
        add(shape, c / n)
        for mark in set(shape) - {"a", "A", "0", ".", ","}:
            add("has" + mark, c / n)
    for (a, b), c in Counter(zip(shapes, shapes[1:], strict=False)).items():
        add(f"{a} {b}", c / n)
    seen = Counter(words)
    add("=next", sum(map(str.__eq__, words, words[1:])) / n)
    add("=again", (len(words) - len(seen)) / n if len(words) >= 20 else 0.0)
    add("=commonest", max(seen.values()) / n if len(words) >= 20 else 0.0)
    return out


def _read(text: str | None) -> tuple[list[str], list[str]]:
    return (text.split(), forms(text)) if text else ([], [])


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Votes and features of texts, found where these are."""
    for batch in batches:
        read = [_read(t.as_py()) for t in batch.column(1)]
        found = [sorted(features(*r).items()) for r in read]
        columns = [[votes(*r) for r in read], [[k for k, _ in f] for f in found], [[v for _, v in f] for f in found]]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.list_(k)) for c, k in zip(columns, kinds, strict=True))], names=["h", "votes", "columns", "values"])


def vote_counts(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Patterns of votes over all documents (3 to the 9th at most), and how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column(0):
                code = 0
                for v in votes(*_read(text.as_py())):
                    code = code * 3 + v + 1
                found[code] += 1
        yield pa.RecordBatch.from_pydict({"code": pa.array(list(found), pa.int32()), "n": pa.array(list(found.values()), pa.int64())})

    rows = docs.select(text_col).mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").collect()
    m = len(HEURISTICS)
    codes = np.array([r["code"] for r in rows], np.int64)
    return np.stack([codes // 3 ** (m - 1 - j) % 3 - 1 for j in range(m)], axis=1).reshape(-1, m), np.array([r["n"] for r in rows], float)


def label_model(docs: DataFrame, text_col: str = "text") -> weak.LabelModel:
    patterns, counts = vote_counts(docs, text_col)
    return weak.fit(patterns, counts, prior=0.8)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, weak.LabelModel]:
    """Weights of the scorer (the last one is the bias), and the label model."""
    small_batches(docs.sparkSession)
    model = label_model(docs, text_col)
    keyed = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_h"), F.col(text_col).alias("_text")).where("_id is not null and _text is not null")
    # FIT_ROWS pairs of numbers: a proven bound.
    few = F.broadcast(least_hashes(keyed.select("_id", "_h"), ["_id", "_h"], FIT_ROWS))
    rows = keyed.join(few, ["_id", "_h"]).dropDuplicates(["_id", "_h"]).select("_h", "_text").mapInArrow(_described, "h long, votes array<long>, columns array<long>, values array<double>").collect()
    rows = sorted(rows, key=lambda r: (r["h"], r["columns"], r["values"]))
    if not rows:
        return np.zeros(DIMS + 1), model
    target = model.posterior(np.array([r["votes"] for r in rows]))
    found = [dict(zip(r["columns"], r["values"], strict=True)) for r in rows]
    place = np.array([i for i, f in enumerate(found) for _ in f], np.int64)
    column = np.array([k for f in found for k in f], np.int64)
    value = np.array([v for f in found for v in f.values()])
    # Good and bad weigh the same, however rare bad ones are.
    good = max(target.sum(), 1.0)
    weight = target / good + (1 - target) / max(len(target) - good, 1.0)
    weights = weak.hashed_logistic(place, column, value, target, DIMS, weight, l2=1e-5, rounds=400, rate=0.3)
    weights[-1] += np.log(model.prior / (1 - model.prior))  # back to the shares that good and bad really have
    return weights, model


def score(text: str | None, weights: np.ndarray) -> float:
    """From 0 (junk) to 1 (good)."""
    margin = sum([weights[k] * v for k, v in sorted(features(*_read(text)).items())]) + weights[-1]
    return 1 / (1 + float(np.exp(-np.clip(margin, -30, 30))))


#: Rows that a worker hands back at a time.
ROWS = 512


def scores(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and quality_score."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                out = [score(text.as_py(), shared.value) for text in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.float64())], names=[id_col, "quality_score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, quality_score double")


def accepted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that the scorer holds for good, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, id_col, text_col)[0])
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                yield part.filter(pa.array([score(text.as_py(), shared.value) >= THRESHOLD for text in part.column(place)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights, _ = fit(docs)
    scored = Scratch(spark, "quality").keep(scores(docs, weights), "scored")
    return scored.select("doc_id", F.col("quality_score").alias("score"), F.when(F.col("quality_score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
