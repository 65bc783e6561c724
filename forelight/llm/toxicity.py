"""Toxicity scores by weak supervision.

Terms (words, and beginnings of words, as many languages inflect) that stand out
in documents labelled toxic become lexicon voters; patterns of writing vote as
well, and the given label is one more voter that can err. A generative model
estimates their accuracies and correlations by expectation-maximisation and
gives posterior labels, on which a linear classifier over hashed terms is
trained; two numbers fitted on labelled documents kept out of that training turn
its margin into a probability.

Only documents whose crc32(id as text) mod 4 is not 2 are learned from. Fitting
takes at most FIT_ROWS of these, those of the least id hashes, whatever their
length: texts are read where they are, and only their distinct words travel. All
rows are scored, over their whole texts.

Defined results: null counts as the empty text, which has no terms and the score
of the bias. Without labels, or with labels of one class only, every score is
the smoothed share of toxic labels; an empty table of documents gives an empty
result. Repeated rows are each scored, and fitted once. A document with several
labels is fitted once for each. Equal texts have equal scores, so nothing hangs on
the order of ties. Other columns of documents and labels, whatever their names, are never read.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forelight.llm import weak
from forelight.llm.common import least_hashes, table, small_batches

FIT_ROWS = 6_000
#: Hashed features; lexicon voters at most; documents that a lexicon term must be in.
DIMS, LEXICON, SUPPORT = 1 << 17, 96, 5
HELD_OUT, PARTS = 2, 4
THRESHOLD = 0.3
CACHED_WORDS = 200_000

_WORDS = regex.compile(r"\p{L}+(?:'\p{L}+)?")


def terms(word: str) -> list[str]:
    """A word, and its beginnings of three to seven letters."""
    return [f"={word}", *(f"^{word[:k]}" for k in range(3, 8) if k <= len(word))]


def bucket(term: str) -> int:
    return zlib.crc32(term.encode()) % DIMS


def tokens(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def _patterns(text: str, words: list[str]) -> list[int]:
    """Votes by ways of writing, whatever the words are: shouting, stressing, scolding at length."""
    letters = sum(map(str.isalpha, text))
    upper = sum(map(str.isupper, text))
    return [
        1 if letters and upper > 0.6 * letters else 0,
        1 if "!!!" in text or "?!" in text else 0,
        -1 if len(words) < 4 else 0,
    ]


@dataclass
class Read:
    """What fitting needs of a text: distinct words in order, how many words there are, votes by ways of writing."""

    words: list[str]
    count: int
    patterns: list[int]


def read(text: str | None) -> Read:
    text = text or ""
    words = tokens(text)
    return Read(sorted(set(words)), len(words), _patterns(text, words))


@dataclass
class Model:
    weights: np.ndarray  # by feature, and the bias
    scale: tuple[float, float, float]  # of the margin, of log words, and the offset
    lexicon: list[str]
    labels: weak.LabelModel | None

    def probability(self, margin: float, words: int) -> float:
        a, b, c = self.scale
        return 1 / (1 + float(np.exp(-np.clip(a * margin + b * np.log1p(words) + c, -30, 30))))


def standing_out(docs: list[list[str]], toxic: np.ndarray) -> dict[str, tuple[float, list[int]]]:
    """Terms of toxic documents whose log odds are above zero by two standard errors, with these and the rows."""
    where: dict[str, list[int]] = {}
    for i in np.flatnonzero(toxic):
        for t in docs[i]:
            where.setdefault(t, []).append(i)
    where = {t: rows for t, rows in where.items() if len(rows) >= SUPPORT}
    clean = dict.fromkeys(where, 0)
    for i in np.flatnonzero(~toxic):
        for t in docs[i]:
            if t in clean:
                clean[t] += 1
    n1, n0 = toxic.sum(), len(docs) - toxic.sum()
    out = {}
    for t, r in where.items():
        score = np.log((len(r) + 0.5) / (n1 + 1)) - np.log((clean[t] + 0.5) / (n0 + 1)) - 2 * np.sqrt(1 / (len(r) + 0.5) + 1 / (clean[t] + 0.5))
        if score > 0:
            out[t] = score, r
    return out


def lexicon(terms_: dict[str, tuple[float, list[int]]]) -> list[str]:
    """The strongest terms, no two of which stand for nearly the same documents."""
    chosen: list[str] = []
    covers: list[set[int]] = []
    for t in sorted(terms_, key=lambda t: (-terms_[t][0], t)):
        rows = set(terms_[t][1])
        if all(len(rows & c) < 0.8 * len(rows | c) for c in covers):
            chosen.append(t)
            covers.append(rows)
        if len(chosen) == LEXICON:
            break
    return chosen


def _posterior(docs: list[list[str]], reads: list[Read], labels: np.ndarray) -> tuple[dict, list[str], weak.LabelModel, np.ndarray]:
    found = standing_out(docs, labels == 1)
    names = lexicon(found)
    place = {t: j for j, t in enumerate(names)}
    votes = np.zeros((len(docs), len(names) + 5), np.int64)
    for i, (d, x, y) in enumerate(zip(docs, reads, labels, strict=True)):
        mine = [place[t] for t in d if t in place]
        votes[i, mine] = 1
        votes[i, len(names) :] = [0 if mine else -1, *x.patterns, 1 if y == 1 else -1]
    start = np.where(labels == 1, 0.9, 0.02)  # labels miss some and are wrong on some
    model = weak.fit(votes, np.ones(len(docs)), prior=float((labels == 1).mean()), start=start, apart=(votes.shape[1] - 1,))
    return found, names, model, model.posterior(votes)


def _train(found: dict, docs: list[list[str]], target: np.ndarray) -> np.ndarray:
    """Weights over the buckets of terms that stand out; all others stay at zero."""
    pick = {t: bucket(t) for t in found}
    pairs = [(i, pick[t]) for i, d in enumerate(docs) for t in d if t in pick]
    if not pairs:
        return np.zeros(DIMS + 1)
    rows, columns = np.array(pairs).T
    used, inner = np.unique(columns, return_inverse=True)
    w = weak.hashed_logistic(rows, inner, np.ones(len(rows)), target, len(used), l2=L2, rounds=ROUNDS, rate=RATE)
    out = np.zeros(DIMS + 1)
    out[used], out[-1] = w[:-1], w[-1]
    return out


def _margins(docs: list[list[str]], weights: np.ndarray) -> np.ndarray:
    return np.array([sum(weights[bucket(t)] for t in d) for d in docs]) + weights[-1]


def fit(reads: list[Read], labels: np.ndarray, parts: np.ndarray) -> Model:
    """``parts``: numbers that deal the rows to FOLDS; margins from the other folds' models calibrate."""
    n = len(reads)
    share = (labels.sum() + 1) / (n + 2)
    if n < 20 or len(set(labels.tolist())) < 2:
        return Model(np.zeros(DIMS + 1), (0.0, 0.0, float(np.log(share / (1 - share)))), [], None)
    # Each term is one string, however many documents have it.
    known: dict[str, list[str]] = {}
    names: dict[str, str] = {}
    for w in {w for r in reads for w in r.words}:
        known[w] = [names.setdefault(t, t) for t in terms(w)]
    docs = [sorted({t for w in r.words for t in known[w]}) for r in reads]
    fold = parts % FOLDS
    margin = np.zeros(n)

    def learn(rows: np.ndarray) -> tuple[np.ndarray, list[str], weak.LabelModel]:
        own = [docs[i] for i in rows]
        found, names, model, soft = _posterior(own, [reads[i] for i in rows], labels[rows])
        return _train(found, own, soft), names, model

    for k in range(FOLDS):
        rest, own = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if len(own) and len(set(labels[rest].tolist())) == 2:
            margin[own] = _margins([docs[i] for i in own], learn(rest)[0])
    weights, names, model = learn(np.arange(n))
    size = np.log1p([r.count for r in reads])
    scale = weak.logistic(np.column_stack([margin, size]), (labels == 1).astype(float), np.ones(n), l2=1e-4)
    return Model(weights, tuple(map(float, scale)), names, model)


FOLDS = 3
L2, ROUNDS, RATE = 1e-3, 200, 0.05


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> tuple[list[Read], np.ndarray, np.ndarray]:
    """At most FIT_ROWS labelled documents outside the held-out part, for the driver."""
    labels = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y")).where("y is not null and _id is not null")
    # The sample is drawn from the labels, which are short, so only its texts move.
    fit = least_hashes(labels.where(F.crc32(F.col("_id").cast("string")) % PARTS != HELD_OUT), ["_id"], FIT_ROWS)
    # FIT_ROWS pairs of numbers: a proven bound.
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(fit), F.col("doc_id") == F.col("_id"))
    texts = texts.select("doc_id", "y", F.xxhash64("text").alias("h"), "text").dropDuplicates(["doc_id", "y", "h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [read(t.as_py()) for t in batch.column(3)]
            columns = [pa.array([r.words for r in found], pa.list_(pa.string())), pa.array([r.count for r in found], pa.int64()), pa.array([r.patterns for r in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), *columns], names=["doc_id", "y", "h", "words", "n", "patterns"])

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = texts.mapInArrow(run, f"doc_id {kind}, y int, h long, words array<string>, n long, patterns array<long>").withColumn("part", F.xxhash64(F.lit(7), "doc_id")).toArrow()
    rows = []
    for batch in found.to_batches():
        doc, y, h, words, n, patterns, part = batch.columns
        for i in range(batch.num_rows):
            key = part[i].as_py(), doc[i].as_py(), y[i].as_py(), h[i].as_py()
            rows.append((key, Read([sys.intern(w) for w in words[i].as_py()], n[i].as_py(), patterns[i].as_py())))
    rows.sort(key=lambda r: r[0])
    return [r for _, r in rows], np.array([k[2] for k, _ in rows], int), np.array([k[0] for k, _ in rows], np.int64)


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and score."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value, {}
        weights = model.weights.astype(np.float64)

        def weigh(word: str) -> float:
            if len(known) >= CACHED_WORDS:
                known.clear()
            out = known[word] = float(sum([weights[bucket(t)] for t in terms(word)]))
            return out

        for batch in batches:
            out = []
            for text in batch.column(1):
                words = tokens(text.as_py() or "")
                # Sorted, so that equal texts have equal sums.
                margin = sum([known[w] if w in known else weigh(w) for w in sorted(set(words))])
                out.append(model.probability(margin + weights[-1], len(words)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=[id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(*training_rows(docs, table(spark, sf_dir, "labels")))
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % PARTS == HELD_OUT
    return scores(docs, model).select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
