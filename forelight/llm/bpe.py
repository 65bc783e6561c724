"""BPE encoding and decoding through a minimal acyclic transducer of frequent words.

The most frequent words of the corpus are encoded once by the merge rules and
compiled into a minimal acyclic automaton whose paths number the words; the
number leads to the word's ids. Workers memory-map the compiled form. Words it
lacks are merged exactly by the rules. Nothing is shuffled but word counts.

Defined results: a null or empty text has no tokens and decodes to ''. Other
columns of the input, whatever their names, are ignored. Repeated rows are
encoded each on its own. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import os
import re
import tempfile
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forelight.llm.common import Scratch, small_batches

#: Words in the lexicon, and how many a task may count at a time before it prunes the rare ones.
LEXICON_WORDS, COUNTED_WORDS = 32_768, 200_000
#: Encoded words, and units of plain texts, that a worker keeps.
CACHED_WORDS = 200_000

_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Texts in which every Unicode version agrees on case, classes and composition.
_PLAIN = re.compile("[\t\n\r -~\xa0-ɏ‐-‧]*").fullmatch


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


_BYTES = {c: b for b, c in enumerate(_byte_letters())}


class Rules:
    """Merge rules and vocabulary of a word-end BPE file."""

    def __init__(self, spec: bytes):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec.decode())
        self.library.no_truncation()
        self.library.no_padding()
        model = json.loads(spec)
        vocab = model["model"]["vocab"]
        end = model["model"]["end_of_word_suffix"]
        self.text = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.text.update({i: t for t, i in self.special.items()})
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        shown = _byte_letters()
        self.inner = [vocab[c] for c in shown]
        self.last = [vocab[c + end] for c in shown]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = rank, vocab[a + b]

    def units(self, text: str) -> tuple[list[str], bool]:
        """Strings to encode one after the other, and whether these are words already.

        In plain texts they are what lies between white space, as no word
        crosses that; the same few come again and again, punctuation included.
        """
        if _PLAIN(text) and not (self.cut and self.cut.search(text)):
            return text.lower().split(), False
        return self.pieces(text), True

    def pieces(self, text: str) -> list[str]:
        """The words that are encoded one by one, special tokens among them."""
        parts = self.cut.split(text) if self.cut else [text]
        out: list[str] = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(" " + part)  # no word begins with a space
            elif _PLAIN(part):
                out += _WORDS.findall(part.lower())
            elif part:
                normal = self.library.normalizer.normalize_str(part)
                out += [bytes(_BYTES[c] for c in w).decode() for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        return out

    def merge(self, word: str) -> list[int]:
        """Ids of one word: always the earliest rule, at its leftmost place."""
        if word[0] == " ":
            return [self.special[word[1:]]]
        raw = word.encode()
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        return self._short(ids) if len(ids) <= 48 else self._long(ids)

    def _short(self, ids: list[int]) -> list[int]:
        get, none = self.merges.get, (1 << 30, 0)
        rules = [get(pair, none) for pair in zip(ids, ids[1:], strict=False)]
        while rules:
            best = min(rules)
            if best is none:
                break
            i = rules.index(best)
            ids[i : i + 2] = [best[1]]
            del rules[i]
            if i:
                rules[i - 1] = get((ids[i - 1], best[1]), none)
            if i < len(rules):
                rules[i] = get((best[1], ids[i + 1]), none)
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        get, n = self.merges.get, len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        queue = [(*rule, i) for i in range(n - 1) if (rule := get((ids[i], ids[i + 1])))]
        queue = [(rank, i, new) for rank, new, i in queue]
        heapq.heapify(queue)
        while queue:
            rank, i, new = heapq.heappop(queue)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or get((ids[i], ids[j])) != (rank, new):
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
                if rule := get((new, ids[after[j]])):
                    heapq.heappush(queue, (rule[0], i, rule[1]))
            if (k := before[i]) >= 0 and (rule := get((ids[k], new))):
                heapq.heappush(queue, (rule[0], k, rule[1]))
        return [x for x in ids if x >= 0]


#: Spreads edges over the table.
_SPREAD = 2654435761


def compile_lexicon(entries: dict[str, list[int]]) -> bytes:
    """A minimal automaton over the words' bytes, and the ids by word number.

    Words enter in byte order; once a word's tail can't change any more its
    states are merged with equal ones, so words share suffixes as well as
    prefixes. Every edge holds how many words precede it among its state's,
    and their sum along a path is the word's number. Edges lie in an open hash
    table by state and byte.
    """
    words = sorted((w.encode(), ids) for w, ids in entries.items())
    register: dict[tuple, int] = {}
    done: list[tuple[bool, tuple[tuple[int, int], ...], int]] = []  # final, edges, words below
    path: list[list] = [[False, []]]  # of the latest word: final, edges closed so far
    latest = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, edges = path.pop()
            key = final, tuple(edges)
            if key not in register:
                register[key] = len(done)
                done.append((*key, final + sum(done[t][2] for _, t in edges)))
            path[-1][1].append((latest[len(path) - 1], register[key]))

    for word, _ in words:
        same = len(os.path.commonprefix([word, latest]))
        close(same)
        path += [[False, []] for _ in word[same:]]
        path[-1][0] = True
        latest = word
    close(0)
    root = len(done)
    done.append((path[0][0], tuple(path[0][1]), len(words)))

    edges = [(state, byte, to) for state, (_, e, _) in enumerate(done) for byte, to in e]
    size = 1 << max(4, (2 * len(edges)).bit_length())
    key, target, skip = (np.zeros(size, np.uint32) for _ in range(3))
    passed = [int(f) for f, _, _ in done]
    for state, byte, to in edges:
        mark = (state << 8 | byte) + 1
        at = mark * _SPREAD & size - 1
        while key[at]:
            at = at + 1 & size - 1
        key[at], target[at], skip[at] = mark, to, passed[state]
        passed[state] += done[to][2]
    final = np.array([f for f, _, _ in done], np.uint32)
    start = np.zeros(len(words) + 1, np.uint32)
    start[1:] = np.cumsum([len(ids) for _, ids in words])
    arrays = [final, key, target, skip, start, np.array([i for _, ids in words for i in ids], np.uint32)]
    head = np.array([root, *map(len, arrays)], np.uint32)
    return b"".join(a.astype("<u4").tobytes() for a in [head, *arrays])


def _outline(word: str) -> tuple[str, str, int]:
    return word[:4], word[-4:], len(word)


class Lexicon:
    """A compiled lexicon, memory-mapped."""

    def __init__(self, compiled: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(compiled)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        view = memoryview(self.map).cast("I")
        self.root, sizes, at, arrays = view[0], view[1:7], 7, []
        for n in sizes:
            arrays.append(view[at : at + n])
            at += n
        self.final, self.key, self.target, self.skip, self.start, self.ids = arrays
        self.mask = len(self.key) - 1
        #: Begin, end and length of all words; most others are told from these by one look.
        self.outlines = {_outline(w) for w in self._words()}

    def _words(self) -> Iterator[str]:
        edges: dict[int, list[tuple[int, int]]] = {}
        for at, mark in enumerate(self.key):
            if mark:
                edges.setdefault((mark - 1) >> 8, []).append(((mark - 1) & 255, self.target[at]))
        stack = [(self.root, b"")]
        while stack:
            state, word = stack.pop()
            if self.final[state]:
                yield word.decode()
            stack += [(to, word + bytes([byte])) for byte, to in edges.get(state, [])]

    def get(self, word: str) -> list[int] | None:
        if _outline(word) not in self.outlines:
            return None
        state, number, key, mask = self.root, 0, self.key, self.mask
        for byte in word.encode():
            mark = (state << 8 | byte) + 1
            at = mark * _SPREAD & mask
            while (found := key[at]) != mark:
                if not found:
                    return None
                at = at + 1 & mask
            number += self.skip[at]
            state = self.target[at]
        return list(self.ids[self.start[number] : self.start[number + 1]]) if self.final[state] else None


@lru_cache(maxsize=2)
def _rules(spec: bytes) -> Rules:
    return Rules(spec)


@lru_cache(maxsize=2)
def _lexicon(compiled: bytes) -> Lexicon:
    return Lexicon(compiled)


@lru_cache(maxsize=1)
def _known(compiled: bytes) -> tuple[dict, dict]:
    """Units and words encoded by this worker so far, over all its tasks."""
    return {}, {}


def frequent_words(texts: DataFrame, spec: bytes, most: int = LEXICON_WORDS) -> dict[str, int]:
    """The most frequent words over all rows of the one text column.

    Those that make up at least a ``3 * most``-th of all words, so no more than
    that many, and of these the first ``most``. Each task counts all its words
    and, whenever it holds COUNTED_WORDS of them, forgets those that it has
    seen least; so a count may be low for rare words, but the words that matter
    for speed are found. Results of encoding don't depend on which words are in
    the lexicon.
    """
    shared = texts.sparkSession.sparkContext.broadcast(spec)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules, seen, exact = _rules(shared.value), Counter(), Counter()
        for batch in batches:
            for text in batch.column(0):
                units, words = rules.units(text.as_py() or "")
                (exact if words else seen).update(units)
                for counter in (seen, exact):
                    if len(counter) > COUNTED_WORDS:
                        best = dict(counter.most_common(COUNTED_WORDS // 4))
                        counter.clear()
                        counter.update(best)
        for unit, n in seen.most_common(most):
            for word in _WORDS.findall(unit):
                exact[word] += n
        best = exact.most_common(most)
        if best:
            yield pa.RecordBatch.from_pydict({"word": [w for w, _ in best], "n": [n for _, n in best]})

    counts = Scratch(texts.sparkSession, "bpe").keep(texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    total = counts.agg(F.sum("n")).head()[0] or 0
    # "word" decides ties, so the same counts always give the same lexicon.
    rows = counts.where(F.col("n") * 3 * most >= total).orderBy(F.desc("n"), "word").limit(most).collect()
    return {r["word"]: r["n"] for r in rows}


def encode(docs: DataFrame, spec: bytes, id_col: str = "doc_id", text_col: str = "text", words: int = LEXICON_WORDS) -> DataFrame:
    """Per document: id, n_tokens, ids and decoded, the latter as the library decodes them.

    ``ids`` is the decimal ids joined by one space, ``decoded`` the tokens'
    texts joined likewise (the file names no decoder).
    """
    return _mapped(docs, spec, id_col, text_col, words, "ids string, decoded string", lambda ids, text: (ids, text))


def encode_digests(docs: DataFrame, spec: bytes, id_col: str = "doc_id", text_col: str = "text", words: int = LEXICON_WORDS) -> DataFrame:
    """Like :func:`encode`, with SHA-256 digests of the two strings."""
    digest = _sha256
    return _mapped(docs, spec, id_col, text_col, words, "ids_sha256 string, decoded_sha256 string", lambda ids, text: (digest(ids), digest(text)))


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _mapped(docs: DataFrame, spec: bytes, id_col: str, text_col: str, words: int, columns: str, finish) -> DataFrame:
    small_batches(docs.sparkSession)
    rules = _rules(spec)
    lexicon = compile_lexicon({w: rules.merge(w) for w in frequent_words(docs.select(text_col), spec, words) if w[0] != " "})
    shared = docs.sparkSession.sparkContext.broadcast((spec, lexicon))
    kind = docs.schema[id_col].dataType.simpleString()
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules, lexicon = _rules(shared.value[0]), _lexicon(shared.value[1])
        (units, words), shown = _known(shared.value[1]), rules.text

        def encoded(word: str) -> tuple[str, str, int]:
            ids = lexicon.get(word) or rules.merge(word)
            return " ".join(map(str, ids)), " ".join([shown[i] for i in ids]), len(ids)

        def of_word(word: str) -> tuple[str, str, int]:
            if len(words) >= CACHED_WORDS // 4:
                words.clear()
            out = words[word] = units.get(word) or encoded(word)
            return out

        def of_unit(unit: str) -> tuple[str, str, int]:
            if len(units) >= CACHED_WORDS:
                units.clear()
            if unit.isalpha():  # one word
                out = words.get(unit) or encoded(unit)
            else:
                got = [words.get(w) or of_word(w) for w in _WORDS.findall(unit)]
                out = got[0] if len(got) == 1 else (" ".join([g[0] for g in got]), " ".join([g[1] for g in got]), sum([g[2] for g in got]))
            units[unit] = out
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                counts, outs = [], []
                for text in part.column(1):
                    found, are_words = rules.units(text.as_py() or "")
                    known, look_up = (words, of_word) if are_words else (units, of_unit)
                    got = [known.get(x) or look_up(x) for x in found]
                    counts.append(sum([g[2] for g in got]))
                    outs.append(finish(" ".join([g[0] for g in got]), " ".join([g[1] for g in got])))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), *(pa.array([o[k] for o in outs], pa.string()) for k in range(2))], names=[id_col, "n_tokens", *names])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, {columns}")


def public_file(name: str = "word_bpe_49k.json") -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op5_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_file())
