"""Word shingles of many texts at once, as 64-bit hashes in NumPy arrays."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

from forelight.llm.common import mix

U = np.uint64
_P = U(0x9E3779B97F4A7C15)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(9, 14)]] = True
_POWERS = [np.ones(1, np.uint64)]
#: A 64-bit code for each byte.
_CODES = mix(np.arange(1, 257, dtype=np.uint64) * U(0xBF58476D1CE4E5B9))


def powers(n: int) -> np.ndarray:
    """_P to the powers 0 to n - 1, modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        steps = np.full(size, _P, np.uint64)
        steps[0] = 1
        _POWERS[0] = np.multiply.accumulate(steps)
    return _POWERS[0][:n]


#: Bytes of a word that are hashed eight at a time, all words together; longer words are hashed one by one.
SHORT = 64
_WHOLE = ~U(0)


def words(raw: np.ndarray, at: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of all words; A-Z are folded, words are split at ASCII white space and at row ends.

    Hashes with different seeds are independent. Each step mixes what came before
    with eight more bytes, so no two words meet because of how they are built.
    """
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    body = _FOLD[raw]
    space = _SPACE[body]
    edge = np.zeros(n + 1, bool)  # a row begins here
    edge[at[:-1]] = True
    opens = ~space
    opens[1:] &= space[:-1] | edge[1:n]
    closes = ~space
    closes[:-1] &= space[1:] | edge[1:n]
    first, last = np.flatnonzero(opens), np.flatnonzero(closes)
    size = last - first + 1
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = body
    # The eight bytes from each place on, as one number.
    eight = np.ndarray((n,), "<u8", padded, strides=(1,))
    value = mix(size.astype(np.uint64) + U(seed) * U(0xA0761D6478BD642F))
    short = size <= SHORT
    for k in range(0, SHORT, 8):
        live = np.flatnonzero(short & (size > k))
        if not len(live):
            break
        left = np.minimum(size[live] - k, 8).astype(np.uint64)
        value[live] = mix(value[live] * _P + (eight[first[live] + k] & (_WHOLE >> (U(64) - U(8) * left))))
    for w in np.flatnonzero(~short):
        value[w] = int.from_bytes(blake2b(body[first[w] : last[w] + 1].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little")
    return value, np.searchsorted(at, first, side="right") - 1


def sets(raw: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, checks, row offsets): each row's distinct shingles in ascending order, each as two independent numbers of 64 bits.

    A row of fewer words than ``size`` has its whole sequence as the one
    shingle, a row without words none.
    """
    rows = len(at) - 1
    (one, row), (two, _) = words(raw, at), words(raw, at, 1)
    count = np.bincount(row, minlength=rows)
    begin = np.zeros(rows + 1, np.int64)
    np.cumsum(count, out=begin[1:])
    length = np.minimum(count, size)
    whole = np.flatnonzero(count >= size)
    n = len(one)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(whole):
        same = np.flatnonzero(row[: n - size + 1] == row[size - 1 :])
        found.append((*(_run(value, same, size) for value in (one, two)), row[same]))
    for k in range(1, size):
        few = np.flatnonzero(length == k)
        few = few[count[few] == k]
        if len(few):
            found.append((*(_run(value, begin[few], k) for value in (one, two)), few))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    h, g, r = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((g, h, r))
    h, g, r = h[order], g[order], r[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1]) | (r[1:] != r[:-1])
    h, g, r = h[new], g[new], r[new]
    offsets = np.zeros(rows + 1, np.int64)
    np.cumsum(np.bincount(r, minlength=rows), out=offsets[1:])
    return h, g, offsets


def _run(value: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """One number for each run of k words that begins at the places given."""
    h = np.full(len(first), U(k), np.uint64)
    for j in range(k):
        h = mix(h * _P + value[first + j])
    return h
