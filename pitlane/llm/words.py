"""Words and word shingles of whole texts as 64-bit hashes, vectorised over UTF-8 bytes.

A word hash is a polynomial over the word's bytes modulo 2^64, mixed; a shingle
hash combines the hashes of its words in order. Equal words have equal hashes
everywhere; different ones collide with a chance of about 2^-64 a pair.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}

#: Odd factors of the words' places in a shingle (16 words at most).
_FACTORS = np.array([pow(0xD1342543DE82EF95, j + 1, 1 << 64) | 1 for j in range(16)], np.uint64)

#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes that belong to a word when words are parted by space, tab, LF, VT, FF and CR.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_table(kind: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        table = np.full(max(n, 1 << 20) + 1, _U(base), np.uint64)
        table[0] = 1
        have = np.cumprod(table, dtype=np.uint64)
        if n <= 1 << 22:  # one very long text doesn't leave its table behind
            _powers[kind] = have
    return have[:n]


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of all words, and the row each is in; a word ends where its row ends."""
    inside = is_word[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(offsets[1:], starts, "right")


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * _power_table("up", _BASE, n), out=sums[1:])
    at = _power_table("down", _BASE_INV, n + 1)
    return mix((sums[ends] - sums[starts]) * at[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each row: (row, hash as int64), ordered by row and hash.

    Words are lower-cased (A-Z). A row of fewer than k words has its whole
    sequence as its one shingle; a row without words has none."""
    data = LOWER[data]
    starts, ends, row = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = span_hashes(data, starts, ends)
    count = np.bincount(row, minlength=len(offsets) - 1)
    first = np.cumsum(count) - count
    # every run of k words, also across rows; then those inside a row
    runs = max(len(words) - k + 1, 0)
    h = np.zeros(runs, np.uint64)
    for j in range(k):
        h += words[j: j + runs] * _FACTORS[j]
    place = np.arange(len(words)) - first[row]
    inside = place[:runs] <= count[row[:runs]] - k
    h, rows = mix(h[inside]), row[:runs][inside]
    short = np.flatnonzero((count < k) & (count > 0))
    if len(short):
        whole = np.array([(words[first[r]: first[r] + count[r]] * _FACTORS[: count[r]]).sum() for r in short], np.uint64)
        whole = mix(whole + count[short].astype(np.uint64))
        at = np.searchsorted(rows, short)
        h, rows = np.insert(h, at, whole), np.insert(rows, at, short)
    h = h.view(np.int64)
    ends = np.searchsorted(rows, np.arange(len(count)), "right")
    begin = 0
    for end in ends.tolist():
        if end - begin > 1:
            h[begin:end].sort()
        begin = end
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    return rows[new], h[new]
