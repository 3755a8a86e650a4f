"""Words and word n-grams of many texts at once, as 64-bit hashes in numpy."""

from __future__ import annotations

import numpy as np

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words that are split by the white space of ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False

#: Bytes of words of letters and digits: 0-9, A-Z, a-z and all of other characters.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers; one value to one value."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words of each text): maximal runs of bytes that ``inside`` marks."""
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n, np.int64)
    part = inside[data]
    first = part.copy()
    first[1:] &= ~part[:-1]
    last = part.copy()
    last[:-1] &= ~part[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    first[edge] = part[edge]  # a run ends where its text ends
    last[edge - 1] = part[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


_KEEP = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], np.uint64)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span: of its length and its bytes, eight at a time."""
    length = ends - starts
    out = mix(length.astype(np.uint64) * _GOLD + _GOLD)
    if not len(starts):
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.arange(8)
    at, todo = 0, np.arange(len(starts))
    while len(todo):
        for lo in range(0, len(todo), 1 << 18):
            some = todo[lo : lo + (1 << 18)]
            word = padded[(starts[some] + at)[:, None] + eight].view(np.uint64).ravel()
            out[some] = mix(out[some] ^ (word & _KEEP[np.minimum(8, length[some] - at)]))
        at += 8
        todo = todo[length[todo] > at]
    return out


def grams(words: np.ndarray, counts: np.ndarray, k: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, grams of each text) of all runs of ``k`` words inside each text.

    ``short``: a text with fewer words, but one at least, gives one hash of all its words.
    """
    n = len(words)
    made = np.maximum(counts - k + 1, 0)
    ends = np.cumsum(counts)
    if n >= k:
        rolled = words[: n - k + 1].copy()
        for j in range(1, k):
            rolled = mix(rolled * _GOLD + words[j : n - k + 1 + j])
        inside = np.ones(n, bool)
        for j in range(k - 1):  # the last k - 1 words of a text begin no gram
            tail = ends[counts > j] - 1 - j
            inside[tail] = False
        rolled = rolled[inside[: n - k + 1]]
    else:
        rolled = np.zeros(0, np.uint64)
    if not short:
        return rolled, made
    few = np.flatnonzero((counts > 0) & (counts < k))
    if not len(few):
        return rolled, made
    alone = np.empty(len(few), np.uint64)
    for i, d in enumerate(few):
        whole = words[ends[d] - counts[d] : ends[d]]
        h = np.array([counts[d]], np.uint64)
        for w in whole:
            h = mix(h * _GOLD + w)
        alone[i] = h[0]
    before = np.concatenate([[0], np.cumsum(made)])[few]
    made = made.copy()
    made[few] = 1
    return np.insert(rolled, before, alone), made
