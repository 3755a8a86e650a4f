"""Splitting texts into the pieces of byte-pair tokenizers, many texts at once, in numpy.

The patterns of these tokenizers split at changes between letters, numbers, white space and
all else, with English contractions as pieces of their own. Here each character's class is
looked up in a table, so pieces are found from class changes instead of by a matcher.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import regex

from resultlake.llm import batches as B
from resultlake.llm import words as W

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: What may follow an apostrophe as a contraction.
ONE, TWO = "stmd", ("re", "ve", "ll")
_APOSTROPHE = 39


#: All code points that a text can hold.
POINTS = [*range(0xD800), *range(0xE000, 0x110000)]


@cache
def classes() -> np.ndarray:
    """The class of each code point by the properties White_Space, L and N as the module ``regex`` knows them."""
    table = np.full(0x110000, OTHER, np.uint8)
    plain = "".join(map(chr, POINTS))
    for pattern, kind in ((r"\p{White_Space}+", SPACE), (r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for m in regex.finditer(pattern, plain):
            lo, hi = ord(m[0][0]), ord(m[0][-1])
            table[lo : hi + 1] = kind
    return table


@cache
def byte_level_classes() -> np.ndarray:
    """The class of each code point as the library tiktoken sees it: its Unicode version is its own."""
    import tiktoken

    table = np.full(0x110000, OTHER, np.uint8)
    plain = "".join(map(chr, POINTS))
    ranks = {bytes([b]): b for b in range(256)}
    for pattern, kind in ((r"\s", SPACE), (r"\p{L}", LETTER), (r"\p{N}", NUMBER)):
        found = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # what no match covers has no tokens, so the bytes that come back are the characters of the class
        table[np.frombuffer(bytes(found.encode_ordinary(plain)).decode().encode("utf-32-le"), np.uint32)] = kind
    return table


class Pieces:
    """The pieces of some texts: UTF-8 bytes of all texts, starts and ends in them, pieces of each text."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray):
        self.data, self.starts, self.ends, self.counts = data, starts, ends, counts

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """(first position, which) so that piece i is the one at first[which[i]]; pieces are told apart by their bytes."""
        _, first, which = np.unique(W.hashes(self.data, self.starts, self.ends), return_index=True, return_inverse=True)
        if not self._equal(first[which]):  # one hash of two pieces
            held = self.data.tobytes()
            seen: dict[bytes, int] = {}
            which = np.array([seen.setdefault(held[s:e], len(seen)) for s, e in zip(self.starts.tolist(), self.ends.tolist())], np.int64)
            first = np.unique(which, return_index=True)[1]
        return first, which

    def _equal(self, other: np.ndarray) -> bool:
        """Whether each piece has the bytes of the piece that ``other`` names."""
        length = self.ends - self.starts
        if (length != length[other]).any():
            return False
        for lo in range(0, len(other), 1 << 18):
            cut = slice(lo, lo + (1 << 18))
            n = length[cut]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            if (self.data[np.repeat(self.starts[cut], n) + step] != self.data[np.repeat(self.starts[other[cut]], n) + step]).any():
                return False
        return True

    def bytes_of(self, positions: np.ndarray) -> list[bytes]:
        held = self.data.tobytes()
        return [held[s:e] for s, e in zip(self.starts[positions].tolist(), self.ends[positions].tolist())]


def points_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, byte position of each, code points before each text)."""
    if not (data & 0x80).any():
        return data, np.arange(len(data)), offsets
    lead = (data & 0xC0) != 0x80
    where = np.flatnonzero(lead)
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, where, np.concatenate([[0], np.cumsum(lead, dtype=np.int64)])[offsets]


def _contractions(points: np.ndarray, kind: np.ndarray, first: np.ndarray, glued: np.ndarray, edge: np.ndarray, folded: bool) -> np.ndarray:
    """For each character the length of the contraction that begins there, else 0."""
    out = np.zeros(len(points), np.int8)
    mark = np.flatnonzero((points == _APOSTROPHE) & first & ~glued)
    mark = mark[mark + 1 < len(points)]
    if not len(mark):
        return out
    text = points | 32 if folded else points  # only letters are compared
    letter = kind == LETTER
    one = mark[letter[mark + 1] & ~edge[mark + 1] & np.isin(text[mark + 1], [ord(c) for c in ONE])]
    out[one] = 2
    more = mark[mark + 2 < len(points)]
    more = more[~edge[more + 1] & ~edge[more + 2]]
    for a, b in TWO:
        out[more[(text[more + 1] == ord(a)) & (text[more + 2] == ord(b)) & letter[more + 1] & letter[more + 2]]] = 3
    return out


def split(column: pa.Array, spaced: bool, table: np.ndarray | None = None) -> Pieces:
    """The pieces of each text of a string column; ``table`` has the class of each code point.

    ``spaced``: a blank belongs to the piece after it, and white space is kept (byte-level
    BPE). Otherwise white space is dropped, each number is a piece of its own and
    contractions are found in either case (BPE with word ends).
    """
    data, offsets = B.buffer(column)
    n = len(offsets) - 1
    if not len(data):
        none = np.zeros(0, np.int64)
        return Pieces(data, none, none, np.zeros(n, np.int64))
    points, where, edges = points_of(data, offsets)
    kind = (classes() if table is None else table)[points]
    size = len(kind)
    edge = np.zeros(size + 1, bool)  # a text begins here
    edge[edges] = True
    edge = edge[:size]
    first = np.ones(size, bool)
    first[1:] = kind[1:] != kind[:-1]
    first |= edge
    glued = np.zeros(size, bool)
    if spaced:
        last = np.ones(size, bool)
        last[:-1] = first[1:]
        ends_text = np.ones(size, bool)
        ends_text[:-1] = edge[1:]
        blank = (kind == SPACE) & last & ~ends_text  # white space before something else
        begin = first | blank
        joined = np.flatnonzero(blank & (points == 32))
        glued[joined + 1] = True
        begin[joined + 1] = False
    else:
        begin = first | (kind == NUMBER)
    short = _contractions(points, kind, first, glued, edge, not spaced)
    at = np.flatnonzero(short)
    if len(at):
        begin[at + 1] = False
        three = at[short[at] == 3]
        begin[three + 2] = False
        after = at + short[at]
        begin[after[after < size]] = True
    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], size)
    if not spaced:
        kept = kind[starts] != SPACE
        starts, ends = starts[kept], ends[kept]
    counts = np.diff(np.searchsorted(starts, edges))
    where = np.append(where, len(data))
    return Pieces(data, where[starts], where[ends], counts)
