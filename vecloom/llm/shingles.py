"""Hashed word shingles of whole texts, for a whole Arrow batch at a time.

A word is a maximal run of bytes that are no separators; A-Z count as a-z. Words are hashed from running sums over the UTF-8
bytes, shingles by chaining word hashes, both as 64-bit numbers. A text of fewer words than the width is
one shingle, its whole sequence (with its length mixed in, so that it equals no part of a longer text).
Work goes through blocks of bounded size, cut between words, so memory does not depend on a text's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that are handled at once; temporaries are about forty times this.
BLOCK = 1 << 21

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply), in place on a fresh array."""
    x = x ^ (x >> _U(31))
    x *= _U(0x7FB5D329728EA185)
    x ^= x >> _U(27)
    x *= _U(0x81DADEF4BC2DD44D)
    x ^= x >> _U(33)
    return x


class Words:
    """Word hashing under a set of separator bytes."""

    def __init__(self, separators: bytes):
        self.sep = np.zeros(256, bool)
        self.sep[list(separators)] = True
        fold = np.arange(256, dtype=np.uint64)
        fold[65:91] += _U(32)
        self.value = mix((fold + _U(1)) * _U(_BASE))
        self.power = self.inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) <= n:
            size = max(n + 1, 1 << 16)
            inv = pow(_BASE, -1, 1 << 64)
            for name, b in (("power", _BASE), ("inverse", inv)):
                p = np.full(size, b, np.uint64)
                p[0] = 1
                setattr(self, name, np.cumprod(p, dtype=np.uint64))

    def hashes(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words of ``data`` (uint8), and their numbers per part; ``bounds`` cuts it into parts."""
        n = len(data)
        if n == 0:
            return np.zeros(0, np.uint64), np.zeros(len(bounds) - 1, np.int64)
        self._powers(n)
        word = ~self.sep[data]
        edge = np.zeros(n + 1, bool)
        edge[bounds] = True
        before = np.empty(n, bool)
        before[0] = False
        before[1:] = word[:-1]
        starts = np.flatnonzero(word & (~before | edge[:n]))
        after = np.empty(n, bool)
        after[-1] = False
        after[:-1] = word[1:]
        ends = np.flatnonzero(word & (~after | edge[1:])) + 1
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.value[data] * self.power[:n], out=total[1:])
        out = mix((total[ends] - total[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))
        return out, np.diff(np.searchsorted(starts, bounds))

    def texts(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The word hashes of each text of ``column`` in turn; null is the empty text."""
        data, bounds = utf8(column)
        k, last = 0, len(bounds) - 1
        while k < last:
            if bounds[k + 1] - bounds[k] > BLOCK:
                yield self._long(data[bounds[k] : bounds[k + 1]])
                k += 1
                continue
            to = max(k + 1, int(np.searchsorted(bounds, bounds[k] + BLOCK, "right")) - 1)
            part, counts = self.hashes(data[bounds[k] : bounds[to]], bounds[k : to + 1] - bounds[k])
            yield from np.split(part, np.cumsum(counts)[:-1])
            k = to

    def _long(self, data: np.ndarray) -> np.ndarray:
        parts, at = [], 0
        while at < len(data):
            to = min(len(data), at + BLOCK)
            if to < len(data):  # up to a separator, which may be further on
                inside = np.flatnonzero(self.sep[data[at:to]])
                if len(inside):
                    to = at + int(inside[-1]) + 1
                else:
                    further = np.flatnonzero(self.sep[data[to:]])
                    to = to + int(further[0]) + 1 if len(further) else len(data)
            parts.append(self.hashes(data[at:to], np.array([0, to - at]))[0])
            at = to
        return np.concatenate(parts)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes in one array, and their bounds; null is the empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    _, offsets, body = column.buffers()
    if n == 0 or body is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    return np.frombuffer(body, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """The sorted distinct shingle hashes of one text; none without words."""
    m = len(words)
    if m == 0:
        return words
    k = min(width, m)
    out = words[: m - k + 1].copy()
    for j in range(1, k):
        out = mix(out * _U(0xD6E8FEB86659FD93) + words[j : m - k + 1 + j])
    if m < width:
        out = mix(out ^ _U(m))
    return np.unique(out)


#: ASCII blanks only.
BLANK_WORDS = bytes([0x20, *range(0x09, 0x0E)])
#: All ASCII but letters and digits: punctuation never decides about a match.
ALNUM_WORDS = bytes(b for b in range(128) if not chr(b).isalnum())
