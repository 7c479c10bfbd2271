"""Filters of a fixed size for hashes that occur often: places are found by the tasks and joined up segment by segment.

A code is a number of 32 bits and the range it lies in. Packed codes are dealt by range, so a range's codes meet in one
group whose size follows from the number of ranges; codes that occur often enough become bits. A filter may say yes to others
(equal places), never no to one of them, so what it lets through has to be decided exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shingles import mix

#: Bits of a filter (16 MB), and bits of one of its segments.
FILTER_BITS = 27
SEGMENT_BITS = 20

_U = np.uint64
_STEP = _U(0xD6E8FEB86659FD93)


def codes_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """The top bits of well-mixed hashes: the range (a power of two many) and 32 bits more."""
    return hashes >> _U(32 - (ranges - 1).bit_length())


def ranges_for(total: int, each: int) -> int:
    return 1 << max(0, (-(-int(total) // each) - 1).bit_length())


def places_of(codes: np.ndarray) -> np.ndarray:
    return mix(codes * _STEP + _U(1)) >> _U(64 - FILTER_BITS)


def in_filter(bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    place = places_of(codes)
    return (bits[place >> _U(3)] >> (_U(7) - (place & _U(7))).astype(np.uint8)) & 1 == 1


def dealt(codes: np.ndarray, ranges: int):
    """``range, lower, upper`` for the sorted ``codes`` of each range that has some."""
    cuts = np.searchsorted(codes, np.arange(ranges + 1, dtype=np.uint64) << _U(32))
    for r in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
        yield r, int(cuts[r]), int(cuts[r + 1])


def counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of ``parts(codes, counts)`` with their total counts."""
    codes, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[first], np.add.reduceat(counts, first)


def as_places(range_no: int, codes: np.ndarray) -> pa.Table:
    """``segment, at``: packed places of one range's ``codes`` (32 bits each)."""
    places = np.unique(places_of(_U(range_no) << _U(32) | codes.astype(np.uint64)))
    segments = places >> _U(SEGMENT_BITS)
    cuts = np.flatnonzero(np.concatenate(([True], segments[1:] != segments[:-1]))) if len(places) else np.zeros(0, int)
    within = (places & _U((1 << SEGMENT_BITS) - 1)).astype(np.uint32)
    packed = [x.tobytes() for x in np.split(within, cuts[1:])][: len(cuts)]
    return pa.table({"segment": pa.array(segments[cuts].astype(np.int32)), "at": pa.array(packed, pa.binary())})


def union_filter(places: DataFrame) -> np.ndarray:
    """The filter's bytes (2 to the power of ``FILTER_BITS``, less three) from ``places(segment, at)``: a fixed size, whatever the corpus."""

    def merge(t: pa.Table) -> pa.Table:
        bits = np.zeros(1 << SEGMENT_BITS, bool)
        for x in t.column("at"):
            bits[np.frombuffer(x.as_buffer(), np.uint32)] = True
        return pa.table({"segment": t.column("segment")[:1], "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    step = 1 << (SEGMENT_BITS - 3)
    got = places.groupBy("segment").applyInArrow(merge, "segment int, bits binary").toArrow()
    for k, bits in zip(got.column("segment").to_pylist(), got.column("bits"), strict=True):
        out[k * step : (k + 1) * step] = np.frombuffer(bits.as_buffer(), np.uint8)
    return out


def repeated(arrays: DataFrame, total: int) -> np.ndarray:
    """A filter of the 64-bit hashes that occur more than once in ``arrays``, one column of lists with ``total`` entries in all."""
    ranges = ranges_for(total, 8 << 20)

    def block(held):
        codes, n = np.unique(np.concatenate(held), return_counts=True)
        rows = [(r, codes[lo:hi].astype(np.uint32), n[lo:hi] > 1) for r, lo, hi in dealt(codes, ranges)]
        return pa.record_batch(
            [
                pa.array([r for r, _, _ in rows], pa.int32()),
                pa.array([c[~m].tobytes() for _, c, m in rows], pa.binary()),
                pa.array([c[m].tobytes() for _, c, m in rows], pa.binary()),
            ],
            names=["range", "ones", "more"],
        )

    def scan(batches):
        held, size = [], 0
        for b in batches:
            values = b.column(0).flatten().to_numpy().view(np.uint64)
            held.append(codes_of(mix(values), ranges))
            size += len(values)
            if size > 1 << 22:
                yield block(held)
                held, size = [], 0
        if size:
            yield block(held)

    def merge(t: pa.Table) -> pa.Table:
        parts = [(np.frombuffer(x.as_buffer(), np.uint32), k) for name, k in (("ones", 1), ("more", 2)) for x in t.column(name)]
        codes, n = counted([(c, np.full(len(c), k)) for c, k in parts])
        return as_places(t.column("range")[0].as_py(), codes[n > 1])

    found = arrays.mapInArrow(scan, "range int, ones binary, more binary").groupBy("range")
    return union_filter(found.applyInArrow(merge, "segment int, at binary"))
