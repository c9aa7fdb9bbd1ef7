"""Bit-packed integers and Elias-Fano sequences on numpy arrays.

All structures are views of byte buffers: opening one copies nothing, so a
buffer may be a memory-mapped file or an Arrow value.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)
_64 = np.uint64(64)


def _mask(width: int) -> np.uint64:
    return np.uint64((1 << width) - 1)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """``values`` (below 2^width) in ``width`` bits each, as 64-bit words."""
    n = len(values)
    if not n or not width:
        return np.zeros(0, dtype=np.uint64)
    values = values.astype(np.uint64)
    words = (n * width + 63) // 64
    at = np.arange(n, dtype=np.uint64) * np.uint64(width)
    place, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    out = np.zeros(words + 1, dtype=np.uint64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    out[place[first]] = np.add.reduceat(values << shift, first)  # disjoint bits
    over = np.flatnonzero(shift + np.uint64(width) > _64)
    out[place[over] + 1] += values[over] >> (_64 - shift[over])
    return out[:words]


def unpack(words: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    """The packed values at the places ``at``."""
    if not width:
        return np.zeros(len(at), dtype=np.uint64)
    bit = at.astype(np.uint64) * np.uint64(width)
    place, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
    out = words[place] >> shift
    over = np.flatnonzero(shift + np.uint64(width) > _64)
    out[over] |= words[place[over] + 1] << (_64 - shift[over])
    return out & _mask(width)


def joined(arrays: list[np.ndarray]) -> bytes:
    """Arrays as one buffer: their number, then type and length of each, then
    the data, each array at a multiple of 8 bytes."""
    head = np.array([len(arrays), *(x for a in arrays for x in (ord(a.dtype.char), len(a)))], dtype=np.int64)
    parts = [head.tobytes()]
    for a in arrays:
        raw = a.tobytes()
        parts += [raw, b"\0" * (-len(raw) % 8)]
    return b"".join(parts)


def opened(buffer) -> list[np.ndarray]:
    """The arrays of ``joined``, as views of the buffer."""
    n = int(np.frombuffer(buffer, np.int64, 1)[0])
    head = np.frombuffer(buffer, np.int64, 2 * n, 8)
    at, out = 8 + 16 * n, []
    for kind, size in zip(head[::2].tolist(), head[1::2].tolist()):
        dtype = np.dtype(chr(kind))
        out.append(np.frombuffer(buffer, dtype, size, at))
        at += -(-size * dtype.itemsize // 8) * 8
    return out


class EliasFano:
    """A non-decreasing sequence: the low bits packed, the high bits unary."""

    FIELDS = 3

    def __init__(self, arrays: list[np.ndarray]):
        self.meta, self.low, self.high = arrays
        self.n, self.width = int(self.meta[0]), int(self.meta[1])
        # high part of each element (select of the ones), and where the elements
        # of each high part begin (select of the zeros of the unary code)
        bits = np.unpackbits(self.high, bitorder="little", count=int(self.meta[2]))
        small = np.int32 if len(bits) < 1 << 31 else np.int64
        zeros = np.flatnonzero(bits == 0).astype(small)
        self.begin = np.concatenate((np.zeros(1, small), zeros - np.arange(len(zeros), dtype=small)))
        self.part = np.flatnonzero(bits).astype(small) - np.arange(self.n, dtype=small)

    @staticmethod
    def built(values: np.ndarray) -> list[np.ndarray]:
        n = len(values)
        values = values.astype(np.uint64)
        top = int(values[-1]) if n else 0
        width = max(0, (top // n).bit_length() - 1) if n else 0
        high = (values >> np.uint64(width)).astype(np.int64)
        size = n + (top >> width) + 1 if n else 0
        bits = np.zeros(size, dtype=np.uint8)
        bits[high + np.arange(n)] = 1
        return [np.array([n, width, size], dtype=np.int64), pack(values & _mask(width), width),
                np.packbits(bits, bitorder="little")]

    def get(self, at: np.ndarray) -> np.ndarray:
        """Elements at the places ``at``."""
        return (self.part[at].astype(np.uint64) << np.uint64(self.width)) | unpack(self.low, self.width, at)

    def successor(self, values: np.ndarray) -> np.ndarray:
        """Place of the first element not below each value (n if there is none)."""
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.width)).astype(np.int64)
        wanted = values & _mask(self.width)
        last = len(self.begin) - 1
        lo = self.begin[np.minimum(high, last)].copy()
        hi = np.where(high >= last, lo, self.begin[np.minimum(high + 1, last)])
        while True:  # binary search among the low bits of one high part
            live = np.flatnonzero(lo < hi)
            if not len(live):
                return lo
            middle = (lo[live] + hi[live]) >> 1
            below = unpack(self.low, self.width, middle) < wanted[live]
            lo[live] = np.where(below, middle + 1, lo[live])
            hi[live] = np.where(below, hi[live], middle)


class Lists:
    """Ascending lists of distinct numbers as one rising sequence: each list is
    shifted by the end of the one before. Pointers are Elias-Fano as well."""

    FIELDS = 2 * EliasFano.FIELDS

    def __init__(self, arrays: list[np.ndarray]):
        pointers = EliasFano(arrays[:EliasFano.FIELDS])
        self.values = EliasFano(arrays[EliasFano.FIELDS:])
        self.begin = pointers.get(np.arange(pointers.n)).astype(np.int64)
        last = self.values.get(np.maximum(self.begin - 1, 0)) if self.values.n else self.begin.astype(np.uint64)
        self.base = np.where(self.begin > 0, last + _ONE, 0).astype(np.uint64)

    @staticmethod
    def built(pointers: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
        """List j has the values pointers[j]:pointers[j + 1]."""
        size = np.diff(pointers)
        last = np.zeros(len(size), dtype=np.uint64)
        full = size > 0
        last[full] = values[pointers[1:][full] - 1].astype(np.uint64) + _ONE
        base = np.concatenate(([0], np.cumsum(last)[:-1])).astype(np.uint64) if len(size) else last
        return [*EliasFano.built(pointers), *EliasFano.built(values.astype(np.uint64) + np.repeat(base, size))]

    def find(self, which: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of ``value`` in list ``which`` and whether it is there; place
        counts through all lists. A list number below 0 holds nothing."""
        n = self.values.n
        if not n or not len(which):
            return np.zeros(len(which), dtype=np.int64), np.zeros(len(which), dtype=bool)
        safe = np.maximum(which, 0)
        target = value.astype(np.uint64) + self.base[safe]
        place = self.values.successor(target)
        there = (which >= 0) & (place >= self.begin[safe]) & (place < self.begin[safe + 1])
        there &= self.values.get(np.minimum(place, n - 1)) == target
        return place, there
