"""Elias-Fano sequences and an n-gram trie over them, in a memory-mapped file.

A monotone sequence keeps the low bits of each item packed and the high bits in
unary.  Reading an item is a select of its one bit; the first item at or after
a value is found from the select of the zero bit before its high part.
All operations take arrays of queries.
"""

from __future__ import annotations

import os

import numpy as np

_U = np.arange(256, dtype=np.uint64)
_M1, _M2, _M4 = (np.uint64(x) for x in (0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F))
_L8, _H8 = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class Writer:
    """Appends arrays to one file; :meth:`map` gives them back memory-mapped."""

    def __init__(self, path: str):
        self.path, self.places = path, []
        open(path, "wb").close()

    def add(self, a: np.ndarray) -> int:
        with open(self.path, "ab") as f:
            f.write(b"\0" * (-f.tell() % 8))
            self.places.append((f.tell(), a.dtype, len(a)))
            a.tofile(f)
        return len(self.places) - 1

    def map(self, k: int) -> np.ndarray:
        at, dtype, n = self.places[k]
        return np.memmap(self.path, dtype, "r", at, (n,)) if n else np.empty(0, dtype)

    @property
    def size(self) -> int:
        return os.path.getsize(self.path)


def _write_bits(values: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros(len(values) * width // 64 + 2, np.uint64)
    if width:
        bit = np.arange(len(values), dtype=np.int64) * width
        at, off = bit >> 6, (bit & 63).astype(np.uint64)
        # items are in order, so those that share a word are neighbours
        first = np.flatnonzero(np.diff(at, prepend=-1))
        out[at[first]] = np.bitwise_or.reduceat(values << off, first) if len(values) else 0
        over = np.flatnonzero(off.astype(np.int64) + width > 64)
        out[at[over] + 1] |= values[over] >> (np.uint64(64) - off[over])
    return out


class EliasFano:
    """A monotone sequence of non-negative integers."""

    def __init__(self, values: np.ndarray, file: Writer):
        values = np.asarray(values).astype(np.uint64)
        self.n, self.file = len(values), file
        top = int(values[-1]) + 1 if self.n else 1
        self.low_bits = max(0, (top // max(self.n, 1)).bit_length() - 1)
        low = values & np.uint64((1 << self.low_bits) - 1)
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        self.zeros = int(high[-1]) + 1 if self.n else 1
        bits = np.zeros(-(-(self.n + self.zeros) // 64) * 64, np.uint8)
        bits[high + np.arange(self.n)] = 1
        packed = np.packbits(bits, bitorder="little")
        ones = np.cumsum(_POP[packed].reshape(-1, 8).sum(1, dtype=np.int64))
        before = np.concatenate([[0], ones[:-1]])
        self._low = file.add(_write_bits(low, self.low_bits))
        self._high = file.add(packed.view(np.uint64))
        self._ones = file.add(before)
        self._zeros = file.add(np.arange(len(before), dtype=np.int64) * 64 - before)

    def _select(self, k: np.ndarray, directory: int, one: bool) -> np.ndarray:
        """Place of the k-th one (or zero) bit: its word from the directory, its
        byte from the word's running byte counts, then a table."""
        table, words = self.file.map(directory), self.file.map(self._high)
        at = np.searchsorted(table, k, "right") - 1
        left = (k - table[at]).astype(np.uint64)
        x = words[at]
        if not one:
            x = ~x
        c = x - ((x >> _U[1]) & _M1)
        c = (c & _M2) + ((c >> _U[2]) & _M2)
        c = (((c + (c >> _U[4])) & _M4) * _L8)           # ones up to and with each byte
        # bytes whose running count is at most ``left``
        byte = (((((left * _L8) | _H8) - c) & _H8) >> _U[7]) * _L8 >> _U[56]
        shift = byte << _U[3]
        left -= ((c << _U[8]) >> shift) & _U[255]
        return (at << 6) + shift.astype(np.int64) + _IN_BYTE[((x >> shift) & _U[255]).astype(np.intp),
                                                             left.astype(np.intp)]

    def get(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        high = self._select(i, self._ones, True) - i
        return (high << self.low_bits) + self._get_low(i)

    def _get_low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.int64)
        words = self.file.map(self._low)
        bit = i * self.low_bits
        at, off = bit >> 6, (bit & 63).astype(np.uint64)
        v = words[at] >> off
        up = np.where(off > 0, words[at + 1] << ((np.uint64(64) - off) & np.uint64(63)), np.uint64(0))
        return ((v | up) & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first item >= x (n if none), and whether it equals x."""
        x = np.asarray(x, np.int64)
        out, same = np.full(len(x), self.n, np.int64), np.zeros(len(x), bool)
        high = x >> self.low_bits
        ok = np.flatnonzero(high < self.zeros)
        h = high[ok]
        # items with the same high part stand between the h-1st and the h-th zero
        start = np.zeros(len(ok), np.int64)
        pos = np.flatnonzero(h > 0)
        start[pos] = self._select(h[pos] - 1, self._zeros, False) - (h[pos] - 1)
        end = self._select(h, self._zeros, False) - h
        low = x[ok] & ((1 << self.low_bits) - 1)
        lo, hi = start, end.copy()
        todo = np.flatnonzero(lo < hi)
        while len(todo):
            mid = (lo[todo] + hi[todo]) >> 1
            less = self._get_low(mid) < low[todo]
            lo[todo[less]] = mid[less] + 1
            hi[todo[~less]] = mid[~less]
            todo = todo[lo[todo] < hi[todo]]
        out[ok] = lo
        here = np.flatnonzero(lo < end)
        same[ok[here]] = self._get_low(lo[here]) == low[here]
        return out, same


class Siblings:
    """Sorted children of parents 0 .. n-1, as one monotone sequence.

    Child ids count from the parent's base (what the parents before it end
    with), so a child is searched relative to its parent, by the successor of
    base + id + 1 among the children.
    """

    def __init__(self, parent: np.ndarray, child: np.ndarray, parents: int, file: Writer):
        count = np.bincount(parent, minlength=parents)
        start = np.concatenate([[0], np.cumsum(count)])
        self.pointers = EliasFano(start, file)
        last = np.zeros(parents, np.int64)
        full = np.flatnonzero(count)
        last[full] = child[start[full + 1] - 1] + 1
        base = np.concatenate([[0], np.cumsum(last)])
        self.children = EliasFano(base[parent] + child + 1, file)

    def _ranges(self, parent: np.ndarray):
        """First child, end and base of each parent; equal neighbours share
        the work."""
        new = np.concatenate([[True], parent[1:] != parent[:-1]]) if len(parent) else np.zeros(0, bool)
        p, at = parent[new], np.cumsum(new) - 1
        lo, hi = self.pointers.get(p), self.pointers.get(p + 1)
        base = np.zeros(len(p), np.int64)
        some = np.flatnonzero(lo > 0)
        base[some] = self.children.get(lo[some] - 1)
        return lo[at], hi[at], base[at]

    def _search(self, parent: np.ndarray, child: np.ndarray):
        if not self.children.n:
            return np.full(len(parent), -1, np.int64), np.zeros(len(parent), np.int64)
        lo, hi, base = self._ranges(parent)
        at, same = self.children.successor(base + child + 1)
        return np.where(same & (at >= lo) & (at < hi), at, -1), lo

    def find(self, parent: np.ndarray, child: np.ndarray) -> np.ndarray:
        """Place of the child among all children, -1 if it isn't its parent's."""
        return self._search(parent, child)[0]

    def rank(self, parent: np.ndarray, child: np.ndarray) -> np.ndarray:
        """Place of the child among its parent's children, -1 if none."""
        at, lo = self._search(parent, child)
        return np.where(at >= 0, at - lo, -1)


def _in_byte() -> np.ndarray:
    t = np.zeros((256, 8), np.int64)
    for b in range(256):
        ones = [k for k in range(8) if b >> k & 1]
        t[b, :len(ones)] = ones
    return t


_IN_BYTE = _in_byte()
