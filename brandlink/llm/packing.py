"""Compact columns of integers for shuffled rows: byte planes, then zstd."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(a: np.ndarray) -> bytes:
    """Any integer array; the i-th bytes of all items stand together."""
    a = np.ascontiguousarray(a)
    if not len(a):
        return b""
    return zstandard.ZstdCompressor(level=1).compress(
        np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes())


def unpack(b: bytes, dtype) -> np.ndarray:
    if not b:
        return np.empty(0, dtype)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def pack_small(a: np.ndarray) -> bytes:
    """Integers in four bytes each where they all fit."""
    small = not len(a) or (int(a.max()) < 1 << 31 and int(a.min()) >= -(1 << 31))
    return (b"4" if small else b"8") + pack(a.astype(np.int32 if small else np.int64))


def unpack_small(b: bytes) -> np.ndarray:
    return unpack(b[1:], np.int32 if b[:1] == b"4" else np.int64).astype(np.int64)


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (in place)."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def runs(lengths: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... within each of consecutive runs of the given lengths."""
    lengths = np.asarray(lengths, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - lengths, lengths)
