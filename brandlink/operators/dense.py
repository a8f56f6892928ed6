"""Dense cosine pairs (V11, V12); the reduction itself is in :mod:`.pca`.

Dense vectors (embeddings, PCA output) share every dimension, so the
prefix filter of :mod:`.pairs` cannot prune them.  Two strategies:

* ``blocks`` (exact): names are hashed into stripes (:mod:`.grid`) and each
  pair of stripes is one group; there a block of ``block_size`` vectors of each
  side is multiplied at a time, and only pairs at or above the threshold leave
  the task.  Work is n^2 dot products -- the semantics of an all-pairs threshold.
* ``lsh`` (approximate): random-hyperplane signatures (Charikar 2002) cut into
  bands; vectors of a pair of stripes that share a band bucket become candidates
  and are verified exactly.  The bits of a band grow with the logarithm of the
  number of vectors that meet, so a bucket stays small, and the bands are as many
  as the wanted recall of a pair at the threshold needs.  Signatures are made
  where they meet, some bands at a time: neither they nor candidates are shuffled.
  Every vector meets all stripes, so with several of them the bands share their
  planes (Andoni and Indyk, E2LSH 2005): a band is two of a few half bands, and a
  pair that agrees in two halves shares a band.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grid import PAIR_SCHEMA, name_column, name_ranks, pair_table, parts_by_stripe, sides, stripe_count, stripe_pairs, striped


# --------------------------------------------------------- dense cosine

def _unit(df: DataFrame, col: str) -> DataFrame:
    norm = F.sqrt(F.aggregate(F.col(col), F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    return df.select("name", F.transform(F.col(col), lambda x: x.cast("double") / norm)
                     .alias("v")).where(norm > 0)


def dense_cosine_pairs(emb: DataFrame, min_similarity: float, name_col: str = "name",
                       vec_col: str = "embedding", method: str = "blocks",
                       block_size: int = 2048, recall: float = 0.95,
                       bands: int | None = None, rows: int | None = None, seed: int = 42, symmetric: bool = False) -> DataFrame:
    """Pairs ``left < right`` with cosine >= ``min_similarity``.

    ``method``: ``blocks`` (exact) or ``lsh`` (approximate); the caller says which.
    ``recall``: for ``lsh`` the chance to find a pair that is just at the
    threshold; ``bands`` and ``rows`` (bits of a band) override what follows from it."""
    e = _unit(emb.select(F.col(name_col).cast("string").alias("name"), F.col(vec_col)), vec_col)
    if method == "blocks":
        out = _blocks(e, min_similarity, block_size)
    elif method == "lsh":
        n = e.count()
        stripes = stripe_count(n, least=1024, most=16384)
        together = n if stripes == 1 else 2 * -(-n // stripes)
        if bands is not None and rows is not None:
            out = _lsh(e, min_similarity, bands, rows, seed, stripes)
        elif stripes == 1:
            out = _lsh(e, min_similarity, *band_plan(together, min_similarity, recall), seed, stripes)
        else:
            out = _lsh_halves(e, min_similarity, *half_plan(together, min_similarity, recall), seed, stripes)
    else:
        raise ValueError(method)
    if symmetric:
        out = out.unionByName(out.select(F.col("right_side").alias("left_side"),
                                         F.col("left_side").alias("right_side"), "similarity"))
    return out


_PACKED = "s int, names array<string>, m binary"


def _pack(batches):
    """Unit vectors of a batch to one row for each stripe."""
    for batch in batches:
        for s, part in parts_by_stripe(batch):
            v = part.column("v")
            m = v.flatten().to_numpy()
            names = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("name"))
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), names, pa.array([m.tobytes()], pa.binary())],
                                             ["s", "names", "m"])


def _product(t: float, block_size: int, candidates=None, keys=None):
    """Pairs at or above ``t`` of a group of two stripes, a block of each side at
    a time; ``candidates(a, b)``: which pairs may be tested (all without);
    ``keys(m)``: half bands, two of which a pair must share (not asked without).
    A block's products cost less than its candidates one by one, so these are
    asked only of the pairs that reach the threshold."""
    def run(table: pa.Table) -> pa.Table:
        both = sides(table)
        if both is None:
            return pair_table(*[pa.array([], pa.string())] * 2, [])
        a, b, same = both
        na, nb = name_column(a), name_column(b)
        ra, rb = name_ranks(na, nb, same)
        ma = np.concatenate([np.frombuffer(x.as_py()) for x in a.column("m")]).reshape(len(na), -1)
        mb = ma if same else np.concatenate([np.frombuffer(x.as_py()) for x in b.column("m")]).reshape(len(nb), -1)
        asked = candidates(ma, mb) if candidates else None
        ka = keys(ma) if keys else None
        kb = ka if same or not keys else keys(mb)
        parts = []
        for i in range(0, len(na), block_size):
            for j in range(i if same else 0, len(nb), block_size):
                sim = ma[i:i + block_size] @ mb[j:j + block_size].T
                hit = sim >= t - 1e-9
                if asked is not None:
                    hit &= asked[i:i + block_size, j:j + block_size]
                ii, jj = np.nonzero(hit)
                v = sim[ii, jj]
                ii, jj = ii + i, jj + j
                keep = np.round(v, 9) >= t
                # a block with itself holds every pair twice
                keep &= ra[ii] < rb[jj] if same and i == j else ra[ii] != rb[jj]
                ii, jj, v = ii[keep], jj[keep], v[keep]
                if ka is not None:
                    keep = _two_shared(ka, kb, ii, jj)
                    ii, jj, v = ii[keep], jj[keep], v[keep]
                parts.append((ii, jj, v, ra[ii] < rb[jj]))
        return pair_table(na, nb, parts)
    return run


def _blocks(e: DataFrame, t: float, block_size: int) -> DataFrame:
    n = stripe_count(e.count(), least=256, most=16384)
    packed = striped(e, n).mapInArrow(_pack, _PACKED)
    return stripe_pairs(packed, n).applyInArrow(_product(float(t), block_size), PAIR_SCHEMA)


def band_plan(n: int, t: float, recall: float) -> tuple[int, int]:
    """(bands, bits of a band): log2(n) bits, and bands until a pair at cosine
    ``t`` shares one with the chance ``recall``."""
    if not 0 < recall < 1:
        raise ValueError("recall lies between 0 and 1")
    rows = max(1, round(math.log2(max(n, 2))))
    hit = (1 - math.acos(max(-1.0, min(1.0, t))) / math.pi) ** rows
    return (1 if hit >= recall else math.ceil(math.log(1 - recall) / math.log(1 - hit))), rows


def _same_bucket(bands: int, rows: int, seed: int):
    """Which pairs of two sets of vectors share the bucket of a band; the planes
    of some bands at a time."""
    def run(ma, mb):
        dim = ma.shape[1]
        rng, weights = np.random.default_rng(seed), 1 << np.arange(rows)
        seen = np.zeros((len(ma), len(mb)), bool)
        step = max(1, _CELLS // (rows * (dim + max(len(ma), len(mb)))))

        def keys(m, planes):
            bits = (m @ planes.T) > 0
            return (bits.reshape(len(m), -1, rows) @ weights).T

        for at in range(0, bands, step):
            planes = rng.standard_normal((min(step, bands - at) * rows, dim))
            ka = keys(ma, planes)
            kb = ka if ma is mb else keys(mb, planes)
            for x, y in zip(ka, kb):
                order = np.argsort(y)
                y = y[order]
                lo, hi = np.searchsorted(y, x, "left"), np.searchsorted(y, x, "right")
                n = hi - lo
                # parts of a bucket join of about _CELLS pairs
                cut = np.flatnonzero(np.diff(np.cumsum(n) // _CELLS, prepend=0))
                for p, q in zip([0, *cut], [*cut, len(n)]):
                    k = n[p:q]
                    first = np.repeat(lo[p:q] - (np.cumsum(k) - k), k)
                    seen[np.repeat(np.arange(p, q), k), order[first + np.arange(len(first))]] = True
        return seen
    return run


_CELLS = 4 << 20  # numbers of an array at a time


def half_plan(n: int, t: float, recall: float) -> tuple[int, int]:
    """(half bands, bits of one): half of log2(n) bits, rounded up, and as many
    that a pair at cosine ``t`` shares two with the chance ``recall``."""
    bits = max(1, math.ceil(band_plan(n, t, recall)[1] / 2))
    q = (1 - math.acos(max(-1.0, min(1.0, t))) / math.pi) ** bits
    m = 2
    while 1 - (1 - q) ** m - m * q * (1 - q) ** (m - 1) < recall:
        m += 1
    return m, bits


def _half_keys(halves: int, bits: int, seed: int):
    """The half bands of vectors, a row each."""
    def run(m):
        planes = np.random.default_rng(seed).standard_normal((bits, halves, m.shape[1]))
        out = np.zeros((len(m), halves), np.uint8 if bits <= 8 else np.uint16 if bits <= 16 else np.uint32)
        step = max(1, _CELLS // halves)
        for at in range(0, len(m), step):
            for i in range(bits):
                out[at:at + step] |= ((m[at:at + step] @ planes[i].T) > 0).astype(out.dtype) << out.dtype.type(i)
        return out
    return run


def _two_shared(ka, kb, ii, jj) -> np.ndarray:
    """Which of the pairs share two half bands: both halves of a band."""
    step = max(1, _CELLS // ka.shape[1])
    parts = [np.count_nonzero(ka[ii[x:x + step]] == kb[jj[x:x + step]], axis=1) >= 2 for x in range(0, len(ii), step)]
    return np.concatenate(parts) if parts else np.empty(0, bool)


def _lsh_halves(e: DataFrame, t: float, halves: int, bits: int, seed: int, stripes: int) -> DataFrame:
    packed = striped(e, stripes).mapInArrow(_pack, _PACKED)
    return stripe_pairs(packed, stripes).applyInArrow(
        _product(float(t), 1024, keys=_half_keys(halves, bits, seed)), PAIR_SCHEMA)


def _lsh(e: DataFrame, t: float, bands: int, rows: int, seed: int, stripes: int) -> DataFrame:
    packed = striped(e, stripes).mapInArrow(_pack, _PACKED)
    return stripe_pairs(packed, stripes).applyInArrow(
        _product(float(t), 1024, _same_bucket(bands, rows, seed)), PAIR_SCHEMA)
