"""Names in stripes, and every pair of stripes in one group.

The stripes are as many for any number of names until one would hold more than
its limit, so the copies that are shuffled grow with the names; a group holds two
stripes at most.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAIR_SCHEMA = "left_side string, right_side string, similarity double"
STRIPES = 12  # at least, where names are enough: 78 groups


def stripe_count(n: int, least: int, most: int) -> int:
    """Stripes of at most about ``most`` names; none of less than ``least``."""
    return max(1, math.ceil(n / most), min(STRIPES, n // least))


def striped(df: DataFrame, stripes: int) -> DataFrame:
    """Adds ``s``; rows of one name share it, rows without a name are left out."""
    return df.where(F.col("name").isNotNull()).withColumn("s", F.pmod(F.xxhash64("name"), F.lit(stripes)).cast("int"))


def parts_by_stripe(batch: pa.RecordBatch):
    """(stripe, rows) of a batch with a column ``s``."""
    s = batch.column("s").to_numpy()
    order = np.argsort(s, kind="stable")
    cut = np.flatnonzero(np.diff(s[order], prepend=-1))
    for rows in np.split(order, cut[1:]):
        if len(rows):
            yield int(s[rows[0]]), batch.take(pa.array(rows))


def stripe_rounds(stripes: int) -> list[tuple[int, int]]:
    """Ranges of distances of stripes on a ring that make up all pairs: at most
    STRIPES copies of a name are made for each, however many stripes there are."""
    far, wide = stripes // 2 + 1, STRIPES // 2
    return [(0, far)] if stripes <= STRIPES else [(x, min(x + wide, far)) for x in range(0, far, wide)]


def stripe_pairs(packed: DataFrame, stripes: int, near: tuple[int, int] | None = None):
    """Packed rows of a stripe ``s``, once for each group ``ga <= gb`` of it;
    ``near``: only groups whose stripes are that far apart on a ring."""
    j = F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))
    rep = packed.withColumn("_j", j)
    if near is not None:
        apart = F.least(F.pmod(F.col("s") - F.col("_j"), F.lit(stripes)), F.pmod(F.col("_j") - F.col("s"), F.lit(stripes)))
        rep = rep.where((apart >= near[0]) & (apart < near[1]))
    return (rep.withColumn("ga", F.least("s", "_j")).withColumn("gb", F.greatest("s", "_j")).drop("_j")
            .groupBy("ga", "gb"))


def sides(t: pa.Table):
    """The two stripes of a group; one twice where it meets itself, or None
    where a stripe has no rows."""
    ga, gb = t.column("ga")[0].as_py(), t.column("gb")[0].as_py()
    s = t.column("s").to_numpy()
    a = t.take(pa.array(np.flatnonzero(s == ga)))
    b = a if ga == gb else t.take(pa.array(np.flatnonzero(s == gb)))
    return (a, b, ga == gb) if a.num_rows and b.num_rows else None


def name_column(t: pa.Table) -> pa.Array:
    """All names of the packed rows."""
    return pa.concat_arrays([c.flatten() for c in t.column("names").chunks])


def name_ranks(a: pa.Array, b: pa.Array, same: bool):
    """Numbers of the names of both sides in their order; equal ones share one."""
    both = np.array(a.to_pylist() + ([] if same else b.to_pylist()), object)
    rank = np.unique(both, return_inverse=True)[1]
    return rank[:len(a)], rank if same else rank[len(a):]


def pair_table(na, nb, parts, column="similarity") -> pa.Table:
    """The smaller name of each pair on the left; ``parts``: (places left, places
    right, values, whether the left place holds the smaller name)."""
    cols = [np.concatenate([p[i] for p in parts]) if parts else np.empty(0, k)
            for i, k in enumerate((np.int64, np.int64, float, bool))]
    names = pa.concat_arrays([na, nb])
    x, y = cols[0], cols[1] + len(na)
    lo, hi = np.where(cols[3], x, y), np.where(cols[3], y, x)
    return pa.table([names.take(pa.array(lo)), names.take(pa.array(hi)), pa.array(cols[2])],
                    ["left_side", "right_side", column])
