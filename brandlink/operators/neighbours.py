"""Exact k nearest neighbours inside groups, by a tree of boxes.

Distinct vectors of a group are numbered along a Z-order curve; runs of ``LEAF``
are leaves and runs of ``FANOUT`` nodes a node above, each with its box.  A
vector's own leaf bounds the distance of its k-th neighbour; from the root down
it then visits only nodes whose box lies within that bound.  Equal vectors are
one point with its smallest ids, so a vector that holds a third of the rows is
one point as well.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .numbering import numbered

LEAF, FANOUT, SALT = 64, 16, 16


def _z_order(low: list[float], high: list[float]):
    """Position on the curve: the bits of the scaled coordinates in turn."""
    low, span = np.array(low), np.array(high) - np.array(low)
    span[span == 0] = 1
    bits = max(1, 60 // max(len(span), 1))

    def run(batches):
        for batch in batches:
            v = np.array(batch.column("v").to_pylist(), float).reshape(-1, len(span))
            q = ((v - low) / span * (2 ** bits - 1)).astype(np.int64)
            z = np.zeros(len(v), np.int64)
            for b in range(bits - 1, -1, -1):
                for j in range(len(span)):
                    z = z << 1 | (q[:, j] >> b & 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(z)], [*batch.schema.names, "z"])
    return run


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, summed coordinate by coordinate."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return out


def _matrix(t: pa.Table, name: str = "v") -> np.ndarray:
    return np.array(t.column(name).to_pylist(), float)


def _bound(k: int):
    """A point's k-th distance in its own leaf; none where the leaf is too small."""
    def run(t: pa.Table) -> pa.Table:
        d = _squares(_matrix(t), _matrix(t))
        np.fill_diagonal(d, np.inf)
        bound = np.partition(d, k - 1, axis=1)[:, k - 1] if len(d) > k else np.full(len(d), np.inf)
        return pa.table([t.column("pid"), t.column("g"), t.column("v").cast(pa.list_(pa.float64())), pa.array(bound)], ["pid", "g", "v", "bound"])
    return run


def _meet(k: int):
    """Visitors of a leaf and its points: each visitor's k nearest there."""
    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pa.table([pa.array([], x) for x in (pa.int64(), pa.int64(), pa.float64())], ["pid", "other", "d"])
        d = _squares(_matrix(a), _matrix(b))
        x, y = a.column("pid").to_numpy(), b.column("pid").to_numpy()
        d[x[:, None] == y[None, :]] = np.inf
        near = np.argsort(d, axis=1, kind="stable")
        # all that are as near as the k-th: ties are settled by id later
        kth = d[np.arange(len(d)), near[:, min(k, d.shape[1]) - 1]]
        i, j = np.nonzero((d <= kth[:, None]) & (d < np.inf))
        return pa.table([pa.array(x[i]), pa.array(y[j]), pa.array(d[i, j])], ["pid", "other", "d"])
    return run


def nearest(rows: DataFrame, k: int, group: str | None = None) -> DataFrame:
    """``id, other, d, rank``: the ``k`` other rows of the group nearest to each
    row of ``id long, v array<double>`` (fewer in groups of at most k rows), ``d``
    the squared distance, ties by the smaller id, ``rank`` from 1.  Ids are
    unique; vectors have one length and no nulls."""
    d = cut_lineage(rows.select("id", "v", (F.col(group) if group else F.lit(0)).alias("g")))
    first = Window.partitionBy("g", "v").orderBy("id")
    few = d.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k + 1)
    points = few.groupBy("g", "v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    dims = d.select(F.size("v").alias("n")).first()
    if dims is None or not dims.n:
        return d.select("id", F.col("id").alias("other"), F.lit(0.0).alias("d"), F.lit(0).alias("rank")).limit(0)
    ends = d.agg(*[f(F.col("v")[j]).alias(f"{f.__name__}{j}") for f in (F.min, F.max) for j in range(dims.n)]).first()
    low, high = [[ends[f"{n}{j}"] for j in range(dims.n)] for n in ("min", "max")]
    schema = T.StructType([*points.schema.fields, T.StructField("z", T.LongType())])
    points = numbered(points.mapInArrow(_z_order(low, high), schema), [F.col("g"), F.col("z"), F.col("v")], "pid")
    # leaves do not cross groups
    points = cut_lineage(points.drop("z"))
    start = points.groupBy("g").agg(F.min("pid").alias("s"), F.count(F.lit(1)).alias("n"))
    at = cut_lineage(points.join(start.select("g", "s"), "g").withColumn("leaf", F.floor((F.col("pid") - F.col("s")) / LEAF)))
    most = start.agg(F.max("n")).first()[0]

    seek = cut_lineage(at.select("pid", "g", "leaf", "v").groupBy("g", "leaf").applyInArrow(
        _bound(k), f"pid long, g {d.schema['g'].dataType.simpleString()}, v array<double>, bound double"))
    boxes, levels, count = at.select("g", F.col("leaf").alias("node"), F.col("v").alias("lo"), F.col("v").alias("hi")), [], math.ceil(most / LEAF)
    while True:
        up = boxes.groupBy("g", "node").agg(
            F.array(*[F.min(F.col("lo")[j]) for j in range(dims.n)]).alias("lo"),
            F.array(*[F.max(F.col("hi")[j]) for j in range(dims.n)]).alias("hi"))
        levels.append(cut_lineage(up.withColumn("parent", F.floor(F.col("node") / FANOUT))))
        if count <= 1:
            break
        boxes, count = levels[-1].select("g", F.col("parent").alias("node"), "lo", "hi"), math.ceil(count / FANOUT)
    salted = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")
    salt = F.pmod(F.xxhash64("pid"), F.lit(SALT)).cast("int").alias("salt")
    state = seek.select("pid", "g", "v", "bound", F.lit(0).cast("long").alias("parent"), salt)
    gap = lambda x, lo, hi: F.greatest(lo - x, x - hi, F.lit(0.0))
    for level in reversed(levels):
        # a node that everything visits is met in SALT parts
        child = level.select("g", "node", "parent", "lo", "hi", salted)
        far = F.lit(0.0)
        for j in range(dims.n):
            far = far + F.pow(gap(F.col("v")[j], F.col("lo")[j], F.col("hi")[j]), F.lit(2.0))
        state = (state.join(child, ["g", "parent", "salt"]).where(far * (1 - 1e-12) <= F.col("bound"))
                 .select("pid", "g", "v", "bound", F.col("node").alias("parent"), "salt"))
    leaves = at.select("pid", "g", "v", F.col("leaf").alias("parent"), salted)
    keys = ["g", "parent", "salt"]
    met = state.groupBy(*keys).cogroup(leaves.groupBy(*keys)).applyInArrow(_meet(k), "pid long, other long, d double")
    near = Window.partitionBy("pid").orderBy("d", F.col("ids")[0])
    ids = points.select(F.col("pid").alias("other"), "ids")
    met = (met.join(ids, "other").withColumn("_n", F.row_number().over(near)).where(F.col("_n") <= k)
           .select("pid", "ids", "d"))
    # its own point's other ids, at distance 0
    met = met.unionByName(points.select("pid", "ids", F.lit(0.0).alias("d")))
    member = d.join(points.select("g", "v", "pid"), ["g", "v"]).select("id", "pid")
    out = member.join(met, "pid").select("id", "d", F.explode("ids").alias("other")).where("id <> other")
    last = Window.partitionBy("id").orderBy("d", "other")
    return out.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select("id", "other", "d", "rank")
