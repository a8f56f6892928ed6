"""Class rebalancing before a fit (M22): synthetic minority rows (Chawla et al.,
JAIR 2002), Tomek links and edited nearest neighbours.  Neighbours come from
:mod:`.neighbours`; no class is paired with itself as a whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .neighbours import nearest
from .numbering import numbered


def _rows(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str]) -> DataFrame:
    """``id, v, target`` with ids in the order of the keys (null features are 0)."""
    v = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features])
    d = df.select(v.alias("v"), F.col(label).cast("int").alias("target"), *keys)
    return cut_lineage(numbered(d, [*[F.col(k) for k in keys], F.col("target"), F.col("v")], "id").select("id", "v", "target"))


def _smote(d: DataFrame, k: int, seed: int) -> DataFrame:
    """``d`` and as many synthetic rows of the smaller class as it lacks: each
    lies on the way from a row to one of its ``k`` nearest of the class."""
    counts = {r.target: r["count"] for r in d.groupBy("target").count().collect()}  # two rows
    if len(counts) < 2 or min(counts.values()) < 2:
        return d
    small = min(counts, key=lambda c: (counts[c], c))
    lacking, have = max(counts.values()) - counts[small], counts[small]
    k = min(k, have - 1)
    mine = d.where(F.col("target") == small).select("id", "v")
    mine = cut_lineage(numbered(mine, [F.col("id")], "at"))
    near = cut_lineage(nearest(mine.select("id", "v"), k).select("id", "other", "rank"))
    draw = lambda i, n: F.pmod(F.xxhash64("new", F.lit(seed + i)), F.lit(n))
    new = d.sparkSession.range(lacking).select(F.col("id").alias("new"))
    new = new.select("new", draw(0, have).alias("at"), (draw(1, k) + 1).cast("int").alias("rank"),
                     (draw(2, 1 << 30) / float(1 << 30)).alias("way"))
    new = new.join(mine.select("at", "id", "v"), "at").join(near, ["id", "rank"])
    new = new.join(mine.select(F.col("id").alias("other"), F.col("v").alias("w")), "other")
    top = d.agg(F.max("id")).first()[0] + 1
    made = new.select((F.col("new") + top).alias("id"),
                      F.transform(F.arrays_zip("v", "w"), lambda x: x["v"] + F.col("way") * (x["w"] - x["v"])).alias("v"),
                      F.lit(small).alias("target"))
    return cut_lineage(d.select("id", "v", "target").unionByName(made))


def _without_tomek(d: DataFrame) -> DataFrame:
    """Rows that are each other's nearest and of different classes go, both."""
    one = cut_lineage(nearest(d.select("id", "v"), 1).select("id", "other"))
    target = d.select("id", "target")
    j = (one.join(one.select(F.col("id").alias("other"), F.col("other").alias("back")), "other")
         .where(F.col("back") == F.col("id")).join(target, "id")
         .join(target.select(F.col("id").alias("other"), F.col("target").alias("t")), "other"))
    return d.join(j.where(F.col("target") != F.col("t")).select("id"), "id", "left_anti")


def _edited(d: DataFrame, k: int = 3) -> DataFrame:
    """Rows stay whose ``k`` nearest are all of their class."""
    near = nearest(d.select("id", "v"), k).select("id", "other")
    target = d.select("id", "target")
    bad = (near.join(target, "id").join(target.select(F.col("id").alias("other"), F.col("target").alias("t")), "other")
           .where(F.col("target") != F.col("t")).select("id").distinct())
    return d.join(bad, "id", "left_anti")


METHODS = ("none", "smote", "smote_enn", "smote_tomek")


def rebalance(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], method: str = "smote",
              k: int = 5, seed: int = 0) -> DataFrame:
    """``id``, the features and ``label`` of a rebalanced training set.

    ``keys`` order the rows and must tell them apart for reruns to agree.  A
    class of one row, or a single class, is left as it is.  Null features count
    as 0."""
    if method not in METHODS:
        raise ValueError(method)
    d = _rows(df, features, label, keys)
    if method != "none":
        d = _smote(d, k, seed)
    if method == "smote_enn":
        d = _edited(d)
    elif method == "smote_tomek":
        d = _without_tomek(d)
    return d.select("id", *[F.col("v")[i].alias(f) for i, f in enumerate(features)], F.col("target").alias(label))
