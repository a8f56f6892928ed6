"""Mixing sources to target weights.

Every document gets a hash-random key (md5 of its id and text).  Within each source the
documents stand in key order; distributed prefix sums of their token counts
say where each one starts, and the source is cut at its exact budget.  A
budget beyond the source's size takes whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import range_numbered, space_words, staged

#: Leading hex digits of the key that make a range bucket (4,096 per source).
BUCKET_DIGITS = 3


def source_targets(sizes: DataFrame, weights=(5, 2, 1), cap: float = 3.0) -> DataFrame:
    """``source, source_size`` -> with ``target``.

    Sources in code-point order (null last) weigh ``weights`` in turn and share
    the total.  A target stops at ``cap`` times its source's size; the excess is
    shared out again by weight until none is above.  Each round is one
    aggregate over the sources; only its sums reach the driver.
    """
    s = range_numbered(sizes, [F.col("source").asc_nulls_last()], "rank")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("rank") % len(weights) + 1).cast("int"))
    s = staged(s.withColumn("w", w).withColumn("cap", F.col("source_size") * cap))
    total = s.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        above = F.col("cap") <= F.lit(level) * F.col("w")
        r = s.agg(F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0.0)),
                  F.sum(F.when(~above, F.col("w"))), F.count(F.when(above, 1))).first()
        if r[1] is None or r[2] == full:  # all capped, or no further source capped
            break
        full, level = r[2], (total - r[0]) / r[1]
    return s.select("source", "source_size",
                    F.least(F.col("cap"), F.lit(level) * F.col("w")).alias("target"))


def mix(docs: DataFrame, weights=(5, 2, 1), cap: float = 3.0, size: Column | None = None,
        seed: str = "mix") -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target, taken``.

    ``taken`` counts the words the mix takes from the document over all epochs:
    whole epochs of the source, then the documents in key order up to the
    rounded target.  The document in which the budget ends gives its first
    words only, so each source's words sum to its rounded target exactly.

    Null text or source: size 0, the null source (last).  An empty table gives
    no rows.  Rows that repeat a doc_id are mixed each on its own; rows equal in
    id and text follow each other.  Documents of size 0 take 0.
    """
    return _taken(docs, weights, cap, size, seed).drop("row")


def _taken(docs: DataFrame, weights, cap: float, size: Column | None = None, seed: str = "mix",
           whole_rows: bool = False) -> DataFrame:
    """As :func:`mix`, with the input row as the struct ``row`` (null without
    ``whole_rows``), so that nothing is joined back by an id."""
    size = F.size(space_words(F.col("text"))).cast("long") if size is None else size
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                         F.coalesce("text", F.lit(""))))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if whole_rows else F.lit(None).cast("int")
    d = staged(docs.select("doc_id", "source", size.alias("size"), key.alias("key"), row.alias("row"))
               .withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS)))
    per_bucket = staged(d.groupBy("source", "bucket").agg(F.sum("size").alias("bsum")))
    targets = source_targets(per_bucket.groupBy("source").agg(F.sum("bsum").alias("source_size")),
                             weights, cap)
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    start = per_bucket.select("source", "bucket",
                              F.coalesce(F.sum("bsum").over(before), F.lit(0)).alias("bstart"))
    start = (start.alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
             .select("b.source", "bucket", "bstart", "source_size", "target"))
    within = (Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    j = (d.alias("d").join(start.alias("b"),
                           F.col("d.source").eqNullSafe(F.col("b.source"))
                           & (F.col("d.bucket") == F.col("b.bucket")))
         .select("doc_id", "d.source", "size", "source_size", "target", "row",
                 (F.col("before") + F.col("bstart")).alias("before")))
    budget = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")
                   ).otherwise(F.lit(0))
    rest = budget - whole * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return j.select("doc_id", "source", "size", "source_size", "target",
                    (F.col("size") * whole + last).cast("long").alias("taken"), "row")


def mixed_documents(docs: DataFrame, weights=(5, 2, 1), cap: float = 3.0) -> DataFrame:
    """The documents of the mix: one row per epoch that takes at least half of
    the document (the budget's last document is taken whole or not at all).
    Documents without words follow no budget: each stays once."""
    m = _taken(docs, weights, cap, whole_rows=True)
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(
        F.floor((F.col("taken") * 2 + F.col("size")) / (F.col("size") * 2)).cast("int"))
    m = m.select("row", copies.alias("copies")).where("copies > 0")
    return m.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
