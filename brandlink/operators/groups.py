"""Pairs to groups.

Every method is a distributed join/aggregate loop; no name list, pair list
or group passes through the driver or one task.  Loops cut their lineage
with reliable checkpoints in the session's checkpoint directory, so a lost
executor only costs the current round.

Group ids are the smallest member name (of threshold communities: the centre),
so results of different methods and runs compare directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .numbering import numbered


def _names(pairs: DataFrame, names: DataFrame | None) -> DataFrame:
    n = (pairs.select(F.col("left_side").alias("name"))
         .unionByName(pairs.select(F.col("right_side").alias("name"))))
    if names is not None:
        n = n.unionByName(names.select("name"))
    return n.where(F.col("name").isNotNull()).distinct()


def _smallest_member(assign: DataFrame, key: str) -> DataFrame:
    """(name, key) -> (name, group_id = smallest name sharing the key)."""
    g = assign.groupBy(key).agg(F.min("name").alias("group_id"))
    return assign.join(g, key).select("name", "group_id")


# ---------------------------------------------------------------- G2

def connected_components(pairs: DataFrame, names: DataFrame | None = None,
                         min_similarity: float | None = None, column: str = "similarity") -> DataFrame:
    """G2 (+G3): transitive groups of the pairs (at or above
    ``min_similarity`` when given); every name of ``names`` and of the pairs
    appears once, alone when unmatched.  Output ``name, group_id``.

    Names are numbered once in their order, and the loop runs on the numbers
    (:func:`star_labels`), so the smallest number of a component is its
    smallest name.
    """
    # read for the edges and for the name list: materialise once
    keep = ["left_side", "right_side"] + ([column] if min_similarity is not None else [])
    pairs = cut_lineage(pairs.select(*keep))
    ids = cut_lineage(numbered(_names(pairs, names), [F.col("name")], "id"))
    edges = pairs if min_similarity is None else pairs.where(F.col(column) >= min_similarity)
    left, right = (ids.select(F.col("name").alias(side), F.col("id").alias(to))
                   for side, to in (("left_side", "a"), ("right_side", "b")))
    labels = star_labels(edges.join(left, "left_side").join(right, "right_side").select("a", "b"))
    out = ids.join(labels, ids.id == labels.node, "left").select(
        "name", F.coalesce("label", "id").alias("id"))
    return out.join(ids.select("id", F.col("name").alias("group_id")), "id").select("name", "group_id")


def star_labels(edges: DataFrame) -> DataFrame:
    """``a, b`` edges -> ``node, label``: the smallest node of each component, for
    nodes with an edge to another node.

    Alternating large and small stars (Kiveris et al., SOCC 2014): a node links
    its larger neighbours to its smallest one, then itself and its smaller
    neighbours to the smallest of them.  A logarithmic number of rounds on
    paths, few on hubs: what hangs on a hub hangs on its smallest neighbour
    after one.  Runs until no edge changes.
    """
    e = cut_lineage(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where(F.col("b") > F.col("a")).join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")).distinct())
        large = cut_lineage(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))))
        e = cut_lineage(small.where(F.col("a") != F.col("b")).distinct())
        # two sums over all edges: equal only when no edge changed
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                          F.sum(F.col("b").cast("decimal(38,0)"))).first())
        if now == state or not now[0]:
            break
        state = now
    leaves = e.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return leaves.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


# ---------------------------------------------------------------- G1

def ordered_groups(pairs: DataFrame, min_similarity: float = 0.7,
                   names: DataFrame | None = None, column: str = "similarity",
                   order_col: str | None = None) -> DataFrame:
    """G1 (+G3): the greedy pass over pairs in order, as a parallel plan.

    Sequential rule: for a pair at or above the threshold both names take the
    group of the left name if it has one, else of the right name, else a new
    group; below it each name not seen yet gets its own group.

    The pass is a forest of events.  An event is a matched pair, or the first
    occurrence of a name when that occurrence is below the threshold (a new
    group).  A matched event copies the group of the latest earlier event of
    its left name, else of its right name, else starts a group.  A name ends in
    the group of its last event.  Latest-earlier events are window lags per
    name; groups are resolved by pointer jumping over the forest.

    Order: ``order_col`` ascending when given (a total order over pairs), else
    similarity descending, then left, then right.
    """
    cols = ["left_side", "right_side", column] + ([order_col] if order_col else [])
    pairs = cut_lineage(pairs.select(*dict.fromkeys(cols)))  # read twice below
    if order_col is not None:
        k = F.struct(F.col(order_col).alias("k0"), F.col("left_side").alias("k1"),
                     F.col("right_side").alias("k2"))
    else:
        k = F.struct((-F.col(column)).alias("k0"), F.col("left_side").alias("k1"),
                     F.col("right_side").alias("k2"))
    p = pairs.select("left_side", "right_side",
                     F.coalesce(F.col(column) >= min_similarity, F.lit(False)).alias("m"),
                     k.alias("k"))

    def ev(slot: int) -> Column:
        return F.struct(F.col("k").alias("k"), F.lit(slot).alias("slot"))

    # occurrences: (name, event, side, matched); a self pair is one occurrence
    same = F.col("left_side") == F.col("right_side")
    occ = (p.select(F.col("left_side").alias("name"),
                    F.when(F.col("m"), ev(0)).otherwise(ev(1)).alias("e"),
                    F.when(same, F.lit("B")).otherwise(F.lit("L")).alias("side"), "m")
           .unionByName(p.where(~same)
                        .select(F.col("right_side").alias("name"),
                                F.when(F.col("m"), ev(0)).otherwise(ev(2)).alias("e"),
                                F.lit("R").alias("side"), "m")))
    # a below-threshold occurrence matters only as the name's first one
    first = occ.groupBy("name").agg(F.min(F.struct("e", "m")).alias("f"))
    orphans = (first.where(~F.col("f.m"))
               .select("name", F.col("f.e").alias("e"), F.lit("O").alias("side"),
                       F.lit(False).alias("m")))
    events_occ = occ.where("m").unionByName(orphans)
    events_occ = cut_lineage(previous_in_order(events_occ, "name", "e", "prev"))

    # parent of each event: latest earlier event of its left name, else right
    ev_parent = (events_occ.groupBy("e").agg(
        F.first(F.when(F.col("side").isin("L", "B"), F.col("prev")), ignorenulls=True).alias("pl"),
        F.first(F.when(F.col("side").isin("R", "B"), F.col("prev")), ignorenulls=True).alias("pr"),
        F.max(F.col("side") == "O").alias("is_orphan")))
    forest = ev_parent.select("e", F.when(F.col("is_orphan"), F.lit(None))
                              .otherwise(F.coalesce("pl", "pr")).alias("parent"))
    roots = _resolve_roots(forest)

    last = events_occ.groupBy("name").agg(F.max("e").alias("e"))
    assign = last.join(roots, "e").select("name", F.col("root").alias("_g"))
    out = _smallest_member(assign, "_g")
    if names is not None:
        rest = names.select("name").distinct().join(out, "name", "left_anti")
        out = out.unionByName(rest.select("name", F.col("name").alias("group_id")))
    return out


def previous_in_order(df: DataFrame, key: str, order: str, out: str,
                      partitions: int | None = None) -> DataFrame:
    """``out`` = the largest ``order`` value below this row's among rows with
    the same ``key`` (a lag per key) without putting a hot key in one task.

    Rows are range-partitioned on (key, order), so a key holding a large share
    of the rows spans several partitions in contiguous order ranges.  The lag
    is taken inside each (partition, key) group; the first row of a group
    then takes the largest value of the same key in the nearest earlier
    partition -- a window over at most one row per partition and key.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # written once: two reads of the range exchange would each sample their own
    # boundaries, and the partition numbers would not agree
    r = cut_lineage(df.repartitionByRange(n, key, order).withColumn("_pid", F.spark_partition_id()))
    local = r.withColumn(out, F.lag(order).over(Window.partitionBy("_pid", key).orderBy(order)))
    bounds = r.groupBy("_pid", key).agg(F.min(order).alias("_first"), F.max(order).alias("_last"))
    bounds = bounds.withColumn(
        "_carry", F.lag("_last").over(Window.partitionBy(key).orderBy("_pid")))
    carry = bounds.where(F.col("_carry").isNotNull()).select(
        "_pid", key, F.col("_first").alias(order), "_carry")
    out_df = local.join(carry, ["_pid", key, order], "left")
    return out_df.withColumn(out, F.coalesce(F.col(out), F.col("_carry"))).drop("_pid", "_carry")


def _resolve_roots(forest: DataFrame) -> DataFrame:
    """Pointer jumping: (e, parent) -> (e, root)."""
    cur = cut_lineage(forest.select("e", F.coalesce("parent", "e").alias("p")))
    while True:  # a pointer's length doubles each round
        nxt = cur.select(F.col("e").alias("_pe"), F.col("p").alias("_pp"))
        step = cur.join(nxt, cur.p == nxt._pe, "left").select(
            "e", "p", F.coalesce("_pp", "p").alias("np"))
        step = cut_lineage(step)
        moving = step.where(F.col("np") != F.col("p")).limit(1).count()
        cur = step.select("e", F.col("np").alias("p"))
        if moving == 0:
            break
    return cur.select("e", F.col("p").alias("root"))


# ---------------------------------------------------------------- G4

def pick_identifier(groups: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """One canonical name per group: most products, then shortest, then
    smallest.  ``counts``: ``name, n_products``.  An aggregate (min_by), so a
    giant group is combined map side, not sorted in one task."""
    g = groups
    if counts is not None:
        g = g.join(counts.select("name", "n_products"), "name", "left")
    else:
        g = g.withColumn("n_products", F.lit(0))
    key = F.struct((-F.coalesce("n_products", F.lit(0))).alias("a"),
                   F.length("name").alias("b"), F.col("name").alias("c"))
    canon = g.groupBy("group_id").agg(F.min_by("name", key).alias("canonical_name"))
    return groups.join(canon, "group_id").select("name", "group_id", "canonical_name")


# ---------------------------------------------------------------- G5

def threshold_communities(sym_pairs: DataFrame, names: DataFrame | None = None,
                          column: str = "similarity") -> DataFrame:
    """G5 with minimum community size 1: every name is a candidate centre
    whose community is its neighbourhood (pairs at or above the threshold,
    itself included); communities are taken largest first without overlap.
    So a name joins the neighbour (or itself) with the largest neighbourhood,
    ties to the smallest name.  ``sym_pairs`` must hold both directions of
    every thresholded pair.  Output ``name, group_id`` (the centre)."""
    sym_pairs = cut_lineage(sym_pairs.select("left_side", "right_side"))  # read three times
    e = sym_pairs.where(F.col("left_side") != F.col("right_side")).select(
        F.col("left_side").alias("a"), F.col("right_side").alias("b")).distinct()
    allnames = _names(sym_pairs, names)
    selfe = allnames.select(F.col("name").alias("a"), F.col("name").alias("b"))
    e = e.unionByName(selfe)
    deg = e.groupBy("a").agg(F.count("*").alias("deg"))
    # name b chooses among centres a with b in N(a)
    cand = e.join(deg, "a").select("b", F.struct((-F.col("deg")).alias("d"),
                                                  F.col("a").alias("c")).alias("k"))
    best = cand.groupBy("b").agg(F.min("k").alias("k"))
    return best.select(F.col("b").alias("name"), F.col("k.c").alias("group_id"))
