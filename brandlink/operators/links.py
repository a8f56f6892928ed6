"""Pair evidence: same-item links, token-set ratio, pair features, merge (L1-L4)."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from ..session import cut_lineage
from .catalog import symmetric_closure
from .pairs import pair_dots, vector_rows

KEYS = ["left_side", "right_side"]


def same_item_links(gold_df: DataFrame, min_items: int = 2, count_rows: bool = False
                    ) -> DataFrame:
    """L1: brand slugs of two different retailers that differ in spelling and
    share ``min_items`` or more products; symmetric, no diagonal.

    One self-join on product_id over all retailer pairs (``a.retailer <
    b.retailer``) replaces one join per retailer pair.  By default each
    ``(retailer, product, brand)`` counts once, so duplicate catalogue rows do
    not multiply the join (``count_rows=True`` counts joined rows instead).
    """
    base = gold_df.select("retailer", "product_id", F.col("brand_desc_slug").alias("brand"))
    if not count_rows:
        base = base.distinct()
    a = base.select(F.col("retailer").alias("ra"), "product_id", F.col("brand").alias("ba"))
    b = base.select(F.col("retailer").alias("rb"), "product_id", F.col("brand").alias("bb"))
    j = a.join(b, "product_id").where((F.col("ra") < F.col("rb")) & (F.col("ba") != F.col("bb")))
    pairs = (j.groupBy("ra", "rb", "ba", "bb").agg(F.count("*").alias("n"))
             .where(F.col("n") >= min_items)
             .select(F.col("ba").alias("left_side"), F.col("bb").alias("right_side")))
    # read twice by the closure (both directions): write once
    return symmetric_closure(cut_lineage(pairs))


# ------------------------------------------------------------ token-set ratio

def _process(c: Column) -> Column:
    """Lower-case ASCII letters, digits and underscore; everything else is a
    blank; trimmed (non-ASCII characters are dropped first)."""
    ascii_only = F.regexp_replace(c, r"[^\x00-\x7F]", "")
    return F.trim(F.lower(F.regexp_replace(ascii_only, r"[^A-Za-z0-9_]", " ")))


def _tokens(p: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.split(p, " +"), lambda x: x != "")))


def common_lengths(left: list[str], right: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair of strings.

    All pairs advance together, a character of the right side at a time: a row
    of the table is the running maximum of the row before and its matches.
    Pairs are taken by length, so that short ones are not padded to long ones.
    """
    out = np.zeros(len(left), np.int64)
    order = sorted(range(len(left)), key=lambda i: (len(left[i]), len(right[i])))
    at = 0
    while at < len(order):
        part = [order[at]]
        while at + len(part) < len(order) and len(part) * (len(left[order[at + len(part)]]) + 1) < _CELLS:
            part.append(order[at + len(part)])
        at += len(part)
        a, b = _code_points([left[i] for i in part], 0), _code_points([right[i] for i in part], 1)
        row = np.zeros((len(part), a.shape[1] + 1), np.int32)
        for j in range(b.shape[1]):
            grown = np.maximum(row[:, 1:], row[:, :-1] + (a == b[:, j:j + 1]))
            row[:, 1:] = np.maximum.accumulate(grown, axis=1)
        out[part] = row[:, -1]
    return out


_CELLS = 1 << 20  # cells of a row of the table at most


def _code_points(strings: list[str], pad: int) -> np.ndarray:
    """Strings as rows of code points; the pad equals no character (surrogates
    never stand in a text) and differs between the sides."""
    out = np.full((len(strings), max(map(len, strings), default=0)), 0xD800 + pad, np.uint32)
    for i, s in enumerate(strings):
        out[i, :len(s)] = np.frombuffer(s.encode("utf-32-le"), np.uint32)
    return out


def char_ratios(left: list[str], right: list[str]) -> np.ndarray:
    """Insertion-deletion ratio 0 .. 100 of each pair: the share of both strings'
    characters in their longest common subsequence, rounded half to even; an
    empty string gives 0, two equal ones 100."""
    total = np.array([len(a) + len(b) for a, b in zip(left, right)], np.int64)
    empty = np.array([not a or not b for a, b in zip(left, right)], bool)
    both = common_lengths(left, right)
    ratio = np.rint(100 * (2 * both / np.maximum(total, 1))).astype(np.int64)
    same = np.array([a == b for a, b in zip(left, right)], bool)
    return np.where(same, 100, np.where(empty, 0, ratio))


@pandas_udf(T.IntegerType())
def _ratio3(need: pd.Series, sect: pd.Series, c12: pd.Series, c21: pd.Series) -> pd.Series:
    """Max of the three character ratios.  Rows with ``need`` false are already
    decided and skipped."""
    out = np.zeros(len(need), np.int64)
    at = np.flatnonzero(need.to_numpy(bool))
    s, x, y = (c.iloc[at].tolist() for c in (sect, c12, c21))
    out[at] = np.maximum.reduce([char_ratios(s, x), char_ratios(s, y), char_ratios(x, y)])
    return pd.Series(out, dtype="int32")


def token_set_ratio(left: Column, right: Column) -> Column:
    """L2: token-set ratio 0..100 of two strings (null input -> 0).

    The token sets, their intersection and differences are native array
    expressions; Python runs only for pairs whose answer is not decided by
    the sets alone (one set inside the other -> 100, an empty side -> 0).
    """
    p1, p2 = _process(left), _process(right)
    t1, t2 = _tokens(p1), _tokens(p2)
    sect = F.array_intersect(t1, t2)
    d12, d21 = F.array_except(t1, t2), F.array_except(t2, t1)
    s = F.array_join(sect, " ")
    c12 = F.trim(F.concat_ws(" ", s, F.array_join(d12, " ")))
    c21 = F.trim(F.concat_ws(" ", s, F.array_join(d21, " ")))
    empty = left.isNull() | right.isNull() | (F.length(p1) == 0) | (F.length(p2) == 0)
    inside = (F.size(sect) > 0) & ((F.size(d12) == 0) | (F.size(d21) == 0))
    need = F.coalesce(~(empty | inside), F.lit(False))
    return (F.when(empty, F.lit(0)).when(inside, F.lit(100))
            .otherwise(_ratio3(need, F.coalesce(s, F.lit("")), F.coalesce(c12, F.lit("")),
                               F.coalesce(c21, F.lit("")))))


def with_token_set_ratio(pairs: DataFrame, column: str = "token_set_ratio") -> DataFrame:
    return pairs.withColumn(column, token_set_ratio(F.col("left_side"), F.col("right_side")))


# -------------------------------------------------------------- pair features

def pair_cosines(pairs: DataFrame, weights: Mapping[str, DataFrame]) -> DataFrame:
    """Exact cosine of every given pair under several encodings at once.

    A name's entries of all encodings are one vector row, so a pair meets two
    rows whatever the number of encodings and terms; missing = 0.0.
    """
    kinds, allw = list(weights), None
    for i, k in enumerate(kinds):
        part = weights[k].select(F.lit(i).alias("kind"), "name", "term", "w")
        allw = part if allw is None else allw.unionByName(part)
    rows = cut_lineage(vector_rows(allw))  # read for the left and the right sides
    dots = pair_dots(pairs.select(*KEYS).distinct(), rows, kinds)
    return pairs.join(dots, KEYS, "left").fillna(0.0, subset=kinds)


def pair_features(base: DataFrame, others: Mapping[str, DataFrame],
                  base_column: str = "similarity_sg", min_similarity: float = 0.2,
                  with_ratio: bool = True) -> DataFrame:
    """L3: candidate pairs (base similarity > ``min_similarity``, self pairs
    out), the other similarities of exactly those pairs (J1, 0 when absent,
    X7), and the token-set ratio (L2)."""
    cand = cut_lineage(base.where(F.col(base_column) > min_similarity)
                       .where(F.col("left_side") != F.col("right_side"))
                       .select(*KEYS, base_column))
    out = pair_cosines(cand, others) if others else cand
    if with_ratio:
        out = with_token_set_ratio(out)
    return out


def merge_evidence(*tables: DataFrame, column: str = "similarity") -> DataFrame:
    """L4: union of scored pair tables (U2), max score per pair."""
    u = None
    for t in tables:
        t = t.select(*KEYS, F.col(column).cast("double").alias(column))
        u = t if u is None else u.unionByName(t)
    return u.groupBy(*KEYS).agg(F.max(column).alias(column))


def constant_score(pairs: DataFrame, value: float, column: str = "similarity") -> DataFrame:
    """P5: a pair table with a fixed score (same-item link = 1.0, ...)."""
    return pairs.select(*KEYS, F.lit(float(value)).alias(column))
