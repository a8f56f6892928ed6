"""Catalogue layers and whole-catalogue operators.

One DataFrame carries every retailer (``retailer`` column), so the three
per-retailer copies of each step in the notebooks become one plan: one scan,
and per-retailer rules expressed as ``CASE`` on the retailer column.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.text import slug, upper_strip, zfill
from ..session import cut_lineage


def _per_retailer(cfg: Config, value) -> Column:
    """CASE retailer WHEN name THEN value(retailer_config) ... END."""
    expr = None
    for r in cfg.retailers:
        cond = F.col("retailer") == r.name
        expr = F.when(cond, value(r)) if expr is None else expr.when(cond, value(r))
    return expr


def level_columns(df: DataFrame) -> list[str]:
    """Names of the category level columns in order."""
    return sorted((c for c in df.columns if c.startswith("level") and c[5:].isdigit()),
                  key=lambda c: int(c[5:]))


def bronze(raw: DataFrame, cfg: Config) -> DataFrame:
    """Rename, one column per category level (null when the path is
    shorter or the retailer has fewer levels), crumb dropped."""
    cols = [F.col("retailer"), F.col("ean").alias("product_id"),
            F.col("brand_name").alias("brand_desc")]
    for i in range(cfg.max_levels):
        lvl = F.get(F.col("crumb"), i)
        keep = _per_retailer(cfg, lambda r, i=i: F.lit(i < r.nb_levels))
        cols.append(F.when(keep, lvl).alias(f"level{i}"))
    return raw.select(*cols)


def _digits(c: str) -> Column:
    """Ids that the silver layer keeps: not null, digits only."""
    return F.col(c).isNotNull() & F.col(c).rlike(r"^\p{Nd}*\z")


def silver(raw: DataFrame, cfg: Config) -> DataFrame:
    """Digit-only non-null ids, non-null brands; brand upper-cased and
    stripped, slugged; levels slugged; ids zero-padded to 13; the all-zero id
    removed.  The id tests run in the scan stage; ``IsNotNull`` is pushed to
    the parquet reader."""
    b = bronze(raw, cfg)
    levels = level_columns(b)
    b = b.where(_digits("product_id") & F.col("brand_desc").isNotNull())
    brand = upper_strip("brand_desc")
    out = b.select(
        "retailer",
        zfill("product_id", 13).alias("product_id"),
        brand.alias("brand_desc"),
        slug(brand, cfg.slug_replacements).alias("brand_desc_slug"),
        *[slug(F.col(c)).alias(c) for c in levels],
    )
    return out.where(F.col("product_id") != "0000000000000")


def gold(raw: DataFrame, cfg: Config, keep_null_level1: bool = False) -> DataFrame:
    """Allow list on level0, deny list on level1 (SQL three-valued logic
    drops a null level1 unless ``keep_null_level1``), placeholder brands out."""
    s = silver(raw, cfg)
    allowed = _per_retailer(cfg, lambda r: F.col("level0").isin(list(r.level0)))
    denied = _per_retailer(cfg, lambda r: F.col("level1").isin(list(r.level1_to_delete))
                           if r.level1_to_delete else F.lit(False))
    not_denied = ~denied
    if keep_null_level1:
        not_denied = not_denied | F.col("level1").isNull()
    out = s.where(allowed & not_denied)
    if cfg.unknown_brands:
        out = out.where(~F.col("brand_desc_slug").isin(list(cfg.unknown_brands)))
    return out


def gold_brands(raw: DataFrame, cfg: Config) -> DataFrame:
    """``brand_desc_slug`` of the gold layer, distinct.  Rows that differ in their
    ids or in what no filter reads are cleaned once for all."""
    kept = raw.where(_digits("ean") & (zfill("ean", 13) != "0000000000000") & F.col("brand_name").isNotNull())
    rows = kept.select("retailer", F.lit("1").alias("ean"), "brand_name", F.slice("crumb", 1, 2).alias("crumb")).distinct()
    # written, or the filters on slugs would be pushed below the distinct
    return gold(cut_lineage(rows), cfg).select("brand_desc_slug").distinct()


# ---------------------------------------------------------------- set operators

def stack(frames: Sequence[DataFrame], allow_missing: bool = True,
          distinct: bool = False) -> DataFrame:
    """Stack by column name (missing columns null when
    ``allow_missing``), optionally distinct."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
    return out.distinct() if distinct else out


def symmetric_closure(pairs: DataFrame, left: str = "left_side",
                      right: str = "right_side") -> DataFrame:
    """Pairs plus their swapped copies, distinct."""
    swapped = pairs.select(F.col(right).alias(left), F.col(left).alias(right),
                           *[c for c in pairs.columns if c not in (left, right)])
    return pairs.unionByName(swapped).distinct()


def align(frames: Sequence[DataFrame], key: str = "product_id") -> DataFrame:
    """N-way full outer join on the shared key, key coalesced (USING
    join).  Duplicate keys multiply, as in the original ``align``."""
    return reduce(lambda a, b: a.join(b, [key], "full_outer"), frames)


def by_retailer(df: DataFrame, cfg: Config, cols: Sequence[str], key: str = "product_id"
                ) -> list[DataFrame]:
    """Per-retailer projections with the retailer index as column suffix,
    ready for ``align``."""
    out = []
    for i, name in enumerate(cfg.retailer_names):
        out.append(df.where(F.col("retailer") == name)
                   .select(key, *[F.col(c).alias(f"{c}_{i}") for c in cols]))
    return out


# ------------------------------------------------------------- profile (C4)

def brand_product_counts(gold_df: DataFrame) -> DataFrame:
    """A1: distinct products per brand slug (rows of distinct (product, brand))."""
    return (gold_df.select("product_id", "brand_desc_slug").distinct()
            .groupBy("brand_desc_slug").agg(F.count("*").alias("n_products")))


def layer_funnel(raw: DataFrame, cfg: Config) -> DataFrame:
    """Rows and width of bronze, silver and gold per retailer, one job."""
    parts = []
    for name, df in (("bronze", bronze(raw, cfg)), ("silver", silver(raw, cfg)),
                     ("gold", gold(raw, cfg))):
        parts.append(df.groupBy("retailer").agg(F.count("*").alias("n_rows"))
                     .select(F.lit(name).alias("layer"), "retailer", "n_rows",
                             F.lit(len(df.columns) - 1).alias("n_columns")))
    return stack(parts)


def retailer_overlap(gold_df: DataFrame, cfg: Config) -> DataFrame:
    """Products shared by each pair of retailers and by all of them.
    One ``groupBy(product_id)`` with presence flags (partial aggregation),
    then conditional counts; no n-way join."""
    names = cfg.retailer_names
    flags = gold_df.groupBy("product_id").agg(*[
        F.max(F.when(F.col("retailer") == n, 1).otherwise(0)).alias(f"in_{i}")
        for i, n in enumerate(names)])
    aggs = []
    for i in range(len(names)):
        for j in range(i + 1, len(names)):
            aggs.append(F.sum(F.col(f"in_{i}") * F.col(f"in_{j}")).cast("long")
                        .alias(f"{names[i]}_{names[j]}"))
    all_in = reduce(lambda a, b: a * b, [F.col(f"in_{i}") for i in range(len(names))])
    aggs.append(F.sum(all_in).cast("long").alias("all_retailers"))
    return flags.agg(*aggs)
