"""Composite jobs (C4-C14) over the fixture catalogue and driver tables.

Every job reads the given tables (or what Spark derives from them) in full;
thresholds are semantic parameters of the similarity operators, never row
caps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FIXTURE_CONFIG, Config
from ..functions.text import slug_compact
from ..operators import catalog, groups, links, pairs, vectors
from ..session import cut_lineage
from ..sources.tables import fixture_catalogue


def gold_fixture(spark: SparkSession, sf_dir: str, variant: str = "dirty",
                 cfg: Config = FIXTURE_CONFIG) -> DataFrame:
    return catalog.gold(fixture_catalogue(spark, sf_dir, variant), cfg)


def gold_brands_fixture(spark: SparkSession, sf_dir: str, variant: str = "dirty",
                        cfg: Config = FIXTURE_CONFIG) -> DataFrame:
    """The gold layer's distinct brands, all that the encodings of names read."""
    return catalog.gold_brands(fixture_catalogue(spark, sf_dir, variant), cfg)


def brand_names(gold_df: DataFrame) -> DataFrame:
    """All brand slugs of all retailers, distinct, as ``name``."""
    return gold_df.select(F.col("brand_desc_slug").alias("name")).distinct()


def _written_names(gold_df: DataFrame) -> DataFrame:
    """``brand_names``, written: TF-IDF reads them for the counts and for their
    number, and a gold layer that is not written would be cleaned each time."""
    return cut_lineage(brand_names(gold_df))


def ngram_weights(gold_df: DataFrame) -> DataFrame:
    """C8 vectors: char 2..5-gram TF-IDF of the compact slug of every brand."""
    names = _written_names(gold_df).withColumn("_t", slug_compact("name"))
    return vectors.char_ngram_tfidf(names, "name", "_t")


def word_weights(gold_df: DataFrame) -> DataFrame:
    """C9 vectors: word TF-IDF of every brand slug."""
    return vectors.word_tfidf(_written_names(gold_df), "name")


def category_weights(gold_df: DataFrame, cfg: Config = FIXTURE_CONFIG) -> DataFrame:
    """C5 vectors: unit-length one-hot category features."""
    return vectors.binary_weights(vectors.category_onehot(gold_df, cfg))


def category_word_weights(gold_df: DataFrame, cfg: Config = FIXTURE_CONFIG) -> DataFrame:
    """C6 vectors: word TF-IDF of the per-brand category-word documents."""
    docs = vectors.category_words(gold_df, cfg)
    return vectors.word_tfidf(docs, "name", "level_slug")


def embedding_weights(gold_df: DataFrame, dim: int = 64) -> DataFrame:
    """C7 vectors: offline encoder (hashed char 3-grams) of every brand."""
    return vectors.hashed_char_embedding(brand_names(gold_df), "name", dim=dim)


SIMILARITY_KINDS = {
    "similarity_sg": ngram_weights,
    "similarity_sgWords": word_weights,
    "similarity_st": embedding_weights,
    "similarity_nomenclature": category_weights,
    "similarity_nomenclatureWords": category_word_weights,
}


def similarity_table(gold_df: DataFrame, kind: str, min_similarity: float,
                     symmetric: bool = True, include_self: bool = True) -> DataFrame:
    """One of the five brand-to-brand similarity tables (C5-C9), pairs at or
    above ``min_similarity``, both directions and the diagonal by default."""
    w = SIMILARITY_KINDS[kind](gold_df)
    return pairs.cosine_pairs(w, min_similarity, symmetric=symmetric,
                              include_self=include_self, column=kind)


def pair_feature_table(gold_df: DataFrame, min_similarity: float = 0.2,
                       with_ratio: bool = True) -> DataFrame:
    """C11: candidate pairs (n-gram similarity > 0.2, both directions) with
    the four other similarities of exactly those pairs and the token-set
    ratio."""
    return features_of_written(cut_lineage(gold_df), min_similarity, with_ratio)  # read by all five encodings


def features_of_written(gold_df: DataFrame, min_similarity: float = 0.2, with_ratio: bool = True) -> DataFrame:
    """``pair_feature_table`` of a gold layer that is written already."""
    sg = similarity_table(gold_df, "similarity_sg", min_similarity, True, False)
    others = {k: f(gold_df) for k, f in SIMILARITY_KINDS.items() if k != "similarity_sg"}
    return links.pair_features(sg, others, "similarity_sg", min_similarity, with_ratio)


def same_item_groups(gold_df: DataFrame, method: str = "components",
                     min_similarity: float = 0.8) -> DataFrame:
    """C10 + G2/G1 + G3 + G4: which spellings are one brand, and its name."""
    gold_df = cut_lineage(gold_df)  # read by links, names and counts
    lk = links.constant_score(links.same_item_links(gold_df), 1.0)
    names = brand_names(gold_df)
    if method == "components":
        g = groups.connected_components(lk, names, min_similarity)
    else:
        g = groups.ordered_groups(lk, min_similarity, names)
    counts = catalog.brand_product_counts(gold_df).withColumnRenamed("brand_desc_slug", "name")
    return groups.pick_identifier(g, counts)
