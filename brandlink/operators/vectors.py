"""Vectors in long form (V1-V9).

A vector is a set of rows ``(name, term, w)``: sparse, keyed by name, never a
positional matrix.  TF-IDF, one-hot and hashed encodings all produce this
shape, and the pair operators in :mod:`.pairs` consume it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.text import (char_ngrams, distinct_words, remove_stopwords, sentence_words,
                              slug, slug_compact, word_tokens)
from ..functions.stopwords import STOPWORDS


def explode_terms(df: DataFrame, name: str, terms) -> DataFrame:
    """One row per (name, term occurrence) from an array column (V3 input)."""
    return df.select(F.col(name).alias("name"), F.explode(terms).alias("term"))


def term_frequency(tokens: DataFrame) -> DataFrame:
    """V3: raw count per (name, term).  Partial aggregation map side."""
    return tokens.groupBy("name", "term").agg(F.count("*").cast("double").alias("tf"))


def document_frequency(weights: DataFrame) -> DataFrame:
    return weights.groupBy("term").agg(F.count("*").alias("df"))


def l2_normalize(weights: DataFrame, col: str = "w") -> DataFrame:
    """V5: divide by the L2 norm of the name's row.  The window holds one
    name's terms only (names are unique keys here)."""
    norm = F.sqrt(F.sum(F.col(col) * F.col(col)).over(Window.partitionBy("name")))
    return weights.withColumn(col, F.col(col) / norm)


def tfidf(tokens: DataFrame, names: DataFrame | None = None, normalize: bool = True
          ) -> DataFrame:
    """V3-V5: ``tf * (ln((1 + n) / (1 + df)) + 1)``, L2-normalised.

    ``n`` counts all documents in ``names`` (also those without terms); it is
    a scalar subquery, so the plan stays lazy.  ``tokens`` has one row per
    occurrence: ``name, term``.
    """
    docs = names.select("name") if names is not None else tokens.select("name")
    n_docs = docs.distinct().agg(F.count("*").cast("double")).scalar()
    tf = term_frequency(tokens)
    dfreq = document_frequency(tf)
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    # df travels with the weights: the similarity join orders terms by it
    w = tf.join(dfreq, "term").select("name", "term", (F.col("tf") * idf).alias("w"), "df")
    return l2_normalize(w) if normalize else w


def vocabulary(weights: DataFrame) -> DataFrame:
    """V6: distinct terms."""
    return weights.select("term").distinct()


def binary_weights(pairs: DataFrame) -> DataFrame:
    """Unit-length 0/1 vectors from distinct ``(name, term)`` rows."""
    d = pairs.select("name", "term").distinct()
    n = F.count("*").over(Window.partitionBy("name"))
    return d.select("name", "term", (F.lit(1.0) / F.sqrt(n)).alias("w"))


# ----------------------------------------------------------- name encodings

def char_ngram_tfidf(names: DataFrame, name_col: str = "name", text_col: str | None = None,
                     lo: int = 2, hi: int = 5) -> DataFrame:
    """C8 vectors: TF-IDF over character 2..5-grams of the compact slug."""
    text = F.col(text_col) if text_col else slug_compact(F.col(name_col))
    base = names.select(F.col(name_col).alias("name"), text.alias("_text"))
    tokens = explode_terms(base, "name", char_ngrams("_text", lo, hi))
    return tfidf(tokens, base)


def word_tfidf(names: DataFrame, name_col: str = "name", text_col: str | None = None,
               stopwords: Sequence[str] | None = STOPWORDS) -> DataFrame:
    """C9 vectors: TF-IDF over word tokens (two or more letters, stop words
    out).  Names without any token get no row (F12)."""
    text = F.col(text_col) if text_col else F.col(name_col)
    base = names.select(F.col(name_col).alias("name"), text.alias("_text"))
    tokens = explode_terms(base, "name", word_tokens("_text", stopwords))
    return tfidf(tokens, base)


def hashed_char_embedding(names: DataFrame, name_col: str = "name", dim: int = 64,
                          n: int = 3) -> DataFrame:
    """Default offline encoder for V9: character ``n``-grams of the compact
    slug hashed (md5) into ``dim`` buckets, counts L2-normalised.  Stands in
    for a sentence-embedding model; the output is a unit vector in long form
    ``(name, term=bucket, w)``."""
    base = names.select(F.col(name_col).alias("name"), slug_compact(F.col(name_col)).alias("_t"))
    grams = explode_terms(base, "name", char_ngrams("_t", n, n))
    bucket = F.pmod(F.conv(F.substring(F.md5(F.col("term")), 1, 8), 16, 10).cast("long"),
                    F.lit(dim))
    counts = (grams.select("name", bucket.cast("string").alias("term"))
              .groupBy("name", "term").agg(F.count("*").cast("double").alias("w")))
    return l2_normalize(counts)


def encode(names: DataFrame, encoder: Callable, name_col: str = "name",
           dim: int | None = None) -> DataFrame:
    """V9 with a user model: ``encoder(list[str]) -> 2-d array`` runs in
    ``mapInPandas`` (loaded once per Python worker, Arrow batches).  Returns
    ``name, embedding array<float>``."""
    import numpy as np
    import pandas as pd

    def run(batches):
        for pdf in batches:
            vecs = np.asarray(encoder(pdf[name_col].tolist()), dtype="float32")
            yield pd.DataFrame({"name": pdf[name_col], "embedding": list(vecs)})

    return names.select(name_col).mapInPandas(run, "name string, embedding array<float>")


def dense_to_long(df: DataFrame, name_col: str = "name", vec_col: str = "embedding",
                  normalize: bool = True) -> DataFrame:
    """Dense ``array<float>`` column to long form ``(name, term=index, w)``."""
    long = df.select(F.col(name_col).alias("name"),
                     F.posexplode(vec_col).alias("pos", "w")).where(F.col("w") != 0)
    long = long.select("name", F.col("pos").cast("string").alias("term"),
                       F.col("w").cast("double").alias("w"))
    return l2_normalize(long) if normalize else long


# -------------------------------------------------- category features

def _level_rows(gold_df: DataFrame, cfg: Config, levels: Sequence[int]) -> DataFrame:
    """(product_id, feature column name, value) for the kept retailers."""
    idx = F.create_map(*[x for i, n in enumerate(cfg.retailer_names)
                         for x in (F.lit(n), F.lit(i))])
    kept = [n for i, n in enumerate(cfg.retailer_names) if i not in cfg.exclude_retailers]
    g = gold_df.where(F.col("retailer").isin(kept)).withColumn("_ri", idx[F.col("retailer")])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(l).alias("level"), F.col(f"level{l}").alias("value")) for l in levels]))
    return (g.select("product_id", "_ri", stacked.alias("_s"))
            .select("product_id", F.col("_ri").alias("retailer_index"),
                    F.col("_s.level").alias("level"), F.col("_s.value").alias("value"))
            .where(F.col("value").isNotNull()))


def brand_products(gold_df: DataFrame) -> DataFrame:
    return gold_df.select("product_id", F.col("brand_desc_slug").alias("name")).distinct()


def category_onehot(gold_df: DataFrame, cfg: Config) -> DataFrame:
    """V1/V2 (A3 as distinct): binary brand x category features, long form
    ``(name, term)``.  A brand takes every kept retailer's category values of
    every product it is sold as, in any retailer (the n-way ``align`` of the
    notebooks as one join on product_id).  Feature = ``level{l}_{i}_{value}``.
    Brands without any feature get no row (Q2)."""
    feats = (_level_rows(gold_df, cfg, cfg.classification_levels)
             .select("product_id", F.concat_ws("_", F.concat(F.lit("level"), F.col("level")),
                                               F.col("retailer_index"), F.col("value"))
                     .alias("term")).distinct())
    return brand_products(gold_df).join(feats, "product_id").select("name", "term").distinct()


def category_words(gold_df: DataFrame, cfg: Config, stopwords: Sequence[str] | None = STOPWORDS,
                   lemmas: DataFrame | None = None) -> DataFrame:
    """C6 documents: per brand, the distinct most-relevant-level values of
    its products (kept retailers), split to words (X8), distinct (X9), stop
    words out (X10), lemmatised (X11), joined and slugged.  Returns
    ``name, level_slug``."""
    lv = cfg.classification_most_relevant_level
    vals = (_level_rows(gold_df, cfg, [lv]).select("product_id", "value").distinct())
    per_brand = (brand_products(gold_df).join(vals, "product_id")
                 .select("name", "value").distinct()
                 .groupBy("name").agg(F.collect_list("value").alias("level")))
    words = distinct_words(sentence_words("level"))
    if stopwords:
        words = remove_stopwords(words, stopwords)
    docs = per_brand.select("name", words.alias("words"))
    if lemmas is not None:
        docs = lemmatise(docs, lemmas)
    return docs.select("name", slug(F.array_join("words", " ")).alias("level_slug"))


def lemmatise(docs: DataFrame, lemmas: DataFrame) -> DataFrame:
    """X11: replace each word by its dictionary lemma (``form, lemma``),
    keeping unknown words; duplicates may reappear and count twice."""
    ex = docs.select("name", F.posexplode("words").alias("pos", "form"))
    j = ex.join(lemmas.select("form", "lemma"), "form", "left")
    return (j.groupBy("name")
            .agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("lemma", "form")
                                                       .alias("word")))).alias("_w"))
            .select("name", F.col("_w.word").alias("words")))
