"""Registered queries: one per inventory ID, each ``(spark, sf_dir) -> DataFrame``.

Doubles are rounded to 6 digits and arrays joined to strings so the
DuckDB oracle in :mod:`.oracle_queries` can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FIXTURE_CONFIG as CFG
from ..functions import text as X
from ..operators import catalog, groups, links, pairs, vectors
from ..sources.tables import fixture_catalogue, page_titles, table
from . import jobs

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

R6 = 6


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _raw(spark, sf, variant="dirty"):
    return fixture_catalogue(spark, sf, variant)


def _gold(spark, sf, variant="dirty"):
    return jobs.gold_fixture(spark, sf, variant)


def _brands(spark, sf, variant="dirty"):
    """In place of the gold layer where only the brands' names are read."""
    return jobs.gold_brands_fixture(spark, sf, variant)


def _r(c: str, to: str | None = None):
    return F.round(F.col(c), R6).alias(to or c)


# ------------------------------------------------------------ catalogue layers

@query("C1_bronze")
def q_bronze(spark, sf):
    return catalog.bronze(_raw(spark, sf), CFG)


@query("C2_silver")
def q_silver(spark, sf):
    return catalog.silver(_raw(spark, sf), CFG)


@query("C3_gold")
def q_gold(spark, sf):
    return _gold(spark, sf)


@query("X1_slug_documents")
def q_slug_docs(spark, sf):
    d = table(spark, sf, "documents", spread=True)
    return d.select("doc_id", X.slug("text", CFG.slug_replacements).alias("slug"))


@query("X3_slug_compact_documents")
def q_slug_compact(spark, sf):
    d = table(spark, sf, "documents", spread=True)
    return d.select("doc_id", X.slug_compact("text").alias("slug"))


@query("X4_upper_strip")
def q_upper_strip(spark, sf):
    return _raw(spark, sf).select("retailer", "ean", "brand_name",
                                  X.upper_strip("brand_name").alias("brand_desc"))


@query("X5_zfill")
def q_zfill(spark, sf):
    r = _raw(spark, sf).where(F.col("ean").rlike(r"^[0-9]*\z"))
    return r.select("retailer", "ean", X.zfill("ean", 13).alias("product_id"))


@query("F10_F11_X6_id_audit")
def q_id_audit(spark, sf):
    r = _raw(spark, sf)
    return r.groupBy("retailer").agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col("ean").rlike("[A-Z]").cast("int")).cast("long").alias("n_upper"),
        F.sum((X.byte_length("ean") < 13).cast("int")).cast("long").alias("n_short"))


# --------------------------------------------------------------- profile (C4)

@query("A1_products_per_brand")
def q_products_per_brand(spark, sf):
    return catalog.brand_product_counts(_gold(spark, sf))


@query("A2_single_product_brands")
def q_single_product(spark, sf):
    return catalog.brand_product_counts(_gold(spark, sf)).where(F.col("n_products") == 1)


@query("A5_U3_brand_slugs")
def q_brand_slugs(spark, sf):
    return jobs.brand_names(_gold(spark, sf))


@query("A6_distinct_counts")
def q_distinct_counts(spark, sf):
    g = _gold(spark, sf)
    per = g.groupBy("retailer").agg(F.countDistinct("product_id").alias("n_products"),
                                    F.countDistinct("brand_desc_slug").alias("n_brands"))
    tot = g.agg(F.countDistinct("product_id").alias("n_products"),
                F.countDistinct("brand_desc_slug").alias("n_brands"))
    return per.unionByName(tot.select(F.lit("all").alias("retailer"), "*"))


@query("A11_layer_funnel")
def q_funnel(spark, sf):
    return catalog.layer_funnel(_raw(spark, sf), CFG)


@query("A12_F13_retailer_overlap")
def q_overlap(spark, sf):
    return catalog.retailer_overlap(_gold(spark, sf), CFG)


@query("J3_align")
def q_align(spark, sf):
    g = _gold(spark, sf)
    return catalog.align(catalog.by_retailer(g, CFG, ["brand_desc_slug"]))


@query("J4_same_products")
def q_same_products(spark, sf):
    g = _gold(spark, sf)
    a, b = catalog.by_retailer(g, CFG, ["brand_desc_slug"])[:2]
    return a.join(b, "product_id", "inner")


@query("U1_stack_diagonal")
def q_stack(spark, sf):
    g = _gold(spark, sf)
    north = g.where(F.col("retailer") == "north").select("retailer", "product_id",
                                                          "brand_desc_slug", "level0", "level1",
                                                          "level2")
    south = g.where(F.col("retailer") == "south").select("retailer", "product_id",
                                                          "brand_desc_slug", "level0", "level1")
    return catalog.stack([north, south])


# ------------------------------------------------------------ links and groups

@query("L1_same_item_links")
def q_links(spark, sf):
    return links.same_item_links(_gold(spark, sf))


@query("C10_same_item_links_simple")
def q_links_simple(spark, sf):
    return links.same_item_links(_gold(spark, sf, "simple"))


@query("G2_components")
def q_components(spark, sf):
    from ..session import cut_lineage

    g = cut_lineage(_gold(spark, sf, "simple"))
    lk = links.same_item_links(g)
    return groups.connected_components(lk, jobs.brand_names(g))


@query("G4_identifier")
def q_identifier(spark, sf):
    return jobs.same_item_groups(_gold(spark, sf, "simple"), "components")


@query("G1_ordered_groups")
def q_ordered(spark, sf):
    """Ordered greedy grouping of the n-gram pairs of the brands (threshold
    0.7, similarity descending to 9 digits, then the names)."""
    g = _gold(spark, sf)
    sg = jobs.similarity_table(g, "similarity_sg", 0.2, symmetric=False, include_self=False)
    sg = sg.select("left_side", "right_side", F.round("similarity_sg", pairs.CMP_DIGITS).alias("similarity"))
    return groups.ordered_groups(sg, 0.7, jobs.brand_names(g))


# -------------------------------------------------------------- similarities

@query("X12_char_ngrams")
def q_ngrams(spark, sf):
    n = jobs.brand_names(_gold(spark, sf))
    return n.select("name", F.array_join(X.char_ngrams(X.slug_compact("name")), " ")
                    .alias("grams"))


@query("X13_word_tokens")
def q_tokens(spark, sf):
    d = table(spark, sf, "documents", spread=True)
    return d.select("doc_id", F.array_join(X.word_tokens(X.slug("text")), " ").alias("tokens"))


@query("V3_V4_V5_tfidf_ngrams")
def q_tfidf(spark, sf):
    w = jobs.ngram_weights(_brands(spark, sf))
    return w.select("name", "term", _r("w"))


@query("V6_vocabulary")
def q_vocab(spark, sf):
    return vectors.vocabulary(jobs.ngram_weights(_brands(spark, sf)))


@query("C8_V10_ngram_cosine")
def q_ngram_cos(spark, sf):
    s = jobs.similarity_table(_brands(spark, sf), "similarity_sg", 0.2)
    return s.select("left_side", "right_side", _r("similarity_sg"))


@query("C9_word_cosine")
def q_word_cos(spark, sf):
    s = jobs.similarity_table(_brands(spark, sf), "similarity_sgWords", 0.2)
    return s.select("left_side", "right_side", _r("similarity_sgWords"))


@query("C5_V1_V2_category_cosine")
def q_cat_cos(spark, sf):
    s = jobs.similarity_table(_gold(spark, sf), "similarity_nomenclature", 0.2)
    return s.select("left_side", "right_side", _r("similarity_nomenclature"))


@query("C6_category_word_cosine")
def q_catword_cos(spark, sf):
    s = jobs.similarity_table(_gold(spark, sf), "similarity_nomenclatureWords", 0.2)
    return s.select("left_side", "right_side", _r("similarity_nomenclatureWords"))


@query("X11_C6_lemmatised_cosine")
def q_lemma_cos(spark, sf):
    """Cosine >= 0.2 of the category words after a dictionary (X11); its stand-in
    is made of the catalogue's own words: a word's lemma is the first word of
    the alphabet with the same initial."""
    from ..session import cut_lineage

    g = cut_lineage(_gold(spark, sf))
    level = F.lower(f"level{CFG.classification_most_relevant_level}")
    forms = g.select(F.explode(F.split(level, " ")).alias("form")).where("form <> ''").distinct()
    lemmas = forms.groupBy(F.left("form", F.lit(1)).alias("initial")).agg(F.min("form").alias("lemma"))
    lemmas = forms.join(lemmas, F.left("form", F.lit(1)) == F.col("initial")).select("form", "lemma")
    docs = vectors.category_words(g, CFG, lemmas=lemmas)
    s = pairs.cosine_pairs(vectors.word_tfidf(docs, "name", "level_slug"), 0.2, symmetric=True, include_self=True)
    return s.select("left_side", "right_side", _r("similarity"))


@query("C7_V9_embedding_cosine")
def q_emb_cos(spark, sf):
    s = jobs.similarity_table(_brands(spark, sf), "similarity_st", 0.5)
    return s.select("left_side", "right_side", _r("similarity_st"))


@query("V10_page_title_cosine")
def q_title_cos(spark, sf):
    t = page_titles(spark, sf).withColumn("_t", X.slug_compact("name"))
    w = vectors.char_ngram_tfidf(t, "name", "_t")
    s = pairs.cosine_pairs(w, 0.5)
    return s.select("left_side", "right_side", _r("similarity"))


@query("O3_top_k_partners")
def q_topk(spark, sf):
    s = jobs.similarity_table(_brands(spark, sf), "similarity_sg", 0.2, include_self=False)
    return pairs.top_k_per_name(s.select("left_side", "right_side", _r("similarity_sg")), 3,
                                "similarity_sg")


def _best(spark, sf, kind, k=10):
    s = pairs.top_k_pairs(jobs.SIMILARITY_KINDS[kind](_gold(spark, sf)), k)
    return s.select("left_side", "right_side", _r("similarity"))


@query("C5_O3_category_partners")
def q_cat_best(spark, sf):
    """The ten best partners of every brand by its categories."""
    return _best(spark, sf, "similarity_nomenclature")


@query("C6_O3_category_word_partners")
def q_catword_best(spark, sf):
    """The ten best partners of every brand by its category words."""
    return _best(spark, sf, "similarity_nomenclatureWords")


@query("C7_O3_embedding_partners")
def q_emb_best(spark, sf):
    """The ten best partners of every brand by its encoded name."""
    return _best(spark, sf, "similarity_st")


@query("C8_O3_ngram_partners")
def q_ngram_best(spark, sf):
    """The ten best partners of every brand by its n-grams."""
    return _best(spark, sf, "similarity_sg")


@query("C9_O3_word_partners")
def q_word_best(spark, sf):
    """The ten best partners of every brand by its words."""
    return _best(spark, sf, "similarity_sgWords")


@query("V14_top_distinct_pairs")
def q_top_pairs(spark, sf):
    s = jobs.similarity_table(_brands(spark, sf), "similarity_sg", 0.2, include_self=False)
    return pairs.top_distinct_pairs(s.select("left_side", "right_side", _r("similarity_sg")),
                                    10, column="similarity_sg")


# ----------------------------------------------------- pair features, evidence

def _features(spark, sf, with_ratio=False, gold=None):
    if gold is not None:
        return jobs.features_of_written(gold, 0.2, with_ratio)
    return jobs.pair_feature_table(_gold(spark, sf), 0.2, with_ratio)


SIM_COLS = ["similarity_sg", "similarity_sgWords", "similarity_st", "similarity_nomenclature",
            "similarity_nomenclatureWords"]


@query("L3_C11_J1_pair_features")
def q_features(spark, sf):
    f = _features(spark, sf)
    return f.select("left_side", "right_side", *[_r(c) for c in SIM_COLS])


@query("L2_token_set_ratio")
def q_ratio(spark, sf):
    """Token-set ratio of every candidate pair."""
    f = _features(spark, sf)
    return links.with_token_set_ratio(f.select("left_side", "right_side"))


@query("L3_C11_pair_features_with_ratio")
def q_features_ratio(spark, sf):
    """All six features of every candidate pair."""
    f = _features(spark, sf, with_ratio=True)
    return f.select("left_side", "right_side", *[_r(c) for c in SIM_COLS], "token_set_ratio")


@query("A9_feature_correlation")
def q_corr(spark, sf):
    return _correlations(_features(spark, sf), SIM_COLS)


@query("A9_correlation_of_six_features")
def q_corr_six(spark, sf):
    return _correlations(_features(spark, sf, with_ratio=True), [*SIM_COLS, "token_set_ratio"])


def _correlations(f, columns):
    """Pearson's correlation of each pair of columns, NaN where a column is
    constant (as values are compared: to ``CMP_DIGITS`` digits)."""
    pairs_ = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    f = f.select(*[F.round(c, pairs.CMP_DIGITS).alias(c) for c in columns])
    aggs = []
    for i, (a, b) in enumerate(pairs_):
        x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
        aggs += [F.covar_pop(a, b).alias(f"v{i}"), (F.stddev_pop(x) * F.stddev_pop(y)).alias(f"d{i}")]
    agg = f.agg(*aggs).select(*[
        F.when(F.col(f"d{i}") == 0, F.lit(float("nan"))).otherwise(F.try_divide(f"v{i}", f"d{i}")).alias(f"c{i}")
        for i in range(len(pairs_))])
    rows = ", ".join(f"'{a}', '{b}', c{i}" for i, (a, b) in enumerate(pairs_))
    out = agg.selectExpr(f"stack({len(pairs_)}, {rows}) AS (feature_1, feature_2, corr)")
    return out.select("feature_1", "feature_2", _r("corr"))


def _evidence(spark, sf, variant="dirty"):
    from ..session import cut_lineage

    g = cut_lineage(_gold(spark, sf, variant))
    sg = jobs.similarity_table(g, "similarity_sg", 0.2, include_self=False)
    sg = sg.withColumnRenamed("similarity_sg", "similarity")
    lk = links.constant_score(links.same_item_links(g), 1.0)
    return g, links.merge_evidence(sg, lk)


@query("L4_A7_merge_evidence")
def q_merge(spark, sf):
    _, ev = _evidence(spark, sf)
    return ev.select("left_side", "right_side", _r("similarity"))


@query("C14_G3_groups_from_evidence")
def q_groups_evidence(spark, sf):
    g, ev = _evidence(spark, sf)
    grp = groups.connected_components(ev, jobs.brand_names(g), 0.8)
    counts = catalog.brand_product_counts(g).withColumnRenamed("brand_desc_slug", "name")
    return groups.pick_identifier(grp, counts)


@query("G5_threshold_communities")
def q_communities(spark, sf):
    g = _gold(spark, sf)
    sg = jobs.similarity_table(g, "similarity_sg", 0.5, include_self=False)
    return groups.threshold_communities(sg.withColumnRenamed("similarity_sg", "similarity"),
                                        jobs.brand_names(g))


def _labels(spark, sf):
    """Labelled pairs: candidate brand pairs (n-gram similarity > 0.2, both
    directions) with the fixture's labelling rule (see ``pair_target``)."""
    g = _gold(spark, sf)
    sg = jobs.similarity_table(g, "similarity_sg", 0.2, include_self=False)
    sg = sg.where(F.col("similarity_sg") > 0.2)
    return sg.select("left_side", "right_side", pair_target().alias("target"))


def pair_target():
    """Fixture label: 1 when both names carry the same first number."""
    same = X.first_number("left_side") == X.first_number("right_side")
    return F.coalesce(same, F.lit(False)).cast("int")


@query("J2_labelled_pairs")
def q_labelled(spark, sf):
    f = _features(spark, sf)
    j = f.join(_labels(spark, sf), ["left_side", "right_side"], "inner")
    return j.select("left_side", "right_side", _r("similarity_sg"), "target")


# --------------------------------------------------------- metrics

def _scored(spark, sf):
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("target"))
    doc = table(spark, sf, "documents").select("doc_id", "n_chars")
    s = lab.join(doc, "doc_id").select(
        "doc_id", "target", (F.col("n_chars") / (F.col("n_chars") + 1500.0)).alias("score"))
    return s.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("A8_class_histogram")
def q_hist(spark, sf):
    return (table(spark, sf, "labels").groupBy(F.col("quality").alias("target"))
            .agg(F.count("*").alias("n")))


@query("M1_stratified_split")
def q_split(spark, sf):
    from ..operators.classify import stratified_split

    lab = table(spark, sf, "labels").select("doc_id", "quality")
    return stratified_split(lab, "quality", ["doc_id"], 0.3, 42)


@query("M3_class_weights")
def q_weights(spark, sf):
    from ..operators.classify import class_weights

    lab = table(spark, sf, "labels").select("doc_id", "quality")
    return class_weights(lab, "quality").select("doc_id", "quality", _r("weight"))


@query("M7_log_loss")
def q_logloss(spark, sf):
    from ..operators.classify import log_loss

    return log_loss(_scored(spark, sf), "target", "score").select(_r("log_loss"))


@query("M8_roc_auc")
def q_auc(spark, sf):
    from ..operators.classify import roc_auc

    return roc_auc(_scored(spark, sf), "target", "score").select(_r("auc"))


@query("M9_roc_curve")
def q_roc(spark, sf):
    from ..operators.classify import roc_curve

    r = roc_curve(_scored(spark, sf), "target", "score")
    return r.select(_r("fpr"), _r("tpr"), _r("threshold"))


@query("M10_confusion")
def q_confusion(spark, sf):
    from ..operators.classify import confusion

    return confusion(_scored(spark, sf), "target", "predicted")


# ------------------------------------------------------------ models

def _train_test(spark, sf, gold=None):
    """Labelled candidate pairs with all six features in an exact stratified
    70/30 split, balanced weights from the training part only; materialised
    once (reliable checkpoint).  ``gold``: the gold layer, where it is written."""
    from ..operators.classify import class_weights, stratified_split
    from ..session import cut_lineage

    # the label set covers every candidate pair, so the inner join with it
    # (J2) is the feature table with the rule's target
    f = _features(spark, sf, with_ratio=True, gold=gold)
    data = f.withColumn("target", pair_target()).fillna(0)
    data = cut_lineage(stratified_split(data, "target", PAIR, 0.3, 42))
    train = cut_lineage(class_weights(data.where(~F.col("is_test")), "target"))
    return train, data.where(F.col("is_test"))


PAIR = ["left_side", "right_side"]
RF_FEATURES = ["similarity_sg", "similarity_sgWords", "similarity_st",
               "similarity_nomenclatureWords", "token_set_ratio"]


@query("M4_M6_M21_random_forest")
def q_rf(spark, sf):
    from ..operators.classify import random_forest, score

    train, test = _train_test(spark, sf)
    model = random_forest(RF_FEATURES, num_trees=100, max_depth=20).fit(train)
    out = score(model, test, ["left_side", "right_side", "target"])
    return out.select("left_side", "right_side", "target", "target_predicted",
                      _r("proba_0"), _r("proba_1"))


@query("M5_M20_tuned_forest_importance")
def q_rf_tuned(spark, sf):
    from ..operators.classify import feature_importances, random_forest

    train, _ = _train_test(spark, sf)
    model = random_forest(RF_FEATURES, num_trees=300, max_depth=10).fit(train)
    return feature_importances(model, RF_FEATURES).select("feature", _r("importance"))


def _boosting(spark, sf, gold=None):
    """Training and test pairs, and the default setting with the training
    part's class scale."""
    from ..operators.boosting import Setting
    from ..operators.classify import positive_scale

    train, test = _train_test(spark, sf, gold)
    scale = positive_scale(train, "target").first()["scale"]
    return train, test, Setting(rounds=100, positive_scale=float(scale))


#: Fixed values of the staged tuning: what each step leaves behind.
STAGE_1 = dict(learning_rate=0.1, max_depth=9, subsample=0.8, colsample=0.8)
STAGE_2 = dict(STAGE_1, max_depth=8)
STAGE_3 = dict(STAGE_2, gamma=0.15)
FINAL = dict(STAGE_3, learning_rate=0.2)


@query("M12_M18_boosted_trees")
def q_gbt(spark, sf):
    """The final settings on the training pairs; every test pair with its
    features, prediction and probabilities (M21)."""
    from dataclasses import replace

    from ..operators import boosting
    from ..operators.classify import FEATURES

    train, test, base = _boosting(spark, sf)
    model, _ = boosting.fit(train, FEATURES, "target", replace(base, **FINAL), PAIR)
    out = model.score(test, [*PAIR, *FEATURES, "target"])
    return out.select(*PAIR, *[_r(c) for c in FEATURES], "target", "target_predicted", _r("proba_0"), _r("proba_1"))


def _quality(scored):
    """(log loss, AUC) of scored pairs; AUC null with one class only."""
    from ..operators.classify import log_loss, roc_auc
    from ..session import cut_lineage

    scored = cut_lineage(scored)
    return (log_loss(scored, "target", "proba_1").first()["log_loss"],
            roc_auc(scored, "target", "proba_1").first()["auc"])


def _rounded(x):
    return None if x is None else float(round(x, 6))


QUALITY = "train_log_loss double, train_auc double, test_log_loss double, test_auc double"


@query("M18_staged_refits")
def q_stages(spark, sf):
    """The models between the tuning steps, trained together: log loss and AUC on
    the training and the test pairs."""
    from dataclasses import replace

    from ..operators import boosting
    from ..operators.classify import FEATURES

    train, test, base = _boosting(spark, sf)
    stages = [("depth 9", STAGE_1), ("depth 8", STAGE_2), ("gamma 0.15", STAGE_3), ("rate 0.2", FINAL)]
    settings = [replace(base, **s) for _, s in stages]
    t = boosting.Training(train, FEATURES, "target", settings, PAIR)
    trees, rows = t.fit(), []
    for i, ((name, _), s) in enumerate(zip(stages, settings)):
        model = boosting.BoostedModel(trees, i, s, FEATURES, t.edges)
        marks = [_rounded(x) for d in (train, test) for x in _quality(model.score(d, ["target"]))]
        rows.append((i + 1, name, *marks))
    return spark.createDataFrame(rows, f"stage int, setting string, {QUALITY}")


@query("M13_early_stopping")
def q_early(spark, sf):
    """Boosting that ends by itself after 10 rounds without a better loss on a
    validation part of the training pairs, with the default and the final
    settings; rounds grown, best round (which the model is cut to), log loss
    and AUC."""
    from dataclasses import replace

    from ..operators import boosting
    from ..operators.classify import FEATURES, stratified_split
    from ..session import cut_lineage

    train, test, base = _boosting(spark, sf)
    train = cut_lineage(stratified_split(train.drop("is_test"), "target", PAIR, 0.2, 7))
    rows = []
    for name, s in (("default", {}), ("final", FINAL)):
        s = replace(base, patience=10, **s)
        model, _ = boosting.fit(train, FEATURES, "target", s, PAIR, valid="is_test")
        marks = [_rounded(x) for d in (train, test) for x in _quality(model.score(d, ["target"]))]
        rows.append((name, model.grown, model.best_round + 1, *marks))
    return spark.createDataFrame(rows, f"setting string, grown_rounds int, best_rounds int, {QUALITY}")


@query("M20_boosted_gain_cover")
def q_gain_cover(spark, sf):
    """Gain and cover of every feature over the splits of the final model."""
    from dataclasses import replace

    from ..operators import boosting
    from ..operators.classify import FEATURES

    train, _, base = _boosting(spark, sf)
    _, trees = boosting.fit(train, FEATURES, "target", replace(base, **FINAL), PAIR)
    out = boosting.importance(trees, FEATURES)
    return out.select("feature", "splits", *[_r(c) for c in ("gain", "cover", "total_gain", "total_cover")])


@query("M11_M19_grid_search")
def q_grid(spark, sf):
    """Forest grid of the original tuning: trees {300, 500} x depth
    {4, 6, 8, 10}, 5 folds, by log loss; mean and deviation per setting."""
    from ..operators.classify import grid_search, param_grid_table, random_forest

    train, _ = _train_test(spark, sf)
    est = random_forest(RF_FEATURES, num_trees=300, max_depth=10)
    _, rows = grid_search(est, {"numTrees": [300, 500], "maxDepth": [4, 6, 8, 10]}, train,
                          folds=5, parallelism=4)
    return param_grid_table(spark, rows)


# ------------------------------------------------------ dense

@query("V12_embedding_cosine")
def q_embed_cos(spark, sf):
    """Exact all-pairs cosine >= 0.3 of the ``embeddings`` table (blocked
    numpy products, threshold before emit)."""
    from ..operators.dense import dense_cosine_pairs

    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("name"), "embedding")
    s = dense_cosine_pairs(e, 0.3, method="blocks", block_size=256)
    return s.select("left_side", "right_side", _r("similarity"))


@query("V12_lsh_embedding_cosine")
def q_embed_lsh(spark, sf):
    """Approximate variant (random-hyperplane bands for a recall of 0.95) of the
    same pairs at a high threshold (0.35); recall is measured against the exact
    blocks in the tests."""
    from ..operators.dense import dense_cosine_pairs

    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("name"), "embedding")
    s = dense_cosine_pairs(e, 0.35, method="lsh", recall=0.95)
    return s.select("left_side", "right_side", _r("similarity"))


def _pca(spark, sf, share=0.9, k=None):
    from ..operators import pca

    return pca.reduce(jobs.ngram_weights(_brands(spark, sf)), share=share, k=k)


def _length(column="embedding"):
    return F.sqrt(F.aggregate(column, F.lit(0.0), lambda a, x: a + x * x))


@query("V7_pca_ngram")
def q_pca(spark, sf):
    """PCA of the brand n-gram TF-IDF keeping 90% of the variance (signs of
    components are arbitrary: compared by norms, no SQL form)."""
    p = _pca(spark, sf)
    return p.embedding.select("name", F.lit(p.k).alias("n_components"), F.round(_length(), R6).alias("norm"))


@query("V7_pca_all_lengths")
def q_pca_all(spark, sf):
    """With every component kept a name's length is that of its centred vector."""
    p = _pca(spark, sf, share=None)
    return p.embedding.select("name", F.round(_length(), R6).alias("norm"))


@query("V7_pca_encodings")
def q_pca_encodings(spark, sf):
    """The share of variance that each encoding's reduction keeps: categories,
    category words and n-grams 0.9, brand words 0.8."""
    from ..operators import pca
    from ..session import cut_lineage

    g = cut_lineage(_gold(spark, sf))
    rows = []
    for name, make, share in (("categories", jobs.category_weights, 0.9), ("category words", jobs.category_word_weights, 0.9),
                              ("n-grams", jobs.ngram_weights, 0.9), ("words", jobs.word_weights, 0.8)):
        p = pca.reduce(make(g), share=share)
        rows.append((name, share, p.k, float(round(p.total, 6)), float(round(sum(p.ratios), 6))))
    return spark.createDataFrame(rows, "encoding string, share double, n_components int, total_variance double, kept double")


@query("V8_pca_explained_variance")
def q_pca_var(spark, sf):
    """Explained variance of the components that keep 90%."""
    p, cum, rows = _pca(spark, sf), 0.0, []
    for i, r in enumerate(p.ratios):
        cum += r
        rows.append((i + 1, float(round(r, 6)), float(round(cum, 6))))
    return spark.createDataFrame(rows, "component int, ratio double, cumulative double")


@query("V8_pca_fixed_650")
def q_pca_fixed(spark, sf):
    """650 components (as many as there are where fewer exist) of the word TF-IDF
    of all documents, and the variance that they explain."""
    from ..operators import pca
    from ..session import cut_lineage

    d = table(spark, sf, "documents", spread=True)
    w = vectors.word_tfidf(d.select(F.col("doc_id").cast("string").alias("name"), X.slug("text").alias("_t")), "name", "_t")
    w = cut_lineage(w.select("name", "term", "w"))
    sizes = w.agg(F.countDistinct("name").alias("n"), F.countDistinct("term").alias("d")).first()
    p = pca.reduce(w, k=min(650, sizes["n"], sizes["d"]))
    kept = sum(p.ratios)
    return p.embedding.select("name", F.lit(p.k).alias("n_components"), F.round(F.lit(kept), R6).alias("explained"),
                              F.round(_length(), R6).alias("norm"))


@query("V11_pca_cosine")
def q_pca_cos(spark, sf):
    """Cosine >= 0.5 of the PCA-reduced n-gram vectors (reference mode:
    centred and truncated, so values differ from the sparse cosine)."""
    from ..operators.dense import dense_cosine_pairs

    s = dense_cosine_pairs(_pca(spark, sf).embedding, 0.5, method="blocks", block_size=512)
    return s.select("left_side", "right_side", _r("similarity"))


@query("V11_pca_cosine_all")
def q_pca_cos_all(spark, sf):
    """Cosine >= 0.3 with every component kept: that of the centred vectors."""
    from ..operators.dense import dense_cosine_pairs

    s = dense_cosine_pairs(_pca(spark, sf, share=None).embedding, 0.3, method="blocks", block_size=512)
    return s.select("left_side", "right_side", _r("similarity"))


# ---------------------------------------------------- J7, S2-S4, M14 search

@query("J7_similarity_outer_join")
def q_outer(spark, sf):
    """Full outer join of three similarity tables on the pair key."""
    from ..session import cut_lineage

    g = cut_lineage(_gold(spark, sf))
    sg = jobs.similarity_table(g, "similarity_sg", 0.2)
    st = jobs.similarity_table(g, "similarity_st", 0.5)
    nm = jobs.similarity_table(g, "similarity_nomenclature", 0.2)
    keys = ["left_side", "right_side"]
    j = sg.join(st, keys, "full_outer").join(nm, keys, "full_outer")
    return j.select(*keys, _r("similarity_sg"), _r("similarity_st"), _r("similarity_nomenclature"))


@query("S2_S3_S4_csv_round_trip")
def q_csv(spark, sf):
    """n-gram pairs written as ';'-separated CSV with header (S4) into the
    session's checkpoint folder, read back with an explicit schema (S2/S3)."""
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..sources.io import read_csv, similarity_schema, write_csv

    s = jobs.similarity_table(_brands(spark, sf), "similarity_sg", 0.2)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    write_csv(s, path)
    back = read_csv(spark, path, similarity_schema("similarity_sg"))
    return back.select("left_side", "right_side", _r("similarity_sg"))


def _search(spark, sf, fixed, grid, sample=None):
    """Cross-validated search (5 stratified folds, 100 rounds) around fixed
    settings; settings and folds are trained together."""
    from dataclasses import replace

    from ..operators import boosting
    from ..operators.classify import FEATURES

    train, _, base = _boosting(spark, sf)
    settings = boosting.settings_of(replace(base, **fixed), grid, sample)
    out = boosting.search(train, FEATURES, "target", settings, PAIR, list(grid), folds=5)
    return out.select(*[_r(c) for c in grid], _r("mean_log_loss"), _r("std_log_loss"), "rank")


@query("M14_random_search_depth_child")
def q_random_search(spark, sf):
    """10 settings drawn from depth 3..14 x smallest child weight 1..5."""
    return _search(spark, sf, dict(learning_rate=0.1, subsample=0.8, colsample=0.8),
                   {"max_depth": range(3, 15), "min_child_weight": range(1, 6)}, sample=10)


@query("M15_random_search_gamma")
def q_search_gamma(spark, sf):
    """Ten values of gamma, 0.05 to 0.5 (all drawn)."""
    return _search(spark, sf, STAGE_2, {"gamma": [0.05 * i for i in range(1, 11)]}, sample=10)


@query("M16_grid_search_sampling")
def q_search_sampling(spark, sf):
    """Row share x column share, 0.6 to 0.9 each: the whole grid of 16."""
    share = [i / 10 for i in range(6, 10)]
    return _search(spark, sf, STAGE_3, {"subsample": share, "colsample": share})


@query("M17_random_search_rate")
def q_search_rate(spark, sf):
    """10 of 30 learning rates, evenly from 0.001 to 1."""
    return _search(spark, sf, STAGE_3, {"learning_rate": [0.001 + i * 0.999 / 29 for i in range(30)]}, sample=10)


@query("M22_rebalanced_auc")
def q_rebalanced(spark, sf):
    """Five-fold AUC of boosted trees (50 rounds) fitted on folds whose smaller
    class was filled up, as it is and with cleaning after; the held-out fold
    stays untouched."""
    from ..operators import boosting
    from ..operators.classify import FEATURES, roc_auc, stratified_folds
    from ..operators.rebalance import rebalance
    from ..session import cut_lineage

    train, _ = _train_test(spark, sf)
    d = cut_lineage(stratified_folds(train.drop("weight"), "target", PAIR, 5))
    rows = []
    for method in ("smote", "smote_enn", "smote_tomek"):
        marks = []
        for f in range(5):
            made = cut_lineage(rebalance(d.where(F.col("fold") != f), FEATURES, "target", PAIR, method))
            model, _ = boosting.fit(made, FEATURES, "target", boosting.Setting(rounds=50), ["id"])
            marks.append(roc_auc(cut_lineage(model.score(d.where(F.col("fold") == f), ["target"])), "target", "proba_1").first()["auc"])
        known = [m for m in marks if m is not None]
        rows.append((method, len(known), _rounded(sum(known) / len(known)) if known else None))
    return spark.createDataFrame(rows, "method string, folds int, mean_auc double")


@query("O4_preview")
def q_preview(spark, sf):
    """First five gold rows by retailer and product id (a preview is a
    limit with an explicit order)."""
    return _gold(spark, sf).orderBy("retailer", "product_id").limit(5)


def _final_model(spark, sf, gold=None):
    from dataclasses import replace

    from ..operators import boosting
    from ..operators.classify import FEATURES

    train, test, base = _boosting(spark, sf, gold)
    model, _ = boosting.fit(train, FEATURES, "target", replace(base, **FINAL), PAIR)
    return model, train, test


@query("C13_C14_model_groups")
def q_model_groups(spark, sf):
    """The end of the original pipeline: boosted trees (final settings)
    trained on the labelled training split score every candidate pair;
    model probabilities and same-item links (1.0) are merged by maximum,
    grouped with the ordered pass at 0.8 (every brand appears), and each
    group gets its canonical name."""
    from ..operators.classify import FEATURES
    from ..session import cut_lineage

    g = cut_lineage(_gold(spark, sf))
    model, train, test = _final_model(spark, sf, g)
    # the two splits together are every candidate pair, features included
    feats = train.select(*PAIR, *FEATURES).unionByName(test.select(*PAIR, *FEATURES))
    scored = model.score(feats, PAIR).select(*PAIR, F.col("proba_1").alias("similarity"))
    lk = links.constant_score(links.same_item_links(g), 1.0)
    ev = cut_lineage(links.merge_evidence(scored, lk))
    grp = groups.ordered_groups(ev, 0.8, jobs.brand_names(g))
    counts = catalog.brand_product_counts(g).withColumnRenamed("brand_desc_slug", "name")
    return groups.pick_identifier(grp, counts)


@query("C13_test_groups")
def q_test_groups(spark, sf):
    """Groups from the test pairs' predictions alone: the ordered pass at 0.8 over
    the model's probabilities, most likely first."""
    from ..session import cut_lineage

    model, _, test = _final_model(spark, sf)
    scored = cut_lineage(model.score(test, PAIR).select(*PAIR, F.col("proba_1").alias("similarity")))
    return groups.ordered_groups(scored, 0.8)
