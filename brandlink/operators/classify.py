"""Supervised pair classifier (M1-M22) on Spark ML, plus exact metrics.

Metrics are SQL aggregates: scores are first collapsed to one row per
distinct value (partial aggregation absorbs a hot score), and running sums
over the ordered scores use a two-level prefix sum (quantile buckets, then
rows inside a bucket), so no window holds the whole table in one task.
"""

from __future__ import annotations

import itertools
import logging
import random
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

FEATURES = ["similarity_sg", "similarity_sgWords", "similarity_st",
            "similarity_nomenclature", "similarity_nomenclatureWords", "token_set_ratio"]
KEYS = ["left_side", "right_side"]


# ------------------------------------------------------------------ M1, M3

def stratified_split(df: DataFrame, label: str, keys: Sequence[str], test_size: float = 0.3,
                     seed: int = 42, bucket_chars: int = 3) -> DataFrame:
    """M1: exact per-class split; adds ``is_test`` (boolean).

    Rows of a class are ordered by ``md5(keys, seed)``; the first
    ``ceil(test_size * n_class)`` are the test set.  The rank is computed in
    two levels: counts per (class, md5 prefix) bucket -- at most 16^3 rows
    per class -- give each bucket's offset, then rows are ranked inside
    their bucket.  md5 spreads rows evenly over buckets, so no task holds a
    whole class.
    """
    d = _class_ranked(df, label, keys, seed, bucket_chars)
    return d.withColumn("is_test", F.col("_rank") <= F.ceil(F.col("_n") * F.lit(test_size))).drop("_rank", "_n")


def stratified_folds(df: DataFrame, label: str, keys: Sequence[str], folds: int = 5,
                     seed: int = 42, bucket_chars: int = 3) -> DataFrame:
    """Adds ``fold`` (0 ... ``folds`` - 1): rows of a class dealt round robin in
    the order of ``md5(keys, seed)``, so a class differs by at most one row
    between folds."""
    d = _class_ranked(df, label, keys, seed, bucket_chars)
    return d.withColumn("fold", ((F.col("_rank") - 1) % folds).cast("int")).drop("_rank", "_n")


def _class_ranked(df: DataFrame, label: str, keys: Sequence[str], seed: int, bucket_chars: int) -> DataFrame:
    """Adds ``_rank`` (from 1, in md5 order) and ``_n`` of each row's class."""
    h = F.md5(F.concat_ws("\u001f", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    d = df.withColumn("_h", h).withColumn("_b", F.substring("_h", 1, bucket_chars))
    cb = d.groupBy(label, "_b").agg(F.count("*").alias("_nb"))
    wc = Window.partitionBy(label)
    cb = (cb.withColumn("_n", F.sum("_nb").over(wc))
          .withColumn("_off", F.coalesce(F.sum("_nb").over(
              wc.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    rn = F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h"))
    out = d.join(cb.select(label, "_b", "_off", "_n"), [label, "_b"])
    return out.withColumn("_rank", F.col("_off") + rn).drop("_h", "_b", "_off")


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """M3: balanced weights ``n / (n_classes * n_class)`` as a column."""
    counts = df.groupBy(label).agg(F.count("*").alias("_nc"))
    n = df.agg(F.count("*").cast("double")).scalar()
    k = counts.agg(F.count("*").cast("double")).scalar()
    return df.join(counts, label).withColumn(out, n / (k * F.col("_nc"))).drop("_nc")


def positive_scale(df: DataFrame, label: str) -> DataFrame:
    """One row: ``scale = n_negative / n_positive`` (boosting positive scale)."""
    return df.agg((F.sum(1 - F.col(label)) / F.sum(F.col(label))).alias("scale"))


# --------------------------------------------------------------- metrics

def log_loss(df: DataFrame, label: str, score: str, eps: float = 2.220446049250313e-16
             ) -> DataFrame:
    """M7: mean binary cross-entropy with probabilities clipped to [eps, 1-eps]."""
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label).cast("double")
    return df.agg((-F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"))


def _score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    y = F.col(label).cast("long")
    return (df.groupBy(F.col(score).cast("double").alias("score"))
            .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")))


def prefix_sums(df: DataFrame, order_col: str, cols: Sequence[str], n_buckets: int = 256,
                descending: bool = False) -> DataFrame:
    """Add ``<c>_before``: sum of ``c`` over rows strictly before in
    ``order_col`` order (distinct values expected).  Two levels: quantile
    buckets (bounded list of split points), bucket offsets over at most
    ``n_buckets`` rows, then running sums inside each bucket."""
    from pyspark.ml.feature import Bucketizer

    sign = -1.0 if descending else 1.0
    d = df.withColumn("_o", F.col(order_col) * F.lit(sign))
    qs = d.approxQuantile("_o", [i / n_buckets for i in range(1, n_buckets)], 1e-3)
    splits = sorted(set(qs))
    splits = [float("-inf")] + splits + [float("inf")]
    d = Bucketizer(splits=splits, inputCol="_o", outputCol="_bk").transform(d)
    tot = d.groupBy("_bk").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    wb = Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select("_bk", *[F.coalesce(F.sum(f"_t_{c}").over(wb), F.lit(0)).alias(f"_off_{c}")
                              for c in cols])
    wi = (Window.partitionBy("_bk").orderBy("_o")
          .rowsBetween(Window.unboundedPreceding, -1))
    d = d.join(tot, "_bk")
    for c in cols:
        d = d.withColumn(f"{c}_before",
                         F.col(f"_off_{c}") + F.coalesce(F.sum(c).over(wi), F.lit(0)))
    return d.drop("_o", "_bk", *[f"_off_{c}" for c in cols])


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """M8: area under the ROC curve, ties counted half (rank formula); null
    where a class is missing."""
    sc = prefix_sums(_score_counts(df, label, score), "score", ["neg"])
    won = F.sum(F.col("pos") * (F.col("neg_before") + 0.5 * F.col("neg")))
    return sc.agg(F.try_divide(won, F.sum("pos") * F.sum("neg")).alias("auc"))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """M9: one point per distinct threshold (score >= threshold is
    positive), plus the origin; ``fpr, tpr, threshold``.  The rate of a class
    without rows is null."""
    sc = prefix_sums(_score_counts(df, label, score), "score", ["pos", "neg"], descending=True)
    totals = sc.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    P = totals.select(F.col("P").cast("double")).scalar()
    N = totals.select(F.col("N").cast("double")).scalar()
    pts = sc.select(F.try_divide(F.col("neg_before") + F.col("neg"), N).alias("fpr"),
                    F.try_divide(F.col("pos_before") + F.col("pos"), P).alias("tpr"),
                    F.col("score").alias("threshold"))
    origin = sc.limit(1).select(F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
                                F.lit(float("inf")).alias("threshold"))
    return pts.unionByName(origin)


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """2x2 confusion matrix as four rows ``target, predicted, n``
    (zero cells included), from one conditional aggregation."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    cells = [(a, b) for a in (0, 1) for b in (0, 1)]
    agg = df.agg(*[F.sum(((y == a) & (p == b)).cast("long")).alias(f"c{a}{b}")
                   for a, b in cells])
    stack = ", ".join(f"{a}, {b}, coalesce(c{a}{b}, 0L)" for a, b in cells)
    return agg.selectExpr(f"stack(4, {stack}) AS (target, predicted, n)")


# ---------------------------------------------------------------- models

def assemble(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def random_forest(features: Sequence[str], label: str = "target", weight: str | None = "weight",
                  num_trees: int = 100, max_depth: int = 20, seed: int = 42) -> Pipeline:
    """M4/M5: random forest with balanced class weights."""
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees,
                                maxDepth=max_depth, seed=seed, maxBins=64)
    if weight:
        rf.setWeightCol(weight)
    return Pipeline(stages=[assemble(features), rf])


def boosted_trees(features: Sequence[str], label: str = "target", weight: str | None = "weight",
                  step_size: float = 0.2, max_iter: int = 100, max_depth: int = 8,
                  subsampling_rate: float = 0.8, feature_subset: str = "0.8",
                  min_info_gain: float = 0.15, min_instances: int = 1, seed: int = 42,
                  validation_col: str | None = None) -> Pipeline:
    """Gradient-boosted trees.  Positive-class scale goes in the
    weight column; gamma maps to ``minInfoGain``, column sampling to the
    per-node ``featureSubsetStrategy``."""
    gbt = GBTClassifier(labelCol=label, featuresCol="features", stepSize=step_size,
                        maxIter=max_iter, maxDepth=max_depth, subsamplingRate=subsampling_rate,
                        featureSubsetStrategy=feature_subset, minInfoGain=min_info_gain,
                        minInstancesPerNode=min_instances, seed=seed, maxBins=64)
    if weight:
        gbt.setWeightCol(weight)
    if validation_col:
        gbt.setValidationIndicatorCol(validation_col)
    return Pipeline(stages=[assemble(features), gbt])


def scale_weights(df: DataFrame, label: str, scale: float, out: str = "weight") -> DataFrame:
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(scale))).otherwise(1.0))


def score(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Predicted class and both class probabilities, keys travel
    with the row."""
    p = model.transform(df)
    prob = vector_to_array(F.col("probability"))
    return p.select(*keep, F.col("prediction").cast("int").alias("target_predicted"),
                    prob[0].alias("proba_0"), prob[1].alias("proba_1"))


def feature_importances(model, features: Sequence[str]) -> DataFrame:
    """Importance per feature, best first (driver holds one number per
    feature)."""
    from pyspark.sql import SparkSession

    imp = model.stages[-1].featureImportances.toArray().tolist()
    s = SparkSession.getActiveSession()
    return s.createDataFrame(list(zip(features, imp)), "feature string, importance double") \
        .orderBy(F.col("importance").desc())


def grid_search(estimator: Pipeline, grid: dict, train: DataFrame, label: str = "target",
                folds: int = 5, parallelism: int = 4, seed: int = 42, sample: int | None = None):
    """Cross-validated search of forests by log loss (lower is better).
    ``sample`` draws that many settings from the grid (random search,
    seeded).  Returns the fitted ``CrossValidatorModel`` and a table of
    settings with mean and standard deviation of the fold scores."""
    clf = estimator.getStages()[-1]
    pgb = ParamGridBuilder()
    for name, values in grid.items():
        pgb = pgb.addGrid(clf.getParam(name), list(values))
    maps = pgb.build()
    if sample is not None and sample < len(maps):
        maps = random.Random(seed).sample(maps, sample)
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="logLoss")
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=ev,
                        numFolds=folds, parallelism=parallelism, seed=seed, collectSubModels=False)
    model = cv.fit(train)
    rows = []
    for pm, avg, std in zip(maps, model.avgMetrics, model.stdMetrics or [0.0] * len(maps)):
        rows.append(({p.name: float(v) for p, v in pm.items()}, float(avg), float(std)))
    return model, rows


def param_grid_table(spark, rows) -> DataFrame:
    data = [(str(sorted(d.items())), a, s) for d, a, s in rows]
    return spark.createDataFrame(data, "params string, mean_log_loss double, std_log_loss double")


def expand_grid(grid: dict) -> list[dict]:
    keys = list(grid)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[grid[k] for k in keys])]
