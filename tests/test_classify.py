import math

from pyspark.sql import functions as F

from brandlink.operators import classify as C


def test_split_exact_per_class(spark):
    rows = [(i, 1 if i % 7 == 0 else 0) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, y int")
    out = C.stratified_split(df, "y", ["id"], 0.3, 42, bucket_chars=1)
    counts = {(r.y, r.is_test): r["count"] for r in out.groupBy("y", "is_test").count().collect()}
    n1 = sum(1 for _, y in rows if y == 1)
    n0 = len(rows) - n1
    assert counts[(1, True)] == math.ceil(0.3 * n1)
    assert counts[(0, True)] == math.ceil(0.3 * n0)


def auc_model(ys, ss):
    pos = [s for y, s in zip(ys, ss) if y == 1]
    neg = [s for y, s in zip(ys, ss) if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_logloss_confusion(spark):
    ys = [1, 0, 1, 0, 1, 1, 0, 0, 1, 0]
    ss = [0.9, 0.1, 0.8, 0.8, 0.3, 0.7, 0.2, 0.6, 0.6, 0.05]
    df = spark.createDataFrame(list(zip(ys, ss, [int(s >= 0.5) for s in ss])),
                               "y int, s double, p int")
    assert abs(C.roc_auc(df, "y", "s").first().auc - auc_model(ys, ss)) < 1e-12
    ll = -sum(y * math.log(s) + (1 - y) * math.log(1 - s) for y, s in zip(ys, ss)) / len(ys)
    assert abs(C.log_loss(df, "y", "s").first().log_loss - ll) < 1e-12
    cm = {(r.target, r.predicted): r.n for r in C.confusion(df, "y", "p").collect()}
    assert sum(cm.values()) == len(ys) and len(cm) == 4
    roc = C.roc_curve(df, "y", "s").collect()
    assert any(r.fpr == 1.0 and r.tpr == 1.0 for r in roc)


def test_search_small(spark):
    import random as _r

    rng = _r.Random(1)
    rows = [(rng.random(), rng.random(), 1 if i % 3 == 0 else 0) for i in range(120)]
    df = spark.createDataFrame(rows, "a double, b double, target int").withColumn("weight", F.lit(1.0))
    est = C.boosted_trees(["a", "b"], max_iter=3, max_depth=2, min_info_gain=0.0)
    _, res = C.grid_search(est, {"maxDepth": [2, 3], "stepSize": [0.1, 0.5]}, df, folds=2,
                           parallelism=2, sample=2)
    assert len(res) == 2 and all(m > 0 for _, m, _ in res)
