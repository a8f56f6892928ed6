import math
import random

import numpy as np
import pytest
from brandlink.operators import boosting as B
from pyspark.sql import functions as F

FEATURES = ["a", "b", "c"]
COLUMNS = "id long, a double, b double, c double, target int"


def rows(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b = round(rng.random(), 2), round(rng.random() * 8) / 8
        c = None if rng.random() < .1 else round(rng.gauss(0, 1), 1)
        p = .9 if (a > .4) == (b > .5) else .15
        out.append((i, a, b, c, int(rng.random() < p)))
    return out


def model_tree(x, g, h, s, depth=0, node=0):
    """Exact greedy tree over the distinct values, a plain recursion: leaves and splits by node."""
    G, H = g.sum(), h.sum()
    best = (B.LEAST_GAIN, None, None)
    if depth < s.max_depth:
        for f in range(x.shape[1]):
            for v in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= v
                gl, hl = g[left].sum(), h[left].sum()
                gr, hr = g[~left].sum(), h[~left].sum()
                if min(hl, hr) < s.min_child_weight:
                    continue
                gain = gl ** 2 / (hl + s.reg_lambda) + gr ** 2 / (hr + s.reg_lambda) - G ** 2 / (H + s.reg_lambda)
                if gain > best[0] + 1e-9:
                    best = (gain, f, v)
    if best[1] is None:
        return {node: None}, -G / (H + s.reg_lambda) * s.learning_rate * np.ones(len(x))
    left = x[:, best[1]] <= best[2]
    out, value = {node: (best[1], best[0])}, np.zeros(len(x))
    for side, child in ((left, 2 * node + 1), (~left, 2 * node + 2)):
        below, value[side] = model_tree(x[side], g[side], h[side], s, depth + 1, child)
        out.update(below)
    if best[0] < s.gamma and out[2 * node + 1] is None and out[2 * node + 2] is None:
        return {node: None}, -G / (H + s.reg_lambda) * s.learning_rate * np.ones(len(x))
    return out, value


@pytest.mark.parametrize("s", [
    B.Setting(rounds=4, max_depth=3, learning_rate=.3),
    B.Setting(rounds=3, max_depth=5, learning_rate=.5, gamma=.8, min_child_weight=2.0, positive_scale=1.7)])
def test_equals_plain_boosting(spark, s):
    data = rows(120, 4)
    df = spark.createDataFrame(data, COLUMNS)
    model, _ = B.fit(df, FEATURES, "target", s, ["id"])
    x = np.array([[-np.inf if v is None else v for v in r[1:4]] for r in data])
    y, margin = np.array([r[4] for r in data]), np.zeros(len(data))
    for t in model.trees:
        p, w = 1 / (1 + np.exp(-margin)), np.where(y > 0, s.positive_scale, 1.0)
        want, value = model_tree(x, (p - y) * w, p * (1 - p) * w, s)
        got = {k: None if v[0] < 0 else v[0] for k, v in t.nodes.items()}
        assert got == {k: None if v is None else v[0] for k, v in want.items()}
        assert all(abs(t.nodes[k][2] - v[1]) < 1e-6 for k, v in want.items() if v)
        margin += value
    p = {r.id: r.proba_1 for r in model.score(df, ["id"]).collect()}
    assert np.allclose([p[i] for i in range(len(data))], 1 / (1 + np.exp(-margin)), atol=1e-7)


def records(trees):
    return sorted((r.model, r.round, r.node, r.feature, r.bin, r.rows, round(r.gain, 9), round(r.loss or 0, 12))
                  for r in trees.collect())


def test_levels_and_tasks_give_the_same_models(spark):
    df = spark.createDataFrame(rows(400, 9), COLUMNS).repartition(5)
    d = df.withColumn("fold", (F.col("id") % 3).cast("int"))
    base = B.Setting(rounds=3, max_depth=4, subsample=.7, colsample=.7, patience=2)
    settings = B.settings_of(base, {"max_depth": [2, 4], "gamma": [0.0, .6]})
    made = [B.Training(d, FEATURES, "target", settings, ["id"], [0, 2], "fold", task_rows=k).fit() for k in (0, 10_000)]
    assert records(made[0]) == records(made[1]) and made[0].select("model").distinct().count() == 8


@pytest.mark.parametrize("task_rows", [0, 10_000])
def test_stops_by_itself(spark, task_rows):
    """Held-out labels are random, so the loss has its best round early on."""
    rng = random.Random(1)
    data = [(i, rng.random(), rng.random(), rng.random(), rng.randint(0, 1)) for i in range(300)]
    df = spark.createDataFrame(data, COLUMNS).withColumn("valid", F.col("id") % 3 == 0)
    s = B.Setting(rounds=60, max_depth=3, learning_rate=.5, patience=3)
    model, trees = B.fit(df, FEATURES, "target", s, ["id"], valid="valid", task_rows=task_rows)
    assert model.grown < 60 and model.grown == model.best_round + 4 == trees.agg(F.max("round")).first()[0] + 1
    assert len(model.trees) == model.best_round + 1
    assert model.losses[model.best_round] == min(model.losses)


def test_importance_of_three_splits(spark):
    """Four cells of a and b; gains and covers by hand: p = 1/2, g = 1/2 or -1/2, h = 1/4 in the first round."""
    cells = [((0., 0.), [0] * 8), ((0., 1.), [0] * 4 + [1] * 4), ((1., 0.), [1] * 4 + [0] * 4), ((1., 1.), [1] * 8)]
    data = [(i * 10 + k, a, b, 0.0, t) for i, ((a, b), ts) in enumerate(cells) for k, t in enumerate(ts)]
    s = B.Setting(rounds=1, max_depth=2, min_child_weight=0.0)
    _, trees = B.fit(spark.createDataFrame(data, COLUMNS), FEATURES, "target", s, ["id"])
    # root on a: G = -+4, H = 4 of both sides; then b: 8 rows of a cell, G = 4 or 0, H = 2
    root = 4 ** 2 / 5 + 4 ** 2 / 5
    child = 4 ** 2 / 3 + 0 - 4 ** 2 / 5
    got = {r.feature: r for r in B.importance(trees, FEATURES).collect()}
    assert set(got) == {"a", "b"} and got["a"].splits == 1 and got["b"].splits == 2
    assert math.isclose(got["a"].gain, root, rel_tol=1e-9) and math.isclose(got["a"].cover, 8, rel_tol=1e-9)
    assert math.isclose(got["b"].gain, child, rel_tol=1e-9) and math.isclose(got["b"].cover, 4, rel_tol=1e-9)
    assert math.isclose(got["b"].total_gain, 2 * child, rel_tol=1e-9)


def test_search_ranks_settings(spark):
    df = spark.createDataFrame(rows(300, 2), COLUMNS)
    base = B.Setting(rounds=20, learning_rate=.3, max_depth=4)
    settings = B.settings_of(base, {"learning_rate": [.001, .3], "min_child_weight": [1.0]})
    got = B.search(df, FEATURES, "target", settings, ["id"], ["learning_rate", "min_child_weight"], folds=3).collect()
    assert [r.learning_rate for r in sorted(got, key=lambda r: r["rank"])] == [.3, .001]
    assert all(r.mean_log_loss < math.log(2) + 1e-9 and r.std_log_loss >= 0 for r in got)
    assert len(B.settings_of(base, {"max_depth": range(3, 15), "min_child_weight": range(1, 6)}, sample=10)) == 10


def test_no_rows_and_one_class(spark):
    empty = spark.createDataFrame([], COLUMNS)
    model, _ = B.fit(empty, FEATURES, "target", B.Setting(rounds=2), ["id"])
    assert model.score(empty, ["id"]).count() == 0
    ones = spark.createDataFrame([(i, 1.0, None, 2.0, 1) for i in range(10)], COLUMNS)
    model, _ = B.fit(ones, FEATURES, "target", B.Setting(rounds=2), ["id"])
    assert all(r.proba_1 > .5 for r in model.score(ones, ["id"]).collect())


def test_whole_sums_are_exact():
    rng = np.random.default_rng(0)
    codes, v = rng.integers(0, 5, 1000), rng.integers(-2**50, 2**50, 1000)
    got = B._whole_sums(codes, v, 5)
    assert got.tolist() == [sum(int(x) for x in v[codes == k]) for k in range(5)]
