import random
from collections import Counter

import numpy as np
import pytest
from brandlink.operators import neighbours, rebalance
from pyspark.sql import functions as F

FEATURES = ["a", "b", "c"]


def vectors(n, seed, ties=True):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        v = [round(rng.random(), 1) if ties else rng.random() for _ in range(3)]
        out.append((i, [0.0, 0.0, 0.0] if ties and rng.random() < .3 else v))
    return out


def brute(rows, k):
    out = {}
    for i, v in rows:
        near = sorted((sum((x - y) ** 2 for x, y in zip(v, w)), j) for j, w in rows if j != i)[:k]
        out[i] = [j for _, j in near]
    return out


@pytest.mark.parametrize("ties, k", [(True, 5), (False, 1), (False, 4)])
def test_nearest_equals_brute_force(spark, ties, k):
    rows = vectors(500, k, ties)
    got = {}
    for r in neighbours.nearest(spark.createDataFrame(rows, "id long, v array<double>"), k).collect():
        got.setdefault(r.id, {})[r["rank"]] = r.other
    want = brute(rows, k)
    same = lambda i, j: sum((x - y) ** 2 for x, y in zip(rows[i][1], rows[j][1]))
    for i, others in want.items():
        mine = [got[i][r] for r in sorted(got[i])]
        # rounded sums may swap equal distances; the distances themselves agree
        assert len(set(mine)) == k and np.allclose([same(i, j) for j in mine], [same(i, j) for j in others], atol=1e-12)
        assert ties or mine == others


def test_nearest_in_groups(spark):
    rows = vectors(300, 8, False)
    df = spark.createDataFrame([(i, v, "x" if i % 3 else "y") for i, v in rows], "id long, v array<double>, part string")
    got = neighbours.nearest(df, 2, "part").collect()
    for part in (0, 1):
        mine = [r for r in rows if bool(r[0] % 3) == bool(part)]
        want = brute(mine, 2)
        for i, _ in mine:
            assert [r.other for r in sorted((r for r in got if r.id == i), key=lambda r: r["rank"])] == want[i]
    few = neighbours.nearest(spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id long, v array<double>"), 5)
    assert sorted((r.id, r.other) for r in few.collect()) == [(1, 2), (2, 1)]
    assert neighbours.nearest(spark.createDataFrame([], "id long, v array<double>"), 5).count() == 0


def table(spark, n=260):
    rng = random.Random(4)
    rows = [(i, *v, int(i % 9 == 0)) for i, v in vectors(n, 4, False)]
    return spark.createDataFrame([(i, a + (.3 if t else 0), b, c, t) for i, a, b, c, t in rows],
                                 "key long, a double, b double, c double, target int"), rng


def test_smote_fills_the_small_class(spark):
    df, _ = table(spark)
    got = rebalance.rebalance(df, FEATURES, "target", ["key"], "smote").collect()
    assert set(Counter(r.target for r in got).values()) == {sum(i % 9 != 0 for i in range(260))}
    old = [(r.key, [r.a, r.b, r.c]) for r in df.where("target = 1").collect()]
    near = brute(old, 5)
    at = dict(old)
    made = [r for r in got if r.id >= 260]
    assert made
    for r in made:  # on the way between a row and one of its five nearest
        v = np.array([r.a, r.b, r.c])
        ok = False
        for i, js in near.items():
            for j in js:
                x, d = np.array(at[i]), np.array(at[j]) - np.array(at[i])
                t = float((v - x) @ d / (d @ d))
                ok |= -1e-9 <= t <= 1 and np.allclose(x + t * d, v, atol=1e-9)
        assert ok
    again = rebalance.rebalance(df.repartition(7), FEATURES, "target", ["key"], "smote").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_tomek_and_edited_equal_brute_force(spark):
    df, _ = table(spark)
    d = rebalance._rows(df, FEATURES, "target", ["key"])
    rows = [(r.id, r.v) for r in d.collect()]
    t = {r.id: r.target for r in d.collect()}
    one, three = brute(rows, 1), brute(rows, 3)
    links = {i for i in t if one[one[i][0]][0] == i and t[i] != t[one[i][0]]}
    assert {r.id for r in rebalance._without_tomek(d).collect()} == set(t) - links and links
    assert {r.id for r in rebalance._edited(d).collect()} == {i for i in t if all(t[j] == t[i] for j in three[i])}


def test_small_classes(spark):
    for n in (0, 1, 9):  # nothing, one class, a class of one row
        df, _ = table(spark, n)
        assert rebalance.rebalance(df, FEATURES, "target", ["key"], "smote_enn").count() <= n
    with pytest.raises(ValueError):
        rebalance.rebalance(table(spark, 5)[0], FEATURES, "target", ["key"], "other")
