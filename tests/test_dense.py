import numpy as np

from brandlink.operators import dense
from brandlink.operators.dense import band_plan, dense_cosine_pairs


def brute(names, m, t):
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    s = u @ u.T
    out = set()
    for i in range(len(names)):
        for j in range(len(names)):
            if names[i] < names[j] and round(s[i, j], 9) >= t:
                out.add((names[i], names[j]))
    return out


def test_blocks_exact_and_lsh_subset(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((6, 16))
    m = np.vstack([base[i % 6] + 0.4 * rng.standard_normal(16) for i in range(90)])
    names = [f"v{i:03d}" for i in range(90)]
    df = spark.createDataFrame([(n, [float(x) for x in row]) for n, row in zip(names, m)],
                               "name string, embedding array<double>")
    exp = brute(names, m, 0.6)
    for bs in (1000, 17):
        got = {(r.left_side, r.right_side) for r in
               dense_cosine_pairs(df, 0.6, method="blocks", block_size=bs).collect()}
        assert got == exp
    lsh = {(r.left_side, r.right_side) for r in
           dense_cosine_pairs(df, 0.6, method="lsh", bands=24, rows=4).collect()}
    assert lsh <= exp and len(lsh) >= 0.9 * len(exp)


def test_lsh_meets_its_recall(spark):
    """Bits grow with log n, bands with the recall; join rows stay far below all pairs."""
    rng = np.random.default_rng(11)
    base = rng.standard_normal((60, 32))
    m = np.vstack([base[i % 60] + .5 * rng.standard_normal(32) for i in range(900)])
    names = [f"v{i:04d}" for i in range(900)]
    df = spark.createDataFrame([(n, [float(x) for x in row]) for n, row in zip(names, m)],
                               "name string, embedding array<double>")
    exp = brute(names, m, 0.7)
    got = {(r.left_side, r.right_side) for r in dense_cosine_pairs(df, 0.7, method="lsh", recall=.95).collect()}
    assert got <= exp and len(got) >= .95 * len(exp) and len(exp) > 1000
    assert [band_plan(n, .7, .95)[1] for n in (2, 1000, 1_000_000)] == [1, 10, 20]
    assert band_plan(1000, .7, .99)[0] > band_plan(1000, .7, .9)[0]
    bands, rows = band_plan(100_000, .7, .95)
    assert bands / 2 ** rows < .1   # the share of unrelated pairs that meet


def test_bands_of_several_stripes_share_their_planes(spark):
    """Planes for a vector are a few of those of bands of their own; the recall stays."""
    halves, bits = dense.half_plan(16384, .35, .95)
    bands, rows = band_plan(16384, .35, .95)
    assert 2 * bits >= rows and halves * (halves - 1) / 2 > bands and halves * bits < bands * rows / 20
    rng = np.random.default_rng(2)
    m = rng.standard_normal((2100, 16))
    names = [f"v{i:04d}" for i in range(len(m))]
    df = spark.createDataFrame([(n, [float(x) for x in row]) for n, row in zip(names, m)],
                               "name string, embedding array<double>")
    exp = brute(names, m, .7)
    got = {(r.left_side, r.right_side) for r in dense_cosine_pairs(df, .7, method="lsh", recall=.95).collect()}
    assert got <= exp and len(exp) > len(got) >= .95 * len(exp) > 1000
