"""Names in stripes: exact joins over several stripes, memory of the bands."""

import tracemalloc

import numpy as np
import pyarrow as pa

from brandlink.operators import grid, pairs
from brandlink.operators.dense import _same_bucket, dense_cosine_pairs


def test_copies_grow_with_the_names_only():
    count = [grid.stripe_count(n, 256, 16384) for n in (0, 100, 2000, 10_000, 50_000, 190_000, 310_000)]
    assert count == [1, 1, 7, 12, 12, 12, 19]


def test_sparse_pairs_over_stripes(spark):
    """Every pair at the threshold, whatever stripes it lies in; a null name has none."""
    rng = np.random.default_rng(3)
    base = rng.random((40, 60)) * (rng.random((40, 60)) < .15)
    m = base[np.arange(700) % 40] + .3 * rng.random((700, 60)) * (rng.random((700, 60)) < .1)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    names = [f"n{i:03d}" for i in range(699)] + [None]
    w = spark.createDataFrame([(names[i], f"t{j}", float(m[i, j])) for i, j in zip(*np.nonzero(m))],
                              "name string, term string, w double")
    assert grid.stripe_count(699, 256, 8192) > 1
    s = m @ m.T
    want = {(names[i], names[j]) for i in range(699) for j in range(i + 1, 699) if round(s[i, j], 9) >= .9}
    got = {(r.left_side, r.right_side): r.similarity for r in pairs.cosine_pairs(w, .9).collect()}
    assert set(got) == want and len(want) > 1000
    assert all(abs(v - s[int(a[1:]), int(b[1:])]) < 1e-9 for (a, b), v in got.items())


def test_dense_pairs_of_null_and_repeated_names(spark):
    """A null name has no pairs, also beside others; a repeated one each of its rows'."""
    rows = [("a", [1., 0.]), ("a", [1., 0.]), ("b", [1., .1]), (None, [1., 0.]), (None, [1., 0.]), ("c", [0., 0.])]
    df = spark.createDataFrame(rows, "name string, embedding array<double>")
    for method in ("blocks", "lsh"):
        got = sorted((r.left_side, r.right_side) for r in dense_cosine_pairs(df, .9, method=method, block_size=2).collect())
        assert got == [("a", "b"), ("a", "b")]


def test_bands_are_made_some_at_a_time():
    m = np.random.default_rng(1).standard_normal((1500, 32))
    tracemalloc.start()
    seen = _same_bucket(1700, 13, 42)(m, m)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen.diagonal().all() and peak < 160 << 20   # all bands at once: 265 MB for their products alone


def test_copies_of_a_round_do_not_grow():
    """However many stripes: every pair of them in one round, a dozen copies at most for each."""
    for n in (1, 2, 7, 12, 13, 22, 75):
        rounds = grid.stripe_rounds(n)
        meet = {(a, b): sum(x <= min((a - b) % n, (b - a) % n) < y for x, y in rounds) for a in range(n) for b in range(n)}
        assert set(meet.values()) == {1}
        assert all(sum(x <= min(b, n - b) < y for b in range(n)) <= grid.STRIPES for x, y in rounds)


def test_sparse_pairs_in_several_rounds(spark, monkeypatch):
    """More stripes than a round takes; also terms in the order of their frequency."""
    monkeypatch.setattr(pairs, "_ENTRIES", 150)
    rng = np.random.default_rng(8)
    base = rng.random((30, 50)) * (rng.random((30, 50)) < .2)
    m = base[np.arange(300) % 30] + .4 * rng.random((300, 50)) * (rng.random((300, 50)) < .1)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    rows = [(f"n{i:03d}", f"t{j}", float(m[i, j])) for i, j in zip(*np.nonzero(m))]
    assert -(-len(rows) // 150) > grid.STRIPES
    s = m @ m.T
    for t in (.3, .8):
        want = {(f"n{i:03d}", f"n{j:03d}") for i in range(300) for j in range(i + 1, 300) if round(s[i, j], 9) >= t}
        got = {(r.left_side, r.right_side): r.similarity for r in pairs.cosine_pairs(
            spark.createDataFrame(rows, "name string, term string, w double"), t).collect()}
        assert set(got) == want and len(want) > 500
        assert all(abs(v - s[int(a[1:]), int(b[1:])]) < 1e-9 for (a, b), v in got.items())


def test_packed_vectors_hold_each_term_once():
    """No term is repeated in a stripe and no norm travels: below ten bytes for an entry."""
    rng = np.random.default_rng(4)
    vec = [[{"df": int(k) + 1, "term": f"term number {k}", "w": float(rng.choice([.1, .2, .3]))}
            for k in rng.choice(3000, 150, replace=False)] for _ in range(2000)]
    kind = pa.struct([("df", pa.int64()), ("term", pa.string()), ("w", pa.float64())])
    batch = pa.RecordBatch.from_arrays([pa.array([f"n{i}" for i in range(2000)]), pa.array(vec, pa.list_(kind)),
                                        pa.array([0] * 2000, pa.int32())], ["name", "vec", "s"])
    rows = list(pairs._pack([batch]))
    assert len(rows) == 1 and sum(c.nbytes for c in rows[0].columns) < 10 * 2000 * 150
