import math
import random

from brandlink.operators import pairs, vectors


def brute_force(rows, t):
    vecs = {}
    for n, term, w in rows:
        vecs.setdefault(n, {})[term] = w
    out = {}
    names = sorted(vecs)
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            s = sum(w * vecs[b].get(k, 0.0) for k, w in vecs[a].items())
            if round(s, 9) >= t:
                out[(a, b)] = s
    return out


def random_unit_rows(rng, n=40, vocab=30):
    rows = []
    for i in range(n):
        terms = rng.sample(range(vocab), rng.randint(1, 8))
        ws = [rng.random() ** 3 + 0.01 for _ in terms]
        norm = math.sqrt(sum(w * w for w in ws))
        rows += [(f"n{i:02d}", f"t{t}", w / norm) for t, w in zip(terms, ws)]
    return rows


def test_prefix_filter_is_exact(spark):
    rng = random.Random(3)
    rows = random_unit_rows(rng)
    w = spark.createDataFrame(rows, "name string, term string, w double")
    for t in (0.2, 0.5, 0.8):
        got = {(r.left_side, r.right_side): r.similarity
               for r in pairs.cosine_pairs(w, t).collect()}
        exp = brute_force(rows, t)
        assert set(got) == set(exp), t
        assert all(abs(got[k] - exp[k]) < 1e-9 for k in exp)


def test_symmetric_and_diagonal(spark):
    rows = [("a", "x", 1.0), ("b", "x", 0.6), ("b", "y", 0.8)]
    w = spark.createDataFrame(rows, "name string, term string, w double")
    got = {(r.left_side, r.right_side) for r in
           pairs.cosine_pairs(w, 0.5, symmetric=True, include_self=True).collect()}
    assert got == {("a", "b"), ("b", "a"), ("a", "a"), ("b", "b")}


def test_smoothed_idf(spark):
    toks = spark.createDataFrame([("d1", "x"), ("d2", "x"), ("d3", "y")], "name string, term string")
    names = spark.createDataFrame([("d1",), ("d2",), ("d3",)], "name string")
    w = vectors.tfidf(toks, names, normalize=False)
    got = {r.name: r.w for r in w.where("term = 'x'").collect()}
    assert abs(got["d1"] - (math.log(4 / 3) + 1)) < 1e-9


def test_top_k(spark):
    p = spark.createDataFrame([("a", "b", 0.9), ("a", "c", 0.8), ("a", "d", 0.7)],
                              "left_side string, right_side string, similarity double")
    got = [r.right_side for r in pairs.top_k_per_name(p, 2).orderBy("right_side").collect()]
    assert got == ["b", "c"]


def test_best_partners_equal_brute_force(spark):
    rows = random_unit_rows(random.Random(5), 60, 25)
    rows += [("far", "t1", 0.01), ("far", "only", math.sqrt(1 - 0.01 ** 2)), ("alone", "none", 1.0)]
    rows += [(f"same{i}", "t0", 1.0) for i in range(6)]  # ties
    sims = brute_force(rows, 1e-12)
    best = {}
    for (a, b), s in sims.items():
        if s > 0:
            best.setdefault(a, []).append((-round(s, 9), b))
            best.setdefault(b, []).append((-round(s, 9), a))
    w = spark.createDataFrame(rows, "name string, term string, w double")
    for k in (1, 4):
        got = {}
        for r in pairs.top_k_pairs(w, k).collect():
            got.setdefault(r.left_side, []).append((-round(r.similarity, 9), r.right_side))
        assert {n: sorted(v) for n, v in got.items()} == {n: sorted(v)[:k] for n, v in best.items()}


def test_dots_by_kind(spark):
    rows = [("a", "x", 0, .6), ("a", "x", 1, .5), ("b", "x", 0, .5), ("b", "y", 1, 1.0), ("c", "x", 1, 2.0)]
    w = spark.createDataFrame(rows, "name string, term string, kind int, w double")
    asked = spark.createDataFrame([("a", "b"), ("c", "a"), ("a", "nobody")], "left_side string, right_side string")
    got = {(r.left_side, r.right_side): (r.p, r.q) for r in pairs.pair_dots(asked, pairs.vector_rows(w), ["p", "q"]).collect()}
    assert got == {("a", "b"): (.3, 0.0), ("c", "a"): (0.0, 1.0), ("a", "nobody"): (0.0, 0.0)}


def test_no_row_for_each_pair_and_term(spark):
    """Verification joins vector rows: nothing is grouped by pair after them."""
    w = spark.createDataFrame(random_unit_rows(random.Random(1)), "name string, term string, w double")
    plan = pairs.cosine_pairs(w, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "collect_list" in plan and "sum(" not in plan.split("MapInArrow")[0]
