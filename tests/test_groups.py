import random

from brandlink.operators import groups


def model_ordered(pairs, t):
    """The documented rule, read backwards: a name ends in the group of its
    last event, and a matched event belongs where the latest earlier event of
    its left name belongs, else of its right name, else it founds a group."""
    events = []  # (names, founder of a lone group)
    seen = set()
    for left, right, s in pairs:
        if s >= t:
            events.append((left, right))
        else:
            events += [(x,) for x in dict.fromkeys((left, right)) if x not in seen]
        seen |= {left, right}

    def latest(name, before):
        return next((k for k in range(before - 1, -1, -1) if name in events[k]), None)

    def founder(k):
        while True:
            names = events[k] if len(events[k]) == 2 else ()
            earlier = next((e for e in (latest(x, k) for x in names) if e is not None), None)
            if earlier is None:
                return k
            k = earlier

    return partition((x, founder(latest(x, len(events)))) for x in seen)


def partition(items):
    part = {}
    for n, k in items:
        part.setdefault(k, set()).add(n)
    return sorted(sorted(v) for v in part.values())


def frame(spark, pl):
    return spark.createDataFrame([(l, r, s, i) for i, (l, r, s) in enumerate(pl)],
                                 "left_side string, right_side string, similarity double, pos int")


def test_ordered_example(spark):
    df = frame(spark, [("a", "b", 0.9), ("c", "d", 0.9), ("b", "c", 0.9)])
    got = partition((r.name, r.group_id) for r in
                    groups.ordered_groups(df, 0.7, order_col="pos").collect())
    assert got == [["a", "b", "c"], ["d"]]


def test_components_example(spark):
    df = frame(spark, [("a", "b", 0.9), ("c", "d", 0.9), ("b", "c", 0.9)])
    got = {r.name: r.group_id for r in groups.connected_components(df).collect()}
    assert set(got.values()) == {"a"} and len(got) == 4


def test_orphans(spark):
    df = frame(spark, [("a", "b", 0.1)])
    got = partition((r.name, r.group_id) for r in
                    groups.ordered_groups(df, 0.7, order_col="pos").collect())
    assert got == [["a"], ["b"]]
    got = partition((r.name, r.group_id) for r in
                    groups.connected_components(df, min_similarity=0.7).collect())
    assert got == [["a"], ["b"]]


def test_ordered_matches_sequential_model(spark):
    rng = random.Random(11)
    for _ in range(3):
        names = [f"n{i}" for i in range(10)]
        pl = [(rng.choice(names), rng.choice(names), rng.choice([0.1, 0.75, 0.9]))
              for _ in range(20)]
        got = partition((r.name, r.group_id) for r in
                        groups.ordered_groups(frame(spark, pl), 0.7, order_col="pos").collect())
        assert got == model_ordered(pl, 0.7)


def test_identifier_and_communities(spark):
    g = spark.createDataFrame([("a", "a"), ("bb", "a"), ("c", "c")], "name string, group_id string")
    cnt = spark.createDataFrame([("a", 1), ("bb", 5), ("c", 1)], "name string, n_products long")
    got = {r.name: r.canonical_name for r in groups.pick_identifier(g, cnt).collect()}
    assert got == {"a": "bb", "bb": "bb", "c": "c"}
    sym = spark.createDataFrame([("a", "b", 1.0), ("b", "a", 1.0), ("b", "c", 1.0), ("c", "b", 1.0)],
                                "left_side string, right_side string, similarity double")
    com = {r.name: r.group_id for r in groups.threshold_communities(sym).collect()}
    assert com == {"a": "b", "b": "b", "c": "b"}


def test_previous_in_order_hot_key(spark):
    from brandlink.operators.groups import previous_in_order

    rows = [("hot", i) for i in range(0, 400, 2)] + [("cold", i) for i in range(5)]
    df = spark.createDataFrame(rows, "name string, e int")
    got = {(r.name, r.e): r.prev for r in previous_in_order(df, "name", "e", "prev", 6).collect()}
    for name in ("hot", "cold"):
        es = sorted(e for n, e in rows if n == name)
        for a, b in zip([None] + es[:-1], es):
            assert got[(name, b)] == a


def test_ordered_refines_components(spark):
    rng = random.Random(23)
    names = [f"n{i}" for i in range(9)]
    pl = [(rng.choice(names), rng.choice(names), rng.choice([0.2, 0.8, 0.95])) for _ in range(18)]
    df = frame(spark, pl)
    ordered = {r.name: r.group_id for r in
               groups.ordered_groups(df, 0.7, order_col="pos").collect()}
    comp = {r.name: r.group_id for r in
            groups.connected_components(df, min_similarity=0.7).collect()}
    assert set(ordered) == set(comp)
    by_group = {}
    for n, g in ordered.items():
        by_group.setdefault(g, set()).add(comp[n])
    assert all(len(cs) == 1 for cs in by_group.values())


def test_previous_in_order_large(spark):
    """Hot keys over many range partitions: the same as a lag per key."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    for seed in (1, 2, 3):
        key = F.when(F.rand(seed) < 0.4, F.lit("hot")).otherwise(
            F.concat(F.lit("k"), (F.rand(seed + 10) * 3000).cast("int").cast("string")))
        df = spark.range(200_000).select(key.alias("key"), F.col("id").alias("o"), F.lit("x").alias("extra"))
        df = df.checkpoint()
        want = df.withColumn("w", F.lag("o").over(Window.partitionBy("key").orderBy("o")))
        got = groups.previous_in_order(df, "key", "o", "p", partitions=16)
        bad = got.join(want.select("o", "w"), "o").where(~F.col("p").eqNullSafe(F.col("w"))).count()
        assert bad == 0 and got.count() == 200_000


def test_components_of_a_long_path_and_a_hub(spark, monkeypatch):
    """100,000 names each, in a logarithmic number of rounds."""
    n, rounds = 100_000, []
    real = groups.cut_lineage
    monkeypatch.setattr(groups, "cut_lineage", lambda d: rounds.append(1) or real(d))
    ids = spark.range(n)
    path = ids.selectExpr("id as a", "id + 1 as b")
    hub = ids.selectExpr(f"{2 * n} + {n} as a", f"{2 * n} + id as b")
    both = path.unionByName(hub)
    got = groups.star_labels(both)
    sizes = {r.label: r["count"] for r in got.groupBy("label").count().collect()}
    assert sizes == {0: n + 1, 2 * n: n + 1}
    assert len(rounds) < 60
