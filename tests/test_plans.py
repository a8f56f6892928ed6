"""Plan-shape checks: pruning and pushdown reach the scan, the cleaning path
stays in the JVM, and no pair operator plans a Cartesian product."""

from brandlink.config import FIXTURE_CONFIG
from brandlink.operators import catalog, links, pairs
from brandlink.plans import jobs
from brandlink.sources.tables import fixture_catalogue

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_scan_pruned_and_pushed(spark):
    g = catalog.gold(fixture_catalogue(spark, SF, materialize=False), FIXTURE_CONFIG)
    p = plan(g)
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in p or \
        "struct<l_partkey:bigint,l_suppkey:bigint>" in p
    assert "PushedFilters: [IsNotNull(l_partkey)" in p
    assert "EvalPython" not in p and "PythonUDF" not in p


def test_pair_operators_no_cartesian(spark):
    g = jobs.gold_fixture(spark, SF)
    w = jobs.ngram_weights(g)
    for df in (pairs.cosine_pairs(w, 0.3), links.same_item_links(g),
               jobs.pair_feature_table(g, 0.2, with_ratio=False)):
        p = plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_model_groups_write_the_gold_layer_once(spark, monkeypatch):
    """Features, links, names and counts read one written table."""
    from brandlink.plans import queries

    made, gold = [], queries._gold
    monkeypatch.setattr(queries, "_gold", lambda *a: made.append(1) or gold(*a))
    assert queries.REGISTRY["C13_C14_model_groups"](spark, SF).count() > 0
    assert len(made) == 1
