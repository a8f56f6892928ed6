import tempfile

from hypothesis import given, settings
from hypothesis import strategies as st

from brandlink.config import Config
from brandlink.operators.catalog import symmetric_closure
from brandlink.operators.groups import connected_components

YAML = """
retailer:
  shop_a:
    nb_levels: 2
    level0: ['FOOD', 'DRINKS']
    level1_to_delete: ["WINE"]
  shop_b:
    nb_levels: 4
    level0: ['FOOD']
    level1_to_delete: []
unknown_brands: ["", "NO BRAND"]
slug_replacements: [["&", "et"]]
classification_levels: ['0', '1']
classification_most_relevant_level: 1
"""


def test_config_from_yaml():
    with tempfile.NamedTemporaryFile("w", suffix=".yml", delete=False) as fh:
        fh.write(YAML)
    cfg = Config.from_yaml(fh.name)
    assert cfg.retailer_names == ["shop_a", "shop_b"]
    assert cfg.max_levels == 4 and cfg.retailer("shop_a").level1_to_delete == ("WINE",)
    assert cfg.classification_levels == (0, 1) and cfg.slug_replacements == (("&", "et"),)


names = st.sampled_from(list("abcdefg"))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(names, names), min_size=1, max_size=10))
def test_closure_symmetric_and_components_partition(spark, edges):
    df = spark.createDataFrame(edges, "left_side string, right_side string")
    clo = {(r.left_side, r.right_side) for r in symmetric_closure(df).collect()}
    assert all((b, a) in clo for a, b in clo)
    comp = {r.name: r.group_id for r in connected_components(df).collect()}
    # union-find model
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    nodes = {x for e in edges for x in e}
    assert set(comp) == nodes
    for x in nodes:
        members = sorted(y for y in nodes if find(y) == find(x))
        assert comp[x] == members[0]
