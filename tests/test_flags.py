from brandlink.config import FIXTURE_CONFIG
from brandlink.operators.catalog import gold
from brandlink.operators.links import same_item_links


def test_gold_null_level1_flag(spark):
    raw = spark.createDataFrame(
        [("north", "123", "Acme", ["SMALL"]), ("north", "124", "Acme", ["SMALL", "OLD"]),
         ("north", "125", "Acme", ["SMALL", "NEW"])],
        "retailer string, ean string, brand_name string, crumb array<string>")
    assert {r.product_id for r in gold(raw, FIXTURE_CONFIG).collect()} == {"0000000000125"}
    kept = {r.product_id for r in gold(raw, FIXTURE_CONFIG, keep_null_level1=True).collect()}
    assert kept == {"0000000000123", "0000000000125"}


def test_links_count_rows_flag(spark):
    g = spark.createDataFrame(
        [("n", "p1", "X"), ("n", "p1", "X"), ("s", "p1", "Y")],
        "retailer string, product_id string, brand_desc_slug string")
    assert same_item_links(g).count() == 0          # one shared product
    assert same_item_links(g, count_rows=True).count() == 2   # duplicate rows count twice
