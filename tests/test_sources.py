import tempfile

from pyspark.sql import functions as F

from brandlink.config import FIXTURE_CONFIG
from brandlink.operators.catalog import gold, gold_brands
from brandlink.sources.tables import fixture_catalogue, read_catalogues

SF = "/root/testdata/sf0.001"


def test_read_catalogues_per_retailer_files(spark):
    raw = fixture_catalogue(spark, SF, materialize=False)
    prefix = tempfile.mkdtemp(prefix="brandlink-cat-") + "/"
    for name in FIXTURE_CONFIG.retailer_names:
        (raw.where(F.col("retailer") == name).drop("retailer")
         .write.mode("overwrite").parquet(f"{prefix}{name}.parquet"))
    back = read_catalogues(spark, prefix, FIXTURE_CONFIG.retailer_names)
    a = gold(back, FIXTURE_CONFIG)
    b = gold(raw, FIXTURE_CONFIG)
    assert a.count() == b.count()
    assert a.exceptAll(b.select(*a.columns)).count() == 0


def test_lineitem_is_made_distinct_before_the_join(spark):
    """Part and retailer decide a row, so repeated lines do not meet the parts."""
    p = fixture_catalogue(spark, SF, materialize=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [l_partkey" in p[p.index("Join"):]


def test_brands_of_the_gold_layer_without_its_rows(spark):
    """The same brands as all cleaned rows give, from each spelling and category once."""
    path = ["STANDARD", "x", "y"]
    rows = [("north", "12", "M&M's", path), ("north", "13", "M&M's", path), ("north", "12", "M&M's", path),
            ("south", "0", "Zero", path), ("south", "00", "Zero", path), ("south", "a1", "Letter", path),
            ("south", None, "Null", path), ("east", "7", None, path), ("east", "7", "No Name", path),
            ("east", "7", "Brând 1", path), ("east", "8", "Short", ["STANDARD"]), ("east", "8", "None", None),
            ("east", "9", "Old", ["STANDARD", "OLD"]), ("east", "9", "Other", ["NOWHERE", "x"]), (None, "9", "Shop", path),
            ("north", "14", "Third", ["STANDARD", "x", "z"])]
    raw = spark.createDataFrame(rows, "retailer string, ean string, brand_name string, crumb array<string>")
    want = {r[0] for r in gold(raw, FIXTURE_CONFIG).select("brand_desc_slug").collect()}
    got = [r[0] for r in gold_brands(raw, FIXTURE_CONFIG).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) >= 3
