"""Feature correlations (A9) on columns without variance."""

import math

from brandlink.plans.queries import _correlations


def test_a_constant_feature_has_no_correlation(spark):
    f = spark.createDataFrame([(0.1, 1.0, 3), (0.2, 1.0000000000000002, 5), (0.4, 1.0, 9)], "a double, b double, c int")
    got = {(r.feature_1, r.feature_2): r["corr"] for r in _correlations(f, ["a", "b", "c"]).collect()}
    assert math.isnan(got["a", "b"]) and math.isnan(got["b", "c"])
    assert got["a", "c"] == 1.0


def test_no_rows_give_null(spark):
    f = spark.createDataFrame([], "a double, b double")
    assert [r["corr"] for r in _correlations(f, ["a", "b"]).collect()] == [None]
