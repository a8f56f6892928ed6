import numpy as np

from brandlink.operators import vectors


def test_lemmatise_keeps_unknown_and_order(spark):
    docs = spark.createDataFrame([("b1", ["chevaux", "frais", "cheval"])], "name string, words array<string>")
    lem = spark.createDataFrame([("chevaux", "cheval")], "form string, lemma string")
    got = vectors.lemmatise(docs, lem).first().words
    assert got == ["cheval", "frais", "cheval"]


def test_encode_with_user_model(spark):
    names = spark.createDataFrame([("ab",), ("abc",)], "name string")

    def enc(texts):
        return np.array([[len(t), 1.0] for t in texts])

    got = {r.name: list(r.embedding) for r in vectors.encode(names, enc).collect()}
    assert got == {"ab": [2.0, 1.0], "abc": [3.0, 1.0]}
    long = vectors.dense_to_long(vectors.encode(names, enc))
    norms = {r.name: r.n for r in long.groupBy("name").agg({"w": "sum"})
             .withColumnRenamed("sum(w)", "n").collect()}
    assert set(norms) == {"ab", "abc"}


def test_category_onehot_feature_names(spark):
    from brandlink.config import FIXTURE_CONFIG

    g = spark.createDataFrame(
        [("north", "p1", "A", "X", "Y", None), ("south", "p1", "B", "X", "Z", None),
         ("east", "p1", "C", "Q", "Q", "Q")],
        "retailer string, product_id string, brand_desc_slug string, level0 string, "
        "level1 string, level2 string")
    got = {(r.name, r.term) for r in vectors.category_onehot(g, FIXTURE_CONFIG).collect()}
    # the third retailer's levels are left out; every brand of the product gets them
    assert ("C", "level0_0_X") in got and ("A", "level1_1_Z") in got
    assert not any("_2_" in t for _, t in got)
