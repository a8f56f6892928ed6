import random

from pyspark.sql import functions as F

from brandlink.operators import links


def lcs(x, y):
    row = [0] * (len(y) + 1)
    for c in x:
        row = [0] + [max(row[j + 1], row[j] + 1) if c == d else row[j + 1] for j, d in enumerate(y)]
        for j in range(1, len(row)):
            row[j] = max(row[j], row[j - 1])
    return row[-1]


def test_character_ratio_equals_brute_force():
    rng = random.Random(0)
    text = lambda: "".join(rng.choice("abcé 日") for _ in range(rng.choice([0, 1, 3, 20, 90])))
    pairs = [(text(), text()) for _ in range(600)] + [("same", "same"), ("", ""), ("x" * 3000, "yx" * 1000)]
    left, right = map(list, zip(*pairs))
    assert links.common_lengths(left, right).tolist() == [lcs(a, b) for a, b in pairs]
    want = [100 if a == b else 0 if not a or not b else round(100 * (2 * lcs(a, b) / (len(a) + len(b)))) for a, b in pairs]
    assert links.char_ratios(left, right).tolist() == want


def model_tsr(a, b):
    import re

    def proc(s):
        s = "".join(c for c in s if ord(c) < 128)
        return re.sub(r"[^A-Za-z0-9_]", " ", s).lower().strip()

    def ratio(x, y):
        if x == y:
            return 100
        if not x or not y:
            return 0
        return int(round(100 * 2 * lcs(x, y) / (len(x) + len(y))))

    p1, p2 = proc(a), proc(b)
    if not p1 or not p2:
        return 0
    t1, t2 = set(p1.split()), set(p2.split())
    sect = " ".join(sorted(t1 & t2))
    c12 = (sect + " " + " ".join(sorted(t1 - t2))).strip()
    c21 = (sect + " " + " ".join(sorted(t2 - t1))).strip()
    return max(ratio(sect, c12), ratio(sect, c21), ratio(c12, c21))


def test_token_set_ratio(spark):
    cases = [("danone bio", "danone"), ("", "x"), ("BRAND ET 13", "BRAND 13 SMALL"),
             ("L OREAL PARIS", "LOREAL"), ("abc def", "abd xyz"), ("Côte d'Or", "cote dor")]
    df = spark.createDataFrame(cases, "left_side string, right_side string")
    got = [r.token_set_ratio for r in links.with_token_set_ratio(df).collect()]
    assert got == [model_tsr(a, b) for a, b in cases]
    assert got[0] == 100 and got[1] == 0


def test_merge_evidence(spark):
    a = spark.createDataFrame([("a", "b", 0.3)], "left_side string, right_side string, similarity double")
    b = links.constant_score(spark.createDataFrame([("a", "b")], "left_side string, right_side string"), 1.0)
    assert links.merge_evidence(a, b).first().similarity == 1.0


def test_same_item_links_symmetric(spark):
    g = spark.createDataFrame(
        [("n", "p1", "X"), ("n", "p2", "X"), ("s", "p1", "Y"), ("s", "p2", "Y"), ("s", "p3", "Z"),
         ("n", "p3", "W")], "retailer string, product_id string, brand_desc_slug string")
    got = {(r.left_side, r.right_side) for r in links.same_item_links(g).collect()}
    assert got == {("X", "Y"), ("Y", "X")}
