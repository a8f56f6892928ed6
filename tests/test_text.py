from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brandlink.functions import text as X

SLUG_CASES = [("M&M's", "METM S"), ("Côte d'Or 1,5L", "COTE D OR 15L"),
              ("  L'Oréal--Paris ", "L OREAL PARIS"), ("Bœuf & Cie.", "BOEUF ET CIE"),
              ("***", ""), ("Straße", "STRASSE"), (None, None)]


def one(spark, col_expr, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(col_expr).collect()]


def test_slug_fixtures(spark):
    got = one(spark, X.slug("x", [("&", "et")]), [c for c, _ in SLUG_CASES])
    assert got == [e for _, e in SLUG_CASES]


def test_slug_compact(spark):
    assert one(spark, X.slug_compact("x"), ["Brând#12 Small", "a-b c"]) == ["brand12small", "abc"]


def test_zfill(spark):
    vals = ["123", "12345678901234567", ""]
    assert one(spark, X.zfill("x", 13), vals) == ["0000000000123", "12345678901234567",
                                                  "0000000000000"]


def test_upper_strip(spark):
    assert one(spark, X.upper_strip("x"), ["  abc \t"]) == ["ABC"]


def test_char_ngrams(spark):
    got = one(spark, F.array_join(X.char_ngrams("x"), " "), ["abcd", "a", ""])
    assert got == ["ab bc cd abc bcd abcd", "", ""]


def test_word_tokens(spark):
    got = one(spark, F.array_join(X.word_tokens("x", stopwords=None), " "),
              ["7up la vache qui rit x 1664"])
    assert got == ["la vache qui rit"]
    got = one(spark, F.array_join(X.word_tokens("x"), " "), ["7up la vache qui rit x 1664"])
    assert got == ["vache rit"]


def test_get_out_of_range(spark):
    df = spark.createDataFrame([(["a"],)], "c array<string>")
    assert df.select(F.get("c", 5)).first()[0] is None


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="aàbçé &'-,1. ßŒ", max_size=12), min_size=1, max_size=8))
def test_slug_idempotent(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    once = df.select(X.slug("x", [("&", "et")]).alias("s"))
    twice = once.select("s", X.slug("s", [("&", "et")]).alias("t")).collect()
    assert all(r.s == r.t for r in twice)
