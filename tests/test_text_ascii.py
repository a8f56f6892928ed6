"""The quick ways of slug and word tokens give what the plain expressions give."""

from pyspark.sql import functions as F

from brandlink.functions import text as X

TEXTS = ["M&M''s 1,234,567 7up, 12,a a,12", "Œuvre d\u2019été ''n'' 1,2", "ǅ ß ŉ′x′ 'Straße' x,1", "don't stop", "été abc ab1 a-bc 9,9é",
         "naïve\u0301x caf\u00e9s", "\u212aelvin ſtop İx", "", "'", "a_b under_score x_ yy", None]


def plain_slug(c):
    out = F.lower(X.transliterate(F.regexp_replace(c, "'+", "-")))
    out = F.regexp_replace(F.regexp_replace(out, "'+", ""), r"(?<=[0-9]),(?=[0-9])", "")
    return F.upper(F.trim(F.regexp_replace(out, "[^a-z0-9]+", " ")))


def test_slug_and_tokens_as_plain(spark):
    d = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    tokens = F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)\b([a-z]{2,})\b"), 1)
    rows = d.select("text", X.slug("text").alias("s"), plain_slug(F.col("text")).alias("ps"),
                    X.word_tokens("text", None).alias("t"), tokens.alias("pt")).collect()
    for r in rows:
        assert r.s == r.ps, r.text
        assert r.t == r.pt, r.text


def test_no_pattern_searches_for_rare_letters(spark):
    """A class of many letters is slow to search, and tokens must not repeat the
    slug's expressions for each use."""
    plan = spark.createDataFrame([("a",)], "text string").select(X.word_tokens(X.slug("text")).alias("t"))
    shown = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in shown and shown.count("[^a-z0-9]+") == 1
