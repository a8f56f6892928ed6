"""URL filters by a rare-token rule index.

A rule is a host and path prefix or a wildcard pattern.  Both become a regular
expression over the normalised address ``//host`` + path + rest, and both hold
literal tokens (whole alphanumeric runs) that any matching address must
contain.  Each rule is indexed under the one of its tokens that is rarest over
all addresses; an address's tokens fetch its candidate rules, and only those
run their regular expression.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii


@dataclass(frozen=True)
class Rule:
    """``kind`` host: ``text`` is ``host/path``, fits the host and its
    subdomains.  ``kind`` pattern: ``*`` stands for any characters."""
    text: str
    verdict: str
    kind: str = "host"


#: The judged rules of the contract.
HOST_RULES = (
    Rule("com/", "allow"), Rule("example.com/en/", "block"),
    Rule("www.example.com/en/", "allow"), Rule("net/es/", "block"), Rule("net/fr/", "block"),
)
#: The method's own rules: addresses of logins, carts, feeds, searches, ads and
#: adult or gambling sites carry no prose worth training on.
PATTERN_RULES = tuple(Rule(p, "block", "pattern") for p in (
    "*/login/*", "*/signin/*", "*/cart/*", "*/checkout/*", "*/wp-admin/*", "*/wp-login.php*",
    "*/search/*", "*/feed/", "*/rss/*", "*/ads/*", "*/adserver/*", "*/tracking/*",
    "//*.casino/*", "*/casino/*", "*/poker/*", "*/porn/*", "*/xxx/*", "//*.xxx/*",
    "//*.adult/*", "*/viagra/*"))


def rule_regex(rule: Rule) -> str:
    """Java regular expression over ``//host`` + path + rest."""
    if rule.kind == "host":
        host, slash, path = rule.text.partition("/")
        return r"^//(?:[^/?#]*\.)?" + re.escape(host) + re.escape(slash + path)
    return "(?s)^" + ".*".join(re.escape(x) for x in rule.text.split("*"))


def rule_tokens(rule: Rule) -> list[str]:
    """Alphanumeric runs that stand whole in every matching address: those not
    next to a wildcard or to an open end."""
    text = ("/" if rule.kind == "host" else "") + rule.text
    closed = text if text.endswith("/") else text + "*"
    return [m.group().lower() for m in re.finditer(r"[0-9A-Za-z]+", closed)
            if closed[m.end():m.end() + 1] != "*" and (m.start() == 0 or closed[m.start() - 1] != "*")]


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """host (A-Z lower-cased), path and the rest; without ``://`` all empty."""
    u = F.coalesce(url, F.lit(""))
    at = F.locate("://", u)
    after = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    rest = F.regexp_extract(after, r"(?s)^[^/?#]*[^?#]*(.*)$", 1)
    return lower_ascii(host), path, rest


def judge_urls(pages: DataFrame, host_rules=HOST_RULES, pattern_rules=PATTERN_RULES,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict, matched``.

    ``rule``: the longest fitting host rule, else null.  ``verdict``: its
    verdict, else block if a pattern rule matches, else allow.  ``matched``:
    pattern rules that match (sorted).  A null address or one without ``://``
    has an empty host and path, fits no rule and is allowed.  Repeated
    addresses are judged once; rows repeat as given.
    """
    spark: SparkSession = pages.sparkSession
    rules = [*host_rules, *pattern_rules]
    u = pages.select(F.col(url_col).alias("u")).where(F.col("u").isNotNull()).distinct()
    host, path, rest = url_parts(F.col("u"))
    u = u.select("u", F.concat(F.lit("//"), host, path, rest).alias("addr"))
    tokens = u.select("u", "addr", F.explode(F.array_distinct(
        F.split(lower_ascii(F.col("addr")), "[^0-9a-z]+"))).alias("token")).where("token <> ''")
    listed = [(i, r.text, r.verdict, r.kind, rule_regex(r), t)
              for i, r in enumerate(rules) for t in rule_tokens(r)]
    schema = "i int, text string, verdict string, kind string, regex string, token string"
    lit = spark.createDataFrame(listed, schema)  # as many rows as the given rules hold tokens
    df = tokens.join(F.broadcast(lit.select("token").distinct()), "token").groupBy("token").count()
    index = (lit.join(df, "token", "left").fillna(0, ["count"]).groupBy("i", "text", "verdict", "kind", "regex")
             .agg(F.min_by("token", F.struct("count", "token")).alias("token")))
    # a rule whose tokens are all open-ended cannot be indexed: it runs on every address
    loose = [(i, r.text, r.verdict, r.kind, rule_regex(r)) for i, r in enumerate(rules)
             if not rule_tokens(r)]
    cand = tokens.join(F.broadcast(index), "token").select("u", "addr", "i", "text", "verdict", "kind", "regex")
    for i, text, verdict, kind, regex in loose:
        cand = cand.unionByName(u.where(F.col("addr").rlike(regex)).select(
            "u", "addr", F.lit(i).alias("i"), F.lit(text).alias("text"),
            F.lit(verdict).alias("verdict"), F.lit(kind).alias("kind"), F.lit(regex).alias("regex")))
    hit = cand.where(F.expr("addr rlike regex"))
    is_host = F.col("kind") == "host"
    found = hit.groupBy("u").agg(
        F.max_by(F.when(is_host, F.struct("text", "verdict")),
                 F.when(is_host, F.struct(F.length("text"), "text"))).alias("best"),
        F.sort_array(F.collect_set(F.when(~is_host, F.col("text")))).alias("matched"))
    host, path, _ = url_parts(F.col(url_col))
    p = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"),
                     F.col(url_col).alias("_u"))
    j = p.join(found, p["_u"] == found["u"], "left")
    return j.select("page_id", "host", "path", F.col("best.text").alias("rule"),
                    F.coalesce(F.col("best.verdict"), F.when(F.size("matched") > 0, "block"),
                               F.lit("allow")).alias("verdict"),
                    F.coalesce("matched", F.array().cast("array<string>")).alias("matched"))
