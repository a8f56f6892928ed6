"""DuckDB renderings of the plans, used as the correctness oracle.

Each builder returns SQL text over the driver's pre-registered views
(``lineitem``, ``part``, ``pages``, ...).  They are independent formulations
of the same semantics (naive joins, window ranks, recursive CTEs), written
for clarity rather than speed.
"""

from __future__ import annotations

from ..config import FIXTURE_CONFIG, Config
from ..functions.stopwords import STOPWORDS
from ..functions.translit import NO_DECOMPOSITION

R6 = 6  # doubles are compared rounded to 6 digits


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


# ------------------------------------------------------------------ strings

def translit(e: str) -> str:
    out = f"strip_accents({e})"
    for src, dst in NO_DECOMPOSITION.items():
        out = f"replace({out}, {q(src)}, {q(dst)})"
    return out


def slug(e: str, replacements=(), separator: str = " ", upper: bool = True) -> str:
    out = e
    for old, new in replacements:
        out = f"replace({out}, {q(old)}, {q(new)})"
    out = f"lower({translit(out)})"
    for _ in range(2):
        out = f"regexp_replace({out}, '([0-9]),([0-9])', '\\1\\2', 'g')"
    out = f"trim(regexp_replace({out}, '[^a-z0-9]+', ' ', 'g'))"
    if separator != " ":
        out = f"replace({out}, ' ', {q(separator)})"
    return f"upper({out})" if upper else out


def upper_strip(e: str) -> str:
    return f"regexp_replace(upper({e}), '^\\s+|\\s+$', '', 'g')"


def zfill(e: str, width: int = 13) -> str:
    return f"CASE WHEN length({e}) < {width} THEN lpad({e}, {width}, '0') ELSE {e} END"


def char_ngrams(e: str, lo: int = 2, hi: int = 5) -> str:
    """List of n-grams of ``e``; use with unnest."""
    return (f"CASE WHEN length({e}) >= {lo} THEN flatten(list_transform("
            f"range({lo}, least({hi}, length({e})) + 1), lambda n: list_transform("
            f"range(1, length({e}) - n + 2), lambda i: substr({e}, i, n)))) "
            f"ELSE []::VARCHAR[] END")


STOP_SQL = "[" + ", ".join(q(w) for w in dict.fromkeys(STOPWORDS)) + "]"


def word_tokens(e: str, stop: bool = True) -> str:
    toks = f"regexp_extract_all(lower({e}), '\\b([a-z]{{2,}})\\b', 1)"
    if stop:
        toks = f"list_filter({toks}, lambda w: NOT list_contains({STOP_SQL}, w))"
    return toks


# ---------------------------------------------------------------- catalogue

def raw_catalogue(variant: str = "dirty") -> str:
    retailer = ("CASE l_suppkey % 3 WHEN 0 THEN 'north' WHEN 1 THEN 'south' "
                "ELSE 'east' END")
    crumb = ("CASE WHEN l_suppkey % 3 = 1 THEN [p_type, split_part(p_name, ' ', 1)] "
             "ELSE [p_type, split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)] END")
    if variant == "dirty":
        ean = ("CASE WHEN l_partkey % 97 = 0 THEN concat('X', CAST(l_partkey AS VARCHAR)) "
               "WHEN l_partkey % 89 = 0 THEN concat(CAST(l_partkey AS VARCHAR), '-1') "
               "WHEN l_partkey % 83 = 0 THEN '0' WHEN l_partkey % 79 = 0 THEN NULL "
               "ELSE CAST(100000000 + l_partkey AS VARCHAR) END")
        brand = ("CASE WHEN l_partkey % 71 = 0 THEN NULL "
                 "WHEN l_partkey % 67 = 0 THEN 'No Name' "
                 "WHEN l_suppkey % 3 = 0 THEN p_brand "
                 "WHEN l_suppkey % 3 = 1 THEN concat(' brand & ', substr(p_brand, 7)) "
                 "ELSE concat('Brând#', substr(p_brand, 7), ' ', p_type) END")
        where = ""
    else:
        ean = "CAST(l_partkey AS VARCHAR)"
        brand = ("CASE WHEN l_suppkey % 3 = 0 THEN p_brand "
                 "WHEN l_suppkey % 3 = 1 THEN concat('brand & ', substr(p_brand, 7)) "
                 "ELSE concat(p_brand, ' ', p_type) END")
        where = ""
    return (f"SELECT DISTINCT {retailer} AS retailer, {ean} AS ean, {brand} AS brand_name, "
            f"{crumb} AS crumb FROM lineitem JOIN part ON l_partkey = p_partkey {where}")


def _per_retailer(cfg: Config, value) -> str:
    whens = " ".join(f"WHEN retailer = {q(r.name)} THEN {value(r)}" for r in cfg.retailers)
    return f"CASE {whens} END"


def bronze(cfg: Config = FIXTURE_CONFIG, raw: str = "raw") -> str:
    levels = ", ".join(
        f"CASE WHEN {_per_retailer(cfg, lambda r, i=i: 'TRUE' if i < r.nb_levels else 'FALSE')} "
        f"THEN crumb[{i + 1}] END AS level{i}" for i in range(cfg.max_levels))
    return (f"SELECT retailer, ean AS product_id, brand_name AS brand_desc, {levels} "
            f"FROM {raw}")


def silver(cfg: Config = FIXTURE_CONFIG, bronze_name: str = "bronze") -> str:
    lv = ", ".join(f"{slug(f'level{i}')} AS level{i}" for i in range(cfg.max_levels))
    b = upper_strip("brand_desc")
    return (f"SELECT * FROM (SELECT retailer, {zfill('product_id')} AS product_id, "
            f"{b} AS brand_desc, {slug(b, cfg.slug_replacements)} AS brand_desc_slug, {lv} "
            f"FROM {bronze_name} WHERE product_id IS NOT NULL AND brand_desc IS NOT NULL "
            f"AND regexp_full_match(product_id, '[0-9]*')) "
            f"WHERE product_id <> '0000000000000'")


def gold(cfg: Config = FIXTURE_CONFIG, silver_name: str = "silver") -> str:
    allowed = _per_retailer(cfg, lambda r: f"level0 IN {in_list(r.level0)}")
    denied = _per_retailer(cfg, lambda r: f"level1 IN {in_list(r.level1_to_delete)}"
                           if r.level1_to_delete else "FALSE")
    unk = (f" AND NOT (brand_desc_slug IN {in_list(cfg.unknown_brands)})"
           if cfg.unknown_brands else "")
    return f"SELECT * FROM {silver_name} WHERE ({allowed}) AND NOT ({denied}){unk}"


def catalogue_ctes(variant: str = "dirty", cfg: Config = FIXTURE_CONFIG) -> str:
    """``raw, bronze, silver, gold`` CTE list (without the leading WITH)."""
    return (f"raw AS ({raw_catalogue(variant)}), bronze AS ({bronze(cfg)}), "
            f"silver AS ({silver(cfg)}), gold AS ({gold(cfg)})")


# ------------------------------------------------------------ tf-idf + cosine

def tfidf_ctes(prefix: str, names_sql: str, tokens_sql: str) -> str:
    """CTEs ``{prefix}_w(name, term, w)``: smoothed-idf tf-idf, L2-normalised.
    ``names_sql`` yields ``name`` (all documents, also those without terms);
    ``tokens_sql`` yields ``name, term`` with one row per occurrence."""
    p = prefix
    return (
        f"{p}_names AS ({names_sql}), {p}_tok AS ({tokens_sql}), "
        f"{p}_tf AS (SELECT name, term, count(*) AS tf FROM {p}_tok GROUP BY name, term), "
        f"{p}_df AS (SELECT term, count(*) AS df FROM {p}_tf GROUP BY term), "
        f"{p}_raw AS (SELECT t.name, t.term, t.tf * (ln((1.0 + (SELECT count(*) FROM {p}_names)) "
        f"/ (1.0 + d.df)) + 1.0) AS w FROM {p}_tf t JOIN {p}_df d USING (term)), "
        f"{p}_w AS (SELECT name, term, w / sqrt(sum(w * w) OVER (PARTITION BY name)) AS w "
        f"FROM {p}_raw)")


def cosine_pairs_sql(weights: str, min_similarity: float, symmetric: bool = True,
                     include_self: bool = False, column: str = "similarity") -> str:
    cond = {(True, True): "TRUE", (True, False): "a.name <> b.name",
            (False, True): "a.name <= b.name", (False, False): "a.name < b.name"}[
        (symmetric, include_self)]
    base = (f"SELECT a.name AS left_side, b.name AS right_side, sum(a.w * b.w) AS s "
            f"FROM {weights} a JOIN {weights} b ON a.term = b.term "
            f"WHERE {cond} GROUP BY a.name, b.name")
    return (f"SELECT left_side, right_side, round(s, {R6}) AS {column} FROM ({base}) "
            f"WHERE round(s, 9) >= {min_similarity}")


def pair_cosine_sql(pairs: str, weights: str, column: str) -> str:
    """Exact cosine for given distinct pairs (0 when no shared term), unrounded."""
    return (f"SELECT p.left_side, p.right_side, coalesce(sum(a.w * b.w), 0.0) AS {column} "
            f"FROM {pairs} p LEFT JOIN {weights} a ON a.name = p.left_side "
            f"LEFT JOIN {weights} b ON b.name = p.right_side AND b.term = a.term "
            f"GROUP BY p.left_side, p.right_side")


# ------------------------------------------------------------ token-set ratio

def _common_length(x: str, y: str) -> str:
    """Longest common subsequence: a table row for each character of ``x``, the
    running maximum of the row before and its matches."""
    row = ("list_prepend(0, list_transform(range(1, length({y}) + 1), lambda j: list_max(list_transform("
           "range(1, j + 1), lambda k: greatest(acc.r[k + 1], acc.r[k] + "
           "CASE WHEN substr({y}, k, 1) = e.c THEN 1 ELSE 0 END)))))").format(y=y)
    return (f"list_max(list_reduce(list_prepend({{'c': '', 'r': list_transform(range(length({y}) + 1), lambda i: 0)}}, "
            f"list_transform(string_split({x}, ''), lambda ch: {{'c': ch, 'r': [0]}})), "
            f"lambda acc, e: {{'c': e.c, 'r': {row}}}).r)")


def _char_ratio(x: str, y: str) -> str:
    return (f"CASE WHEN {x} = {y} THEN 100 WHEN {x} = '' OR {y} = '' THEN 0 ELSE "
            f"round_even(100 * (2 * {_common_length(x, y)} / (length({x}) + length({y}))), 0) END")


def token_set_ctes(pairs: str) -> str:
    """CTE ``tsr(left_side, right_side, token_set_ratio)`` for the pairs of a table."""
    clean = ("trim(lower(regexp_replace(regexp_replace({c}, '[^\\x00-\\x7F]', '', 'g'), '[^A-Za-z0-9_]', ' ', 'g')))")
    toks = "list_sort(list_distinct(list_filter(string_split({p}, ' '), lambda w: w <> '')))"
    return (
        f"tp AS (SELECT left_side, right_side, {clean.format(c='left_side')} AS p1, {clean.format(c='right_side')} AS p2 FROM {pairs}), "
        f"tt AS (SELECT *, {toks.format(p='p1')} AS t1, {toks.format(p='p2')} AS t2 FROM tp), "
        "td AS (SELECT *, list_filter(t1, lambda w: list_contains(t2, w)) AS sect, "
        "list_filter(t1, lambda w: NOT list_contains(t2, w)) AS d12, list_filter(t2, lambda w: NOT list_contains(t1, w)) AS d21 FROM tt), "
        "ts AS (SELECT *, array_to_string(sect, ' ') AS s, trim(array_to_string(list_concat(sect, d12), ' ')) AS c12, "
        "trim(array_to_string(list_concat(sect, d21), ' ')) AS c21 FROM td), "
        "tsr AS (SELECT left_side, right_side, CAST(CASE WHEN p1 = '' OR p2 = '' THEN 0 "
        "WHEN len(sect) > 0 AND (len(d12) = 0 OR len(d21) = 0) THEN 100 ELSE "
        f"greatest({_char_ratio('s', 'c12')}, {_char_ratio('s', 'c21')}, {_char_ratio('c12', 'c21')}) END AS INTEGER) "
        "AS token_set_ratio FROM ts)")
