"""DuckDB oracle SQL for the registered queries (same keys as ``queries``)."""

from __future__ import annotations

from ..config import FIXTURE_CONFIG as CFG
from . import oracle as o

SQL: dict[str, str] = {}
R6 = o.R6


def sql(name: str, text: str) -> None:
    SQL[name] = text


def W(variant: str = "dirty", extra: str = "", recursive: bool = False) -> str:
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + o.catalogue_ctes(variant, CFG) + (", " + extra if extra else "")


KEPT = [r.name for i, r in enumerate(CFG.retailers) if i not in CFG.exclude_retailers]
RIDX = "CASE retailer " + " ".join(f"WHEN {o.q(r.name)} THEN {i}"
                                   for i, r in enumerate(CFG.retailers)) + " END"

# ------------------------------------------------------------ catalogue layers
sql("C1_bronze", W() + " SELECT * FROM bronze")
sql("C2_silver", W() + " SELECT * FROM silver")
sql("C3_gold", W() + " SELECT * FROM gold")
sql("X1_slug_documents",
    f"SELECT doc_id, {o.slug('text', CFG.slug_replacements)} AS slug FROM documents")
sql("X3_slug_compact_documents",
    f"SELECT doc_id, {o.slug('text', (), separator='', upper=False)} AS slug FROM documents")
sql("X4_upper_strip", W() + f" SELECT retailer, ean, brand_name, "
    f"{o.upper_strip('brand_name')} AS brand_desc FROM raw")
sql("X5_zfill", W() + f" SELECT retailer, ean, {o.zfill('ean')} AS product_id FROM raw "
    f"WHERE regexp_full_match(ean, '[0-9]*')")
sql("F10_F11_X6_id_audit", W() + " SELECT retailer, count(*) AS n_rows, "
    "CAST(sum(CAST(regexp_matches(ean, '[A-Z]') AS INTEGER)) AS BIGINT) AS n_upper, "
    "CAST(sum(CAST(strlen(ean) < 13 AS INTEGER)) AS BIGINT) AS n_short FROM raw GROUP BY retailer")

# --------------------------------------------------------------- profile (C4)
A1 = ("SELECT brand_desc_slug, count(*) AS n_products FROM "
      "(SELECT DISTINCT product_id, brand_desc_slug FROM gold) GROUP BY brand_desc_slug")
sql("A1_products_per_brand", W() + " " + A1)
sql("A2_single_product_brands", W() + f" SELECT * FROM ({A1}) WHERE n_products = 1")
sql("A5_U3_brand_slugs", W() + " SELECT DISTINCT brand_desc_slug AS name FROM gold")
sql("A6_distinct_counts", W() + " SELECT retailer, count(DISTINCT product_id) AS n_products, "
    "count(DISTINCT brand_desc_slug) AS n_brands FROM gold GROUP BY retailer UNION ALL "
    "SELECT 'all', count(DISTINCT product_id), count(DISTINCT brand_desc_slug) FROM gold")
sql("A11_layer_funnel", W() + " " + " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, retailer, count(*) AS n_rows, {width} AS n_columns "
    f"FROM {layer} GROUP BY retailer"
    for layer, width in (("bronze", 5), ("silver", 6), ("gold", 6))))
_names = CFG.retailer_names
_flags = ", ".join(f"max(CASE WHEN retailer = {o.q(n)} THEN 1 ELSE 0 END) AS in_{i}"
                   for i, n in enumerate(_names))
_pairs = ", ".join(f"CAST(sum(in_{i} * in_{j}) AS BIGINT) AS {_names[i]}_{_names[j]}"
                   for i in range(3) for j in range(i + 1, 3))
sql("A12_F13_retailer_overlap", W() + f" SELECT {_pairs}, "
    f"CAST(sum(in_0 * in_1 * in_2) AS BIGINT) AS all_retailers FROM "
    f"(SELECT product_id, {_flags} FROM gold GROUP BY product_id)")
_per = ", ".join(f"r{i} AS (SELECT product_id, brand_desc_slug AS brand_desc_slug_{i} "
                 f"FROM gold WHERE retailer = {o.q(n)})" for i, n in enumerate(_names))
sql("J3_align", W(extra=_per) + " SELECT * FROM r0 FULL JOIN r1 USING (product_id) "
    "FULL JOIN r2 USING (product_id)")
sql("J4_same_products", W(extra=_per) + " SELECT * FROM r0 JOIN r1 USING (product_id)")
sql("U1_stack_diagonal", W() + " SELECT retailer, product_id, brand_desc_slug, level0, level1, "
    "level2 FROM gold WHERE retailer = 'north' UNION ALL SELECT retailer, product_id, "
    "brand_desc_slug, level0, level1, NULL FROM gold WHERE retailer = 'south'")

# ------------------------------------------------------------ links and groups
LINKS = ("lbase AS (SELECT DISTINCT retailer, product_id, brand_desc_slug AS brand FROM gold), "
         "lk AS (SELECT a.brand AS left_side, b.brand AS right_side FROM lbase a JOIN lbase b "
         "ON a.product_id = b.product_id AND a.retailer < b.retailer AND a.brand <> b.brand "
         "GROUP BY a.retailer, b.retailer, a.brand, b.brand HAVING count(*) >= 2), "
         "links AS (SELECT left_side, right_side FROM lk UNION "
         "SELECT right_side, left_side FROM lk)")
sql("L1_same_item_links", W(extra=LINKS) + " SELECT * FROM links")
sql("C10_same_item_links_simple", W("simple", LINKS) + " SELECT * FROM links")
COMPONENTS = (LINKS + ", nodes AS (SELECT DISTINCT brand_desc_slug AS name FROM gold), "
              "reach(name, other) AS (SELECT name, name FROM nodes UNION "
              "SELECT r.name, l.right_side FROM reach r JOIN links l ON l.left_side = r.other), "
              "comp AS (SELECT name, min(other) AS group_id FROM reach GROUP BY name)")
sql("G2_components", W("simple", COMPONENTS, recursive=True) + " SELECT * FROM comp")
sql("G4_identifier", W("simple", COMPONENTS + ", cnt AS (SELECT brand_desc_slug AS name, "
                       "count(*) AS n_products FROM (SELECT DISTINCT product_id, brand_desc_slug "
                       "FROM gold) GROUP BY 1)", recursive=True)
    + " SELECT name, group_id, first_value(name) OVER (PARTITION BY group_id ORDER BY "
      "n_products DESC, length(name), name) AS canonical_name FROM comp JOIN cnt USING (name)")

# -------------------------------------------------------------- similarities
NAMES = "bn AS (SELECT DISTINCT brand_desc_slug AS name FROM gold)"
COMPACT = o.slug("name", (), separator="", upper=False)
NG = NAMES + ", " + o.tfidf_ctes(
    "ng", "SELECT name FROM bn",
    f"SELECT name, unnest({o.char_ngrams(COMPACT)}) AS term FROM bn")
WD = NAMES + ", " + o.tfidf_ctes(
    "wd", "SELECT name FROM bn", f"SELECT name, unnest({o.word_tokens('name')}) AS term FROM bn")
_kept = o.in_list(KEPT)
CAT = (NAMES + ", bp AS (SELECT DISTINCT product_id, brand_desc_slug AS name FROM gold), "
       f"kept AS (SELECT product_id, {RIDX} AS ri, level0, level1, level2 FROM gold "
       f"WHERE retailer IN {_kept}), "
       "feats AS (SELECT DISTINCT product_id, 'level' || l || '_' || ri || '_' || v AS term FROM ("
       + " UNION ALL ".join(f"SELECT product_id, ri, {i} AS l, level{i} AS v FROM kept"
                            for i in CFG.classification_levels)
       + ") WHERE v IS NOT NULL), "
       "oh AS (SELECT DISTINCT bp.name, f.term FROM bp JOIN feats f USING (product_id)), "
       "cat_w AS (SELECT name, term, 1.0 / sqrt(count(*) OVER (PARTITION BY name)) AS w FROM oh)")
_lv = CFG.classification_most_relevant_level
# level values are slugs already (upper-case words), so the words are their
# lower-cased blank-separated parts
_words = (f"list_filter(list_sort(list_distinct(flatten(list(string_split(lower(v), ' '))))), "
          f"lambda x: x <> '' AND NOT list_contains({o.STOP_SQL}, x))")
CATW = (NAMES + ", bp AS (SELECT DISTINCT product_id, brand_desc_slug AS name FROM gold), "
        f"vals AS (SELECT DISTINCT product_id, level{_lv} AS v FROM gold "
        f"WHERE retailer IN {_kept} AND level{_lv} IS NOT NULL), "
        "docs0 AS (SELECT DISTINCT bp.name, vals.v FROM bp JOIN vals USING (product_id)), "
        f"docs AS (SELECT name, {o.slug(f'array_to_string({_words}, chr(32))')} AS level_slug "
        f"FROM docs0 GROUP BY name), "
        + o.tfidf_ctes("cw", "SELECT name FROM docs",
                       f"SELECT name, unnest({o.word_tokens('level_slug')}) AS term FROM docs"))
EMB = (NAMES + ", eg AS (SELECT name, unnest(" + o.char_ngrams(COMPACT, 3, 3) + ") AS g FROM bn), "
       "eb AS (SELECT name, CAST(('0x' || substr(md5(g), 1, 8))::BIGINT % 64 AS VARCHAR) AS term, "
       "count(*) AS c FROM eg GROUP BY 1, 2), "
       "emb_w AS (SELECT name, term, c / sqrt(sum(c * c) OVER (PARTITION BY name)) AS w FROM eb)")

sql("X12_char_ngrams", W(extra=NAMES) +
    f" SELECT name, array_to_string({o.char_ngrams(COMPACT)}, ' ') AS grams FROM bn")
sql("X13_word_tokens", "SELECT doc_id, array_to_string("
    + o.word_tokens(o.slug("text")) + ", ' ') AS tokens FROM documents")
sql("V3_V4_V5_tfidf_ngrams", W(extra=NG) + f" SELECT name, term, round(w, {R6}) AS w FROM ng_w")
sql("V6_vocabulary", W(extra=NG) + " SELECT DISTINCT term FROM ng_w")
sql("C8_V10_ngram_cosine", W(extra=NG) + " " +
    o.cosine_pairs_sql("ng_w", 0.2, True, True, "similarity_sg"))
sql("C9_word_cosine", W(extra=WD) + " " +
    o.cosine_pairs_sql("wd_w", 0.2, True, True, "similarity_sgWords"))
sql("C5_V1_V2_category_cosine", W(extra=CAT) + " " +
    o.cosine_pairs_sql("cat_w", 0.2, True, True, "similarity_nomenclature"))
sql("C6_category_word_cosine", W(extra=CATW) + " " +
    o.cosine_pairs_sql("cw_w", 0.2, True, True, "similarity_nomenclatureWords"))
sql("C7_V9_embedding_cosine", W(extra=EMB) + " " +
    o.cosine_pairs_sql("emb_w", 0.5, True, True, "similarity_st"))
TITLES = ("tn AS (SELECT DISTINCT name FROM (SELECT regexp_extract(html, "
          "'(?is)<title>(.*?)</title>', 1) AS name FROM pages) WHERE length(name) > 0), "
          + o.tfidf_ctes("pt", "SELECT name FROM tn",
                         f"SELECT name, unnest({o.char_ngrams(COMPACT)}) AS term FROM tn"))
sql("V10_page_title_cosine", "WITH " + TITLES + " " +
    o.cosine_pairs_sql("pt_w", 0.5, False, False, "similarity"))
_sg = o.cosine_pairs_sql("ng_w", 0.2, True, False, "similarity_sg")
sql("O3_top_k_partners", W(extra=NG) + f" SELECT left_side, right_side, similarity_sg FROM "
    f"(SELECT *, row_number() OVER (PARTITION BY left_side ORDER BY similarity_sg DESC, "
    f"right_side) AS rn FROM ({_sg})) WHERE rn <= 3")
sql("V14_top_distinct_pairs", W(extra=NG) + f" SELECT * FROM ({_sg}) WHERE left_side < right_side "
    f"AND similarity_sg < 0.999999 ORDER BY similarity_sg DESC, left_side, right_side LIMIT 10")

# ----------------------------------------------------- pair features, evidence
ALL_W = (NG + ", " + WD.replace(NAMES + ", ", "") + ", " + EMB.replace(NAMES + ", ", "") + ", "
         + CAT.replace(NAMES + ", ", "") + ", "
         + CATW.replace(NAMES + ", ", "").replace(
             "bp AS (SELECT DISTINCT product_id, brand_desc_slug AS name FROM gold), ", ""))
_SIMS = [("similarity_sgWords", "wd_w"), ("similarity_st", "emb_w"),
         ("similarity_nomenclature", "cat_w"), ("similarity_nomenclatureWords", "cw_w")]
_SG_SYM = ("SELECT left_side, right_side, s AS similarity_sg FROM (SELECT a.name AS left_side, "
           "b.name AS right_side, sum(a.w * b.w) AS s FROM ng_w a JOIN ng_w b ON a.term = b.term "
           "WHERE a.name <> b.name GROUP BY a.name, b.name) WHERE round(s, 9) >= {t}")
FEAT = (ALL_W + ", cand AS (SELECT * FROM (" + _SG_SYM.format(t=0.2) + ") WHERE similarity_sg > 0.2), "
        + ", ".join(f"f_{k} AS ({o.pair_cosine_sql('cand', w, k)})" for k, w in _SIMS)
        + ", feat AS (SELECT cand.left_side, cand.right_side, cand.similarity_sg, "
        + ", ".join(f"f_{k}.{k}" for k, _ in _SIMS) + " FROM cand "
        + " ".join(f"JOIN f_{k} USING (left_side, right_side)" for k, _ in _SIMS) + ")")
_ALL_SIMS = ["similarity_sg"] + [k for k, _ in _SIMS]
sql("L3_C11_J1_pair_features", W(extra=FEAT) + " SELECT left_side, right_side, "
    + ", ".join(f"round({c}, {R6}) AS {c}" for c in _ALL_SIMS) + " FROM feat")
_cp = [(a, b) for i, a in enumerate(_ALL_SIMS) for b in _ALL_SIMS[i + 1:]]
sql("A9_feature_correlation", W(extra=FEAT) + " " + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, round(corr({a}, {b}), {R6}) AS corr FROM feat"
    for a, b in _cp))
EVID = (NG + ", sg AS (" + _SG_SYM.format(t=0.2) + "), " + LINKS + ", ev AS (SELECT left_side, "
        "right_side, max(similarity) AS similarity FROM (SELECT left_side, right_side, "
        "similarity_sg AS similarity FROM sg UNION ALL SELECT left_side, right_side, 1.0 FROM links) "
        "GROUP BY left_side, right_side)")
sql("L4_A7_merge_evidence", W(extra=EVID) + f" SELECT left_side, right_side, "
    f"round(similarity, {R6}) AS similarity FROM ev")
sql("C14_G3_groups_from_evidence", W(extra=EVID + ", e8 AS (SELECT left_side, right_side FROM ev "
    "WHERE similarity >= 0.8), reach(name, other) AS (SELECT name, name FROM bn UNION "
    "SELECT r.name, e.right_side FROM reach r JOIN e8 e ON e.left_side = r.other), "
    "comp AS (SELECT name, min(other) AS group_id FROM reach GROUP BY name), "
    "cnt AS (SELECT brand_desc_slug AS name, count(*) AS n_products FROM (SELECT DISTINCT "
    "product_id, brand_desc_slug FROM gold) GROUP BY 1)", recursive=True)
    + " SELECT name, group_id, first_value(name) OVER (PARTITION BY group_id ORDER BY "
      "n_products DESC, length(name), name) AS canonical_name FROM comp JOIN cnt USING (name)")
sql("G5_threshold_communities", W(extra=NG + ", e AS (SELECT left_side AS a, right_side AS b FROM ("
    + _SG_SYM.format(t=0.5) + ") UNION SELECT name, name FROM bn), "
    "deg AS (SELECT a, count(*) AS deg FROM e GROUP BY a)")
    + " SELECT name, group_id FROM (SELECT e.b AS name, e.a AS group_id, row_number() OVER "
      "(PARTITION BY e.b ORDER BY d.deg DESC, e.a) AS rn FROM e JOIN deg d USING (a)) WHERE rn = 1")
_fn = "nullif(regexp_extract({c}, '[0-9]+', 0), '')"
LABELS = ("lab AS (SELECT left_side, right_side, CAST(coalesce(" + _fn.format(c="left_side")
          + " = " + _fn.format(c="right_side") + ", FALSE) AS INTEGER) AS target FROM ("
          + _SG_SYM.format(t=0.2) + ") WHERE similarity_sg > 0.2)")
sql("J2_labelled_pairs", W(extra=FEAT + ", " + LABELS) + f" SELECT left_side, right_side, "
    f"round(similarity_sg, {R6}) AS similarity_sg, target FROM feat JOIN lab "
    f"USING (left_side, right_side)")

# --------------------------------------------------------- metrics
SCORED = ("WITH scored AS (SELECT l.doc_id, l.quality AS target, d.n_chars / (d.n_chars + 1500.0) "
          "AS score FROM labels l JOIN documents d USING (doc_id)), "
          "sp AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS predicted FROM scored)")
sql("A8_class_histogram", "SELECT quality AS target, count(*) AS n FROM labels GROUP BY quality")
sql("M1_stratified_split", "SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY "
    "md5(concat_ws(chr(31), CAST(doc_id AS VARCHAR), '42'))) <= ceil(0.3 * count(*) OVER "
    "(PARTITION BY quality)) AS is_test FROM labels")
sql("M3_class_weights", f"SELECT doc_id, quality, round(count(*) OVER () / ((SELECT count(DISTINCT "
    f"quality) FROM labels) * count(*) OVER (PARTITION BY quality)), {R6}) AS weight FROM labels")
_eps = 2.220446049250313e-16
sql("M7_log_loss", SCORED + f" SELECT round(-avg(target * ln(p) + (1 - target) * ln(1 - p)), {R6}) "
    f"AS log_loss FROM (SELECT target, least(greatest(score, {_eps}), 1 - {_eps}) AS p FROM scored)")
sql("M8_roc_auc", SCORED + ", rk AS (SELECT target, rank() OVER (ORDER BY score) + "
    "(count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM scored) "
    f"SELECT round((sum(CASE WHEN target = 1 THEN r END) - sum(target) * (sum(target) + 1) / 2.0) "
    f"/ (sum(target) * sum(1 - target)), {R6}) AS auc FROM rk")
sql("M9_roc_curve", SCORED + ", sc AS (SELECT score, sum(target) AS pos, sum(1 - target) AS neg "
    "FROM scored GROUP BY score), tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM sc) "
    f"SELECT round(sum(neg) OVER w / N, {R6}) AS fpr, round(sum(pos) OVER w / P, {R6}) AS tpr, "
    f"round(score, {R6}) AS threshold FROM sc, tot WINDOW w AS (ORDER BY score DESC ROWS BETWEEN "
    "UNBOUNDED PRECEDING AND CURRENT ROW) UNION ALL SELECT 0.0, 0.0, 'inf'::DOUBLE")
sql("M10_confusion", SCORED + " " + " UNION ALL ".join(
    f"SELECT {a} AS target, {b} AS predicted, (SELECT count(*) FROM sp WHERE target = {a} AND "
    f"predicted = {b}) AS n" for a in (0, 1) for b in (0, 1)))

# ------------------------------------------------------------ dense
sql("V12_embedding_cosine", "WITH e AS (SELECT CAST(vec_id AS VARCHAR) AS name, "
    "CAST(embedding AS DOUBLE[]) AS v FROM embeddings), u AS (SELECT name, v, "
    "sqrt(list_dot_product(v, v)) AS nrm FROM e WHERE list_dot_product(v, v) > 0), "
    "p AS (SELECT a.name AS left_side, b.name AS right_side, list_dot_product(a.v, b.v) / "
    "(a.nrm * b.nrm) AS s FROM u a JOIN u b ON a.name < b.name) "
    f"SELECT left_side, right_side, round(s, {R6}) AS similarity FROM p WHERE round(s, 9) >= 0.3")

# ------------------------------------------------------------- J7, S2-S4
sql("J7_similarity_outer_join", W(extra=NG + ", " + EMB.replace(NAMES + ", ", "") + ", "
    + CAT.replace(NAMES + ", ", "") + ", sg AS (" + o.cosine_pairs_sql("ng_w", 0.2, True, True,
                                                                      "similarity_sg")
    + "), st AS (" + o.cosine_pairs_sql("emb_w", 0.5, True, True, "similarity_st")
    + "), nm AS (" + o.cosine_pairs_sql("cat_w", 0.2, True, True, "similarity_nomenclature") + ")")
    + " SELECT * FROM sg FULL JOIN st USING (left_side, right_side) "
      "FULL JOIN nm USING (left_side, right_side)")
sql("S2_S3_S4_csv_round_trip", SQL["C8_V10_ngram_cosine"])
sql("O4_preview", W() + " SELECT * FROM gold ORDER BY retailer, product_id LIMIT 5")

# ------------------------------------------------------------ V7, V11, all components
# x.y of the centred vectors: x.y - x.m - y.m + m.m, with the mean m over the names that have terms
CENTRED = (NG + ", n AS (SELECT count(DISTINCT name) AS n FROM ng_w), "
           "m AS (SELECT term, sum(w) / (SELECT n FROM n) AS m FROM ng_w GROUP BY term), "
           "mm AS (SELECT sum(m * m) AS mm FROM m), "
           "xm AS (SELECT name, sum(w * m) AS xm, sum(w * w) AS xx FROM ng_w JOIN m USING (term) GROUP BY name), "
           "len AS (SELECT name, xm, sqrt(greatest(xx - 2 * xm + mm, 0)) AS len FROM xm, mm)")
sql("V7_pca_all_lengths", W(extra=CENTRED) + f" SELECT name, round(len, {R6}) AS norm FROM len")
sql("V11_pca_cosine_all", W(extra=CENTRED) + ", dots AS (SELECT a.name AS x, b.name AS y, sum(a.w * b.w) AS d "
    "FROM ng_w a JOIN ng_w b ON a.term = b.term AND a.name < b.name GROUP BY a.name, b.name), "
    "c AS (SELECT a.name AS left_side, b.name AS right_side, "
    "(coalesce(d, 0) - a.xm - b.xm + mm) / (a.len * b.len) AS s "
    "FROM len a JOIN len b ON a.name < b.name AND a.len > 0 AND b.len > 0 CROSS JOIN mm "
    "LEFT JOIN dots ON dots.x = a.name AND dots.y = b.name) "
    f"SELECT left_side, right_side, round(s, {R6}) AS similarity FROM c WHERE round(s, 9) >= 0.3")

# ------------------------------------------------------------ best partners (O3)


def best_partners(extra: str, weights: str, k: int = 10) -> str:
    return (W(extra=extra) + f" SELECT left_side, right_side, round(s, {R6}) AS similarity FROM ("
            "SELECT *, row_number() OVER (PARTITION BY left_side ORDER BY round(s, 9) DESC, right_side) AS rn FROM ("
            "SELECT a.name AS left_side, b.name AS right_side, sum(a.w * b.w) AS s "
            f"FROM {weights} a JOIN {weights} b ON a.term = b.term AND a.name <> b.name GROUP BY a.name, b.name)) "
            f"WHERE rn <= {k}")


sql("C5_O3_category_partners", best_partners(CAT, "cat_w"))
sql("C6_O3_category_word_partners", best_partners(CATW, "cw_w"))
sql("C7_O3_embedding_partners", best_partners(EMB, "emb_w"))
sql("C8_O3_ngram_partners", best_partners(NG, "ng_w"))
sql("C9_O3_word_partners", best_partners(WD, "wd_w"))

# ------------------------------------------------------------ token-set ratio
FEAT6 = FEAT + ", " + o.token_set_ctes("cand") + ", feat6 AS (SELECT * FROM feat JOIN tsr USING (left_side, right_side))"
sql("L2_token_set_ratio", W(extra=FEAT6) + " SELECT left_side, right_side, token_set_ratio FROM tsr")
sql("L3_C11_pair_features_with_ratio", W(extra=FEAT6) + " SELECT left_side, right_side, "
    + ", ".join(f"round({c}, {R6}) AS {c}" for c in _ALL_SIMS) + ", token_set_ratio FROM feat6")
_SIX = _ALL_SIMS + ["token_set_ratio"]
sql("A9_correlation_of_six_features", W(extra=FEAT6) + " " + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, round(corr({a}, {b}), {R6}) AS corr FROM feat6"
    for i, a in enumerate(_SIX) for b in _SIX[i + 1:]))

# ------------------------------------------------------------ lemmas in the category words (X11)
_all_words = f"SELECT DISTINCT unnest(string_split(lower(level{_lv}), ' ')) AS f FROM gold"
_lemmas = f"list_transform({_words}, lambda w: coalesce(m[substr(w, 1, 1)], w))"
LEMMA = (f"lm AS (SELECT map_from_entries(list((i, l))) AS m FROM (SELECT substr(f, 1, 1) AS i, min(f) AS l "
         f"FROM ({_all_words}) WHERE f <> '' GROUP BY 1)), "
         + CATW.replace(_words, _lemmas).replace("FROM docs0 GROUP BY name", "FROM docs0, lm GROUP BY name, m"))
sql("X11_C6_lemmatised_cosine", W(extra=LEMMA) + " " +
    o.cosine_pairs_sql("cw_w", 0.2, True, True, "similarity"))

# ------------------------------------------------------------ ordered groups (G1): the pass itself, a step for each pair
ORDERED = (NG + ", gp AS (SELECT left_side AS l, right_side AS r, round(s, 9) AS s FROM (SELECT a.name AS left_side, "
           "b.name AS right_side, sum(a.w * b.w) AS s FROM ng_w a JOIN ng_w b ON a.term = b.term AND a.name < b.name "
           "GROUP BY a.name, b.name) WHERE round(s, 9) >= 0.2), "
           "go AS (SELECT *, row_number() OVER (ORDER BY s DESC, l, r) AS i FROM gp), "
           "st(i, m, n) AS (SELECT CAST(0 AS BIGINT), CAST(MAP {} AS MAP(VARCHAR, BIGINT)), CAST(0 AS BIGINT) UNION ALL "
           "SELECT go.i, CASE WHEN s >= 0.7 THEN map_concat(m, MAP {l: coalesce(m[l], m[r], n + 1), "
           "r: coalesce(m[l], m[r], n + 1)}) ELSE map_concat(MAP {l: n + 1, r: n + 2}, m) END, n + 2 "
           "FROM st JOIN go ON go.i = st.i + 1), "
           "fin AS (SELECT unnest(map_entries(m)) AS e FROM (SELECT m FROM st ORDER BY i DESC LIMIT 1)), "
           "got AS (SELECT e.key AS name, e.value AS g FROM fin UNION ALL SELECT name, -row_number() OVER () FROM bn "
           "WHERE name NOT IN (SELECT e.key FROM fin))")
sql("G1_ordered_groups", W(extra=ORDERED, recursive=True)
    + " SELECT name, min(name) OVER (PARTITION BY g) AS group_id FROM got")
