"""A sample of registered queries against their DuckDB oracle at sf0.001
(the full set runs with ``python tests/compare.py``)."""

import pytest

from compare import compare, duck

SF = "/root/testdata/sf0.001"
SAMPLE = ["C3_gold", "X1_slug_documents", "L1_same_item_links", "G2_components",
          "C8_V10_ngram_cosine", "C5_V1_V2_category_cosine", "L3_C11_J1_pair_features",
          "M8_roc_auc", "V12_embedding_cosine", "V7_pca_all_lengths", "V11_pca_cosine_all",
          "C8_O3_ngram_partners", "L2_token_set_ratio", "X11_C6_lemmatised_cosine", "G1_ordered_groups"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, SF, con)
    assert res["schema_ok"] and res["values_ok"], res
