"""A cross-section of the registered queries against DuckDB; ``compare.py`` runs all of them."""

import pytest

from compare import compare, connect
from panelkit.plans import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
CHECKED = ["scan_facts", "clean_facts", "panel_features", "calendar_lag", "describe_all", "value_share", "chart_box", "top_sectors",
           "anova_two_way", "mann_whitney", "kruskal", "fdr_bh", "ols_coef", "forecast_table", "bigrams", "top_terms_by_group",
           "knn_classify", "roc_curve", "davies_bouldin", "adjusted_mutual_info"]


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_entry_point_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
    assert len({q for q in QUERIES if q not in ORACLES}) <= 5
