"""Every registered query against its DuckDB oracle on the sf0.001 tables (exact match)."""

import os

import pytest

from panelkit.plans.catalog import ORACLE, QUERIES, load_all
from panelkit.plans.verify import compare, duckdb_connection

SF = "/root/testdata/sf0.001"
load_all()
SLOW = {"model_gradient_boosting", "early_stop_epoch"}


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not available")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF, con)
    assert r["status"] == "exact", r


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not available")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - SLOW))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0


def test_entry_contract(spark):
    import importlib.util
    spec = importlib.util.spec_from_file_location("entry", os.path.join(os.path.dirname(__file__), "..", "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    assert set(mod.oracle_sql()) <= set(mod.queries())
    assert mod.entry(spark).count() > 0


DISTRIBUTED = ["describe_numeric", "numeric_by_target", "box_stats", "panel_summary", "payment_summary_by_target",
               "display_range", "relationship_summary", "ratio_by_target", "density_2d", "ranking_metrics",
               "roc_pr_curve", "threshold_search", "final_metrics", "stratified_group_split_ranked", "tabular_features"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not available")
@pytest.mark.parametrize("name", DISTRIBUTED)
def test_large_input_paths_match_oracle(spark, con, name):
    """Thresholds at 0: rank-search quantiles, range-partitioned prefix sums, shuffle joins."""
    keys = ("panelkit.quantiles.inMemoryLimit", "panelkit.prefix.inMemoryLimit", "panelkit.broadcast.maxRows")
    for k in keys:
        spark.conf.set(k, "0")
    try:
        r = compare(spark, name, SF, con)
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert r["status"] == "exact", r
