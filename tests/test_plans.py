"""Plan-shape checks: pruning and pushdown reach the scan, no cartesian
products in the core plans, and the basket aggregate needs no extra shuffle."""

import pytest

SF = "/root/testdata/sf0.01"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def qs():
    from trolley.plans.registry import load_all
    return load_all()[0]


def test_scan_pruned_pushes_filter_and_columns(spark, qs):
    p = _plan(qs["scan_pruned"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThanOrEqual(l_quantity,10.0)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double>" in p


@pytest.mark.parametrize("name", ["dim_basket", "v_monthly_revenue", "association_rules", "score_layout",
                                  "fc_metrics", "recommender_summary"])
def test_no_cartesian_product(spark, qs, name):
    p = _plan(qs[name](spark, SF))
    assert "CartesianProduct" not in p


def test_lineitem_scan_reads_only_needed_columns(spark, qs):
    p = _plan(qs["dim_basket"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double>" in p
