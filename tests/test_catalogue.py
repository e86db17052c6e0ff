"""Every query with SQL is compared with DuckDB over the whole smallest tables."""

from __future__ import annotations

import pytest
from oracle_check import connect, difference

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_entry_has_rows(spark):
    assert entry(spark).columns == ["month_date", "revenue", "delta_prev_month", "pct_change"]
    assert entry(spark).count() > 12


def test_totals_agree_across_reports(spark):
    def total(name, column):
        return round(sum(r[column] for r in QUERIES[name](spark, SF_DIR).collect()), 2)

    kpi = total("headline_kpis", "total_revenue")
    assert kpi == total("monthly_revenue", "revenue") == total("monthly_store_revenue", "revenue")
    assert kpi == total("category_revenue", "revenue") == total("abc_pareto", "revenue")
    shares = QUERIES["payment_mix_open"](spark, SF_DIR).groupBy("period").sum("share_pct").collect()
    assert all(abs(r[1] - 100) < 0.05 for r in shares)


def pushed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_windows_reach_the_scan(spark):
    plan = pushed(QUERIES["campaign_uplift"](spark, SF_DIR))
    assert "GreaterThanOrEqual(o_orderdate,1997-11-01" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in plan


def test_windows_of_labelled_reports_reach_the_scan(spark):
    for name in ("payment_mix_open", "payment_mix_closed", "category_mix_long", "category_mix_wide"):
        assert "GreaterThanOrEqual(o_orderdate,1997-11-01" in pushed(QUERIES[name](spark, SF_DIR)), name


def test_signals_read_the_lines_once(spark):
    plan = pushed(QUERIES["campaign_signals"](spark, SF_DIR))
    assert plan.count("lineitem.parquet") == 1 and plan.count("orders.parquet") == 1


def test_ranks_are_trimmed_before_the_shuffle(spark):
    for name in ("product_rank_in_category", "top2_customers_per_store"):
        assert "WindowGroupLimit" in pushed(QUERIES[name](spark, SF_DIR))


def test_no_report_uses_a_nested_loop_join_or_a_python_worker(spark):
    for name in sorted(set(ORACLES) - {"dbscan_clusters", "dbscan_counts", "dbscan_silhouette"}):
        plan = pushed(QUERIES[name](spark, SF_DIR))
        for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "ArrowEvalPython", "BatchEvalPython"):
            assert bad not in plan, (name, bad)
