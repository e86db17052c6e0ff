from __future__ import annotations

from datetime import date

from fixtures import CUSTOMERS, line, rows, tables, tx
from pyspark.sql import functions as F

from tillworks.functions import labels, money
from tillworks.plans import campaign, customers, models, revenue


def monthly(spark):
    """Three months with 10.00, 0.00 and 5.00, then January of the next year with 8.00."""
    days = [date(2024, 10, 5), date(2024, 11, 5), date(2024, 12, 5), date(2025, 1, 5)]
    transactions = [tx(i, d) for i, d in enumerate(days, 1)]
    items = [line(i, i, 1, net) for i, net in enumerate(["10.00", "0.00", "5.00", "8.00"], 1)]
    return tables(spark, transactions, items)


def test_first_month_and_month_without_revenue(spark):
    got = rows(revenue.monthly_revenue_mom(monthly(spark)))
    assert [r[1:] for r in got] == [(10, None, None), (0, -10, -100), (5, 5, None), (8, 3, 60)]


def test_year_to_date_restarts_in_january(spark):
    got = rows(revenue.ytd_and_mom(monthly(spark)))
    assert [(r[0], r[2], r[4], r[5], r[6]) for r in got] == [
        (2024, "October", 10, None, None),
        (2024, "November", 10, 10, -100),
        (2024, "December", 15, 0, None),
        (2025, "January", 8, None, None),
    ]


def test_equal_revenue_shares_a_rank(spark):
    day = date(2025, 1, 1)
    t = tables(spark, [tx(1, day)], [line(1, 1, 1, "9.00"), line(2, 1, 2, "9.00"), line(3, 1, 4, "2.00")])
    got = rows(revenue.product_rank_in_category(t))
    assert [(r[1], r[3]) for r in got] == [("P1", 1), ("P2", 1), ("P4", 3)]


def test_equal_transaction_counts_share_a_dense_rank(spark):
    day = date(2025, 1, 1)
    transactions = [tx(1, day, store=1), tx(2, day, store=1), tx(3, day, store=2), tx(4, day, store=2), tx(5, day, store=3)]
    t = tables(spark, transactions, [line(i, i, 1, f"{i}.00") for i in range(1, 6)])
    got = {r[0]: r for r in rows(revenue.store_matrix(t))}
    assert {s: r[6] for s, r in got.items()} == {1: 1, 2: 1, 3: 2}
    assert {s: r[5] for s, r in got.items()} == {2: 1, 3: 2, 1: 3}


def test_half_cent_is_rounded_up(spark):
    row = spark.range(1).select(
        money.discount_amount(F.lit("16.70").cast("decimal(12,2)"), F.lit(5)).alias("a"),
        money.net_in_one_step(F.lit(1), F.lit("16.70"), F.lit(5)).alias("b"),
    )
    assert rows(row) == [(0.84, 15.87)]


def test_first_product_over_eighty_percent_is_b(spark):
    t = tables(
        spark,
        [tx(1, date(2025, 1, 1))],
        [line(1, 1, 1, "81.00"), line(2, 1, 2, "15.00"), line(3, 1, 3, "4.00")],
    )
    got = sorted(rows(customers.abc_classes(t)))
    assert [(r[0], r[3], r[4]) for r in got] == [(1, 81, "B"), (2, 96, "C"), (3, 100, "C")]


def test_scores_of_seven_customers(spark):
    """Tiles of 2, 2, 1, 1, 1; the most recent customers get recency score 1."""
    transactions, items = [], []
    for c in range(1, 8):
        for n in range(c):
            number = c * 10 + n
            transactions.append(tx(number, date(2025, 1, c), customer=c))
            items.append(line(number, number, 1, f"{c}.00"))
    got = {r[0]: r for r in rows(customers.rfm_scores(tables(spark, transactions, items), as_of=date(2025, 2, 1)))}
    assert [got[c][4] for c in range(1, 8)] == [5, 4, 3, 2, 2, 1, 1]
    assert [got[c][5] for c in range(1, 8)] == [1, 1, 2, 2, 3, 4, 5]
    assert got[7][1:4] == (25, 7, 49) and got[7][7:] == (11, "Loyal")


def test_label_ladder_tests_totals_first(spark):
    cases = spark.createDataFrame([(13, 3), (10, 1), (7, 1), (6, 2), (6, 3)], "total int, r int")
    got = cases.select(labels.rfm_label(F.col("total"), F.col("r")))
    assert [r[0] for r in rows(got)] == ["Champion", "Loyal", "Potential", "At Risk", "Need Attention"]


def test_customers_without_sales(spark):
    t = tables(spark, [tx(1, date(2025, 1, 1)), tx(2, date(2025, 3, 1))], [line(1, 1, 1, "30.00"), line(2, 2, 1, "15.00")])
    assert dict(rows(customers.customer_ltv(t)))[8] == 0 and dict(rows(customers.customer_ltv(t)))[1] == 45
    clv = {r[0]: r[1:] for r in rows(customers.customer_clv(t))}
    assert clv[8] == (0, 0) and clv[1] == (2, 270)
    found = dict(rows(customers.customer_label(t, customers.rfm_refresh(t, date(2025, 4, 1)))))
    assert found[8] == "Unknown" and found[1] == "Other"
    assert len(found) == len(CUSTOMERS)
    assert dict(rows(revenue.store_revenue(t))) == {1: 45, 2: 0, 3: 0}


W = campaign.CASE_2025


def test_baseline_divides_by_twenty_or_by_days_present(spark):
    transactions = [
        tx(1, date(2025, 11, 1)),
        tx(2, date(2025, 11, 3), method="mbway"),
        tx(3, date(2025, 11, 28), method="mbway"),
        tx(4, date(2025, 11, 29), method="mbway"),
    ]
    t = tables(spark, transactions, [line(1, 1, 1, "100.00"), line(2, 2, 1, "50.00"), line(3, 3, 1, "30.00")])
    assert rows(campaign.campaign_uplift(t, W)) == [(150, 7.5, 30, 300)]
    kpis = rows(campaign.campaign_kpis(t, W))[0]
    assert kpis[:3] == (75, 30, -60)
    assert kpis[5:] == (50, 100)
    closed = {(r[0], r[1]): r[2:] for r in rows(campaign.payment_mix_closed(t, W))}
    assert closed[("campaign", "mbway")] == (1, 100)
    assert closed[("baseline", "card")] == (1, 50)


def test_empty_windows_give_null(spark):
    t = tables(spark, [tx(1, date(2025, 1, 1))], [line(1, 1, 1, "10.00")])
    assert rows(campaign.campaign_uplift(t, W)) == [(None, None, None, None)]
    assert rows(campaign.campaign_kpis(t, W)) == [(None,) * 7]
    assert rows(campaign.payment_mix_open(t, W)) == []
    assert not any(r[4] for r in rows(campaign.campaign_signals(t, W)))


def test_running_total_and_top_customers(spark):
    transactions = [tx(1, date(2025, 1, 1), 1), tx(2, date(2025, 1, 2), 2), tx(3, date(2025, 1, 2), 3)]
    t = tables(spark, transactions, [line(i, i, 1, f"{i}0.00") for i in range(1, 4)])
    assert sorted(rows(revenue.daily_store_running_total(t))) == [
        (1, date(2025, 1, 1), 10, 10),
        (1, date(2025, 1, 2), 50, 60),
    ]
    assert sorted(r[1] for r in rows(revenue.top_customers_per_store(t))) == [2, 3]


def test_scalar_functions(spark):
    t = tables(spark, [tx(1, date(2025, 1, 1), store=2)], [line(1, 1, 1, "12.50")])
    models.fct_sales(t.sales_items, t.transactions).createOrReplaceTempView("fct_sales")
    t.transactions.createOrReplaceTempView("transactions")
    customers.register_scalar_functions(spark)
    got = spark.sql(
        "SELECT store_revenue(2), store_revenue(9), customer_ltv(1), customer_ltv(8), customer_transaction_count(1)"
    )
    assert rows(got) == [(12.5, 0, 12.5, 0, 1)]


def test_calendar(spark):
    days = spark.createDataFrame([(date(2025, 11, 28),), (date(2025, 12, 1),)], "transaction_date date")
    got = sorted(rows(models.dim_date(days)))
    assert [r[0] for r in got] == [20251128, 20251129, 20251130, 20251201]
    assert got[1][2:] == (7, "Saturday", 11, "November", 4, 2025, "Y", "N")


def _below(plan: str, start: int) -> list[str]:
    """The lines of a plan under the line ``start``."""
    lines = plan.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    rest = lines[start + 1 :]
    return rest[: next((i for i, line in enumerate(rest) if depth(line) <= depth(lines[start])), len(rest))]


def test_lines_of_the_star_join_do_not_move_by_customer(spark):
    t = tables(spark, [tx(1, date(2024, 1, 5))], [line(1, 1, 1, "5.00")])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = models.flat_sales(t)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [i for i, text in enumerate(plan.splitlines()) if "Exchange hashpartitioning(customer_id" in text]
    assert moved and not any("quantity" in text for i in moved for text in _below(plan, i))
    assert rows(models.flat_sales(t).select("product_id", "customer_city", "store_region")) == [(1, "Porto", "north")]
