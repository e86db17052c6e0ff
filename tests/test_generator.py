from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tillworks.plans import campaign, generator
from tillworks.plans.generator import GeneratorConfig, base_tables, case_tables, expected_signals
from tillworks.sources import schemas


@pytest.fixture(scope="module")
def case(spark):
    return case_tables(spark)


def test_base_tables_follow_their_rules(spark):
    config = GeneratorConfig(transactions=3000)
    t = base_tables(spark, config)
    assert (t.customers.count(), t.products.count(), t.stores.count(), t.transactions.count()) == (300, 80, 12, 3000)
    lines = t.sales_items.groupBy("transaction_id").agg(
        F.count("*").alias("n"), F.countDistinct("product_id").alias("products")
    )
    spread = lines.agg(F.min("n"), F.max("n"), F.sum(F.expr("cast(n <> products AS int)")), F.count("*")).first()
    assert tuple(spread) == (1, 5, 0, 3000)
    days = t.transactions.agg(F.min("transaction_date"), F.max("transaction_date")).first()
    assert days[0] <= date(2024, 1, 3) and days[1] >= date(2025, 12, 29)
    rules = t.sales_items.where(
        ~F.col("quantity").between(1, 4)
        | ~F.col("discount_pct").isin(generator.BASE_DISCOUNTS)
        | (F.col("gross_amount") - F.col("discount_amount") != F.col("net_amount"))
        | (F.col("gross_amount") != F.col("quantity") * F.col("unit_price"))
    )
    assert rules.isEmpty()
    for name, schema in schemas.SOURCES.items():
        frame = getattr(t, name).select(schema.names)
        assert [f.dataType for f in frame.schema] == [f.dataType for f in schema], name


def test_generation_is_repeatable_and_seeded(spark):
    def total(seed):
        t = base_tables(spark, GeneratorConfig(transactions=500, seed=seed))
        return t.sales_items.repartition(3).agg(F.sum("net_amount"), F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first()

    assert total(42) == total(42)
    assert total(42) != total(43)


def test_rolling_years_window():
    config = GeneratorConfig.last_years(2, date(2026, 1, 1), transactions=10)
    assert (config.start_date, config.end_date, config.transactions) == (date(2024, 1, 2), date(2026, 1, 1), 10)


def test_case_volumes(case):
    per_day = {r.transaction_date: r["count"] for r in case.transactions.groupBy("transaction_date").count().collect()}
    assert len(per_day) == 45
    assert 160 <= per_day[date(2025, 11, 28)] <= 220
    assert all(95 <= per_day[d] <= 140 for d in (date(2025, 11, 29), date(2025, 11, 30), date(2025, 12, 1)))
    assert all(35 <= per_day[date(2025, 11, d)] <= 55 for d in range(1, 28))
    assert case.products.groupBy("category").count().where("count <> 10").isEmpty()


def test_case_shows_the_expected_signals(spark, case):
    got = {r.signal: r for r in campaign.campaign_signals(case, campaign.CASE_2025).collect()}
    expected = {r.signal: r.expected_direction for r in expected_signals(spark).collect()}
    assert {s: r.direction for s, r in got.items()} == expected
    assert all(r.ok for r in got.values()), got


def test_case_with_odd_sizes_keeps_products_and_ids(spark, monkeypatch):
    monkeypatch.setattr(generator, "CASE_DAILY", (1500, 1500))
    config = GeneratorConfig(
        customers=10, products=61, stores=2, transactions=0, start_date=date(2025, 11, 1), end_date=date(2025, 11, 2), seed=1
    )
    t = case_tables(spark, config)
    assert t.products.count() == 61 and t.products.select("category").distinct().count() == 6
    assert t.transactions.count() == 3000 == t.transactions.select("transaction_id").distinct().count()
    assert t.sales_items.select("sales_item_id").distinct().count() == t.sales_items.count()
    few = GeneratorConfig(products=4, customers=5, stores=1, transactions=0, start_date=date(2025, 11, 1), end_date=date(2025, 11, 1))
    assert case_tables(spark, few).sales_items.count() > 0
