"""Customer scores, values and labels; product classes by cumulative revenue."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.functions import calendar, labels, money
from tillworks.operators.ordering import with_ntiles, with_running_total
from tillworks.plans import models
from tillworks.sources.tables import SalesTables


def _as_of(t: SalesTables, as_of: date | None) -> Column:
    """The day recency is counted from; by default the day after the last transaction."""
    if as_of is not None:
        return F.lit(as_of)
    return t.headers.agg(F.date_add(F.max("transaction_date"), 1)).scalar()


def _rfm_scores(t: SalesTables, as_of: date | None, recency_high_is_recent: bool = False) -> DataFrame:
    base = (
        models.totals_with_headers(t)
        .groupBy("customer_id")
        .agg(
            F.max("transaction_date").alias("last_purchase"),
            F.count("*").alias("frequency"),
            F.sum("net_cents").alias("monetary"),
        )
        .select(
            "customer_id",
            F.datediff(_as_of(t, as_of), F.col("last_purchase")).alias("recency_days"),
            "frequency",
            "monetary",
        )
    )
    recency = F.desc("recency_days") if recency_high_is_recent else F.asc("recency_days")
    return with_ntiles(
        base,
        5,
        {
            "r_score": [recency, "customer_id"],
            "f_score": ["frequency", "customer_id"],
            "m_score": ["monetary", "customer_id"],
        },
    )


def rfm_scores(t: SalesTables, as_of: date | None = None, recency_high_is_recent: bool = False) -> DataFrame:
    scored = _rfm_scores(t, as_of, recency_high_is_recent)
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return scored.select(
        "customer_id",
        "recency_days",
        "frequency",
        money.amount(F.col("monetary")).alias("monetary"),
        "r_score",
        "f_score",
        "m_score",
        total.alias("rfm_total"),
        labels.rfm_label(total, F.col("r_score"), recency_high_is_recent).alias("customer_label"),
    )


def rfm_refresh(t: SalesTables, as_of: date | None = None, threshold: int = 13) -> DataFrame:
    """Rows of the score table: only Champion or Other, with the time of the refresh."""
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return _rfm_scores(t, as_of).select(
        "customer_id",
        "r_score",
        "f_score",
        "m_score",
        labels.champion_label(total, threshold).alias("label"),
        _as_of(t, as_of).cast("timestamp").alias("refreshed_at"),
    )


def customer_label(t: SalesTables, scores: DataFrame) -> DataFrame:
    """Label of every customer, 'Unknown' where the score table has none."""
    return (
        t.customers.select("customer_id")
        .join(scores.select("customer_id", "label"), "customer_id", "left")
        .select("customer_id", F.coalesce("label", F.lit("Unknown")).alias("label"))
    )


def customer_ltv(t: SalesTables) -> DataFrame:
    sums = models.totals_with_headers(t).groupBy("customer_id").agg(F.sum("net_cents").alias("net_cents"))
    return (
        t.customers.select("customer_id")
        .join(sums, "customer_id", "left")
        .select("customer_id", money.amount(F.coalesce("net_cents", F.lit(0))).alias("lifetime_value"))
    )


def customer_clv(t: SalesTables, months: int = 12) -> DataFrame:
    """Mean net amount of an active month times the horizon; months without a purchase do not count.

    Sums go to customer and month first, so the distinct months are simply the rows that are left.
    """
    monthly = (
        models.totals_with_headers(t)
        .groupBy("customer_id", calendar.month_index(F.col("transaction_date")).alias("month"))
        .agg(F.sum("net_cents").alias("net_cents"))
    )
    sums = monthly.groupBy("customer_id").agg(F.sum("net_cents").alias("net_cents"), F.count("*").alias("active_months"))
    projected = money.mean_amount(F.col("net_cents") * months, F.col("active_months"))
    return (
        t.customers.select("customer_id")
        .join(sums, "customer_id", "left")
        .select(
            "customer_id",
            F.coalesce("active_months", F.lit(0)).alias("active_months"),
            F.coalesce(projected, F.lit(0).cast("decimal(1,0)")).alias("clv"),
        )
    )


def customer_transaction_count(t: SalesTables) -> DataFrame:
    counts = t.headers.groupBy("customer_id").agg(F.count("*").alias("n"))
    return (
        t.customers.select("customer_id")
        .join(counts, "customer_id", "left")
        .select("customer_id", F.coalesce("n", F.lit(0)).alias("transaction_count"))
    )


def register_scalar_functions(spark) -> None:
    """Per-id forms over the views ``fct_sales`` and ``transactions``: revenue, lifetime value, count."""
    for name, table, key, value in [
        ("store_revenue", "fct_sales", "store_id", "coalesce(sum(net_amount), 0)"),
        ("customer_ltv", "fct_sales", "customer_id", "coalesce(sum(net_amount), 0)"),
        ("customer_transaction_count", "transactions", "customer_id", "count(*)"),
    ]:
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(wanted BIGINT) RETURNS DECIMAL(38,2) "
            f"RETURN SELECT {value} FROM {table} WHERE {key} = wanted"
        )


def abc_classes(t: SalesTables, a: float = 0.80, b: float = 0.95) -> DataFrame:
    """Product classes by cumulative share of revenue, largest first."""
    revenue = (
        t.lines.join(t.headers.select("transaction_id"), "transaction_id")
        .groupBy("product_id")
        .agg(F.sum("net_cents").alias("net_cents"))
    )
    running = with_running_total(revenue, "net_cents", [F.desc("net_cents"), "product_id"], "upto")
    total = running.agg(F.sum("net_cents")).scalar()
    share = money.divided(F.col("upto"), total)
    return running.select(
        "product_id",
        money.amount(F.col("net_cents")).alias("revenue"),
        money.percent(F.col("net_cents"), total).alias("pct_of_total"),
        money.percent(F.col("upto"), total).alias("cumulative_pct"),
        labels.abc_class(share, a, b).alias("abc_class"),
    )
