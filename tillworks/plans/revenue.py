"""Revenue, ranking and volume reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillworks.functions import calendar, money
from tillworks.operators.ordering import with_ranks
from tillworks.plans import models
from tillworks.sources.tables import SalesTables


def monthly_store_revenue(t: SalesTables) -> DataFrame:
    month = calendar.year_month(F.col("transaction_date")).alias("year_month")
    per_store = models.totals_with_stores(t).groupBy(month, "store_id").agg(F.sum("net_cents").alias("net_cents"))
    named = per_store.join(t.stores.select("store_id", "store_name"), "store_id")
    return (
        named.groupBy("year_month", "store_name")
        .agg(money.amount(F.sum("net_cents")).alias("revenue"))
        .orderBy("year_month", F.desc("revenue"), "store_name")
    )


def _by_product(t: SalesTables) -> DataFrame:
    """Sums per product name and category of the lines that have a header, added up by product id before the names
    are joined."""
    sold = t.lines.join(t.headers.select("transaction_id"), "transaction_id", "left_semi")
    sums = sold.groupBy("product_id").agg(
        F.sum("net_cents").alias("net_cents"), F.sum("quantity").alias("units")
    )
    named = sums.join(t.products.select("product_id", "product_name", "category"), "product_id")
    return named.groupBy("product_name", "category").agg(
        F.sum("net_cents").alias("net_cents"), F.sum("units").alias("units")
    )


def top_products(t: SalesTables, limit: int = 10) -> DataFrame:
    return (
        _by_product(t)
        .orderBy(F.desc("net_cents"), "product_name")
        .limit(limit)
        .select(
            "product_name",
            "category",
            money.amount(F.col("net_cents")).alias("revenue"),
            F.col("units").alias("units_sold"),
        )
    )


def avg_ticket_by_segment(t: SalesTables) -> DataFrame:
    per_customer = (
        models.totals_with_headers(t)
        .groupBy("customer_id")
        .agg(F.sum("net_cents").alias("net_cents"), F.count("*").alias("tickets"))
    )
    by_segment = (
        per_customer.join(t.customers.select("customer_id", "segment"), "customer_id")
        .groupBy("segment")
        .agg(F.sum("net_cents").alias("net_cents"), F.sum("tickets").alias("tickets"))
    )
    ticket = money.mean_amount(F.col("net_cents"), F.col("tickets"))
    return by_segment.select("segment", ticket.alias("avg_ticket")).orderBy(F.desc("avg_ticket"), "segment")


def _monthly(t: SalesTables) -> DataFrame:
    month = calendar.month_date(F.col("transaction_date")).alias("month_date")
    sums = models.totals_with_headers(t).groupBy(month).agg(F.sum("net_cents").alias("net_cents"))
    return sums.select("month_date", money.amount(F.col("net_cents")).alias("revenue"))


def monthly_revenue(t: SalesTables) -> DataFrame:
    return _monthly(t).orderBy("month_date")


def monthly_revenue_mom(t: SalesTables) -> DataFrame:
    """Change against the month before; the window runs over one row per month."""
    before = F.lag("revenue").over(Window.orderBy("month_date"))
    return (
        _monthly(t)
        .withColumn("before", before)
        .select(
            "month_date",
            "revenue",
            (F.col("revenue") - F.col("before")).alias("delta_prev_month"),
            money.percent_change(F.col("revenue"), F.col("before")).alias("pct_change"),
        )
        .orderBy("month_date")
    )


def product_rank_in_category(t: SalesTables, keep: int = 5) -> DataFrame:
    """Ranks inside each category; the filter on the rank trims every map task before the shuffle."""
    ranked = _by_product(t).withColumn(
        "category_rank", F.rank().over(Window.partitionBy("category").orderBy(F.desc("net_cents")))
    )
    return (
        ranked.where(F.col("category_rank") <= keep)
        .select("category", "product_name", money.amount(F.col("net_cents")).alias("revenue"), "category_rank")
        .orderBy("category", "category_rank", "product_name")
    )


def headline_kpis(t: SalesTables) -> DataFrame:
    net, lines = F.sum("net_cents"), F.sum("line_count")
    return models.totals_with_headers(t).agg(
        F.count("*").alias("total_transactions"),
        money.amount(net).alias("total_revenue"),
        money.mean_amount(net, lines).alias("avg_line_amount"),
    )


def category_revenue(t: SalesTables) -> DataFrame:
    sums = _by_product(t).groupBy("category").agg(
        money.amount(F.sum("net_cents")).alias("revenue"), F.sum("units").alias("units_sold")
    )
    return sums.orderBy(F.desc("revenue"), "category")


def daily_revenue(t: SalesTables) -> DataFrame:
    return (
        models.totals_with_headers(t)
        .groupBy("transaction_date")
        .agg(
            money.amount(F.sum("net_cents")).alias("revenue"),
            money.amount(F.sum("discount_cents")).alias("discount_amount"),
            money.percent(F.sum("discount_cents"), F.sum("gross_cents")).alias("discount_ratio_pct"),
        )
        .orderBy("transaction_date")
    )


def ytd_and_mom(t: SalesTables) -> DataFrame:
    """Year-to-date total and growth; both restart in January."""
    day = F.col("transaction_date")
    monthly = (
        models.totals_with_headers(t)
        .groupBy(
            F.year(day).alias("year_num"), F.month(day).alias("month_num"), F.date_format(day, "MMMM").alias("month_name")
        )
        .agg(F.sum("net_cents").alias("net_cents"))
    )
    in_year = Window.partitionBy("year_num").orderBy("month_num")
    upto = in_year.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        monthly.withColumn("ytd", F.sum("net_cents").over(upto))
        .withColumn("before", F.lag("net_cents", 1).over(in_year))
        .select(
            "year_num",
            "month_num",
            "month_name",
            money.amount(F.col("net_cents")).alias("monthly_revenue"),
            money.amount(F.col("ytd")).alias("ytd_revenue"),
            money.amount(F.col("before")).alias("prev_month_revenue"),
            money.percent_change(F.col("net_cents"), F.col("before")).alias("mom_growth_pct"),
        )
        .orderBy("year_num", "month_num")
    )


def store_matrix(t: SalesTables) -> DataFrame:
    """Store figures; ``avg_ticket`` is the mean line here, as the report has always defined it."""
    stores = (
        models.totals_with_stores(t)
        .groupBy("store_id")
        .agg(
            F.sum("net_cents").alias("net_cents"),
            F.count("*").alias("total_transactions"),
            F.sum("line_count").alias("line_count"),
            F.sum("discounted_net_cents").alias("discounted_net_cents"),
        )
    )
    ranked = with_ranks(
        stores, {"revenue_rank": ("rank", "net_cents"), "volume_rank": ("dense_rank", "total_transactions")}
    )
    return ranked.select(
        "store_id",
        money.amount(F.col("net_cents")).alias("total_revenue"),
        "total_transactions",
        money.mean_amount(F.col("net_cents"), F.col("line_count")).alias("avg_ticket"),
        money.percent(F.col("discounted_net_cents"), F.col("net_cents")).alias("discounted_revenue_pct"),
        "revenue_rank",
        "volume_rank",
    ).orderBy("revenue_rank", "store_id")


def monthly_store_summary(t: SalesTables) -> DataFrame:
    """The stored monthly aggregate: revenue, transactions and unique customers per store."""
    day = F.col("transaction_date")
    return (
        models.totals_with_stores(t)
        .groupBy(F.year(day).alias("year_num"), F.month(day).alias("month_num"), "store_id")
        .agg(
            money.amount(F.sum("net_cents")).alias("revenue"),
            F.count("*").alias("transactions"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
    )


def store_revenue(t: SalesTables) -> DataFrame:
    """Revenue of every store, 0 where it sold nothing."""
    sums = models.totals_with_stores(t).groupBy("store_id").agg(F.sum("net_cents").alias("net_cents"))
    return (
        t.stores.select("store_id")
        .join(sums, "store_id", "left")
        .select("store_id", money.amount(F.coalesce("net_cents", F.lit(0))).alias("revenue"))
    )


def units_by_product(t: SalesTables) -> DataFrame:
    sums = t.lines.groupBy("product_id").agg(F.sum("quantity").alias("total_quantity_sold"))
    return sums.orderBy(F.desc("total_quantity_sold"), "product_id")


def gross_revenue_by_store(t: SalesTables) -> DataFrame:
    sums = models.totals_with_stores(t).groupBy("store_id").agg(
        money.amount(F.sum("list_cents")).alias("total_revenue")
    )
    return sums.orderBy(F.desc("total_revenue"), "store_id")


def top_customers_per_store(t: SalesTables, keep: int = 2) -> DataFrame:
    spent = models.totals_with_stores(t).groupBy("store_id", "customer_id").agg(F.sum("list_cents").alias("spent"))
    place = F.row_number().over(Window.partitionBy("store_id").orderBy(F.desc("spent"), "customer_id"))
    best = spent.withColumn("rn", place).where(F.col("rn") <= keep)
    return best.select("store_id", "customer_id", money.amount(F.col("spent")).alias("total_spent"), "rn")


def daily_store_running_total(t: SalesTables) -> DataFrame:
    """Running total per store over its days (one row per store and day enters the window)."""
    daily = (
        models.totals_with_stores(t)
        .groupBy("store_id", "transaction_date")
        .agg(F.sum("list_cents").alias("list_cents"))
    )
    upto_day = F.sum("list_cents").over(Window.partitionBy("store_id").orderBy("transaction_date"))
    return daily.select(
        "store_id",
        "transaction_date",
        money.amount(F.col("list_cents")).alias("daily_revenue"),
        money.amount(upto_day).alias("cumulative_revenue"),
    )


def table_counts(t: SalesTables) -> DataFrame:
    frames = {
        "customers": t.customers,
        "products": t.products,
        "stores": t.stores,
        "transactions": t.transactions,
        "sales_items": t.lines,
    }
    counts = None
    for name, frame in frames.items():
        one = frame.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts
