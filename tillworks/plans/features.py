"""Feature frames for the learning jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.functions import calendar, money
from tillworks.operators.preparation import label_codes, with_codes, with_label_codes
from tillworks.plans import models
from tillworks.session import stored
from tillworks.sources.tables import SalesTables

LINE_FEATURES = [
    "quantity",
    "unit_price",
    "discount_pct",
    "has_discount",
    "day_of_week",
    "month",
    "is_weekend",
    "category_encoded",
    "customer_city_encoded",
    "store_region_encoded",
    "payment_method_encoded",
]
_LABELS = ["customer_segment", "category", "customer_city", "store_region", "payment_method"]
VALUE_FEATURES = ["total_spent", "avg_basket", "num_transactions", "avg_quantity", "avg_discount"]
CUSTOMER_FEATURES = [*VALUE_FEATURES, "favourite_category", "preferred_payment", "store_region"]


def line_features(t: SalesTables, key: Column | None = None) -> DataFrame:
    """Eleven features per sales line, the segment code and the amount to predict.

    ``key`` is an expression over the id that takes its place: the id is long, and lines without it move more cheaply.
    The joined lines are written once, in their labels; which labels occur is read from there.
    """
    items = t.sales_items.select(
        F.col("sales_item_id") if key is None else key, "transaction_id", "product_id", "quantity", "unit_price", "discount_pct", "net_amount"
    )
    own = items.columns[0]
    # headers are wider than products, so lines meet them last
    sold = items.join(t.products.select("product_id", "category"), "product_id").drop("product_id")
    flat = stored(sold.join(models.headers_with_places(t), "transaction_id").select(
        own, "quantity", "unit_price", "discount_pct", "net_amount", "transaction_date", *_LABELS
    ))
    day = F.col("transaction_date")
    coded = with_label_codes(flat, _LABELS, labels_from=stored(flat.select(*_LABELS).distinct()))
    return coded.select(
        own,
        "quantity",
        F.col("unit_price").cast("double").alias("unit_price"),
        "discount_pct",
        (F.col("discount_pct") > 0).cast("int").alias("has_discount"),
        F.weekday(day).alias("day_of_week"),
        F.month(day).alias("month"),
        calendar.weekend_code(day).alias("is_weekend"),
        "category_encoded",
        "customer_city_encoded",
        "store_region_encoded",
        "payment_method_encoded",
        F.col("customer_segment_encoded").alias("segment_encoded"),
        F.col("net_amount").cast("double").alias("net_amount"),
    )


_SUMS = ["net_cents", "line_count", "units", "pct_points", "tickets"]


def _value_columns() -> list:
    lines, spent = F.col("line_count"), money.amount(F.col("net_cents")).cast("double")
    return [
        spent.alias("total_spent"),
        (spent / lines).alias("avg_basket"),
        F.col("tickets").alias("num_transactions"),
        (F.col("units") / lines).alias("avg_quantity"),
        (F.col("pct_points") / lines).alias("avg_discount"),
    ]


def customer_values(t: SalesTables) -> DataFrame:
    """Five features per customer, all sums over transaction totals."""
    sums = (
        models.totals_with_headers(t)
        .withColumn("tickets", F.lit(1))
        .groupBy("customer_id")
        .agg(*[F.sum(c).alias(c) for c in _SUMS])
    )
    return sums.select("customer_id", *_value_columns())


def customer_features(t: SalesTables) -> DataFrame:
    """Eight features per customer and the segment code.

    Medians and modes are taken from counts per (customer, value): at most as many rows per customer as
    there are categories, or store and payment combinations, however many lines it has. Lines meet the headers
    once, added up by transaction and product.
    """
    of_lines = ["net_cents", "line_count", "units", "pct_points"]
    per_product = t.lines.groupBy("transaction_id", "product_id").agg(
        F.sum("net_cents").alias("net_cents"),
        F.count("*").alias("line_count"),
        F.sum("quantity").alias("units"),
        F.sum("discount_pct").alias("pct_points"),
    )
    headers = t.transactions.select("transaction_id", "customer_id", "store_id", F.lower("payment_method").alias("payment"))
    bought = stored(per_product.join(headers, "transaction_id"))
    by_place = stored(
        bought.groupBy("transaction_id", "customer_id", "store_id", "payment")
        .agg(*[F.sum(c).alias(c) for c in of_lines])
        .withColumn("tickets", F.lit(1))
        .groupBy("customer_id", "store_id", "payment")
        .agg(*[F.sum(c).alias(c) for c in _SUMS])
        .join(t.stores.select("store_id", "region"), "store_id")
    )
    by_category = stored(
        bought.groupBy("customer_id", "product_id")
        .agg(F.sum("line_count").alias("n"))
        .join(t.products.select("product_id", "category"), "product_id")
        .groupBy("customer_id", "category")
        .agg(F.sum("n").alias("n"))
    )
    sold_to = by_place.select("customer_id").distinct().join(t.customers.select("customer_id", "segment"), "customer_id")
    codes = label_codes({"payment": by_place, "region": by_place, "category": by_category, "segment": sold_to})
    places = with_codes(by_place, ["payment", "region"], codes)
    sums = places.groupBy("customer_id").agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        F.percentile("region_encoded", 0.5, F.col("line_count")).alias("store_region"),
    )
    favourite = (
        with_codes(by_category, ["category"], codes)
        .groupBy("customer_id")
        .agg(F.percentile("category_encoded", 0.5, F.col("n")).alias("favourite_category"))
    )
    preferred = (
        places.groupBy("customer_id", "payment_encoded")
        .agg(F.sum("line_count").alias("n"))
        .groupBy("customer_id")
        .agg(F.min_by("payment_encoded", F.struct(-F.col("n"), F.col("payment_encoded"))).alias("preferred_payment"))
    )
    segments = with_codes(sold_to, ["segment"], codes).select("customer_id", "segment_encoded")
    return (
        sums.select("customer_id", *_value_columns(), "store_region")
        .join(favourite, "customer_id")
        .join(preferred, "customer_id")
        .join(segments, "customer_id")
        .select("customer_id", *CUSTOMER_FEATURES, "segment_encoded")
    )
