"""Staging, fact and dimension frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.functions import calendar
from tillworks.sources import schemas
from tillworks.sources.tables import SalesTables

FACT_COLUMNS = [
    "sales_item_id",
    "transaction_id",
    "transaction_date",
    "customer_id",
    "store_id",
    "payment_method",
    "product_id",
    "quantity",
    "unit_price",
    "discount_pct",
    "gross_amount",
    "discount_amount",
    "net_amount",
]


def _cast_to(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def stg_transactions(transactions: DataFrame) -> DataFrame:
    return _cast_to(transactions, schemas.TRANSACTIONS).withColumn("payment_method", F.lower(F.trim("payment_method")))


def stg_sales_items(sales_items: DataFrame) -> DataFrame:
    """Typed lines; the id keeps the type of its source (a number in files, text where it is made of the line)."""
    own = sales_items.schema["sales_item_id"].dataType
    kinds = [(f.name, own if f.name == "sales_item_id" else f.dataType) for f in schemas.SALES_ITEMS.fields]
    return sales_items.select(*[F.col(name).cast(kind).alias(name) for name, kind in kinds])


def dim_products(products: DataFrame) -> DataFrame:
    return _cast_to(products, schemas.PRODUCTS)


def fct_sales(sales_items: DataFrame, transactions: DataFrame) -> DataFrame:
    """One row per sales line, with the attributes of its transaction."""
    joined = stg_sales_items(sales_items).join(stg_transactions(transactions), "transaction_id")
    return joined.select(*FACT_COLUMNS)


def transaction_totals(lines: DataFrame) -> DataFrame:
    """Measures per transaction, amounts in cents.

    Partial sums run before the shuffle, so a transaction with very many lines reaches its task as one row
    per map task; the join to the headers then reuses this partitioning, and COUNT(DISTINCT
    transaction_id) becomes a plain count because a transaction id is a key on both sides.
    """
    return lines.groupBy("transaction_id").agg(
        F.sum("net_cents").alias("net_cents"),
        F.sum("gross_cents").alias("gross_cents"),
        F.sum("discount_cents").alias("discount_cents"),
        F.sum(F.when(F.col("discount_pct") > 0, F.col("net_cents"))).alias("discounted_net_cents"),
        F.sum(F.col("quantity") * F.col("unit_cents")).alias("list_cents"),
        F.sum("quantity").alias("units"),
        F.sum("discount_pct").alias("pct_points"),
        F.count("*").alias("line_count"),
    )


def totals_with_headers(t: SalesTables) -> DataFrame:
    return transaction_totals(t.lines).join(t.headers, "transaction_id")


def totals_with_stores(t: SalesTables) -> DataFrame:
    return transaction_totals(t.lines).join(t.transactions, "transaction_id")


def dim_date(days: DataFrame, column: str = "transaction_date") -> DataFrame:
    """Every calendar day between the first and the last day of ``days``, with its attributes."""
    span = days.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    each = span.select(F.explode(F.sequence("first", "last")).alias("day"))
    return each.select(*calendar.calendar_columns(F.col("day")))


def headers_with_places(t: SalesTables) -> DataFrame:
    """Headers with customer and store attributes. There are fewer headers than lines, so lines need not move by customer."""
    customers = t.customers.select(
        "customer_id", F.col("segment").alias("customer_segment"), F.col("city").alias("customer_city")
    )
    stores = t.stores.select("store_id", F.col("region").alias("store_region"))
    headers = t.transactions.withColumn("payment_method", F.lower(F.trim("payment_method")))
    return headers.join(customers, "customer_id").join(stores, "store_id")


def flat_sales(t: SalesTables, *, with_ids: bool = False) -> DataFrame:
    """The star join: fact lines with product, customer and store attributes."""
    items = t.sales_items if with_ids else t.lines
    products = t.products.select("product_id", "category", "product_name")
    joined = items.join(headers_with_places(t), "transaction_id").join(products, "product_id")
    return joined.select(
        *(["sales_item_id"] if with_ids else []),
        "transaction_id",
        "transaction_date",
        "customer_id",
        "store_id",
        "product_id",
        "quantity",
        "unit_price",
        "discount_pct",
        "gross_amount",
        "net_amount",
        "payment_method",
        "category",
        "product_name",
        "customer_segment",
        "customer_city",
        "store_region",
    )
