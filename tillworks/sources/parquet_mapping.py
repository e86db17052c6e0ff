"""Reads the parquet test tables and gives them the shape of the sales schema.

A store is the customer's nation, the payment method the order priority, the category the part type.
The files carry no line id, so one is made of the order, a digest of the line's own content, and the number of
the copy where an order holds the same line more than once. It depends on nothing else: ids stay as they are when
other lines come or go.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.session import stored
from tillworks.sources.tables import SalesTables, with_amounts

_LINE_CONTENT = [
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_shipdate",
    "floor(l_quantity * 100 + 0.5D)",
    "floor(l_extendedprice * 100 + 0.5D)",
    "floor(l_discount * 100 + 0.5D)",
    "floor(l_tax * 100 + 0.5D)",
    "l_returnflag",
    "l_linestatus",
]

# Declared, so that no footer is read to find them out.
_FILES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz,"
        " o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
        " l_shipdate timestamp_ntz"
    ),
}


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_FILES[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.lower("c_mktsegment").alias("segment"),
        F.col("n_name").alias("city"),
    )


def _products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("product_name"),
        F.lower("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"),
    )


def _stores(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("long").alias("store_id"),
        F.col("n_name").alias("store_name"),
        F.lower("r_name").alias("region"),
    )


def _headers(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("payment_method"),
    )


def _transactions(headers: DataFrame, customer: DataFrame) -> DataFrame:
    homes = customer.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").cast("long").alias("store_id")
    )
    # an order of an unknown customer stays, without a store: the quality report counts it
    return headers.join(homes, "customer_id", "left").select(
        "transaction_id", "transaction_date", "customer_id", "store_id", "payment_method"
    )


def _line_columns(lineitem: DataFrame, *extra: str) -> DataFrame:
    """Line columns; every expression stays on one row, so no shuffle is needed.

    Prices and discounts are doubles that stand for two decimals, hence the floor of x * 100 + 0.5.
    """
    typed = lineitem.selectExpr(
        *extra,
        "l_orderkey AS transaction_id",
        "l_partkey AS product_id",
        "CAST(l_quantity AS INT) AS quantity",
        "CAST(floor(l_discount * 100 + 0.5D) AS INT) AS discount_pct",
        "floor(l_extendedprice * 100 + 0.5D) AS gross_cents",
    )
    priced = typed.selectExpr(
        "*",
        "CASE WHEN quantity <> 0 THEN (2 * gross_cents + quantity) div (2 * quantity) END AS unit_cents",
        "(gross_cents * discount_pct + 50) div 100 AS discount_cents",
    )
    return with_amounts(priced.selectExpr("*", "gross_cents - discount_cents AS net_cents"))


def _numbered_lines(lineitem: DataFrame, wanted: DataFrame | None) -> DataFrame:
    """Lines with their id. Only lines that share eight bytes of hash with another are brought together to number their
    copies (equal lines do; what does so by chance is the first of its own content), all others stay where they are.
    """
    if wanted is not None:
        # written once, and met by a list of known size: the lines of few orders are found without moving all the others
        listed = stored(wanted.select(F.col("transaction_id").alias("wanted_id")))
        lineitem = stored(lineitem.join(listed, lineitem.l_orderkey == listed.wanted_id, "left_semi"))
    content = ", ".join(f"coalesce(CAST({c} AS STRING), '')" for c in _LINE_CONTENT)
    digested = lineitem.withColumn("digest", F.expr(f"md5(concat_ws('|', {content}))"))
    mark = F.xxhash64("l_orderkey", "digest")
    # partial counts, so no order is too long; stored, so that Spark knows how short the list is
    repeated = stored(digested.groupBy(mark.alias("mark")).agg(F.count("*").alias("n")).where("n > 1").select("mark"))
    same = mark == repeated.mark
    single = digested.join(repeated, same, "left_anti").withColumn("copy", F.lit(1).cast("long"))
    counted = digested.join(repeated, same, "left_semi").groupBy(*digested.columns).agg(F.count("*").alias("copies"))
    each = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*single.columns)
    return _line_columns(single.unionByName(each), "concat_ws('-', l_orderkey, digest, copy) AS sales_item_id")


def parquet_tables(spark: SparkSession, folder: str) -> SalesTables:
    @cache
    def read(name: str) -> DataFrame:
        return _read(spark, folder, name)

    return SalesTables(
        {
            "customers": lambda: _customers(read("customer"), read("nation")),
            "products": lambda: _products(read("part")),
            "stores": lambda: _stores(read("nation"), read("region")),
            "transactions": lambda: _transactions(_headers(read("orders")), read("customer")),
            "headers": lambda: _headers(read("orders")),
            "lines": lambda: _line_columns(read("lineitem")),
        },
        lambda wanted: _numbered_lines(read("lineitem"), wanted),
    )


def lines_in_time(spark: SparkSession, folder: str) -> DataFrame:
    """(transaction, product) of the lines shipped no later than their order day, of all days."""
    orders = _read(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    lines = _read(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).where(F.col("l_shipdate") <= F.col("o_orderdate"))
    return joined.select(F.col("l_orderkey").alias("transaction_id"), F.col("l_partkey").alias("product_id"))
