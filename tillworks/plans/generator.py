"""Synthetic sales data of any size: every value is a repeatable draw from the row's own key.

Nothing is drawn on the driver, so a billion transactions are generated by as many tasks as a billion
read from files, and a lost task makes the same rows again.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.functions import money
from tillworks.functions.hashing import choice, int_draw, unit_draw, weighted_choice
from tillworks.sources import schemas
from tillworks.sources.tables import SalesTables

# Names, ranges and rates of the generated data.
SEGMENTS = ["budget", "family", "premium", "business"]
CITIES = ["Lisboa", "Porto", "Braga", "Coimbra", "Faro"]
CATEGORIES = ["beverage", "bakery", "dairy", "frozen", "snacks", "cleaning"]
REGIONS = ["north", "center", "south"]
PAYMENT_METHODS = ["cash", "card", "mbway"]
BASE_PRICE = (0.90, 45.00)
BASE_DISCOUNTS = [0, 0, 0, 5, 10, 15]
QUANTITY = (1, 4)
CASE_PRICES = {
    "beverage": (1.0, 8.0),
    "bakery": (0.8, 7.0),
    "dairy": (1.2, 12.0),
    "frozen": (2.0, 18.0),
    "snacks": (0.9, 10.0),
    "cleaning": (2.5, 20.0),
}
CASE_START, CASE_END = date(2025, 11, 1), date(2025, 12, 15)
CASE_EVENT_DAY = date(2025, 11, 28)
CASE_AFTER_DAYS = (date(2025, 11, 29), date(2025, 12, 1))
CASE_DISRUPTION = (date(2025, 12, 5), date(2025, 12, 10))
CASE_SHIFT_FROM = date(2025, 11, 27)
CASE_DAILY, CASE_EVENT, CASE_AFTER = (35, 55), (160, 220), (95, 140)
CASE_DISRUPTION_RATE = 0.9
CASE_WEIGHTS, CASE_SHIFTED_WEIGHTS = [0.18, 0.62, 0.20], [0.09, 0.58, 0.33]
CASE_PROMOTED = ["snacks", "cleaning"]
CASE_EVENT_DISCOUNTS = [15, 20, 25, 30]
CASE_AFTER_DISCOUNTS = [5, 10, 15, 20]
CASE_DISRUPTION_DISCOUNTS = [10, 15, 20]
CASE_DISCOUNTS = [0, 0, 0, 5, 10]
CASE_SIGNALS = [
    (
        "bf_revenue_spike",
        "2025-11-28 vs baseline 2025-11-01..2025-11-20",
        "up",
        "Black Friday promotions and traffic surge",
    ),
    ("discount_ratio_up", "2025-11-28..2025-12-01", "up", "Aggressive campaign discounting"),
    ("mobile_payment_share_up", "from 2025-11-27 onward", "up", "Shift from cash/card to mbway during campaign"),
    ("category_mix_shift", "2025-11-28", "snacks_and_cleaning_up", "Promoted categories on Black Friday"),
]


IDS_PER_DAY = 1_000_000_000


# The default sizes, windows and seeds of both scenarios.
@dataclass(frozen=True)
class GeneratorConfig:
    customers: int = 300
    products: int = 80
    stores: int = 12
    transactions: int = 2200
    max_items: int = 5
    start_date: date = date(2024, 1, 1)
    end_date: date = date(2025, 12, 31)
    seed: int = 42

    @staticmethod
    def last_years(years: int, until: date, **sizes) -> GeneratorConfig:
        """A window of ``years`` times 365 days that ends on ``until``."""
        return GeneratorConfig(start_date=until - timedelta(days=365 * years), end_date=until, **sizes)


CASE_CONFIG = GeneratorConfig(
    customers=160, products=60, stores=8, transactions=0, start_date=CASE_START, end_date=CASE_END, seed=20251128
)


def _ids(spark: SparkSession, count: int, name: str) -> DataFrame:
    return spark.range(1, count + 1).withColumnRenamed("id", name)


def _numbered(prefix: str, key: str, digits: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(key).cast("string"), digits, "0"))


def _customers(spark: SparkSession, c: GeneratorConfig, prefix: str) -> DataFrame:
    key = F.col("customer_id")
    return _ids(spark, c.customers, "customer_id").select(
        "customer_id",
        _numbered(prefix, "customer_id", 4).alias("customer_name"),
        choice(key, f"{c.seed}:segment:", SEGMENTS).alias("segment"),
        choice(key, f"{c.seed}:city:", CITIES).alias("city"),
    )


def _stores(spark: SparkSession, c: GeneratorConfig, prefix: str) -> DataFrame:
    return _ids(spark, c.stores, "store_id").select(
        "store_id",
        _numbered(prefix, "store_id", 2).alias("store_name"),
        choice(F.col("store_id"), f"{c.seed}:region:", REGIONS).alias("region"),
    )


def _price(key: Column, seed: int, low: Column, high: Column) -> Column:
    return F.round(low + unit_draw(key, f"{seed}:price:") * (high - low), 2)


def _base_products(spark: SparkSession, c: GeneratorConfig) -> DataFrame:
    key = F.col("product_id")
    return _ids(spark, c.products, "product_id").select(
        "product_id",
        _numbered("Product ", "product_id", 3).alias("product_name"),
        choice(key, f"{c.seed}:category:", CATEGORIES).alias("category"),
        _price(key, c.seed, F.lit(BASE_PRICE[0]), F.lit(BASE_PRICE[1])).alias("unit_price"),
    )


def _case_products(spark: SparkSession, c: GeneratorConfig) -> DataFrame:
    """Products dealt over the categories in runs of equal length (the last ones may be one longer), each with the price
    range of its category."""
    key, n = F.col("product_id"), len(CATEGORIES)
    place = F.floor((key - 1) * n / c.products).cast("int") + 1
    low = F.element_at(F.array(*[F.lit(CASE_PRICES[name][0]) for name in CATEGORIES]), place)
    high = F.element_at(F.array(*[F.lit(CASE_PRICES[name][1]) for name in CATEGORIES]), place)
    return _ids(spark, c.products, "product_id").select(
        "product_id",
        _numbered("CaseProduct ", "product_id", 3).alias("product_name"),
        F.element_at(F.array(*[F.lit(name) for name in CATEGORIES]), place).alias("category"),
        _price(key, c.seed, low, high).alias("unit_price"),
    )


def _distinct_products(c: GeneratorConfig) -> Column:
    """1 to ``max_items`` different product ids for a transaction.

    More candidates are drawn than needed and repeats dropped; the first ids follow at the end so that
    even a run of repeats leaves enough.
    """
    key = F.col("transaction_id")
    wanted = int_draw(key, f"{c.seed}:items:", 1, min(c.max_items, c.products))
    drawn = F.transform(
        F.sequence(F.lit(1), F.lit(4 * c.max_items)),
        lambda i: int_draw(F.concat_ws("/", key, i), f"{c.seed}:product:", 1, c.products).cast("long"),
    )
    spare = F.sequence(F.lit(1), F.lit(c.max_items)).cast("array<bigint>")
    return F.slice(F.array_distinct(F.concat(drawn, spare)), F.lit(1), wanted)


def _with_lines(headers: DataFrame, products: DataFrame, c: GeneratorConfig, discount) -> DataFrame:
    """Sales lines of the headers; ``discount`` maps the line's key to a column of percentages."""
    chosen = headers.select("transaction_id", "transaction_date", F.posexplode(_distinct_products(c)).alias("n", "product_id"))
    priced = chosen.join(products.select("product_id", "category", "unit_price"), "product_id")
    line_key = F.concat_ws("/", "transaction_id", "product_id")
    drawn = priced.select(
        (F.col("transaction_id") * c.max_items + F.col("n")).alias("sales_item_id"),
        "transaction_id",
        "product_id",
        int_draw(line_key, f"{c.seed}:quantity:", *QUANTITY).alias("quantity"),
        F.col("unit_price").cast(money.AMOUNT).alias("unit_price"),
        discount(line_key).alias("discount_pct"),
    )
    gross = drawn.withColumn("gross_amount", money.gross_amount(F.col("quantity"), F.col("unit_price")))
    reduced = gross.withColumn("discount_amount", money.discount_amount(F.col("gross_amount"), F.col("discount_pct")))
    return reduced.withColumn("net_amount", money.net_amount(F.col("gross_amount"), F.col("discount_amount")))


def _header(c: GeneratorConfig, day: Column, payment: Column) -> list[Column]:
    key = F.col("transaction_id")
    return [
        key,
        day.alias("transaction_date"),
        int_draw(key, f"{c.seed}:customer:", 1, c.customers).cast("long").alias("customer_id"),
        int_draw(key, f"{c.seed}:store:", 1, c.stores).cast("long").alias("store_id"),
        payment.alias("payment_method"),
    ]


def base_tables(spark: SparkSession, c: GeneratorConfig = GeneratorConfig()) -> SalesTables:
    products = _base_products(spark, c)
    key = F.col("transaction_id")
    span = (c.end_date - c.start_date).days
    day = F.date_add(F.lit(c.start_date), int_draw(key, f"{c.seed}:day:", 0, span))
    headers = _ids(spark, c.transactions, "transaction_id").select(
        *_header(c, day, choice(key, f"{c.seed}:payment:", PAYMENT_METHODS))
    )
    items = _with_lines(headers, products, c, lambda k: choice(k, f"{c.seed}:discount:", BASE_DISCOUNTS))
    return SalesTables.of(
        {
            "customers": _customers(spark, c, "Customer "),
            "products": products,
            "stores": _stores(spark, c, "Store "),
            "transactions": headers,
            "sales_items": items,
        }
    )


def _case_calendar(spark: SparkSession, c: GeneratorConfig) -> DataFrame:
    """One row per day with its number of transactions."""
    days = spark.range((c.end_date - c.start_date).days + 1)
    day = F.date_add(F.lit(c.start_date), F.col("id").cast("int"))
    key = F.col("id")
    usual = int_draw(key, f"{c.seed}:volume:", *CASE_DAILY)
    volume = (
        F.when(day == F.lit(CASE_EVENT_DAY), int_draw(key, f"{c.seed}:volume:", *CASE_EVENT))
        .when(day.between(*map(F.lit, CASE_AFTER_DAYS)), int_draw(key, f"{c.seed}:volume:", *CASE_AFTER))
        .when(day.between(*map(F.lit, CASE_DISRUPTION)), F.floor(usual * F.lit(CASE_DISRUPTION_RATE)).cast("int"))
        .otherwise(usual)
    )
    return days.select(F.col("id").alias("day_no"), day.alias("day"), volume.alias("volume"))


def case_tables(spark: SparkSession, c: GeneratorConfig = CASE_CONFIG) -> SalesTables:
    """The campaign scenario: surge days, a shift of payments and promoted categories."""
    products = _case_products(spark, c)
    slots = _case_calendar(spark, c).select("day_no", "day", F.explode(F.sequence(F.lit(1), "volume")).alias("n"))
    key, day = F.col("transaction_id"), F.col("day")
    usual = weighted_choice(key, f"{c.seed}:payment:", PAYMENT_METHODS, CASE_WEIGHTS)
    shifted = weighted_choice(key, f"{c.seed}:payment:", PAYMENT_METHODS, CASE_SHIFTED_WEIGHTS)
    payment = F.when(day >= F.lit(CASE_SHIFT_FROM), shifted).otherwise(usual)
    # days count from zero and slots from one; a day's ids end where the next day's begin
    headers = slots.select((F.col("day_no") * IDS_PER_DAY + F.col("n")).alias("transaction_id"), "day").select(
        *_header(c, day, payment)
    )

    def discount(line_key: Column) -> Column:
        day, salt = F.col("transaction_date"), f"{c.seed}:discount:"
        promoted = (day == F.lit(CASE_EVENT_DAY)) & F.col("category").isin(CASE_PROMOTED)
        return (
            F.when(promoted, choice(line_key, salt, CASE_EVENT_DISCOUNTS))
            .when(day.between(*map(F.lit, CASE_AFTER_DAYS)), choice(line_key, salt, CASE_AFTER_DISCOUNTS))
            .when(day.between(*map(F.lit, CASE_DISRUPTION)), choice(line_key, salt, CASE_DISRUPTION_DISCOUNTS))
            .otherwise(choice(line_key, salt, CASE_DISCOUNTS))
        )

    return SalesTables.of(
        {
            "customers": _customers(spark, c, "CaseCustomer "),
            "products": products,
            "stores": _stores(spark, c, "CaseStore "),
            "transactions": headers,
            "sales_items": _with_lines(headers, products, c, discount),
        }
    )


def expected_signals(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CASE_SIGNALS, schemas.SIGNALS)
