"""The nightly load: insert only what is not there yet."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillworks.functions import calendar, money
from tillworks.operators.pair_index import PairIndex
from tillworks.sources.store import Change, Store

LOADED_PAIR = ["transaction_id", "product_id"]


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``incoming`` whose keys are not in ``existing``; the known keys are made distinct first."""
    known = existing.select(*keys).distinct()
    return incoming.join(known, keys, "left_anti")


def load_range(loaded: DataFrame | PairIndex, transactions: DataFrame, sales_items: DataFrame, first: date, last: date) -> DataFrame:
    """New fact rows of the days ``first`` to ``last``.

    The guard is the pair (transaction, product), not the line: a pair that occurs twice in one batch
    loads twice, a pair that was loaded before never loads again, on whatever day that was. ``loaded`` is the fact, of
    which the batch's transactions are looked up, or the index of its pairs.
    """
    days = F.col("transaction_date").between(F.lit(first), F.lit(last))
    lines = transactions.where(days).join(sales_items, "transaction_id")
    return as_fact_rows(insert_if_absent(known_pairs(loaded, lines), lines, LOADED_PAIR))


def known_pairs(loaded: DataFrame | PairIndex, lines: DataFrame) -> DataFrame:
    """Loaded pairs of the transactions of ``lines``."""
    if isinstance(loaded, PairIndex):
        return loaded.known(lines)
    return loaded.join(lines.select("transaction_id").distinct(), "transaction_id", "left_semi")


def as_fact_rows(lines: DataFrame) -> DataFrame:
    """Lines with their transaction's columns, in the layout of the warehouse fact."""
    quantity, price, pct = F.col("quantity"), F.col("unit_price"), F.col("discount_pct")
    return lines.select(
        F.col("sales_item_id").alias("sales_key"),
        calendar.date_id(F.col("transaction_date")).alias("date_id"),
        "customer_id",
        "store_id",
        "product_id",
        "transaction_id",
        "quantity",
        price.cast("decimal(10,2)").alias("unit_price"),
        pct.cast("decimal(5,2)").alias("discount_pct"),
        money.gross_amount(quantity, price).alias("gross_amount"),
        money.net_in_one_step(quantity, price, pct).alias("net_amount"),
        "payment_method",
    )


def load_day(loaded: DataFrame | PairIndex, transactions: DataFrame, sales_items: DataFrame, day: date) -> DataFrame:
    return load_range(loaded, transactions, sales_items, day, day)


def month_range(year: int, month: int) -> tuple[date, date]:
    after = date(year + month // 12, month % 12 + 1, 1)
    return date(year, month, 1), date.fromordinal(after.toordinal() - 1)


def load_month(loaded: DataFrame | PairIndex, transactions: DataFrame, sales_items: DataFrame, year: int, month: int) -> DataFrame:
    """The month as one range load. A transaction has one date, so no day can see the rows of another."""
    return load_range(loaded, transactions, sales_items, *month_range(year, month))


def new_calendar_days(dim_date: DataFrame, days: DataFrame, column: str = "transaction_date") -> DataFrame:
    """Calendar rows for days that the date dimension does not hold yet."""
    seen = days.select(F.col(column).alias("day")).distinct().select(*calendar.calendar_columns(F.col("day")))
    return insert_if_absent(dim_date, seen, ["date_id"])


def run_load(fact_path: str, fresh: DataFrame) -> int:
    """Appends the new rows and returns their number, counted while they are written; a failed job commits nothing."""
    written = Observation()
    fresh.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(fact_path)
    return written.get["rows"]


def run_indexed_load(
    store: Store,
    index: PairIndex,
    fresh: DataFrame,
    table: str = "fact",
    also: Callable[[Change, DataFrame], None] | None = None,
) -> int:
    """Appends the new rows to a table of the store, and their pairs to the index, in one change; returns their number.

    ``also`` writes what else follows from the written rows, as a part of the same change.
    """
    written = Observation()
    with store.change() as change:
        change.append(table, fresh.observe(written, F.count(F.lit(1)).alias("rows")))
        loaded = store.spark.read.schema(fresh.schema).parquet(f"{store.folder}/{table}/load={change.loads[table][-1]}")
        index.add(change, loaded)
        if also is not None:
            also(change, loaded)
    return written.get["rows"]
