"""The monthly summary per store, kept up to date from what a load brings.

Its state can be merged: sums in cents, and the sets of transactions and customers as bitmaps by bucket of ids. A load adds the
state of its own rows, in the same change as the rows; nothing that was loaded before is read. A transaction or
customer that comes again sets bits that are set, so counts of distinct ones stay exact. The view merges the loads;
``compact`` writes them as one. Ids are whole numbers from 0 on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.functions import calendar, money
from tillworks.sources.store import Change, Store

_GROUP = ["year_num", "month_num", "store_id"]


class MonthlySummary:
    """The tables ``<name>_sums`` and ``<name>_sets`` of a store."""

    def __init__(self, store: Store, name: str = "months"):
        self.store, self.sums, self.sets = store, f"{name}_sums", f"{name}_sets"
        group = "year_num int, month_num int, store_id bigint"
        self.sums_schema = T.StructType.fromDDL(f"{group}, net_cents bigint")
        self.sets_schema = T.StructType.fromDDL(f"{group}, kind string, bucket bigint, bits binary")

    def add(self, change: Change, rows: DataFrame) -> None:
        """State of rows with transaction_id, transaction_date, customer_id, store_id and net_cents, lines or totals."""
        day = F.col("transaction_date")
        dated = rows.select(
            F.year(day).alias("year_num"), F.month(day).alias("month_num"), "store_id", "net_cents", "transaction_id", "customer_id"
        )
        change.append(self.sums, dated.groupBy(*_GROUP).agg(F.sum("net_cents").alias("net_cents")))
        ids = F.stack(F.lit(2), F.lit("transactions"), F.col("transaction_id"), F.lit("customers"), F.col("customer_id"))
        each = dated.select(*_GROUP, ids.alias("kind", "id")).where("id IS NOT NULL")
        bucket, bit = F.bitmap_bucket_number("id").alias("bucket"), F.bitmap_bit_position("id").alias("bit")
        placed = each.select(*_GROUP, "kind", bucket, bit)
        change.append(self.sets, placed.groupBy(*_GROUP, "kind", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))

    def _state(self) -> tuple[DataFrame, DataFrame]:
        sums = self.store.read(self.sums, self.sums_schema).groupBy(*_GROUP).agg(F.sum("net_cents").alias("net_cents"))
        sets = self.store.read(self.sets, self.sets_schema).groupBy(*_GROUP, "kind", "bucket")
        return sums, sets.agg(F.bitmap_or_agg("bits").alias("bits"))

    def compact(self, change: Change) -> None:
        sums, sets = self._state()
        change.replace(self.sums, sums)
        change.replace(self.sets, sets)

    def view(self) -> DataFrame:
        """year_num, month_num, store_id, month_start, revenue, transactions and unique_customers."""
        sums, sets = self._state()

        def size(kind: str) -> Column:
            return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bitmap_count("bits"))), F.lit(0))

        counts = sets.groupBy(*_GROUP).agg(size("transactions").alias("transactions"), size("customers").alias("unique_customers"))
        same = [sums[c].eqNullSafe(counts[c]) for c in _GROUP]
        return sums.join(counts, same).select(
            *[sums[c] for c in _GROUP],
            calendar.first_of_month(sums["year_num"], sums["month_num"]).alias("month_start"),
            money.amount(F.col("net_cents")).alias("revenue"),
            "transactions",
            "unique_customers",
        )
