"""Numeric identity keys: every natural key gets a number once, and keeps it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.operators.ordering import with_position
from tillworks.sources.store import Change, Store


class KeyMap:
    """A table (natural key, number) of a store, which only new keys extend.

    New keys are numbered from the largest number on, in their own order, by range partitions; no task sees more than
    its range, and a key that is there already keeps its number. NULL keys have no number. The change that extends the map
    can write what uses its numbers, so both become visible together.
    """

    def __init__(self, store: Store, key: str, kind: str, name: str):
        self.store, self.key, self.table = store, key, name
        self.schema = T.StructType.fromDDL(f"{key} {kind}, number bigint")

    def numbers(self) -> DataFrame:
        return self.store.read(self.table, self.schema)

    def extended(self, change: Change, rows: DataFrame) -> DataFrame:
        """All numbers after the change, the new keys of ``rows`` included."""
        known = self.numbers()
        new = rows.select(self.key).where(F.col(self.key).isNotNull()).distinct().join(known, self.key, "left_anti")
        last = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
        placed = with_position(new, [self.key], "number").withColumn("number", F.col("number") + last)
        added = change.append(self.table, placed.select(*self.schema.names))
        return known.unionByName(added)

    def with_numbers(self, change: Change, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` with the number of their key; the map is extended by the change."""
        numbers = self.extended(change, rows).withColumnRenamed("number", name)
        return rows.join(numbers, self.key, "left").select(*rows.columns, name)
