"""Which (transaction, product) pairs have been loaded: an index that is looked into without reading the fact.

Pairs lie on shelves (folders) by the hash of their transaction. Beside them lie Bloom filters: a transaction belongs to
a block and sets four of its 32,768 bits. A load first asks the filters of its transactions' blocks; what may have been
loaded, on whatever day, is then looked up on the shelves it can be on, and no other shelf is opened. New transactions, which
is what a nightly load mostly brings, open none. A filter says yes too often where blocks hold many more than
``1,000`` transactions; the answer stays right, only more shelves are opened, until ``compact`` lays them out anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.session import stored
from tillworks.sources.store import Change, Store

_HASHES = 4
_BLOCK_BITS = 32_768
_KEYS = ["transaction_id", "product_id"]


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("transaction_id"), F.lit(blocks))


def _bits() -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), "transaction_id"), F.lit(_BLOCK_BITS)) for i in range(1, _HASHES + 1)]


def _is_set(bits: str, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bits), F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), position % 8)) % 2 == 1


class PairIndex:
    """An index in the tables ``<name>_pairs`` and ``<name>_filters`` of a store; blocks and shelves stay as they are."""

    def __init__(self, store: Store, key_types: tuple[str, str] = ("bigint", "bigint"), blocks: int = 1 << 12, shelves: int = 64, name: str = "loaded"):
        self.store, self.blocks, self.shelves = store, blocks, shelves
        self.pairs, self.filters = f"{name}_pairs", f"{name}_filters"
        keys = [f"{k} {t}" for k, t in zip(_KEYS, key_types)]
        self.pairs_schema = T.StructType.fromDDL(", ".join([*keys, "shelf int"]))
        self.filters_schema = T.StructType.fromDDL("block bigint, bits binary")

    def _shelf(self) -> Column:
        return F.pmod(_block(self.blocks), F.lit(self.shelves)).cast("int")

    def _filters(self, pairs: DataFrame) -> DataFrame:
        """One row per block: partial bitmaps per task, so a block's transactions need not meet. Read from the shelves, a
        task has the blocks of few shelves only; a transaction that comes again sets the same bits."""
        set_bits = F.explode(F.array(*_bits())).alias("bit")
        each = pairs.select(_block(self.blocks).alias("block"), set_bits)
        return each.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))

    def add(self, change: Change, pairs: DataFrame) -> None:
        """Pairs (other columns are ignored) become part of the index with the change."""
        placed = pairs.select(*_KEYS).distinct().withColumn("shelf", self._shelf())
        added = change.append(self.pairs, placed.repartition("shelf", F.pmod(F.xxhash64(*_KEYS), F.lit(8))), "shelf")
        change.append(self.filters, self._filters(added))

    def compact(self, change: Change) -> None:
        """The loads of the index as one, with one filter per block."""
        change.replace(self.pairs, self.store.read(self.pairs, self.pairs_schema).distinct().repartition("shelf"), "shelf")
        merged = self.store.read(self.filters, self.filters_schema).groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))
        change.replace(self.filters, merged)

    def possible(self, rows: DataFrame) -> DataFrame:
        """Transactions of ``rows`` (with their shelf) that the filters do not rule out."""
        asked = rows.select("transaction_id").where("transaction_id IS NOT NULL").distinct()
        placed = asked.select("transaction_id", _block(self.blocks).alias("block"), self._shelf().alias("shelf"))
        filters = self.store.read(self.filters, self.filters_schema)
        hit = F.lit(True)
        for position in _bits():
            hit = hit & _is_set("bits", position)
        return placed.join(filters, "block").where(hit).select("transaction_id", "shelf").distinct()

    def known(self, rows: DataFrame) -> DataFrame:
        """The pairs of ``rows``' transactions that the index holds; reads the shelves they can be on."""
        possible = stored(self.possible(rows))
        shelves = [r.shelf for r in possible.select("shelf").distinct().collect()]  # no more than there are shelves
        pairs = self.store.read(self.pairs, self.pairs_schema).where(F.col("shelf").isin(shelves))
        return pairs.join(possible, ["transaction_id", "shelf"], "left_semi").select(*_KEYS)
