"""The five source tables as one value that every plan takes."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.functions import money

# Line amounts by the name of their column in whole cents.
AMOUNTS = {
    "unit_cents": "unit_price",
    "gross_cents": "gross_amount",
    "discount_cents": "discount_amount",
    "net_cents": "net_amount",
}


def with_amounts(lines: DataFrame) -> DataFrame:
    """Adds the DECIMAL columns to lines that come in cents."""
    return lines.selectExpr("*", *[f"CAST({c} * 0.01BD AS {money.AMOUNT}) AS {a}" for c, a in AMOUNTS.items()])


def with_cents(lines: DataFrame) -> DataFrame:
    """Adds the columns in cents to lines that come with DECIMAL amounts."""
    return lines.withColumns({c: money.cents(F.col(a)) for c, a in AMOUNTS.items()})


class SalesTables:
    """``lines`` are the sales lines without their id, ``headers`` the transactions without their store.

    Lines carry their amounts twice, as DECIMAL and in cents; a plan pays only for the columns it uses.

    A source that holds those columns passes the full tables; a source that has to derive them (see
    ``sources.parquet_mapping``) passes cheaper frames, and plans that do not need the id or the store
    do not pay for it. Frames are made on first use: opening a file costs a look at its footer.
    """

    def __init__(self, frames: dict[str, Callable[[], DataFrame]], number_lines: Callable[[DataFrame | None], DataFrame]):
        self._frames = frames
        self._number_lines = number_lines

    @cached_property
    def customers(self) -> DataFrame:
        return self._frames["customers"]()

    @cached_property
    def products(self) -> DataFrame:
        return self._frames["products"]()

    @cached_property
    def stores(self) -> DataFrame:
        return self._frames["stores"]()

    @cached_property
    def transactions(self) -> DataFrame:
        return self._frames["transactions"]()

    @cached_property
    def headers(self) -> DataFrame:
        return self._frames.get("headers", self._frames["transactions"])()

    @cached_property
    def lines(self) -> DataFrame:
        return self._frames["lines"]()

    @cached_property
    def sales_items(self) -> DataFrame:
        return self._number_lines(None)

    def sales_items_of(self, transactions: DataFrame) -> DataFrame:
        """Lines with their id, at least those of the given transactions.

        An id depends on the lines of its own transaction only, so a source that has to number lines
        numbers no others.
        """
        return self._number_lines(transactions.select("transaction_id"))

    @staticmethod
    def of(frames: dict[str, DataFrame]) -> SalesTables:
        """Tables of a source that has them all in full."""
        lines = with_cents(frames["sales_items"])
        named = {name: (lambda f=frame: f) for name, frame in frames.items()}
        return SalesTables({**named, "lines": lambda: lines}, lambda _wanted: lines)
