"""Small literal tables: hand-checkable inputs for the plans."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from tillworks.sources import schemas
from tillworks.sources.tables import SalesTables

CUSTOMERS = [(i, f"C{i}", "budget" if i % 2 else "family", "Porto") for i in range(1, 9)]
PRODUCTS = [(1, "P1", "snacks", 10.0), (2, "P2", "snacks", 10.0), (3, "P3", "dairy", 5.0), (4, "P4", "snacks", 1.0)]
STORES = [(1, "S1", "north"), (2, "S2", "south"), (3, "S3", "south")]


def line(item: int, tx: int, product: int, net: str, quantity: int = 1, pct: int = 0):
    amount = Decimal(net)
    return (item, tx, product, quantity, amount / quantity, pct, amount, Decimal("0.00"), amount)


def tables(spark, transactions, items, customers=CUSTOMERS, products=PRODUCTS, stores=STORES) -> SalesTables:
    rows = {
        "customers": customers,
        "products": products,
        "stores": stores,
        "transactions": transactions,
        "sales_items": items,
    }
    return SalesTables.of({n: spark.createDataFrame(r, schemas.SOURCES[n]) for n, r in rows.items()})


def tx(number: int, day: date, customer: int = 1, store: int = 1, method: str = "card"):
    return (number, day, customer, store, method)


def rows(df) -> list[tuple]:
    return [tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in df.collect()]
