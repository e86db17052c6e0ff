"""Amounts are exact: whole cents (BIGINT) inside aggregates, DECIMAL in tables, never binary fractions.

Sums of cents stay primitive longs in generated code, where sums of DECIMAL(12,2) would allocate an object
per row, and they do not depend on row order. A total beyond 9.2e16 currency units raises an error (ANSI
mode) rather than wrapping. Ratios divide decimals (twelve fractional digits) and round half up at the
end; only the last projection turns amounts into doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AMOUNT = "decimal(12,2)"


def gross_amount(quantity: Column, unit_price: Column) -> Column:
    return F.round(quantity.cast("decimal(10,0)") * unit_price.cast(AMOUNT), 2).cast(AMOUNT)


def discount_amount(gross: Column, discount_pct: Column) -> Column:
    return F.round(gross * discount_pct.cast("decimal(5,2)") * F.lit(0.01).cast("decimal(3,2)"), 2).cast(AMOUNT)


def net_amount(gross: Column, discount: Column) -> Column:
    return (gross - discount).cast(AMOUNT)


def net_in_one_step(quantity: Column, unit_price: Column, discount_pct: Column) -> Column:
    """Net amount rounded once, at the end, as the nightly load stores it."""
    kept = F.lit(100).cast("decimal(5,2)") - discount_pct.cast("decimal(5,2)")
    exact = quantity.cast("decimal(10,0)") * unit_price.cast("decimal(10,2)") * kept
    return F.round(exact * F.lit(0.01).cast("decimal(3,2)"), 2).cast(AMOUNT)


def cents(amount: Column) -> Column:
    """Whole cents of an amount with two decimals."""
    return (amount * F.lit(100).cast("decimal(3,0)")).cast("long")


def amount(in_cents: Column) -> Column:
    """The amount with two decimals for a number of cents."""
    return in_cents.cast("decimal(20,0)") * F.lit(0.01).cast("decimal(3,2)")


def mean_amount(in_cents: Column, count: Column) -> Column:
    return amount(F.round(divided(in_cents, count), 0))


def divided(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL where the denominator is zero or NULL.

    The operand types are fixed because they decide how many digits Spark keeps: these give twelve
    fractional digits, while sums of sums (32 digits and more) would leave only six.
    """
    whole = F.nullif(denominator.cast("decimal(24,2)"), F.lit(0).cast("decimal(24,2)"))
    return numerator.cast("decimal(26,2)") / whole


def percent(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    return F.round(divided(numerator * F.lit(100).cast("decimal(3,0)"), denominator), digits)


def percent_change(value: Column, before: Column, digits: int = 2) -> Column:
    return percent(value - before, before, digits)


def presented(df: DataFrame) -> DataFrame:
    """Final projection: decimal columns become doubles, everything else stays."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
