"""Class ladders. The order of the branches is part of the meaning."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def period(day: Column, windows: dict[str, tuple[date, date | None]]) -> Column:
    """Name of the first window that holds ``day``; an open window has no end; else 'other'."""
    label = None
    for name, (start, end) in windows.items():
        inside = day >= F.lit(start) if end is None else day.between(F.lit(start), F.lit(end))
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return label.otherwise("other")


def rfm_label(total: Column, recency_score: Column, recency_high_is_recent: bool = False) -> Column:
    """Totals are tested first, so 'At Risk' is only reached below 7.

    Scores come from NTILE over ascending recency days, which gives 1 to the most recent customers;
    ``recency_high_is_recent`` states that the caller turned the score round.
    """
    at_risk = recency_score <= 2
    return (
        F.when(total >= 13, "Champion")
        .when(total >= 10, "Loyal")
        .when(total >= 7, "Potential")
        .when(at_risk, "At Risk")
        .otherwise("Need Attention")
    )


def champion_label(total: Column, threshold: int = 13) -> Column:
    return F.when(total >= threshold, "Champion").otherwise("Other")


def abc_class(cumulative_share: Column, a: float = 0.80, b: float = 0.95) -> Column:
    """An item that crosses a limit already belongs to the next class."""
    upto_a, upto_b = F.lit(Decimal(str(a))), F.lit(Decimal(str(b)))
    return F.when(cumulative_share <= upto_a, "A").when(cumulative_share <= upto_b, "B").otherwise("C")
