"""Least squares by normal equations.

The Gram matrix of whole-number columns is one aggregate with exact sums, whatever the number of rows. It has as many rows
as there are columns, so the equations are solved where the plan is made, in fractions: no rounding, and a column that
depends on others is found out exactly and gets the coefficient 0.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EXACT = "decimal(38, 0)"


def gram(rows: DataFrame, columns: list[str], label: str) -> list[list[int]]:
    """Sums of products of each two of (1, columns), and with the label as the last column. NULLs leave their row out."""
    named = [F.lit(1).cast("long"), *[F.col(c).cast("long") for c in columns], F.col(label).cast("long")]
    n = len(named) - 1
    pairs = [(i, j) for i in range(n) for j in range(i, n + 1)]
    rows = rows.dropna(subset=[*columns, label])
    # the largest sum that the values allow: where it fits into a long, the sum is one
    count, *edges = rows.agg(F.count("*"), *[f(c) for c in named for f in (F.min, F.max)]).first()
    largest = [max(abs(edges[2 * i] or 0), abs(edges[2 * i + 1] or 0)) for i in range(n + 1)]

    def total(i: int, j: int) -> Column:
        if count * largest[i] * largest[j] < 1 << 63:
            return F.coalesce(F.sum(named[i] * named[j]), F.lit(0))
        return F.coalesce(F.sum((named[i].cast(_EXACT) * named[j]).cast(_EXACT)), F.lit(0).cast(_EXACT))

    sums = [total(i, j) for i, j in pairs]
    found = dict(zip(pairs, rows.agg(*sums).first()))
    return [[int(found[min(i, j), max(i, j)]) for j in range(n + 1)] for i in range(n)]


def solved(matrix: list[list[int]]) -> list[Fraction]:
    """Solution of the equations (the last column is the right side) by elimination; the largest pivot comes first."""
    m = [[Fraction(v) for v in row] for row in matrix]
    n, pivots = len(m), {}
    left = set(range(n))
    for column in range(n):
        row = max(left, key=lambda r: (abs(m[r][column]), -r), default=None)
        if row is None or m[row][column] == 0:
            continue  # depends on the columns before it
        left.remove(row)
        pivots[column] = row
        m[row] = [v / m[row][column] for v in m[row]]
        for other in range(n):
            if other != row and m[other][column]:
                factor = m[other][column]
                m[other] = [v - factor * p for v, p in zip(m[other], m[row])]
    return [m[pivots[c]][n] if c in pivots else Fraction(0) for c in range(n)]


def coefficients(rows: DataFrame, columns: list[str], label: str) -> list[float]:
    """The intercept and one coefficient per column."""
    return [float(w) for w in solved(gram(rows, columns, label))]


def predicted(weights: list[float], columns: list[str]) -> Column:
    total = F.lit(weights[0])
    for w, c in zip(weights[1:], columns):
        total = total + F.lit(w) * F.col(c)
    return total
