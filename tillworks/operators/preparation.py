"""Label codes, train/test splits and standard scaling, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.functions.hashing import hash_number
from tillworks.operators.ordering import number_within
from tillworks.session import stored

TEST_PERCENT = 20


def label_codes(sources: dict[str, DataFrame]) -> DataFrame:
    """_column, _label, _code: the place of each value of a column in the sorted list of its values, counted from 0.

    ``sources`` names the frame that holds a column. The values of all columns are numbered together, however many there
    are: one ordering by (column, value), from which every column's numbers start anew.
    """
    labels = [df.select(F.lit(c).alias("_column"), F.col(c).alias("_label")).where("_label IS NOT NULL").distinct() for c, df in sources.items()]
    numbered = number_within(reduce(DataFrame.unionByName, labels), "_column", ["_label"], "_code")
    return stored(numbered.withColumn("_code", (F.col("_code") - 1).cast("int")))


def with_codes(df: DataFrame, columns: list[str], codes: DataFrame) -> DataFrame:
    """``<column>_encoded`` for each column; NULL has no code."""
    for c in columns:
        own = codes.where(F.col("_column") == c).select("_label", F.col("_code").alias(f"{c}_encoded"))
        df = df.join(own, df[c] == own["_label"], "left").drop("_label")
    return df


def with_label_codes(df: DataFrame, columns: list[str], labels_from: DataFrame | None = None) -> DataFrame:
    """``<column>_encoded`` of text columns; ``labels_from``: a smaller frame with the same values, where one is at hand."""
    source = df if labels_from is None else labels_from
    return with_codes(df, columns, label_codes({c: source for c in columns}))


def random_split(key: str) -> Column:
    """'test' for about a fifth of the keys, the same ones on every run."""
    return F.when(hash_number(F.col(key)) % 100 < TEST_PERCENT, "test").otherwise("train")


def with_stratified_split(df: DataFrame, label: str, key: str) -> DataFrame:
    """``split`` such that a fifth of every class, rounded half up, is 'test'; members follow the key's hash."""
    drawn = df.withColumn("_draw", hash_number(F.col(key)))
    placed = number_within(drawn, label, ["_draw", key], "_place")
    sizes = df.groupBy(label).agg(F.count("*").alias("_size"))
    in_test = F.col("_place") * 200 <= F.col("_size") * 2 * TEST_PERCENT + 100
    return (
        placed.join(sizes, label)
        .withColumn("split", F.when(in_test, "test").otherwise("train"))
        .select(*df.columns, "split")
    )


def scaled(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None, suffix: str = "") -> DataFrame:
    """(x - mean) / population deviation, both taken from ``fit_on``; a constant column is only shifted.

    Without a suffix the columns are replaced, with one they are added.
    """
    source = df if fit_on is None else fit_on
    moments = source.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in columns], *[F.stddev_pop(c).alias(f"{c}_dev") for c in columns]
        ).alias("moments")
    )
    kept = df.columns if suffix else [c for c in df.columns if c not in columns]
    with_moments = df.withColumn("_m", moments.scalar())

    def score(c: str) -> Column:
        deviation = F.col(f"_m.{c}_dev")
        return (F.col(c) - F.col(f"_m.{c}_mean")) / F.when(deviation == 0, 1.0).otherwise(deviation)

    return with_moments.select(*kept, *[score(c).alias(f"{c}{suffix}") for c in columns])
