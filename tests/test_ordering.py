from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillworks.operators import ordering


@pytest.fixture
def values(spark):
    """5,003 rows; a third of them share one value, and value 3 is absent for id 0."""
    ids = spark.range(5003)
    value = F.when(F.col("id") % 3 == 0, 7).otherwise((F.col("id") * 37) % 50)
    return ids.select(
        "id", value.cast("int").alias("v"), ((F.col("id") * 91) % 1000).cast("decimal(12,2)").alias("amount")
    )


def _pairs(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_ntile_equals_plain_window(values):
    got = ordering.with_ntiles(values, 5, {"a": ["v", "id"], "b": [F.desc("amount"), "id"]})
    want = values.select(
        "id",
        F.ntile(5).over(Window.orderBy("v", "id")).alias("a"),
        F.ntile(5).over(Window.orderBy(F.desc("amount"), "id")).alias("b"),
    )
    assert _pairs(got, "id", "a", "b") == _pairs(want, "id", "a", "b")


@pytest.mark.parametrize("rows,sizes", [(7, [2, 2, 1, 1, 1]), (3, [1, 1, 1]), (10, [2, 2, 2, 2, 2])])
def test_ntile_sizes(spark, rows, sizes):
    tiles = ordering.with_ntiles(spark.range(rows), 5, {"t": ["id"]})
    counted = [r["count"] for r in tiles.groupBy("t").count().orderBy("t").collect()]
    assert counted == sizes


def test_running_total_equals_plain_window(values):
    got = ordering.with_running_total(values, "amount", [F.desc("amount"), "id"], "upto")
    frame = Window.orderBy(F.desc("amount"), "id").rowsBetween(Window.unboundedPreceding, 0)
    want = values.withColumn("upto", F.sum("amount").over(frame))
    assert _pairs(got, "id", "upto") == _pairs(want, "id", "upto")


def test_ranks_equal_plain_window(values):
    got = ordering.with_ranks(values, {"r": ("rank", "v"), "d": ("dense_rank", "amount")})
    want = values.select(
        "id",
        F.rank().over(Window.orderBy(F.desc("v"))).alias("r"),
        F.dense_rank().over(Window.orderBy(F.desc("amount"))).alias("d"),
    )
    assert _pairs(got, "id", "r", "d") == _pairs(want, "id", "r", "d")


def test_nulls_are_treated_as_by_a_plain_window(spark):
    rows = [(1, None), (2, 5), (3, None), (4, 7), (5, 5), (6, None)]
    df = spark.createDataFrame(rows, "id long, v long")
    got = ordering.with_ranks(df, {"r": ("rank", "v"), "d": ("dense_rank", "v")})
    want = df.select("*", F.rank().over(Window.orderBy(F.desc("v"))).alias("r"), F.dense_rank().over(Window.orderBy(F.desc("v"))).alias("d"))
    assert got.columns == want.columns and _rows(got) == _rows(want)
    upto = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    got = ordering.with_running_total(df, "v", ["id"], "upto")
    assert _rows(got) == _rows(df.withColumn("upto", F.sum("v").over(upto)))
    empty = ordering.with_running_total(df.withColumn("v", F.lit(None).cast("long")), "v", ["id"], "upto")
    assert {r.upto for r in empty.collect()} == {None}


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_number_within_splits_hot_groups(values):
    copies = values.unionByName(values.where("v = 7").withColumn("id", F.col("id") + 10_000))
    copies = copies.withColumn("v", F.when(F.col("v") != 3, F.col("v")))
    got = ordering.number_within(copies, "v", ["amount", "id"], "n")
    want = copies.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("amount", "id")))
    assert _rows(got.select("v", "amount", "id", "n")) == _rows(want.select("v", "amount", "id", "n"))


def test_rows_are_sliced_evenly(values):
    sliced = ordering._sliced(values, [F.col("v"), F.col("id")])
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 5003 / 3
