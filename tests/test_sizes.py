"""What moves, and how much of it: steps that would grow faster than the tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillworks.operators import quality
from tillworks.operators.trees import Split, Tree
from tillworks.plans import learning
from tillworks.sources import parquet_mapping

FOLDER = "/root/testdata/sf0.001"


def _recorded(monkeypatch, module):
    written, store = [], module.stored
    monkeypatch.setattr(module, "stored", lambda df: written.append(store(df)) or written[-1])
    return written


def test_lines_of_few_orders_are_cut_down_before_they_are_numbered(spark, monkeypatch):
    t = parquet_mapping.parquet_tables(spark, FOLDER)
    few = t.headers.where("transaction_id < 40")
    written = _recorded(monkeypatch, parquet_mapping)
    ids = {r.sales_item_id for r in t.sales_items_of(few).select("sales_item_id").collect()}
    assert [df.count() for df in written if "l_partkey" in df.columns] == [len(ids)]
    assert ids == {r[0] for r in t.sales_items.where("transaction_id < 40").select("sales_item_id").collect()}


def test_copies_are_sought_by_eight_bytes(spark, monkeypatch):
    t = parquet_mapping.parquet_tables(spark, FOLDER)
    written = _recorded(monkeypatch, parquet_mapping)
    before = sorted(r[0] for r in t.sales_items.select("sales_item_id").collect())
    assert [df.dtypes for df in written] == [[("mark", "bigint")]]
    monkeypatch.setattr(F, "xxhash64", lambda *columns: F.lit(7).cast("long"))
    assert sorted(r[0] for r in parquet_mapping.parquet_tables(spark, FOLDER).sales_items.select("sales_item_id").collect()) == before


@pytest.mark.parametrize("collide", [False, True])
def test_repeated_text_keys_are_counted_among_shared_hashes(spark, monkeypatch, collide):
    rows = spark.createDataFrame([("a",), ("b",), ("a",), (None,), (None,), ("c",), ("c",), ("c",)], "id string")
    written = _recorded(monkeypatch, quality)
    if collide:
        monkeypatch.setattr(F, "xxhash64", lambda *columns: F.lit(7).cast("long"))
    report = quality.quality_report({"t": quality.TableRules(rows, unique=("id",))})
    assert [r.failures for r in report.collect()] == [2]
    assert [df.dtypes for df in written] == [[("_mark", "bigint")]]


def test_lines_to_learn_from_leave_their_id_behind(spark):
    lines = learning._split_lines(parquet_mapping.parquet_tables(spark, FOLDER))
    assert "sales_item_id" not in lines.columns
    assert {r.split for r in lines.select("split").distinct().collect()} == {"train", "test"}


def test_training_frames_have_no_more_parts_than_cores(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        files = learning._training_frame(spark.range(5000)).inputFiles()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(files) <= spark.sparkContext.defaultParallelism


def test_a_large_tree_is_a_short_expression(spark):
    tree = Tree({node: Split(node % 2, node / 2) for node in range(1, 64) if node not in (5, 10, 11, 20, 21, 22, 23) and node < 40}, {})
    place = tree.node(F.col("x"), lambda node: node)
    assert str(place).count("CASE") <= 2

    def walk(x):
        node = 1
        while node in tree.splits:
            split = tree.splits[node]
            v = x[split.feature]
            node = 2 * node if v is not None and v <= split.threshold else 2 * node + 1
        return node

    rows = [([a / 3 if a % 7 else None, b * 1.5],) for a in range(12) for b in range(12)]
    got = spark.createDataFrame(rows, "x array<double>").select("x", place.alias("node")).collect()
    assert [r.node for r in got] == [walk(r.x) for r in got]
