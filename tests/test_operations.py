from __future__ import annotations

from datetime import date

from fixtures import CUSTOMERS, line, tables, tx
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tillworks.sources.parquet_mapping import parquet_tables
from tillworks.operators import loading
from tillworks.operators.quality import split_valid
from tillworks.plans import operations
from tillworks.plans.generator import GeneratorConfig, base_tables
from tillworks.sources import files, schemas
from tillworks.streaming import nightly

DAY = date(2025, 1, 31)


def empty_fact(spark):
    return spark.createDataFrame([], schemas.WAREHOUSE_FACT)


def test_load_keeps_repeated_pairs_of_a_batch_and_never_loads_twice(spark):
    t = tables(spark, [tx(1, DAY), tx(2, date(2025, 2, 1))], [line(1, 1, 1, "5.00"), line(2, 1, 1, "6.00"), line(3, 2, 1, "7.00")])
    first = loading.load_day(empty_fact(spark), t.transactions, t.sales_items, DAY)
    assert sorted(r.sales_key for r in first.collect()) == [1, 2]
    assert loading.load_day(first, t.transactions, t.sales_items, DAY).count() == 0
    late = tables(spark, [tx(1, DAY)], [line(1, 1, 1, "5.00"), line(8, 1, 2, "1.00"), line(9, 1, 1, "2.00")])
    again = loading.load_day(first, late.transactions, late.sales_items, DAY)
    assert [r.sales_key for r in again.collect()] == [8]


def test_month_load_equals_its_days(spark):
    days = [date(2024, 12, 31), date(2025, 1, 1), DAY, date(2025, 2, 1)]
    t = tables(spark, [tx(i, d) for i, d in enumerate(days, 1)], [line(i, i, 1, "5.00") for i in range(1, 5)])
    month = loading.load_month(empty_fact(spark), t.transactions, t.sales_items, 2025, 1)
    assert sorted(r.date_id for r in month.collect()) == [20250101, 20250131]
    assert loading.month_range(2024, 12) == (date(2024, 12, 1), date(2024, 12, 31))


def test_load_appends_and_reports_its_rows(spark, tmp_path):
    t = tables(spark, [tx(1, DAY)], [line(1, 1, 1, "5.00"), line(2, 1, 2, "6.00")])
    path = str(tmp_path / "fact")

    def run() -> int:
        fact = files.read_parquet_or_empty(spark, path, schemas.WAREHOUSE_FACT)
        return loading.run_load(path, loading.load_day(fact, t.transactions, t.sales_items, DAY))

    assert run() == 2
    assert run() == 0


def test_new_calendar_days(spark):
    days = spark.createDataFrame([(DAY,), (date(2025, 2, 1),)], "transaction_date date")
    known = loading.new_calendar_days(spark.createDataFrame([], "date_id int"), days.limit(1))
    assert [r.date_id for r in loading.new_calendar_days(known, days).collect()] == [20250201]


def test_quality_finds_one_failure_per_rule(spark):
    customers = [*CUSTOMERS, (9, "C9", "unknown", "Faro")]
    bad = list(line(6, 1, 1, "1.00"))
    bad[3], bad[5] = 0, 101
    orphan = line(5, 99, 1, "1.00")
    no_product = list(line(4, 1, 1, "1.00"))
    no_product[2] = None
    items = [line(1, 1, 1, "5.00"), line(1, 1, 2, "5.00"), orphan, tuple(no_product), tuple(bad)]
    t = tables(spark, [tx(1, DAY)], items, customers=customers)
    report = operations.quality(t, ["budget", "family"], ["card"])
    failed = {(r.table_name, r.rule, r.column_name): r.failures for r in report.collect() if r.failures}
    assert failed == {
        ("customers", "accepted_values", "segment"): 1,
        ("stg_sales_items", "not_null", "product_id"): 1,
        ("stg_sales_items", "unique", "sales_item_id"): 1,
        ("stg_sales_items", "relationship", "transaction_id"): 1,
        ("stg_sales_items", "positive_quantity", "quantity"): 1,
        ("stg_sales_items", "discount_range", "discount_pct"): 1,
        ("fct_sales", "not_null", "product_id"): 1,
        ("fct_sales", "unique", "sales_item_id"): 1,
    }
    assert report.count() > 40


def test_split_valid_names_the_broken_rules(spark):
    frame = spark.createDataFrame([(1, 2), (2, 0), (3, None)], "id int, quantity int")
    good, bad = split_valid(frame, {"positive_quantity": F.col("quantity") > 0})
    assert [r.id for r in good.collect()] == [1]
    assert sorted((r.id, r.broken_rules) for r in bad.collect()) == [(2, ["positive_quantity"]), (3, ["positive_quantity"])]


def test_checked_append_keeps_bad_lines_apart(spark, tmp_path):
    bad = list(line(2, 1, 1, "1.00"))
    bad[3] = 0
    items = tables(spark, [tx(1, DAY)], [line(1, 1, 1, "5.00"), tuple(bad)]).sales_items.select(schemas.SALES_ITEMS.names)
    kept = operations.append_checked(items, str(tmp_path / "items"), str(tmp_path / "rejected"))
    assert [r.sales_item_id for r in kept.collect()] == [1]
    rejected = spark.read.parquet(str(tmp_path / "rejected"))
    assert [(r.sales_item_id, r.broken_rules) for r in rejected.collect()] == [(2, ["positive_quantity"])]


def test_checked_append_knows_parents_copies_and_earlier_runs(spark, tmp_path):
    t = tables(spark, [tx(1, DAY)], [line(1, 1, 1, "5.00"), line(2, 9, 1, "6.00"), line(3, 1, 99, "7.00"), line(4, 1, 2, "1.00"), line(4, 1, 2, "2.00")])
    items = t.sales_items.select(schemas.SALES_ITEMS.names)
    paths = str(tmp_path / "items"), str(tmp_path / "rejected")
    for _ in range(2):
        kept = operations.append_checked(items, *paths, parents={"transaction_id": t.transactions, "product_id": t.products})
        assert [r.sales_item_id for r in kept.collect()] == [1]
        rejected = spark.read.parquet(paths[1]).collect()
        assert sorted((r.sales_item_id, *r.broken_rules) for r in rejected) == [
            (2, "transaction_id_known"), (3, "product_id_known"), (4, "unique_id"), (4, "unique_id"),
        ]


def _parquet_copy(spark, folder, **changes):
    """The smallest tables with some of them changed."""
    for name in "region nation customer part orders lineitem".split():
        df = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        changes.get(name, lambda x: x)(df).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_quality_sees_faults_in_parquet_tables(spark, tmp_path):
    def orders(df):
        return df.withColumn("o_custkey", F.when(F.col("o_orderkey") == df.first().o_orderkey, 10**9).otherwise(F.col("o_custkey")))

    def lineitem(df):
        one = df.limit(1)
        return df.unionByName(one.withColumn("l_quantity", F.lit(0.0))).unionByName(one.withColumn("l_orderkey", F.lit(10**9).cast("long")))

    folder = _parquet_copy(spark, tmp_path, orders=orders, lineitem=lineitem)
    report = queries()["quality_report"](spark, folder)
    failed = {(r.table_name, r.rule, r.column_name): r.failures for r in report.where("failures > 0").collect()}
    assert failed == {
        ("stg_transactions", "relationship", "customer_id"): 1,
        ("stg_transactions", "not_null", "store_id"): 1,
        ("stg_sales_items", "positive_quantity", "quantity"): 1,
        ("stg_sales_items", "not_null", "unit_price"): 1,
        ("stg_sales_items", "relationship", "transaction_id"): 1,
    }


def test_line_ids_stay_when_other_lines_come(spark, tmp_path):
    before = parquet_tables(spark, "/root/testdata/sf0.001").sales_items.select("transaction_id", "sales_item_id")
    more = lambda df: df.unionByName(df.where("l_orderkey % 7 = 0").withColumn("l_linenumber", F.lit(99)))
    after = parquet_tables(spark, _parquet_copy(spark, tmp_path, lineitem=more)).sales_items
    assert before.join(after, "sales_item_id", "left_anti").count() == 0
    assert after.select("sales_item_id").distinct().count() == after.count()


def test_loads_read_only_the_days_they_load(spark):
    for name in ("etl_load_day", "etl_load_month"):
        plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        scans = [x for x in plan.split("FileScan")[1:] if "orders.parquet" in x]
        assert scans and all("GreaterThanOrEqual(o_orderdate,1997-11" in x.split("ReadSchema")[0] for x in scans), name


def test_models_and_refreshes(spark, tmp_path):
    t = tables(spark, [tx(1, DAY, method="CARD"), tx(2, date(2025, 2, 3))], [line(1, 1, 1, "5.00"), line(2, 2, 1, "6.00")])
    marts = operations.build_models(t, str(tmp_path))
    assert [r.payment_method for r in marts["fct_sales"].orderBy("sales_item_id").collect()] == ["card", "card"]
    assert marts["dim_products"].count() == 4 and spark.table("stg_transactions").count() == 2
    for _ in range(2):
        scores = operations.refresh_scores(t, str(tmp_path / "scores"), date(2025, 3, 1))
        assert scores.schema == schemas.RFM_SCORES and scores.count() == 1
    months = operations.refresh_store_months(t, str(tmp_path / "months"))
    assert sorted((r.month_num, r.transactions) for r in months.collect()) == [(1, 1), (2, 1)]


def test_csv_round_trip_and_missing_file(spark, tmp_path):
    t = base_tables(spark, GeneratorConfig(transactions=200))
    files.write_csv_tables(t, str(tmp_path))
    again = files.csv_tables(spark, str(tmp_path))
    assert again.sales_items.select(schemas.SALES_ITEMS.names).exceptAll(t.sales_items.select(schemas.SALES_ITEMS.names)).isEmpty()
    assert again.transactions.count() == 200
    missing = files.read_csv_or_empty(spark, str(tmp_path / "none.csv"), schemas.STORES)
    assert missing.schema == schemas.STORES and missing.isEmpty()


def test_full_refresh_append_and_json(spark, tmp_path):
    frame = spark.createDataFrame([("regression", "m", "R2", 0.5)], schemas.METRICS)
    path = str(tmp_path / "table")
    files.replace_table(frame, path)
    assert files.replace_table(frame, path).count() == 1
    assert files.append_table(frame, path).count() == 2
    files.write_json(frame, str(tmp_path / "json"))
    assert files.read_json(spark, str(tmp_path / "json"), schemas.METRICS).collect() == frame.collect()


def test_partition_refresh_leaves_other_months(spark, tmp_path):
    path = str(tmp_path / "mv")
    rows_ = [(2025, 1, 10), (2025, 2, 20)]
    files.replace_partitions(spark.createDataFrame(rows_, "y int, m int, v int"), path, "y", "m")
    after = files.replace_partitions(spark.createDataFrame([(2025, 2, 99)], "y int, m int, v int"), path, "y", "m")
    assert sorted((r.m, r.v) for r in after.collect()) == [(1, 10), (2, 99)]


def test_quarter_filter_prunes_folders(spark, tmp_path):
    fact = spark.createDataFrame([(1, date(2025, 2, 1)), (2, date(2025, 5, 1))], "id int, transaction_date date")
    stored = files.write_by_quarter(fact, str(tmp_path / "fact"))
    one = stored.where("year = 2025 AND quarter = 2")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "quarter" in plan
    assert [r.id for r in one.collect()] == [2]


def test_streamed_lines_load_once(spark, tmp_path):
    t = tables(spark, [tx(1, DAY), tx(2, DAY)], [line(1, 1, 1, "5.00"), line(2, 2, 3, "6.00"), line(3, 1, 4, "1.00")])
    inbox, fact, pending, progress = (str(tmp_path / n) for n in ("inbox", "fact", "pending", "progress"))
    headers = {"now": t.transactions.where("transaction_id = 1")}

    def run():
        stream = nightly.line_stream(spark, inbox)
        nightly.append_new_lines(stream, lambda: headers["now"], fact, pending, progress).awaitTermination()
        return sorted(r.sales_key for r in spark.read.parquet(fact).collect())

    items = t.sales_items.select(schemas.SALES_ITEMS.names)
    items.where("sales_item_id = 1").write.mode("append").option("header", True).csv(inbox)
    assert run() == [1]
    items.where("sales_item_id < 3").write.mode("append").option("header", True).csv(inbox)
    assert run() == [1]  # the second line's header has not come yet
    headers["now"] = t.transactions
    items.where("sales_item_id = 3").write.mode("append").option("header", True).csv(inbox)
    assert run() == [1, 2, 3]
