"""Loads, checks and stored layouts as catalogue plans."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.operators import loading
from tillworks.operators.keys import KeyMap
from tillworks.operators.pair_index import PairIndex
from tillworks.operators.quality import TableRules, quality_report, split_valid
from tillworks.functions import money
from tillworks.plans import customers, models, revenue
from tillworks.plans.summaries import MonthlySummary
from tillworks.session import scratch_table, stored
from tillworks.sources.files import as_view, replace_partitions, replace_table, write_by_quarter
from tillworks.sources.store import Change, Store
from tillworks.sources.tables import SalesTables


def _staged(t: SalesTables) -> DataFrame:
    return t.transactions.withColumn("payment_method", F.lower(F.trim("payment_method")))


def index_of(pairs: DataFrame, folder: str | None = None) -> PairIndex:
    """The index as earlier runs left it that had loaded these pairs."""
    store = Store(pairs.sparkSession, folder or scratch_table(pairs.sparkSession, "warehouse"))
    index = PairIndex(store)
    with store.change() as change:
        index.add(change, pairs)
    return index


def _load(t: SalesTables, loaded: PairIndex, first: date, last: date) -> DataFrame:
    """The headers and the lines of these are cut down to the days of the load; the index knows the pairs of all days."""
    of_range = t.headers.where(F.col("transaction_date").between(F.lit(first), F.lit(last)))
    return loading.load_range(loaded, _staged(t), t.sales_items_of(of_range), first, last)


def load_day(t: SalesTables, loaded: PairIndex, day: date) -> DataFrame:
    return _load(t, loaded, day, day)


def load_month(t: SalesTables, loaded: PairIndex, year: int, month: int) -> DataFrame:
    return _load(t, loaded, *loading.month_range(year, month))


def new_days_of_month(t: SalesTables, year: int, month: int, known_until: date) -> DataFrame:
    """Calendar rows for the sales days of a month that a date dimension up to ``known_until`` does not hold."""
    first, last = loading.month_range(year, month)
    day = F.col("transaction_date")
    known = models.dim_date(t.headers.where(day.between(F.lit(first), F.lit(known_until))))
    return loading.new_calendar_days(known, t.headers.where(day.between(F.lit(first), F.lit(last))))


def build_models(t: SalesTables, folder: str) -> dict[str, DataFrame]:
    """Staging models become views, marts become tables that are written in full."""
    base = folder.rstrip("/")
    as_view(models.stg_transactions(t.transactions), "stg_transactions")
    as_view(models.stg_sales_items(t.sales_items), "stg_sales_items")
    return {
        "fct_sales": replace_table(models.fct_sales(t.sales_items, t.transactions), f"{base}/fct_sales"),
        "dim_products": replace_table(models.dim_products(t.products), f"{base}/dim_products"),
    }


def refresh_scores(t: SalesTables, path: str, as_of: date | None = None) -> DataFrame:
    """The score table, emptied and loaded again."""
    return replace_table(customers.rfm_refresh(t, as_of), path)


def refresh_store_months(t: SalesTables, path: str) -> DataFrame:
    """The stored monthly aggregate; only the months that ``t`` has sales for are written again."""
    return replace_partitions(revenue.monthly_store_summary(t), path, "year_num", "month_num")


def append_checked(
    items: DataFrame, path: str, rejected_path: str, parents: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Appends the sales lines that pass the value rules, have their parents and are not there yet.

    What is in a table already is not appended again, so a second run changes nothing. Lines that break a rule (an id that
    occurs twice in ``items`` is one) go with the rules' names to a table of their own. Both tables lie in one folder and change in
    one commit: after a failure neither shows anything of the run.
    ``parents`` maps a key column to the frame that has to hold its values in a column of the same name.
    """
    rules = {
        "has_keys": F.col("sales_item_id").isNotNull() & F.col("transaction_id").isNotNull() & F.col("product_id").isNotNull(),
        "positive_quantity": F.col("quantity") > 0,
        "positive_price": F.col("unit_price") > 0,
        "discount_range": F.col("discount_pct").between(0, 100),
    }
    checked = items
    for key, frame in (parents or {}).items():
        known = frame.select(key).distinct().withColumn(f"_{key}_known", F.lit(True))
        checked = checked.join(known, key, "left")
        rules[f"{key}_known"] = F.col(f"_{key}_known")
    repeated = items.groupBy("sales_item_id").agg((F.count("*") == 1).alias("_once"))
    checked = checked.join(repeated, "sales_item_id", "left")
    rules["unique_id"] = F.col("_once")
    valid, rejected = split_valid(checked, rules)
    judged = stored(valid.withColumn("broken_rules", F.array().cast("array<string>")).unionByName(rejected))
    judged = judged.select(*items.columns, "broken_rules")
    passed = judged.where(F.size("broken_rules") == 0).select(*items.columns)
    failed = judged.where(F.size("broken_rules") > 0).distinct()
    store, (table, rejected_table) = _shared_store(items.sparkSession, path, rejected_path)
    with store.change() as change:
        change.append(rejected_table, _absent(failed, store, rejected_table, [*items.columns, "broken_rules"]))
        change.append(table, _absent(passed, store, table, ["sales_item_id"]))
    return store.read(table, items.schema)


def _shared_store(spark: SparkSession, *paths: str) -> tuple[Store, list[str]]:
    """The store of the folder that holds all the paths, and the names of the tables in it."""
    folders = {path.rstrip("/").rpartition("/")[0] for path in paths}
    if len(folders) != 1:
        raise ValueError("tables that change together lie in one folder")
    return Store(spark, folders.pop()), [path.rstrip("/").rpartition("/")[2] for path in paths]


def _absent(rows: DataFrame, store: Store, table: str, keys: list[str]) -> DataFrame:
    """Rows that the table does not hold yet; compared by a digest of the keys, which may be NULL."""
    there = store.read(table, rows.schema)
    digest = F.sha2(F.to_json(F.struct(*keys)), 256)
    known = there.select(digest.alias("_digest")).distinct()
    return rows.withColumn("_digest", digest).join(known, "_digest", "left_anti").drop("_digest")


def fact_by_quarter(t: SalesTables, first_year: int, last_year: int) -> DataFrame:
    """The fact of some years in one folder per quarter, written and read back."""
    wanted = F.col("transaction_date").between(F.lit(date(first_year, 1, 1)), F.lit(date(last_year, 12, 31)))
    headers = t.headers.where(wanted)
    fact = models.fct_sales(t.sales_items_of(headers), t.transactions.where(wanted))
    return write_by_quarter(fact, scratch_table(t.lines.sparkSession, "fact"))


def quarter_revenue(t: SalesTables, year: int, quarter: int) -> DataFrame:
    """A quarter's revenue by store from the fact of its year; the filter selects folders, not rows."""
    by_quarter = fact_by_quarter(t, year, year)
    return (
        by_quarter.where((F.col("year") == year) & (F.col("quarter") == quarter))
        .groupBy("year", "quarter", "store_id")
        .agg(F.sum("net_amount").alias("revenue"), F.count("*").alias("line_count"))
    )


def summary_of_loads(t: SalesTables, *until: date) -> DataFrame:
    """The monthly summary after one load for each day of ``until``: the sales up to it that the loads before did not bring."""
    spark = t.lines.sparkSession
    store = Store(spark, scratch_table(spark, "warehouse"))
    summary = MonthlySummary(store)
    day, after = F.col("transaction_date"), None
    for last in until:
        with store.change() as change:
            of_load = models.totals_with_stores(t).where(day <= F.lit(last))
            summary.add(change, of_load if after is None else of_load.where(day > F.lit(after)))
        after = last
    return summary.view()


def load_and_summarise(store: Store, index: PairIndex, summary: MonthlySummary, fresh: DataFrame) -> int:
    """New fact rows, their pairs and their part of the monthly summary, in one change; returns the number of rows."""

    def summarised(change: Change, loaded: DataFrame) -> None:
        day = F.to_date(F.col("date_id").cast("string"), "yyyyMMdd").alias("transaction_date")
        cents = money.cents(F.col("net_amount")).alias("net_cents")
        summary.add(change, loaded.select("transaction_id", "customer_id", "store_id", day, cents))

    return loading.run_indexed_load(store, index, fresh, also=summarised)


def numbered_lines(t: SalesTables, until: date) -> DataFrame:
    """Lines with their number in the warehouse: those of transactions up to a day are loaded first, the others later.

    The numbers of the first load stay as they are when the second one extends the map.
    """
    spark = t.lines.sparkSession
    store = Store(spark, scratch_table(spark, "warehouse"))
    keys = KeyMap(store, "sales_item_id", "string", "sales_keys")
    dated = stored(t.sales_items.select("sales_item_id", "transaction_id").join(t.headers.select("transaction_id", "transaction_date"), "transaction_id"))
    early = F.coalesce(F.col("transaction_date") <= F.lit(until), F.lit(False))
    for load in (dated.where(early), dated.where(~early)):
        with store.change() as change:
            keys.extended(change, load)
    return dated.join(keys.numbers(), "sales_item_id").select(F.col("number").alias("sales_key"), "sales_item_id", "transaction_id")


def quality(t: SalesTables, segments: list[str], payment_methods: list[str]) -> DataFrame:
    """Key, reference and value rules over the five tables, their staging models and the fact.

    The source lines are read once: the numbered lines and the fact made of them are stored, and the rules
    read the columns they need from there; of the fact only those are stored.
    """
    stg_transactions, stg_items = stored(models.stg_transactions(t.transactions)), stored(models.stg_sales_items(t.sales_items))
    fact = stored(models.fct_sales(stg_items, stg_transactions).select("sales_item_id", "transaction_id", "product_id", "net_amount"))
    quantity, pct = F.col("quantity"), F.col("discount_pct")
    consistent = F.col("gross_amount") - F.col("discount_amount") == F.col("net_amount")
    return quality_report(
        {
            "customers": TableRules(
                t.customers,
                not_null=("customer_id", "customer_name", "segment", "city"),
                unique=("customer_id",),
                checks={"accepted_values": ("segment", F.col("segment").isin(segments))},
            ),
            "products": TableRules(
                t.products, not_null=("product_id", "product_name", "category", "unit_price"), unique=("product_id",)
            ),
            "stores": TableRules(t.stores, not_null=("store_id", "store_name", "region"), unique=("store_id",)),
            "stg_transactions": TableRules(
                stg_transactions,
                not_null=("transaction_id", "transaction_date", "customer_id", "store_id", "payment_method"),
                unique=("transaction_id",),
                parents={"customer_id": (t.customers, "customer_id"), "store_id": (t.stores, "store_id")},
                checks={"accepted_values": ("payment_method", F.col("payment_method").isin(payment_methods))},
            ),
            "stg_sales_items": TableRules(
                stg_items,
                not_null=tuple(stg_items.columns),
                unique=("sales_item_id",),
                parents={
                    "transaction_id": (stg_transactions, "transaction_id"),
                    "product_id": (t.products, "product_id"),
                },
                checks={
                    "positive_quantity": ("quantity", quantity > 0),
                    "positive_price": ("unit_price", F.col("unit_price") > 0),
                    "discount_range": ("discount_pct", pct.between(0, 100)),
                    "amounts_add_up": ("net_amount", consistent),
                },
            ),
            "fct_sales": TableRules(
                fact,
                not_null=("sales_item_id", "transaction_id", "product_id", "net_amount"),
                unique=("sales_item_id",),
                parents={"transaction_id": (stg_transactions, "transaction_id")},
                non_empty=True,
            ),
        }
    )
