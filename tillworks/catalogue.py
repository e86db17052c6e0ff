"""Name to query: what ``__spark_entry__`` registers."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.functions.money import presented
from tillworks.operators.preparation import random_split, with_stratified_split
from tillworks.plans import campaign, customers, features, learning, models, operations, revenue
from tillworks.sources.parquet_mapping import lines_in_time, parquet_tables
from tillworks.sources.tables import SalesTables

Query = Callable[[SparkSession, str], DataFrame]
WINDOWS = campaign.TABLES_1997
LOAD_DAY, LOAD_MONTH, STORED_QUARTER = date(1997, 11, 28), (1997, 11), (1997, 4)
KNOWN_UNTIL, KEYED_UNTIL = date(1997, 11, 14), date(1996, 6, 30)
SUMMARISED_UNTIL = date(1997, 10, 31), date(1997, 11, 28), date(1998, 12, 31)
SEGMENTS = ["automobile", "building", "furniture", "household", "machinery"]
PAYMENT_METHODS = ["1-urgent", "2-high", "3-medium", "4-not specified", "5-low"]


def _on_tables(plan: Callable[[SalesTables], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return presented(plan(parquet_tables(spark, sf_dir)))

    return run


def _in_windows(plan: Callable) -> Query:
    return _on_tables(lambda t: plan(t, WINDOWS))


def _on_load(plan: Callable) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return presented(plan(parquet_tables(spark, sf_dir), operations.index_of(lines_in_time(spark, sf_dir))))

    return run


MODELS = {
    "fct_sales": lambda t: models.fct_sales(t.sales_items, t.transactions),
    "stg_transactions": lambda t: models.stg_transactions(t.transactions),
    "stg_sales_items": lambda t: models.stg_sales_items(t.sales_items),
    "dim_products": lambda t: models.dim_products(t.products),
    "dim_date": lambda t: models.dim_date(t.headers),
    "flat_sales": lambda t: models.flat_sales(t),
}
REVENUE = {
    "monthly_store_revenue": revenue.monthly_store_revenue,
    "top_products": revenue.top_products,
    "avg_ticket_by_segment": revenue.avg_ticket_by_segment,
    "monthly_revenue_mom": revenue.monthly_revenue_mom,
    "product_rank_in_category": revenue.product_rank_in_category,
    "headline_kpis": revenue.headline_kpis,
    "monthly_revenue": revenue.monthly_revenue,
    "category_revenue": revenue.category_revenue,
    "daily_revenue": revenue.daily_revenue,
    "ytd_and_mom": revenue.ytd_and_mom,
    "store_matrix": revenue.store_matrix,
    "mv_monthly_store_revenue": revenue.monthly_store_summary,
    "store_revenue": revenue.store_revenue,
    "units_by_product": revenue.units_by_product,
    "gross_revenue_by_store": revenue.gross_revenue_by_store,
    "top2_customers_per_store": revenue.top_customers_per_store,
    "daily_store_running_total": revenue.daily_store_running_total,
    "table_counts": revenue.table_counts,
}
CUSTOMERS = {
    "rfm_scores": customers.rfm_scores,
    "rfm_refresh": customers.rfm_refresh,
    "customer_label": lambda t: customers.customer_label(t, customers.rfm_refresh(t)),
    "customer_ltv": customers.customer_ltv,
    "customer_clv": customers.customer_clv,
    "customer_transaction_count": customers.customer_transaction_count,
    "abc_pareto": customers.abc_classes,
}
CAMPAIGN = {
    "campaign_uplift": campaign.campaign_uplift,
    "discount_ratio_by_period": campaign.discount_ratio_by_period,
    "payment_mix_open": campaign.payment_mix_open,
    "category_mix_wide": campaign.category_mix_wide,
    "payment_mix_closed": campaign.payment_mix_closed,
    "category_mix_long": campaign.category_mix_long,
    "campaign_kpis": campaign.campaign_kpis,
    "campaign_signals": campaign.campaign_signals,
}

OPERATIONS = {
    "dim_date_upsert": lambda t: operations.new_days_of_month(t, *LOAD_MONTH, known_until=KNOWN_UNTIL),
    "partitioned_fact": lambda t: operations.quarter_revenue(t, *STORED_QUARTER),
    "mv_after_loads": lambda t: operations.summary_of_loads(t, *SUMMARISED_UNTIL),
    "sales_keys": lambda t: operations.numbered_lines(t, KEYED_UNTIL),
    "quality_report": lambda t: operations.quality(t, SEGMENTS, PAYMENT_METHODS),
}


def _split_sizes(t: SalesTables) -> DataFrame:
    lines = t.sales_items.withColumn("split", random_split("sales_item_id"))
    return lines.groupBy("split").agg(F.count("*").alias("line_count"), F.sum("net_amount").alias("revenue"))


def _stratified(t: SalesTables) -> DataFrame:
    return with_stratified_split(
        t.customers.select("customer_id", "segment"), label="segment", key="customer_id"
    )


def _points(t: SalesTables) -> DataFrame:
    return learning.scaled_values(t)


LEARNING = {
    "line_features": features.line_features,
    "customer_values": features.customer_values,
    "customer_features": features.customer_features,
    "random_split": _split_sizes,
    "stratified_split": _stratified,
    "scaled_customer_values": _points,
    "regression_metrics": learning.regression,
    "amount_tree": learning.amount_tree,
    "amount_tree_metrics": learning.amount_tree_metrics,
    "segment_tree": learning.segment_tree,
    "segment_tree_metrics": learning.segment_tree_metrics,
    "linear_coefficients": learning.linear_coefficients,
    "linear_metrics": learning.linear_metrics,
    "lloyd_clusters": learning.lloyd_clusters,
    "lloyd_elbow": learning.lloyd_elbow,
    "feature_importance": learning.feature_importance,
    "classification_metrics": learning.classification,
    "mlp_accuracy": learning.perceptron,
    "kmeans_clusters": lambda t: learning.kmeans_labels(_points(t)),
    "kmeans_elbow": learning.elbow,
    "dbscan_clusters": lambda t: learning.dbscan_labels(_points(t)),
    "dbscan_counts": lambda t: learning.dbscan_counts(learning.dbscan_labels(_points(t))),
    "clustering_metrics": learning.clustering_metrics,
    "cluster_assignments": learning.cluster_assignments,
    "cluster_sizes": learning.cluster_sizes,
    "projections_with_clusters": learning.projections_with_clusters,
    "dbscan_silhouette": learning.dbscan_silhouette,
    "class_supports": learning.class_supports,
    "fold_sizes": learning.fold_sizes,
    "pca_projections": lambda t: learning.pca_projections(_points(t)),
    "pca_variance": lambda t: learning.pca_variance(_points(t)),
    "cross_validation": learning.cross_validation,
    "metric_summary": learning.metric_summary,
}
LOADS = {
    "etl_load_day": lambda t, loaded: operations.load_day(t, loaded, LOAD_DAY),
    "etl_load_month": lambda t, loaded: operations.load_month(t, loaded, *LOAD_MONTH),
}


def all_queries() -> dict[str, Query]:
    found = {name: _on_tables(plan) for name, plan in {**MODELS, **REVENUE, **CUSTOMERS, **OPERATIONS, **LEARNING}.items()}
    found.update({name: _in_windows(plan) for name, plan in CAMPAIGN.items()})
    found.update({name: _on_load(plan) for name, plan in LOADS.items()})
    return found
