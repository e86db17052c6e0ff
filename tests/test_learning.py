from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from tillworks.operators import evaluation, lloyd, preparation
from tillworks.plans import features, learning
from tillworks.plans.generator import GeneratorConfig, base_tables
from tillworks.session import stored


@pytest.fixture(scope="module")
def sales(spark):
    return base_tables(spark, GeneratorConfig(transactions=1500))


@pytest.fixture(scope="module")
def points(sales):
    return stored(learning.scaled_values(sales))


def matrix(df, columns):
    return np.array([[float(v) for v in r] for r in df.select(*columns).collect()])


def test_customer_features_on_literal_counts(spark):
    """Median of codes 0, 1 is 0.5; the mode of a tie is the smallest code."""
    from datetime import date

    from fixtures import line, tables, tx

    day = date(2025, 1, 1)
    transactions = [tx(1, day, method="cash"), tx(2, day, method="card"), tx(3, day, customer=2, store=2)]
    t = tables(spark, transactions, [line(1, 1, 1, "10.00"), line(2, 2, 3, "20.00", 2), line(3, 3, 1, "1.00", pct=10)])
    got = {r.customer_id: r for r in features.customer_features(t).collect()}
    assert (got[1].favourite_category, got[1].preferred_payment, got[1].store_region) == (0.5, 0, 0)
    assert (got[1].total_spent, got[1].avg_basket, got[1].num_transactions, got[1].avg_quantity) == (30, 15, 2, 1.5)
    assert (got[2].avg_discount, got[2].store_region) == (10, 1)
    assert (got[1].segment_encoded, got[2].segment_encoded) == (0, 1)


def test_label_codes_are_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "s string")
    coded = preparation.with_label_codes(df.union(df.selectExpr("CAST(NULL AS STRING)")), ["s"])
    got = sorted({(r.s, r.s_encoded) for r in coded.collect()}, key=repr)
    assert got == [("a", 0), ("b", 1), ("c", 2), (None, None)] and coded.count() == 8
    assert "collect_set" not in coded._jdf.queryExecution().toString()


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0)], "id int, x double, c double")
    got = preparation.scaled(df, ["x", "c"]).orderBy("id").collect()
    assert [(r.x, r.c) for r in got] == [(-1.0, 0.0), (1.0, 0.0)]


def test_stratified_split_takes_a_fifth_of_each_class(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7 == 0).cast("int").alias("label"))
    split = preparation.with_stratified_split(df, "label", "id")
    got = {(r.label, r.split): r["count"] for r in split.groupBy("label", "split").count().collect()}
    assert got == {(0, "test"): 171, (0, "train"): 686, (1, "test"): 29, (1, "train"): 114}


def test_metrics_on_known_predictions(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0, 0), (2.0, 3.0, 0, 1), (3.0, 3.0, 1, 1)], "y double, p double, t int, c int")
    got = {r.metric: r.value for r in evaluation.regression_metrics(df, "y", {"m": "p"}).collect()}
    assert got == {"MAE": 0.3333, "RMSE": 0.5774, "R2": 0.5}
    counts = evaluation.confusion_counts(df.unionByName(spark.createDataFrame([(0.0, 0.0, 2, 0)], df.schema)), "t", {"m": "c"})
    report = {r.metric: r.value for r in evaluation.classification_metrics(counts).collect()}
    assert report["Accuracy"] == 0.5
    assert (report["precision_class_0"], report["recall_class_0"], report["f1_class_0"]) == (0.5, 0.5, 0.5)
    assert (report["precision_class_2"], report["f1_class_2"], report["support_class_2"]) == (0, 0, 1)


def test_linear_model_equals_least_squares(sales):
    frame = stored(learning.regression_frame(sales).select("split", "net_amount", "scaled", "sales_item_id"))
    model = learning._regressors()["Linear Regression"].fit(frame.where("split = 'train'"))
    train = frame.where("split = 'train'").collect()
    x = np.array([[1.0, *r.scaled.toArray()] for r in train])
    y = np.array([r.net_amount for r in train])
    want = np.linalg.lstsq(x, y, rcond=None)[0]
    assert np.allclose([model.intercept, *model.coefficients.toArray()], want, atol=1e-6)
    share = 1 - len(train) / frame.count()
    assert 0.17 < share < 0.23


def test_regression_models_learn_price_times_quantity(sales):
    got = {(r.model, r.metric): r.value for r in learning.regression(sales).collect()}
    assert len(got) == 12
    assert got["Linear Regression", "R2"] > 0.8
    assert got["Decision Tree", "R2"] > 0.95
    assert got["Random Forest", "R2"] > 0.99
    assert got["Gradient Boosting", "R2"] > 0.99


def test_price_and_quantity_weigh_most(sales):
    top = [r.feature for r in learning.feature_importance(sales).limit(2).collect()]
    assert sorted(top) == ["quantity", "unit_price"]


def test_kmeans_assigns_the_nearest_centre(points):
    labels = points.join(learning.kmeans_labels(points), "customer_id")
    x, k = matrix(labels, features.VALUE_FEATURES), matrix(labels, ["kmeans_cluster"])[:, 0]
    centres = np.array([x[k == c].mean(0) for c in range(4)])
    nearest = ((x[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
    assert (nearest == k).mean() > 0.97


def test_inertia_falls_with_more_clusters(sales):
    costs = [r.inertia for r in learning.elbow(sales, range(2, 5)).collect()]
    assert costs[0] > costs[1] > costs[2]


def test_fits_that_share_their_rounds_are_those_of_single_fits(points):
    found = learning._best_kmeans(points, [2, 4], starts=3)
    vectors = learning._vector(points, features.VALUE_FEATURES).cache()
    for k, (cost, centres) in found.items():
        fits = [KMeans(k=k, seed=learning.SEED + i, maxIter=300, tol=1e-4).fit(vectors) for i in range(3)]
        best = min(fits, key=lambda m: m.summary.trainingCost)
        assert cost == pytest.approx(best.summary.trainingCost, rel=1e-9)
        assert np.allclose(centres, best.clusterCenters(), atol=1e-9)
    vectors.unpersist()


def test_all_starts_read_the_points_once_a_round(spark, points):
    starts = [matrix(points.limit(k), features.VALUE_FEATURES) for k in (2, 3, 4, 5)]
    spark.sparkContext.setJobGroup("shared", "shared")
    lloyd.from_starts(points.coalesce(1), features.VALUE_FEATURES, starts, rounds=3, tol=0.0)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("shared")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 3 * 2


def test_silhouette_equals_all_pairs(points):
    """Squared Euclidean distance, own cluster without the point itself."""
    labels = stored(points.join(learning.kmeans_labels(points), "customer_id"))
    x, k = matrix(labels, features.VALUE_FEATURES), matrix(labels, ["kmeans_cluster"])[:, 0]
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    scores = []
    for i in range(len(x)):
        own = k == k[i]
        a = d[i][own].sum() / max(own.sum() - 1, 1)
        b = min(d[i][k == c].mean() for c in set(k) - {k[i]})
        scores.append((b - a) / max(a, b))
    assert abs(learning._silhouette(labels, "kmeans_cluster") - np.mean(scores)) < 1e-6


def test_components_equal_the_correlation_matrix(points):
    x = matrix(points, features.VALUE_FEATURES)
    values, vectors = np.linalg.eigh(x.T @ x / len(x))
    order = values.argsort()[::-1]
    variance = learning.pca_variance(points).orderBy("component").collect()
    assert np.allclose([r.explained_ratio for r in variance], values[order] / 5, atol=1e-6)
    assert abs(variance[-1].cumulative_ratio - 1) < 1e-9
    projected = matrix(learning.pca_projections(points).join(points, "customer_id"), ["pc1", *features.VALUE_FEATURES])
    want = projected[:, 1:] @ vectors[:, order[0]]
    assert np.allclose(np.abs(projected[:, 0]), np.abs(want), atol=1e-6)


def test_cross_validation_summary(sales, monkeypatch):
    monkeypatch.setattr(learning, "FOREST_DEPTH", 6)
    got = {r.metric: r.value for r in learning.cross_validation(sales).collect()}
    folds = [got[f"R2_fold_{i}"] for i in range(1, 6)]
    assert abs(got["R2_mean"] - np.mean(folds)) < 1e-3 and abs(got["R2_std"] - np.std(folds)) < 1e-3
    assert min(folds) > 0.9


def test_outputs_are_written_and_checked(spark, sales, tmp_path):
    missing = learning.check_outputs(spark, str(tmp_path / "none")).collect()
    assert {r.output for r in missing if not r.ok} == set(learning.OUTPUTS)
    folder = str(tmp_path / "outputs")
    learning.write_outputs(sales, folder, forest_depth=4)
    checked = {r.output: r for r in learning.check_outputs(spark, folder).collect()}
    assert set(checked) == set(learning.OUTPUTS) and all(r.ok for r in checked.values())
    customers = sales.transactions.select("customer_id").distinct().count()
    assert checked["cluster_assignments"].row_count == checked["projections"].row_count == customers


def test_cluster_sizes_add_up(sales):
    sizes = learning.cluster_sizes(sales).groupBy("model").sum("customers").collect()
    customers = sales.transactions.select("customer_id").distinct().count()
    assert {r["sum(customers)"] for r in sizes} == {customers} and len(sizes) == 2
