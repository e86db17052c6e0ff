"""Learning jobs on Spark ML and on own trees: regression, classification, clustering, components, cross-validation.

Training frames are written once to the shared folder (``_training_frame``): iterative fits read them many
times, and a lost executor must not cause the joins behind them to run again.
"""

from __future__ import annotations

from collections.abc import Callable
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml.classification import (
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillworks.operators import evaluation, forest, linear, lloyd
from tillworks.operators.density import dbscan
from tillworks.operators.ordering import with_ntiles
from tillworks.operators.preparation import random_split, scaled, with_stratified_split
from tillworks.operators.trees import Tree, grown
from tillworks.plans.features import (
    CUSTOMER_FEATURES,
    LINE_FEATURES,
    VALUE_FEATURES,
    customer_features,
    customer_values,
    line_features,
)
from tillworks.session import stored, scratch_table
from tillworks.sources import schemas
from tillworks.sources.files import read_json, write_json
from tillworks.sources.tables import SalesTables

SEED = 42
# Forests of the single-machine library grow without a depth limit; Spark needs one, and cost doubles
# with every level.
FOREST_DEPTH = 10
# Every running task of a forest holds one block of node statistics of this size; a small block costs more
# passes on the deepest levels, a large one times the cores of an executor can exceed its memory.
FOREST_MEMORY_MB = 64
# The same for the sums of ``operators.forest``; more trees than fit take one more look at the rows.
SUMS_MEMORY_MB = 192
TREES, FOLD_TREES = 100, 50
BOOSTED_ROUNDS, BOOSTED_DEPTH, BOOSTED_STEP = 100, 3, 0.1
# Independent fits submitted at a time; each alone leaves executors idle between its short stages.
PARALLEL_FITS = 5


def _together(fits: list[Callable]) -> list:
    """Results of independent fits, in order. The threads only submit jobs; the work is on the executors."""
    inherit = inheritable_thread_target(SparkSession.getActiveSession())
    with ThreadPool(min(PARALLEL_FITS, len(fits))) as pool:
        return pool.map(lambda fit: fit(), [inherit(f) for f in fits])


def _vector(df: DataFrame, columns: list[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=name).transform(df)


def _training_frame(df: DataFrame, *key: str) -> DataFrame:
    """Written once, spread over all cores: small joins end in few partitions, and fits are CPU-bound.

    One partition per core and no more: every partition sends its own statistics of all nodes of a forest, about 9 KB for
    each of them, however few rows it has.
    """
    return stored(df.repartition(df.sparkSession.sparkContext.defaultParallelism, *key))


def _with_vectors(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Raw and scaled feature vectors; scaling is fitted on the training part."""
    standard = scaled(rows, columns, fit_on=rows.where("split = 'train'"), suffix="_scaled")
    both = _vector(_vector(standard, columns), [f"{c}_scaled" for c in columns], "scaled")
    return both.drop(*columns, *[f"{c}_scaled" for c in columns])


def _split_lines(t: SalesTables) -> DataFrame:
    """Features, amount and part of every line. The part is told from the id, which stays behind."""
    return line_features(t, random_split("sales_item_id").alias("split"))


def regression_frame(t: SalesTables) -> DataFrame:
    lines = line_features(t).withColumn("split", random_split("sales_item_id"))
    return _with_vectors(_training_frame(lines, "sales_item_id"), LINE_FEATURES)


def _cents() -> Column:
    return F.round(F.col("net_amount") * 100).alias("cents")


def _seeded_lines(t: SalesTables) -> DataFrame:
    """``_split_lines`` with a number of the id, by which the trees of a forest draw the line."""
    own = F.struct(random_split("sales_item_id").alias("split"), F.xxhash64("sales_item_id").alias("seed"))
    return line_features(t, own.alias("own")).select("own.*", *LINE_FEATURES, "segment_encoded", "net_amount")


def _forest(frame: forest.Binned, without: list[int | None], depth: int | None = None) -> list[forest.Tree]:
    """All features compete in every split, as in the single-machine library."""
    return forest.grown(frame, without, FOREST_DEPTH if depth is None else depth, SUMS_MEMORY_MB)


def _regressors() -> dict[str, object]:
    """The models that Spark's library fits; the forest and the boosted trees are ``operators.forest``."""
    return {"Linear Regression": LinearRegression(featuresCol="scaled", labelCol="net_amount", solver="normal", regParam=0.0)}


TREE_DEPTH, CLASS_TREE_DEPTH = 6, 5


def _features(columns: list[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns]).alias("x")


def _amount_rows(lines: DataFrame) -> DataFrame:
    """Features, amount in cents and part of every line of ``_split_lines``."""
    cents = F.round(F.col("net_amount") * 100).cast("long").alias("cents")
    return lines.select(_features(LINE_FEATURES), cents, "split")


def _segment_rows(customers: DataFrame) -> tuple[DataFrame, list[str]]:
    """Features, segment code and part of every customer of ``_split_customers``, and the names of its columns with 1
    for the own class."""
    rows = customers.select("customer_id", _features(CUSTOMER_FEATURES), F.col("segment_encoded").alias("class"), "split")
    classes = rows.agg(F.max("class")).first()[0] + 1
    counts = {f"is_{c}": (F.col("class") == c).cast("long") for c in range(classes)}
    return rows.withColumns(counts), list(counts)


def _amount_tree(rows: DataFrame, depth: int) -> Tree:
    return grown(rows.where("split = 'train'").select("x", "cents"), ["cents"], "cents", depth)


def _segment_tree(rows: DataFrame, classes: list[str], depth: int) -> Tree:
    return grown(rows.where("split = 'train'").select("x", "class", *classes), classes, "class", depth)


def _mean_amount(tree: Tree, node: int) -> float:
    n, cents = tree.totals[node]
    return cents / n / 100


def _main_class(tree: Tree, node: int) -> int:
    """The class of most rows, the smallest one on ties."""
    counts = tree.totals[node][1:]
    return counts.index(max(counts))


def _tree_table(spark: SparkSession, tree: Tree, features: list[str], value: Callable) -> DataFrame:
    rows = []
    for node in sorted(tree.totals):
        split = tree.splits.get(node)
        name, threshold = (features[split.feature], split.threshold) if split else (None, None)
        rows.append((node, name, threshold, tree.totals[node][0], float(value(tree, node))))
    return spark.createDataFrame(rows, "node long, feature string, threshold double, row_count long, value double")


def amount_tree(t: SalesTables, depth: int = TREE_DEPTH) -> DataFrame:
    """The nodes of the regression tree: split (NULL in leaves), training rows and mean amount."""
    return _tree_table(t.lines.sparkSession, _amount_tree(_amount_rows(_split_lines(t)), depth), LINE_FEATURES, _mean_amount)


def segment_tree(t: SalesTables, depth: int = CLASS_TREE_DEPTH) -> DataFrame:
    """The nodes of the classification tree: split (NULL in leaves), training rows and class."""
    rows, classes = _segment_rows(_split_customers(t))
    return _tree_table(t.lines.sparkSession, _segment_tree(rows, classes, depth), CUSTOMER_FEATURES, _main_class)


def amount_tree_metrics(t: SalesTables, depth: int = TREE_DEPTH) -> DataFrame:
    """MAE, RMSE and R2 of the regression tree on the test lines."""
    return _judged_amount_tree(_split_lines(t), depth)


def _judged_amount_tree(lines: DataFrame, depth: int = TREE_DEPTH) -> DataFrame:
    rows = _amount_rows(lines)
    tree = _amount_tree(rows, depth)
    guess = tree.node(F.col("x"), lambda node: _mean_amount(tree, node))
    judged = rows.where("split = 'test'").select((F.col("cents") / 100).alias("net_amount"), guess.alias("guess"))
    return evaluation.regression_metrics(judged, "net_amount", {"Decision Tree": "guess"})


def segment_tree_metrics(t: SalesTables, depth: int = CLASS_TREE_DEPTH) -> DataFrame:
    """Accuracy, precision, recall, F1 and support of the classification tree on the test customers."""
    return _judged_segment_tree(_split_customers(t), depth)


def _judged_segment_tree(customers: DataFrame, depth: int = CLASS_TREE_DEPTH) -> DataFrame:
    rows, classes = _segment_rows(customers)
    tree = _segment_tree(rows, classes, depth)
    guess = tree.node(F.col("x"), lambda node: _main_class(tree, node))
    judged = rows.where("split = 'test'").select("class", guess.alias("guess"))
    return evaluation.classification_metrics(evaluation.confusion_counts(judged, "class", {"Decision Tree": "guess"}))


_WHOLE = ["quantity", "unit_cents", *LINE_FEATURES[2:]]  # the line features as whole numbers


def _whole_lines(t: SalesTables) -> DataFrame:
    cents = {name: F.round(F.col(c) * 100).cast("long") for name, c in (("unit_cents", "unit_price"), ("cents", "net_amount"))}
    return _split_lines(t).withColumns(cents)


def _line_weights(lines: DataFrame) -> list[float]:
    return linear.coefficients(lines.where("split = 'train'"), _WHOLE, "cents")


def linear_coefficients(t: SalesTables) -> DataFrame:
    """Intercept and coefficients of the linear model of the net amount (in cents, price in cents)."""
    weights = _line_weights(_whole_lines(t))
    rows = [(i, name, round(w, 6)) for i, (name, w) in enumerate(zip(["intercept", *_WHOLE], weights))]
    return t.lines.sparkSession.createDataFrame(rows, "place int, term string, coefficient double")


def linear_metrics(t: SalesTables) -> DataFrame:
    """MAE, RMSE and R2 of the linear model on the test lines."""
    lines = _whole_lines(t)
    guess = linear.predicted(_line_weights(lines), _WHOLE) / 100
    judged = lines.where("split = 'test'").select("net_amount", guess.alias("guess"))
    return evaluation.regression_metrics(judged, "net_amount", {"Linear Regression": "guess"})


def _fit_all(estimators: dict, train: DataFrame, test: DataFrame) -> tuple[dict, DataFrame, dict[str, str]]:
    """Models by name, the test frame with one prediction column per model, and the names of those."""
    columns = {name: f"p{i}" for i, name in enumerate(estimators)}
    for name, estimator in estimators.items():
        estimator.setPredictionCol(columns[name])
        if hasattr(estimator, "setRawPredictionCol"):
            estimator.setRawPredictionCol(f"raw_{columns[name]}").setProbabilityCol(f"prob_{columns[name]}")
    fitted = dict(zip(estimators, _together([lambda e=e: e.fit(train) for e in estimators.values()])))
    for model in fitted.values():
        test = model.transform(test)
    return fitted, test, columns


def _judged(predictions: DataFrame, model: str, part: int) -> DataFrame:
    """MAE, RMSE and R2 of a forest's predictions in cents for one part of the lines."""
    amounts = predictions.where(F.col("part") == part).select((F.col("y") / 100).alias("net_amount"), (F.col("prediction") / 100).alias("guess"))
    return evaluation.regression_metrics(amounts, "net_amount", {model: "guess"})


def _forests_frame(lines: DataFrame) -> forest.Binned:
    """Binned lines of ``_seeded_lines``; the test lines are the part 1, which no tree sees and whose features cut no bins."""
    in_test = (F.col("split") == "test").cast("int")
    bounds = forest.thresholds(lines.where("split = 'train'"), LINE_FEATURES)
    return forest.binned(lines.withColumn("cents", _cents()), LINE_FEATURES, "cents", F.col("seed"), in_test, bounds)


def regression(t: SalesTables, forest_depth: int = FOREST_DEPTH) -> DataFrame:
    """MAE, RMSE and R2 of four models that predict the net amount of a line."""
    lines = _training_frame(_seeded_lines(t))
    rows = _with_vectors(lines, LINE_FEATURES)
    frame = _forests_frame(lines)

    def linear_model() -> DataFrame:
        models = {name: e.fit(rows.where("split = 'train'")) for name, e in _regressors().items()}
        judged = [m.transform(rows.where("split = 'test'")) for m in models.values()]
        return evaluation.union_metrics(*[evaluation.regression_metrics(j, "net_amount", {name: "prediction"}) for name, j in zip(models, judged)])

    def random_forest() -> DataFrame:
        return _judged(forest.predicted(frame, _forest(frame, [1] * TREES, forest_depth)), "Random Forest", 1)

    def boosting() -> DataFrame:
        model = forest.boosted(frame, 1, BOOSTED_ROUNDS, BOOSTED_DEPTH, BOOSTED_STEP)
        return _judged(forest.predicted(frame, model), "Gradient Boosting", 1)

    return evaluation.union_metrics(*_together([linear_model, random_forest, boosting, lambda: _judged_amount_tree(lines)]))


def feature_importance(t: SalesTables) -> DataFrame:
    """Weights of the forest's features, largest first."""
    lines = stored(_seeded_lines(t).where("split = 'train'").select("seed", *LINE_FEATURES, _cents()))
    frame = forest.binned(lines, LINE_FEATURES, "cents", F.col("seed"))
    weights = forest.importances(_forest(frame, [None] * TREES), len(LINE_FEATURES))
    return lines.sparkSession.createDataFrame(
        [(name, float(w)) for name, w in zip(LINE_FEATURES, weights)], "feature string, importance double"
    ).orderBy(F.desc("importance"), "feature")


def _split_customers(t: SalesTables) -> DataFrame:
    customers = with_stratified_split(stored(customer_features(t)), "segment_encoded", "customer_id")
    return _training_frame(customers, "customer_id")


def classification_frame(t: SalesTables) -> DataFrame:
    return _with_vectors(_split_customers(t), CUSTOMER_FEATURES)


def _classifiers(train_rows: int, depth: int = FOREST_DEPTH) -> dict[str, object]:
    """The penalty 1 / rows makes the mean-loss objective equal to a unit weight on the summed loss."""
    common = {"labelCol": "segment_encoded"}
    return {
        "Logistic Regression": LogisticRegression(
            featuresCol="scaled", family="multinomial", maxIter=1000, regParam=1.0 / train_rows, **common
        ),
        "Random Forest": RandomForestClassifier(
            numTrees=100, maxDepth=depth, maxMemoryInMB=FOREST_MEMORY_MB, seed=SEED, **common
        ),
    }


def classification(t: SalesTables, forest_depth: int = FOREST_DEPTH) -> DataFrame:
    """Accuracy and per-class figures of three models that predict the customer segment."""
    customers = _split_customers(t)
    frame = _with_vectors(customers, CUSTOMER_FEATURES)
    train, test = frame.where("split = 'train'"), frame.where("split = 'test'")
    _, judged, columns = _fit_all(_classifiers(train.count(), forest_depth), train, test)
    metrics = evaluation.classification_metrics(evaluation.confusion_counts(judged, "segment_encoded", columns))
    return evaluation.union_metrics(metrics, _judged_segment_tree(customers))


def perceptron(t: SalesTables) -> DataFrame:
    """The layered network 8-32-16-classes on scaled features."""
    frame = classification_frame(t)
    # Every step of the optimiser reads the training rows, and the network does not keep them itself.
    train, test = frame.where("split = 'train'").persist(), frame.where("split = 'test'")
    classes = frame.agg(F.max("segment_encoded")).first()[0] + 1
    network = MultilayerPerceptronClassifier(
        featuresCol="scaled",
        labelCol="segment_encoded",
        layers=[len(CUSTOMER_FEATURES), 32, 16, classes],
        maxIter=80,
        seed=SEED,
    )
    _, judged, columns = _fit_all({"MLP": network}, train, test)
    train.unpersist()
    counts = evaluation.confusion_counts(judged, "segment_encoded", columns)
    return evaluation.classification_metrics(counts).where("metric = 'Accuracy'")


def scaled_values(t: SalesTables) -> DataFrame:
    return scaled(stored(customer_values(t)), VALUE_FEATURES)


def _best_kmeans(points: DataFrame, ks: list[int], starts: int = 10) -> dict[int, tuple[float, np.ndarray]]:
    """Per k the cost and the centres of the fit with the lowest cost out of ``starts`` seeds.

    Spark chooses the centres that each fit begins with; from there all fits go through their rounds together, so a round
    reads the points once and not once for every k and seed.
    """
    vectors = _vector(points, VALUE_FEATURES)
    asked = [(k, KMeans(k=k, seed=SEED + i, maxIter=0)) for k in ks for i in range(starts)]
    begun = _together([lambda e=e: np.array(e.fit(vectors).clusterCenters()) for _, e in asked])
    ended = lloyd.from_starts(points, VALUE_FEATURES, begun, rounds=300, tol=1e-4)
    fits: dict[int, list] = {k: [] for k in ks}
    for (k, _), fit in zip(asked, ended):
        fits[k].append(fit)
    return {k: min(found, key=lambda fit: fit[0]) for k, found in fits.items()}


def kmeans_labels(points: DataFrame, k: int = 4) -> DataFrame:
    rows = stored(points.select("customer_id", *VALUE_FEATURES))
    _, centres = _best_kmeans(rows, [k])[k]
    return lloyd.labelled(rows, VALUE_FEATURES, centres, "kmeans_cluster").select("customer_id", "kmeans_cluster")


def dbscan_labels(points: DataFrame) -> DataFrame:
    return dbscan(points, "customer_id", VALUE_FEATURES, eps=0.8, min_points=5)


def elbow(t: SalesTables, ks: range = range(2, 9)) -> DataFrame:
    """Lowest inertia per number of clusters."""
    points = stored(scaled_values(t).select(*VALUE_FEATURES))
    costs = [(k, round(cost, 2)) for k, (cost, _) in _best_kmeans(points, list(ks)).items()]
    return points.sparkSession.createDataFrame(costs, "k int, inertia double")


def _lloyd(t: SalesTables, ks: list[int]) -> DataFrame:
    points = stored(lloyd.in_millionths(scaled_values(t), "customer_id", VALUE_FEATURES))
    return lloyd.assigned(points, lloyd.clustered(points, ks))


def lloyd_clusters(t: SalesTables, ks: range = range(2, 9)) -> DataFrame:
    """Cluster of every customer for every number of clusters, from seeds by farthest point."""
    return _lloyd(t, list(ks)).select(F.col("key").alias("customer_id"), "k", "cluster")


def lloyd_elbow(t: SalesTables, ks: range = range(2, 9)) -> DataFrame:
    """Inertia and size of the largest cluster per number of clusters."""
    found = _lloyd(t, list(ks)).groupBy("k", "cluster").agg(F.sum("d").alias("d"), F.count("*").alias("n"))
    inertia = F.round(F.sum("d") / float(lloyd.UNIT) ** 2, 4).alias("inertia")
    return found.groupBy("k").agg(inertia, F.max("n").alias("largest_cluster"))


def _silhouette(points: DataFrame, cluster: str) -> float | None:
    """Mean silhouette with squared Euclidean distance, which needs only cluster sums, never pairs."""
    if points.select(cluster).distinct().limit(2).count() < 2:
        return None
    vectors = _vector(points, VALUE_FEATURES)
    return ClusteringEvaluator(predictionCol=cluster, metricName="silhouette").evaluate(vectors)


def cluster_assignments(t: SalesTables) -> DataFrame:
    """The five features of every customer with both cluster numbers."""
    values = stored(customer_values(t))
    points = stored(scaled(values, VALUE_FEATURES))
    return values.join(kmeans_labels(points), "customer_id").join(dbscan_labels(points), "customer_id")


def clustering_metrics(t: SalesTables) -> DataFrame:
    """Silhouette of both clusterings (noise left out), and what the density clustering found."""
    points = stored(scaled_values(t))
    labelled = stored(points.join(kmeans_labels(points), "customer_id").join(dbscan_labels(points), "customer_id"))
    clustered = labelled.where("dbscan_cluster <> -1")
    clusters, noise = labelled.agg(
        F.countDistinct(F.when(F.col("dbscan_cluster") >= 0, F.col("dbscan_cluster"))),
        F.count(F.when(F.col("dbscan_cluster") == -1, 1)),
    ).first()
    rows = [
        ("clustering", "K-Means", "silhouette", _silhouette(labelled, "kmeans_cluster")),
        ("clustering", "DBSCAN", "silhouette", _silhouette(clustered, "dbscan_cluster")),
        ("clustering", "DBSCAN", "clusters", float(clusters)),
        ("clustering", "DBSCAN", "noise", float(noise)),
    ]
    return points.sparkSession.createDataFrame(rows, schemas.METRICS)


def dbscan_counts(labels: DataFrame) -> DataFrame:
    """Number of clusters and of noise points."""
    cluster = F.col("dbscan_cluster")
    return labels.agg(
        F.countDistinct(F.when(cluster >= 0, cluster)).alias("clusters"),
        F.count(F.when(cluster == -1, 1)).alias("noise"),
    )


def _components(scaled_points: DataFrame, k: int) -> tuple[list[list[float]], list[float]]:
    """Loadings (largest one of each component positive) and explained shares of variance."""
    model = PCA(k=k, inputCol="features", outputCol="pca").fit(_vector(scaled_points, VALUE_FEATURES))
    loadings = model.pc.toArray().T
    signed = [[float(w) for w in (row if row[abs(row).argmax()] > 0 else -row)] for row in loadings]
    return signed, [float(v) for v in model.explainedVariance.toArray()]


def pca_projections(points: DataFrame) -> DataFrame:
    """First two components per customer, as sums over the scaled columns."""
    loadings, _ = _components(points, 2)

    def projected(weights: list[float]):
        return sum((F.col(c) * F.lit(w) for c, w in zip(VALUE_FEATURES[1:], weights[1:])), F.col(VALUE_FEATURES[0]) * weights[0])

    return points.select("customer_id", *[F.round(projected(w), 6).alias(f"pc{i}") for i, w in enumerate(loadings, 1)])


def pca_variance(points: DataFrame) -> DataFrame:
    """Explained share per component and its running total."""
    _, shares = _components(points, len(VALUE_FEATURES))
    rows = points.sparkSession.createDataFrame(list(enumerate(shares, 1)), "component int, explained_ratio double")
    running = F.sum("explained_ratio").over(Window.orderBy("component"))
    return rows.select(
        "component", F.round("explained_ratio", 6).alias("explained_ratio"), F.round(running, 6).alias("cumulative_ratio")
    )


def class_supports(t: SalesTables) -> DataFrame:
    """Customers per segment code in the training and the test part: what the classification report is about."""
    customers = with_stratified_split(stored(customer_features(t)), "segment_encoded", "customer_id")
    return customers.groupBy("segment_encoded", "split").agg(F.count("*").alias("customers"))


def fold_sizes(t: SalesTables, folds: int = 5) -> DataFrame:
    """Lines and their net amount per cross-validation fold."""
    lines = with_ntiles(t.sales_items.select("sales_item_id", "net_cents"), folds, {"fold": ["sales_item_id"]})
    return lines.groupBy("fold").agg(F.count("*").alias("line_count"), (F.sum("net_cents") / 100.0).alias("revenue"))


def cluster_sizes(t: SalesTables) -> DataFrame:
    """Customers per cluster of both clusterings; -1 is the noise of the density clustering."""
    points = stored(scaled_values(t))
    parts = [
        labels.groupBy(F.col(column).alias("cluster")).agg(F.count("*").alias("customers")).select(F.lit(name).alias("model"), "*")
        for name, column, labels in (
            ("K-Means", "kmeans_cluster", kmeans_labels(points)),
            ("DBSCAN", "dbscan_cluster", dbscan_labels(points)),
        )
    ]
    return parts[0].unionByName(parts[1])


def projections_with_clusters(t: SalesTables) -> DataFrame:
    """First two components of every customer with both cluster numbers."""
    points = stored(scaled_values(t))
    both = pca_projections(points).join(kmeans_labels(points), "customer_id").join(dbscan_labels(points), "customer_id")
    return both.select("customer_id", "pc1", "pc2", "kmeans_cluster", "dbscan_cluster")


#: What ``write_outputs`` leaves, and the columns that have to be there.
OUTPUTS = {
    "metrics": ["task", "model", "metric", "value"],
    "feature_importance": ["feature", "importance"],
    "cluster_assignments": ["customer_id", *VALUE_FEATURES, "kmeans_cluster", "dbscan_cluster"],
    "projections": ["customer_id", "pc1", "pc2", "kmeans_cluster", "dbscan_cluster"],
}


def write_outputs(t: SalesTables, folder: str, forest_depth: int = FOREST_DEPTH) -> dict[str, str]:
    """Runs the learning jobs and writes their results, JSON for the metrics and parquet for the rest; name -> path."""
    base = folder.rstrip("/")
    paths = {name: f"{base}/{name}" for name in OUTPUTS}
    metrics = evaluation.union_metrics(regression(t, forest_depth), classification(t, forest_depth), clustering_metrics(t))
    write_json(metrics.select(*OUTPUTS["metrics"]), paths["metrics"])
    for name, made in (
        ("feature_importance", feature_importance(t)),
        ("cluster_assignments", cluster_assignments(t)),
        ("projections", projections_with_clusters(t)),
    ):
        made.write.mode("overwrite").parquet(paths[name])
    return paths


def check_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """One row per expected output: whether it is there with its columns, and how many rows it has."""
    rows = []
    for name, columns in OUTPUTS.items():
        reader = spark.read.json if name == "metrics" else spark.read.parquet
        try:
            found = reader(f"{folder.rstrip('/')}/{name}")
            rows.append((name, set(columns) <= set(found.columns), found.count()))
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            rows.append((name, False, 0))
    checked = spark.createDataFrame(rows, "output string, complete boolean, row_count long")
    return checked.withColumn("ok", F.col("complete") & (F.col("row_count") > 0))


def dbscan_silhouette(t: SalesTables) -> DataFrame:
    """Mean silhouette (squared distances) of the clustered points of the density clustering."""
    points = stored(scaled_values(t))
    labelled = points.join(dbscan_labels(points), "customer_id").where("dbscan_cluster <> -1")
    value = _silhouette(stored(labelled), "dbscan_cluster")
    return points.sparkSession.createDataFrame([(None if value is None else round(value, 6),)], "silhouette double")


def cross_validation(t: SalesTables, folds: int = 5) -> DataFrame:
    """R2 of a forest on contiguous blocks of lines, with mean and population deviation."""
    lines = with_ntiles(line_features(t), folds, {"fold": ["sales_item_id"]})
    lines = stored(lines.select("fold", F.xxhash64("sales_item_id").alias("seed"), *LINE_FEATURES, _cents()))
    frame = forest.binned(lines, LINE_FEATURES, "cents", F.col("seed"), F.col("fold"))
    numbers = list(range(1, folds + 1))
    # the forests of all folds grow together; each leaves its fold out
    trees = _forest(frame, [n for n in numbers for _ in range(FOLD_TREES)])
    judged = stored(forest.predicted(frame, trees))
    scores = []
    for fold in numbers:
        r2 = _judged(judged, "Random Forest", fold).where("metric = 'R2'")
        scores.append(r2.select(F.lit(f"R2_fold_{fold}").alias("metric"), "value"))
    per_fold = stored(evaluation.union_metrics(*scores))
    summary = per_fold.agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("dev")).select(
        F.inline(
            F.array(
                F.struct(F.lit("R2_mean").alias("metric"), F.round("mean", 4).alias("value")),
                F.struct(F.lit("R2_std").alias("metric"), F.round("dev", 4).alias("value")),
            )
        )
    )
    named = per_fold.unionByName(summary)
    return named.select(
        F.lit("cross_validation").alias("task"), F.lit("Random Forest").alias("model"), "metric", "value"
    )


def metric_summary(t: SalesTables) -> DataFrame:
    """One row per model from the stored metrics document; a metric a model does not have is NULL."""
    spark = t.lines.sparkSession
    document = scratch_table(spark, "metrics")
    write_json(evaluation.union_metrics(regression(t), classification(t)), document)
    stored = read_json(spark, document, schemas.METRICS)
    wide = [
        evaluation.metrics_wide(stored, "regression", ["MAE", "RMSE", "R2"]).withColumn("task", F.lit("regression")),
        evaluation.metrics_wide(stored, "classification", ["Accuracy"]).withColumn("task", F.lit("classification")),
    ]
    return wide[0].unionByName(wide[1], allowMissingColumns=True).select(
        "task", "model", "MAE", "RMSE", "R2", "Accuracy"
    )
