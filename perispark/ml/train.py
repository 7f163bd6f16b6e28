"""Cross-validated model sets, the tree grid and batch scoring on Spark ML.

Every fit is a distributed job; the driver loops over folds and model kinds only and keeps a few metric rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass
from threading import BoundedSemaphore

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IndexToString, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from perispark import fixed_values as fv
from perispark.functions.columns import binary_target
from perispark.ml.boosting import BoostedTrees
from perispark.ml.folds import assign_folds, stratified_split
from perispark.ml.metrics import average_precision, binary_metrics, class_report, multiclass_metrics, regression_metrics, roc_auc, summarise_folds
from perispark.ml.prep import Preprocessor, active_features, fit_folds, look_up
from perispark.session import use_checkpoint_dir

REGRESSION, CLASSIFICATION = fv.REGRESSION_EXPERIMENT, fv.CLASSIFICATION_EXPERIMENT


def estimators(task: str, trees: int = 100, seed: int = 42, rows: int = 1, c: float = 1.0, forest_depth: int = 10,
               boost_depth: int = 6, boost_step: float = 0.3) -> dict:
    """The three model kinds of a task; all read ``features`` and ``label``.

    ``rows`` is the number of training rows: the L2 penalty of inverse strength ``c`` is shared out over them. Forests
    look at all features for numbers and at their square root for classes. Depth has to have a bound here (30 at most).
    Forests keep the node of each row in each tree, so that a level does not walk all trees from their roots; that is a
    dozen steps from the rows, which need no checkpoint. Boosted trees are Spark's, grown by :class:`BoostedTrees`.
    """
    common = {"featuresCol": "features", "labelCol": "label"}
    forest = {"numTrees": trees, "maxDepth": forest_depth, "seed": seed, "cacheNodeIds": True, "checkpointInterval": -1, **common}
    boost = {"maxIter": trees, "maxDepth": boost_depth, "stepSize": boost_step, "seed": seed, **common}
    if task == "regression":
        return {
            "LinearRegression": LinearRegression(**common),
            "RandomForestRegressor": RandomForestRegressor(featureSubsetStrategy="all", **forest),
            "GBTRegressor": BoostedTrees(GBTRegressor(**boost)),
        }
    if task == "classification":
        return {
            "LogisticRegression": LogisticRegression(maxIter=1000, regParam=1.0 / (c * max(rows, 1)), standardization=False, **common),
            "RandomForestClassifier": RandomForestClassifier(featureSubsetStrategy="sqrt", **forest),
            "GBTClassifier": BoostedTrees(GBTClassifier(**boost)),
        }
    raise ValueError(f"unknown task {task!r}")


@dataclass
class TrainedModel:
    """A fitted preparation and the model fitted on what it makes."""

    prep: Preprocessor
    stages: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.stages.transform(self.prep.transform(df))

    def save(self, spark: SparkSession, path: str) -> None:
        self.prep.save(spark, f"{path}/prep")
        self.stages.write().overwrite().save(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TrainedModel:
        return cls(Preprocessor.load(spark, f"{path}/prep"), PipelineModel.load(f"{path}/model"))


ROWS_PER_PARTITION = 100_000  # fewer are not worth a task
MOST_ROWS = 500_000  # of a partition
CACHED_BYTES = 8 << 30  # what all fits that run side by side keep of their rows


def _side_by_side(rows: int, features: int, trees: int, fits: int, cached_bytes: int) -> tuple[int, int]:
    """(fits, forests among them) that run at the same time, one of each at least.

    A fit keeps its encoded rows and what boosting makes of them, a forest also a count and nodes per row and tree: half of
    ``cached_bytes`` is for the former, half for forests.
    """
    boosted = rows * (12 * features + 264)
    forest = rows * (12 * trees + 4 * features + 176)
    return tuple(max(1, min(fits, cached_bytes // 2 // max(kept, 1))) for kept in (boosted, forest))


def _partitions(rows: int, least: int, side: int, cores: int) -> int:
    """Partitions of the training rows: two tasks a core over the ``side`` fits and a forest that run at the same time.

    Every level of every tree is a job with two tasks a partition, so more of them cost time and fill no core that is
    idle. They are of ``least`` rows at least, and of ``MOST_ROWS`` at most.
    """
    return max(1, -(-rows // max(least, MOST_ROWS)), min(-(-rows // least), -(-2 * cores // (side + 1))))


def _in_parts(rows: DataFrame, parts: int) -> DataFrame:
    """Stored rows in ``parts`` partitions: merged in place if there are more, dealt anew only if there are fewer."""
    return rows.coalesce(parts) if rows.rdd.getNumPartitions() >= parts else rows.repartition(parts, "_row")


def train_set(df: DataFrame, task: str, key: str = "caseid", target: str = fv.ICU_TARGET,
              numeric: Sequence[str] = tuple(fv.NUMERIC_FEATURES), categorical: Sequence[str] = tuple(fv.CATEGORICAL_FEATURES),
              k: int = 5, trees: int = 100, seed: int = 42, rows_per_partition: int = ROWS_PER_PARTITION, cached_bytes: int = CACHED_BYTES,
              **settings) -> tuple[dict[str, TrainedModel], DataFrame]:
    """Cross-validate and fit all models of a task; return (models fitted on all rows, run metrics).

    Folds are stratified for classification (target > 0). Preparation is fitted inside each fold, all folds in one pass, and
    categories are looked up once for all of them. Metrics are means and population deviations over the folds. Training
    rows lie in as many partitions as their number and the cores ask for. As many folds are fitted side by side as
    ``cached_bytes`` holds, one at least, each with its kinds of model side by side; forests keep most of a row and have a
    bound of their own, and so have boosted trees, which grow level by level in several folds. ``settings`` go to ``estimators``.
    """
    spark = df.sparkSession
    known, numbers = active_features(df, numeric, target)
    cats = [c for c in categorical if c in df.columns]
    label = binary_target(target).cast("double") if task == "classification" else F.col(target).cast("double")
    rows = known.select(key, *numbers, *cats, label.alias("label"))
    rows = assign_folds(rows, k, key, "label" if task == "classification" else None, seed).withColumn("_row", F.monotonically_increasing_id())
    # the feature plan is read many times: cut it once, in a place that outlives executors
    use_checkpoint_dir(spark)
    rows = rows.checkpoint()
    n = rows.count()
    side, forests = _side_by_side(n, len(numbers) + len(cats), trees, k + 1, cached_bytes)
    parts = _partitions(n, rows_per_partition, side, spark.sparkContext.defaultParallelism)
    rows = _in_parts(rows, parts)
    preps, dictionary = fit_folds(rows, numbers, cats, k)
    joined = sorted({c for p in preps for c in p.joined})
    if joined:
        rows = _in_parts(look_up(rows, joined, dictionary, ["_row"], "_codes_").checkpoint(), parts)
    first = estimators(task, trees, seed, **settings)
    names, boosted = list(first), [name for name, kind in first.items() if isinstance(kind, BoostedTrees)]
    single = [name for name in names if name not in boosted]
    at_once = max(1, min(k + 1, cached_bytes // 4 // max(1, n * BoostedTrees.kept_bytes(len(numbers) + len(cats)))))
    free = BoundedSemaphore(forests)

    def encoded(i: int) -> list[DataFrame]:
        """Training and test rows of fold ``i``; ``k`` trains on all rows."""
        vectors = rows.select("fold", "label", array_to_vector(preps[i].vector(i)).alias("features"))
        return [vectors.where(part).select("features", "label") for part in (F.col("fold") != i, F.col("fold") == i)]

    def result(name: str, i: int, model: Model, test: DataFrame) -> Row | TrainedModel:
        """Metrics of a model of fold ``i``, or the model fitted on all rows."""
        if i == k:
            return TrainedModel(preps[i], PipelineModel(stages=[VectorAssembler(inputCols=preps[i].features, outputCol="features"), model]))
        scored = model.transform(test)
        if task == "regression":
            m = regression_metrics(scored, "label", "prediction").first().asDict()
        else:
            m = binary_metrics(scored, "label", "prediction").select("f1", "accuracy").first().asDict()
            m["auc"] = _area(scored)
        return Row(model=name, fold=i, **m)

    def fit_all(i: int) -> list:
        """Results of the kinds of model that are fitted fold by fold."""
        train, test = [part.persist() for part in encoded(i)]
        kinds = estimators(task, trees, seed, train.count(), **settings)

        def fit(name: str) -> Row | TrainedModel:
            with free if name.startswith("RandomForest") else nullcontext():
                model = kinds[name].fit(train)
            return result(name, i, model, test)

        with ThreadPoolExecutor(len(single) or 1) as pool:
            found = list(pool.map(fit, single))
        train.unpersist()
        test.unpersist()
        return found

    def boost(name: str) -> list:
        """Results of boosted trees, which grow in ``at_once`` folds side by side."""
        found = []
        for start in range(0, k + 1, at_once):
            group = range(start, min(start + at_once, k + 1))
            models = first[name].fit_all([encoded(i)[0] for i in group])
            with ThreadPoolExecutor(len(group)) as pool:
                found += pool.map(lambda i, model: result(name, i, model, encoded(i)[1]), group, models)
        return found

    with ThreadPoolExecutor(side + len(boosted)) as pool:
        grown = [pool.submit(boost, name) for name in boosted]
        found = [dict(zip(single, fold)) for fold in pool.map(fit_all, range(k + 1))]
        for name, results in zip(boosted, grown):
            for fold, r in zip(found, results.result()):
                fold[name] = r
    *folds, whole = [[fold[name] for name in names] for fold in found]
    metrics = ["rmse", "mae", "r2"] if task == "regression" else ["auc", "f1", "accuracy"]
    results = spark.createDataFrame([r for found in folds for r in found])
    return dict(zip(names, whole)), run_metrics(results, metrics, REGRESSION if task == "regression" else CLASSIFICATION)


def run_parameters(df: DataFrame, task: str, target: str = fv.ICU_TARGET, numeric: Sequence[str] = tuple(fv.NUMERIC_FEATURES),
                   categorical: Sequence[str] = tuple(fv.CATEGORICAL_FEATURES), k: int = 5) -> DataFrame:
    """(experiment, param, value as text) of a training run: rows, folds, features used and dropped, rows per class."""
    known, numbers = active_features(df, numeric, target)
    cats = [c for c in categorical if c in df.columns]
    counts = [F.count(F.lit(1)).alias("n_samples")]
    if task == "classification":
        counts += [F.count_if(binary_target(target) == c).alias(f"n_class_{c}") for c in (0, 1)]
    row = known.agg(*counts).first().asDict()
    row |= {"n_folds": k, "n_numeric_features": len(numbers), "n_categorical_features": len(cats),
            "dropped_features": ",".join(c for c in numeric if c not in numbers) or "none"}
    experiment = REGRESSION if task == "regression" else CLASSIFICATION
    return df.sparkSession.createDataFrame([(experiment, p, str(v)) for p, v in row.items()], "experiment string, param string, value string")


def fold_runs(folds: DataFrame, experiment: str, model: str, metrics: Sequence[str]) -> DataFrame:
    """Fold metrics of one model as rows of the run table."""
    return run_metrics(folds.withColumn("model", F.lit(model)), metrics, experiment)


def grid_runs(results: DataFrame, experiment: str) -> DataFrame:
    """Test metrics of every grid configuration as rows of the run table."""
    names = [c for c in results.columns if c not in ("criterion", "max_depth", "min_samples_split")]
    named = results.withColumn("model", F.concat_ws("-", "criterion", "max_depth", "min_samples_split"))
    return named.unpivot(["model"], names, "metric", "value").select(
        F.lit(experiment).alias("experiment"), F.concat_ws("-", F.lit(experiment), "model").alias("run_id"), "model", "metric", "value")


def _area(scored: DataFrame) -> float:
    """ROC area over all thresholds (``numBins`` of 0 turns off down-sampling)."""
    return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", numBins=0).evaluate(scored)


def run_metrics(folds: DataFrame, metrics: Sequence[str], experiment: str, model: str = "model") -> DataFrame:
    """Long run table (one row per model and summary metric), the replacement of a tracking server."""
    summary = summarise_folds(folds, metrics, [model])
    names = [f"{m}_{s}" for m in metrics for s in ("mean", "std")]
    return summary.select(F.col(model).alias("model"), *names).unpivot(["model"], names, "metric", "value").select(
        F.lit(experiment).alias("experiment"),
        F.concat_ws("-", F.lit(experiment), "model").alias("run_id"), "model", "metric", "value",
    )


def best_run(runs: DataFrame, experiment: str, metric: str, ascending: bool) -> DataFrame:
    """The run with the lowest (or highest) value of a metric; the name settles ties."""
    rows = runs.where((F.col("experiment") == experiment) & (F.col("metric") == metric) & F.col("value").isNotNull())
    order = F.col("value").asc() if ascending else F.col("value").desc()
    return rows.orderBy(order, "run_id").limit(1)


def best_model(runs: DataFrame, experiment: str) -> str:
    """Name of the best model: lowest mean RMSE, or highest mean ROC area."""
    regression = experiment == REGRESSION
    row = best_run(runs, experiment, "rmse_mean" if regression else "auc_mean", regression).first()
    if row is None:
        raise ValueError(f"no runs in experiment {experiment!r}; train first")
    return row["model"]


def save_models(models: dict[str, TrainedModel], root: str) -> None:
    for name, model in models.items():
        model.save(SparkSession.active(), f"{root.rstrip('/')}/icu_{name}")


def load_model(root: str, name: str) -> TrainedModel:
    return TrainedModel.load(SparkSession.active(), f"{root.rstrip('/')}/icu_{name}")


def predict_icu(features: DataFrame, regressor: TrainedModel, classifier: TrainedModel, caseid: int | None = None) -> DataFrame:
    """Predicted days and need of intensive care for all cases, or for one; absent features count as missing."""
    if caseid is not None:
        features = features.where(F.col("caseid") == F.lit(caseid))
    for name, kind in [(c, "double") for c in fv.NUMERIC_FEATURES] + [(c, "string") for c in fv.CATEGORICAL_FEATURES]:
        if name not in features.columns:
            features = features.withColumn(name, F.lit(None).cast(kind))
    actual = F.col(fv.ICU_TARGET).cast("double") if fv.ICU_TARGET in features.columns else F.lit(None).cast("double")
    rows = features.select("caseid", actual.alias("actual_icu_days"), *fv.NUMERIC_FEATURES, *fv.CATEGORICAL_FEATURES)
    keep = ["caseid", "actual_icu_days"]
    days = regressor.transform(rows).select(*rows.columns, F.round("prediction", 2).alias("predicted_icu_days"))
    need = classifier.transform(days).select(*keep, "predicted_icu_days", (F.col("prediction") == 1).alias("predicted_needs_icu"))
    return need.withColumn("verdict", F.when(F.col("predicted_needs_icu"), fv.VERDICT_ICU).otherwise(fv.VERDICT_NO_ICU))


GRID_SCHEMA = ("criterion string, max_depth int, min_samples_split int, accuracy double, balanced_accuracy double, "
               "precision_macro double, precision_weighted double, recall_macro double, recall_weighted double, "
               "f1_macro double, f1_weighted double")


def _tree(config: tuple[str, int, int], seed: int) -> DecisionTreeClassifier:
    criterion, depth, split = config
    return DecisionTreeClassifier(
        impurity="gini" if criterion == "gini" else "entropy",  # log loss is the entropy criterion
        maxDepth=depth, minInstancesPerNode=max(1, split // 2), seed=seed, featuresCol="features", labelCol="label",
    )


def _labelled(df: DataFrame, target: str, key: str):
    features = [c for c in df.columns if c not in (target, key)]
    index = StringIndexer(inputCol=target, outputCol="label", stringOrderType="alphabetAsc").fit(df)
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    return index, assembler


REPORT_COLUMNS = "label string, precision double, recall double, f1 double, support long, predicted long, tp long"


def _reports(found: list[tuple], lead: str, spark: SparkSession) -> DataFrame:
    """Class reports of several fits in one table; a fit has one row per class, so the driver holds a few of them."""
    return spark.createDataFrame([(*keys, *row) for keys, rows in found for row in rows], f"{lead}, {REPORT_COLUMNS}")


def grid_search(df: DataFrame, target: str, key: str, grid: Sequence[tuple] = tuple(fv.TREE_GRID), test_size: float = 0.2,
                seed: int = 42, parallel: int = 4) -> DataFrame:
    """Fit a decision tree per configuration on a stratified split; one row of test metrics each."""
    return grid_results(df, target, key, grid, test_size, seed, parallel)[0]


MAX_BINS = 32  # of a feature in a tree
ALL_ROWS = 10_000  # training rows up to which a tree sets its bins by every row
PLAIN_VALUES = 64  # a feature with about so many values, or fewer, needs no bins


def _binned(df: DataFrame, features: Sequence[str]) -> dict[str, Column]:
    """Each feature as a tree sees it: the number of its bin if ``df``, the training rows, has many values of it, else the value.

    Bins hold equal shares of the rows. Null and NaN stay what they are, for the assembler to refuse.
    """
    known = {c: F.col(f"`{c}`").cast("double") for c in features}
    found = df.agg(F.count(F.lit(1)).alias("_n"), *[F.approx_count_distinct(v).alias(c) for c, v in known.items()]).first()
    many = [c for c in features if found["_n"] > ALL_ROWS and found[c] > PLAIN_VALUES]
    places = [i / MAX_BINS for i in range(1, MAX_BINS)]
    limits = df.agg(*[F.percentile_approx(F.when(~F.isnan(known[c]), known[c]), places, 10_000).alias(c) for c in many]).first() if many else {}
    for c in many:
        above = sum((F.when(known[c] > F.lit(float(x)), 1.0).otherwise(0.0) for x in sorted(set(limits[c] or []))), F.lit(0.0))
        known[c] = F.when(known[c].isNull() | F.isnan(known[c]), known[c]).otherwise(above)
    return known


def grid_results(df: DataFrame, target: str, key: str, grid: Sequence[tuple] = tuple(fv.TREE_GRID), test_size: float = 0.2,
                 seed: int = 42, parallel: int = 4) -> tuple[DataFrame, DataFrame]:
    """(test metrics, class reports) of every configuration.

    A tree tells rows apart by their bins only, and a node needs no more than the number of rows per bins and class. So rows
    with equal bins are counted once for all configurations, and trees are fitted and scored on the counts.
    """
    spark = df.sparkSession
    use_checkpoint_dir(spark)
    features = [c for c in df.columns if c not in (target, key)]
    rows = stratified_split(df, key, target, test_size, seed).drop(key).persist()
    bins = _binned(rows.where(~F.col("is_test")), features)
    counted = rows.select(F.col(f"`{target}`"), "is_test", *[b.alias(c) for c, b in bins.items()]).groupBy(target, "is_test", *[f"`{c}`" for c in features])
    cells = counted.agg(F.count(F.lit(1)).alias("_rows")).checkpoint()
    rows.unpersist()
    index, assembler = _labelled(cells.drop("is_test", "_rows"), target, key)
    cells = assembler.transform(index.transform(cells)).select("features", "label", "_rows", "is_test")
    train = cells.where(~F.col("is_test")).drop("is_test").persist()
    test = cells.where("is_test").drop("is_test").persist()
    n = train.agg(F.sum("_rows")).first()[0] or 0

    def fit(config: tuple[str, int, int]) -> Row:
        tree = _tree(config, seed).setWeightCol("_rows")
        least = tree.getMinInstancesPerNode()
        # rows per node are a weight here; half a row less keeps rounding away from the limit
        tree = tree.setMinInstancesPerNode(1).setMinWeightFractionPerNode((least - 0.5) / n) if 2 * least <= n else tree.setMaxDepth(0)
        scored = tree.fit(train).transform(test)
        metrics = multiclass_metrics(scored, "label", "prediction", "_rows").first().asDict()
        report = [(index.labels[int(float(r.label))], *r[1:]) for r in class_report(scored, "label", "prediction", "_rows").collect()]
        return Row(criterion=config[0], max_depth=config[1], min_samples_split=config[2], **metrics), (config, report)

    with ThreadPoolExecutor(parallel) as pool:
        results, reports = zip(*pool.map(fit, grid))
    train.unpersist()
    test.unpersist()
    names = [part.split()[0] for part in GRID_SCHEMA.split(", ")]
    return (spark.createDataFrame([tuple(r[n] for n in names) for r in results], GRID_SCHEMA),
            _reports(reports, "criterion string, max_depth int, min_samples_split int", spark))


def best_config(results: DataFrame) -> DataFrame:
    """Highest macro F1, then accuracy, then the smallest depth and split size."""
    return results.orderBy(F.desc("f1_macro"), F.desc("accuracy"), "max_depth", "min_samples_split", "criterion").limit(1)


def fit_best_tree(df: DataFrame, target: str, key: str, best: Row, seed: int = 42) -> PipelineModel:
    """The winning tree on all rows; predictions come back as original labels."""
    index, assembler = _labelled(df, target, key)
    tree = _tree((best["criterion"], best["max_depth"], best["min_samples_split"]), seed)
    model = tree.fit(assembler.transform(index.transform(df)))
    back = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=index.labels)
    return PipelineModel(stages=[assembler, model, back])


def logistic_pipeline(features: Sequence[str], rows: int, c: float = 1.0, max_iter: int = 1000) -> Pipeline:
    """Standardised L2 logistic regression; ``c`` weighs the loss, Spark weighs the penalty per row."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter, regParam=1.0 / (c * rows), standardization=False),
    ])


FOLD_METRICS = ["accuracy", "balanced_accuracy", "precision", "recall", "f1", "roc_auc", "average_precision"]


def train_logistic_cv(df: DataFrame, target: str, key: str, k: int = 5, seed: int = 42, c: float = 1.0, max_iter: int = 1000,
                      parallel: int = 4) -> tuple[PipelineModel, DataFrame]:
    """(model fitted on all rows, fold metrics) of a binary table with numeric features."""
    return logistic_cv_results(df, target, key, k, seed, c, max_iter, parallel)[:2]


def logistic_cv_results(df: DataFrame, target: str, key: str, k: int = 5, seed: int = 42, c: float = 1.0, max_iter: int = 1000,
                        parallel: int = 4) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """(model fitted on all rows, fold metrics, class report of each fold)."""
    spark = df.sparkSession
    features = [x for x in df.columns if x not in (target, key)]
    rows = assign_folds(df.withColumn("label", F.col(target).cast("double")), k, key, "label", seed).persist()

    def fold(i: int) -> tuple:
        train, test = rows.where(F.col("fold") != i), rows.where(F.col("fold") == i)
        model = logistic_pipeline(features, train.count(), c, max_iter).fit(train)
        scored = model.transform(test).select("label", "prediction", vector_to_array("probability")[1].alias("score")).persist()
        values = binary_metrics(scored, "label", "prediction").first().asDict()
        values.update(roc_auc(scored, "label").first().asDict())
        values.update(average_precision(scored, "label").first().asDict())
        report = [(str(int(float(r.label))), *r[1:]) for r in class_report(scored, "label", "prediction").collect()]
        scored.unpersist()
        return (i, *[values[m] for m in FOLD_METRICS]), ((i,), report)

    with ThreadPoolExecutor(parallel) as pool:
        results, reports = zip(*pool.map(fold, range(k)))
    model = logistic_pipeline(features, rows.count(), c, max_iter).fit(rows)
    rows.unpersist()
    folds = spark.createDataFrame(list(results), "fold_idx int, " + ", ".join(f"{m} double" for m in FOLD_METRICS))
    return model, folds, _reports(reports, "fold_idx int", spark)
