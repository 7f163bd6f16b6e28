"""Metric and model queries. Metrics have SQL beside them; fitted models are checked by their rows only."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from perispark import fixed_values as fv
from perispark.functions.columns import binary_target
from perispark.ml import folds, metrics, train
from perispark.ml.prep import active_features, apply_preprocessor, fit_preprocessor
from perispark.ml.store import ModelStore
from perispark.queries import fixtures as fx
from perispark.queries.clinical import FEATURES_SQL, features
from perispark.queries.registry import Registry, rounded
from perispark.queries.tables import shared_folder
from perispark.session import use_checkpoint_dir

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


# ---- preparation ----
NUMBERS = ["age", "bmi", "asa", "preop_hb", "preop_plt", "preop_wbc", "preop_gluc"]


def mode_sql(c):
    return f"(SELECT {c} FROM f WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


ENCODED_SQL = f"""WITH f AS MATERIALIZED ({FEATURES_SQL}), med AS (SELECT {", ".join(f"median({c}) AS {c}" for c in NUMBERS)} FROM f),
 filled AS MATERIALIZED (SELECT caseid, {", ".join(f"coalesce(f.{c}, med.{c}) AS {c}" for c in NUMBERS)},
 {", ".join(f"coalesce({c}, {mode_sql(c)}) AS {c}" for c in fv.CATEGORICAL_FEATURES)} FROM f CROSS JOIN med)
 SELECT caseid, {", ".join(f"round(({c} - avg({c}) OVER ()) / (stddev_pop({c}) OVER ()), 6) AS f_{c}" for c in NUMBERS)},
 {", ".join(f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS DOUBLE) AS f_{c}" for c in fv.CATEGORICAL_FEATURES)} FROM filled"""


@query(ENCODED_SQL)
def impute_encode_scale(spark, sf):
    use_checkpoint_dir(spark)
    stored = features(spark, sf).checkpoint()  # a stored table in practice; fitting reads it several times
    known, numbers = active_features(stored, fv.NUMERIC_FEATURES, fv.ICU_TARGET)
    fitted = fit_preprocessor(known, numbers, fv.CATEGORICAL_FEATURES)
    return rounded(apply_preprocessor(known, fitted, ["caseid"]).select("caseid", *fitted.features), *[f"f_{c}" for c in numbers])


# ---- metrics ----
REGRESSION_SQL = "SELECT l_extendedprice AS y, l_quantity * 1000 AS yhat FROM {lineitem}"
CLASSES_SQL = """SELECT l_returnflag AS y, CASE WHEN l_partkey % 50 = 0 THEN 'X' WHEN l_linestatus <> 'F' THEN 'N'
 WHEN l_quantity > 25 THEN 'A' ELSE 'R' END AS yhat FROM {lineitem}"""


@query(f"""SELECT round(sqrt(avg((y - yhat) ** 2)), 4) AS rmse, round(avg(abs(y - yhat)), 4) AS mae,
 round(1 - avg((y - yhat) ** 2) / var_pop(y), 6) AS r2 FROM ({REGRESSION_SQL})""")
def regression_metrics(spark, sf):
    return rounded(rounded(metrics.regression_metrics(fx.project(spark, sf, REGRESSION_SQL)), "rmse", "mae", digits=4), "r2")


def binary_sql(source, by=""):
    group = f" GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""SELECT {lead}(tp + tn) / (tp + fp + fn + tn) AS accuracy, (tp / (tp + fn) + tn / (tn + fp)) / 2 AS balanced_accuracy,
 coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1
 FROM (SELECT {lead}count(CASE WHEN y = 1 AND yhat = 1 THEN 1 END) AS tp, count(CASE WHEN y <> 1 AND yhat = 1 THEN 1 END) AS fp,
 count(CASE WHEN y = 1 AND yhat <> 1 THEN 1 END) AS fn, count(CASE WHEN y <> 1 AND yhat <> 1 THEN 1 END) AS tn FROM ({source}){group})"""


BINARY = ["accuracy", "balanced_accuracy", "precision", "recall", "f1"]


@query(f"SELECT {', '.join(f'round({m}, 6) AS {m}' for m in BINARY)} FROM ({binary_sql(fx.PREDICTIONS_SQL)})")
def binary_metrics(spark, sf):
    return rounded(metrics.binary_metrics(fx.project(spark, sf, fx.PREDICTIONS_SQL)), *BINARY)


@query(f"""SELECT round(sum(pos * (below + neg / 2)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 6) AS roc_auc FROM (
 SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM (
 SELECT score, count(CASE WHEN y = 1 THEN 1 END) AS pos, count(CASE WHEN y = 0 THEN 1 END) AS neg FROM ({fx.SCORES_SQL}) GROUP BY score))""")
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(fx.project(spark, sf, fx.SCORES_SQL)), "roc_auc")


@query(f"""SELECT round(sum(pos * tp / (tp + fp)) / sum(pos), 6) AS average_precision FROM (SELECT pos, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM (
 SELECT score, count(CASE WHEN y = 1 THEN 1 END) AS pos, count(CASE WHEN y = 0 THEN 1 END) AS neg FROM ({fx.SCORES_SQL}) GROUP BY score)
 WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))""")
def average_precision(spark, sf):
    return rounded(metrics.average_precision(fx.project(spark, sf, fx.SCORES_SQL)), "average_precision")


REPORT_SQL = f"""WITH p AS ({CLASSES_SQL}), l AS (SELECT y AS label FROM p UNION SELECT yhat FROM p), c AS (SELECT label,
 (SELECT count(*) FROM p WHERE y = label) AS support, (SELECT count(*) FROM p WHERE yhat = label) AS predicted,
 (SELECT count(*) FROM p WHERE y = label AND yhat = label) AS tp FROM l)
 SELECT label, coalesce(tp / nullif(predicted, 0), 0.0) AS precision, coalesce(tp / nullif(support, 0), 0.0) AS recall,
 coalesce(2 * tp / nullif(predicted + support, 0), 0.0) AS f1, support, predicted, tp FROM c"""


@query(f"SELECT * REPLACE (round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1) FROM ({REPORT_SQL})")
def class_report(spark, sf):
    return rounded(metrics.class_report(fx.project(spark, sf, CLASSES_SQL)), "precision", "recall", "f1")


MULTI = [f"{m}_{w}" for m in ("precision", "recall", "f1") for w in ("macro", "weighted")]


@query(f"""SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(avg(CASE WHEN support > 0 THEN recall END), 6) AS balanced_accuracy,
 {", ".join(f"round(avg({m}), 6) AS {m}_macro, round(sum({m} * support) / sum(support), 6) AS {m}_weighted" for m in ("precision", "recall", "f1"))}
 FROM ({REPORT_SQL})""")
def multiclass_metrics(spark, sf):
    return rounded(metrics.multiclass_metrics(fx.project(spark, sf, CLASSES_SQL)), "accuracy", "balanced_accuracy", *MULTI)


LABELS = ["A", "N", "R", "X"]


@query(f"""WITH p AS ({CLASSES_SQL}) SELECT true_label, {", ".join(
    f"(SELECT count(*) FROM p WHERE y = true_label AND yhat = '{x}') AS pred_{x}" for x in LABELS)}
 FROM (VALUES ('A'), ('N'), ('R'), ('X')) AS l(true_label)""")
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(fx.project(spark, sf, CLASSES_SQL), LABELS)


FOLDS_SQL = f"SELECT CAST(tie % 5 AS INTEGER) AS fold, y, CASE WHEN score > 0.6 THEN 1 ELSE 0 END AS yhat FROM ({fx.SCORES_SQL})"


@query(f"""SELECT count(*) AS n_folds, {", ".join(f"round(avg({m}), 6) AS {m}_mean, round(stddev_pop({m}), 6) AS {m}_std" for m in BINARY)}
 FROM ({binary_sql(FOLDS_SQL, 'fold')})""")
def cv_summary(spark, sf):
    per_fold = metrics.binary_metrics(fx.project(spark, sf, FOLDS_SQL), by=["fold"])
    return rounded(metrics.summarise_folds(per_fold, BINARY), *[f"{m}_{s}" for m in BINARY for s in ("mean", "std")])


RUNS_SQL = "SELECT event_type AS model, CAST(event_id % 5 AS INTEGER) AS fold, value AS y, least(value, 40.0) AS yhat FROM {events}"


@query(f"""SELECT 'ICU_Days_Regression' AS experiment, 'ICU_Days_Regression-' || model AS run_id, model, 'rmse_mean' AS metric, round(value, 6) AS value FROM (
 SELECT model, avg(rmse) AS value FROM (SELECT model, fold, sqrt(avg((y - yhat) ** 2)) AS rmse FROM ({RUNS_SQL}) GROUP BY model, fold) GROUP BY model)
 ORDER BY value, model LIMIT 1""")
def best_run(spark, sf):
    per_fold = metrics.regression_metrics(fx.project(spark, sf, RUNS_SQL), by=["model", "fold"])
    runs = train.run_metrics(per_fold, ["rmse", "mae", "r2"], train.REGRESSION)
    return rounded(train.best_run(runs, train.REGRESSION, "rmse_mean", ascending=True), "value")


CONFIGS_SQL = """SELECT CASE WHEN l_returnflag = 'A' THEN 'gini' WHEN l_returnflag = 'N' THEN 'entropy' ELSE 'log_loss' END AS criterion,
 l_linenumber AS max_depth, CAST(l_suppkey % 3 + 2 AS INTEGER) AS min_samples_split, count(*) % 3 AS f1_macro, count(*) % 2 AS accuracy FROM {lineitem}
 GROUP BY l_returnflag, l_linenumber, l_suppkey % 3"""


@query(f"SELECT * FROM ({CONFIGS_SQL}) ORDER BY f1_macro DESC, accuracy DESC, max_depth, min_samples_split, criterion LIMIT 1")
def best_config(spark, sf):
    return train.best_config(fx.project(spark, sf, CONFIGS_SQL))


# ---- folds and splits: which rows land where is a hash, how many is fixed ----
@query("""SELECT l_returnflag AS label, CAST(fold AS INTEGER) AS fold, (n - fold + 4) // 5 AS rows_in_fold FROM (
 SELECT l_returnflag, count(*) AS n FROM {lineitem} GROUP BY l_returnflag), range(5) r(fold)""")
def stratified_folds(spark, sf):
    rows = keyed_lines(spark, sf).select("line", F.col("l_returnflag").alias("label"))
    return folds.assign_folds(rows, 5, "line", "label").groupBy("label", "fold").agg(F.count(F.lit(1)).alias("rows_in_fold"))


@query("""SELECT label, is_test, CASE WHEN is_test THEN cut ELSE n - cut END AS n FROM (SELECT l_returnflag AS label, count(*) AS n,
 CAST(ceil(count(*) * 0.2) AS BIGINT) AS cut FROM {lineitem} GROUP BY l_returnflag), (VALUES (TRUE), (FALSE)) t(is_test)""")
def stratified_split(spark, sf):
    rows = keyed_lines(spark, sf).select("line", F.col("l_returnflag").alias("label"))
    return folds.stratified_split(rows, "line", "label").groupBy("label", "is_test").agg(F.count(F.lit(1)).alias("n"))


def keyed_lines(spark, sf):
    """Line items with one key per row, built from all columns (order and line number repeat)."""
    lines = fx.table(spark, sf, "lineitem")
    return lines.withColumn("line", F.xxhash64(*lines.columns))


# ---- models ----
def store(spark):
    """Runs and models of this session's shared folder."""
    return ModelStore(spark, f"{use_checkpoint_dir(spark)}/model-store")


def stored_features(spark, sf):
    """The feature table, written once as in practice: trainings read it several times."""
    use_checkpoint_dir(spark)
    return features(spark, sf).checkpoint()


LINES_SQL = "SELECT l_quantity AS x, l_extendedprice AS label, CAST(l_orderkey % 5 AS INTEGER) AS fold FROM {lineitem}"


@query(f"""WITH r AS MATERIALIZED ({LINES_SQL}), f AS (SELECT k.fold, regr_slope(label, x) AS slope, regr_intercept(label, x) AS base
 FROM r JOIN (SELECT DISTINCT fold FROM r) k ON r.fold <> k.fold GROUP BY k.fold), e AS (SELECT r.fold, label, label - slope * x - base AS d FROM r JOIN f USING (fold))
 SELECT fold, round(sqrt(avg(d * d)), 3) AS rmse, round(avg(abs(d)), 3) AS mae, round(1 - avg(d * d) / var_pop(label), 6) AS r2 FROM e GROUP BY fold""")
def linear_folds(spark, sf):
    """The set's linear model on one feature and given folds, each fold scored by the model of the others."""
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(fx.project(spark, sf, LINES_SQL))
    scored = None
    for i in range(5):
        model = train.estimators("regression")["LinearRegression"].fit(rows.where(F.col("fold") != i))
        part = model.transform(rows.where(F.col("fold") == i)).select("fold", "label", "prediction")
        scored = part if scored is None else scored.unionByName(part)
    found = metrics.regression_metrics(scored, "label", "prediction", by=["fold"])
    return rounded(rounded(found, "rmse", "mae", digits=3), "r2")


@query()
def train_regression(spark, sf):
    return store(spark).train(stored_features(spark, sf), "regression")[1]


@query()
def train_classification(spark, sf):
    return store(spark).train(stored_features(spark, sf), "classification")[1]


PARAMETERS = [("n_samples", "CAST(count(*) AS VARCHAR)"), ("n_folds", "max('5')"), ("n_numeric_features", "max('7')"), ("n_categorical_features", "max('5')"),
              ("dropped_features", "max('preop_cr,preop_alb')")]
CLASS_COUNTS = [("n_class_0", "CAST(count(CASE WHEN icu_days <= 0 THEN 1 END) AS VARCHAR)"), ("n_class_1", "CAST(count(CASE WHEN icu_days > 0 THEN 1 END) AS VARCHAR)")]


@query(" UNION ALL ".join(f"SELECT '{experiment}' AS experiment, '{name}' AS param, {value} AS value FROM ({FEATURES_SQL})"
                          for experiment, rows in ((train.REGRESSION, PARAMETERS), (train.CLASSIFICATION, PARAMETERS + CLASS_COUNTS)) for name, value in rows))
def run_parameters(spark, sf):
    table = features(spark, sf)
    return train.run_parameters(table, "regression").unionByName(train.run_parameters(table, "classification"))


@query()
def icu_predictions(spark, sf):
    """Every case scored by the best stored model of each task; what is not stored yet is trained first."""
    return store(spark).predict(stored_features(spark, sf))


GRID_SQL = """SELECT criterion || '-' || max_depth || '-' || min_samples_split AS model, CAST(f1_macro AS DOUBLE) AS f1_macro, CAST(accuracy AS DOUBLE) AS accuracy
 FROM (SELECT * FROM (""" + CONFIGS_SQL + "))"


def runs_sql(experiment, source, metrics):
    return " UNION ALL ".join(f"SELECT '{experiment}' AS experiment, '{experiment}-' || model AS run_id, model, '{m}' AS metric, round({e}, 6) AS value FROM ({source}) GROUP BY model"
                              for m, e in metrics.items())


FOLD_SOURCE = f"SELECT 'LogisticRegression' AS model, * FROM ({binary_sql(FOLDS_SQL, 'fold')})"
RMSE_SOURCE = f"SELECT model, fold, sqrt(avg((y - yhat) ** 2)) AS rmse, avg(abs(y - yhat)) AS mae FROM ({RUNS_SQL}) GROUP BY model, fold"


@query(" UNION ALL ".join([
    runs_sql(train.REGRESSION, RMSE_SOURCE, {f"{m}_{n}": f"{e}({m})" for m in ("rmse", "mae") for n, e in (("mean", "avg"), ("std", "stddev_pop"))}),
    runs_sql("Logistic_CV", FOLD_SOURCE, {f"{m}_{n}": f"{e}({m})" for m in BINARY for n, e in (("mean", "avg"), ("std", "stddev_pop"))}),
    runs_sql("Tree_Grid", GRID_SQL, {m: f"max({m})" for m in ("f1_macro", "accuracy")}),
]))
def run_table(spark, sf):
    """Runs of a model set, a cross-validation and a grid, appended to a stored table (one of them twice) and read from it."""
    runs = ModelStore(spark, shared_folder(spark, "runs"))
    per_fold = metrics.regression_metrics(fx.project(spark, sf, RUNS_SQL), by=["model", "fold"])
    runs.append(train.run_metrics(per_fold, ["rmse", "mae"], train.REGRESSION), "a")
    folds = metrics.binary_metrics(fx.project(spark, sf, FOLDS_SQL), by=["fold"])
    runs.append(rounded(train.fold_runs(folds, "Logistic_CV", "LogisticRegression", BINARY), "value"), "b")
    grid = fx.project(spark, sf, CONFIGS_SQL).withColumns({m: F.col(m).cast("double") for m in ("f1_macro", "accuracy")})
    for _ in range(2):
        runs.append(train.grid_runs(grid, "Tree_Grid"), "c")
    return rounded(runs.runs().drop("training"), "value")


def flagged_lines(spark, sf):
    return keyed_lines(spark, sf).select("line", "l_quantity", "l_extendedprice", "l_discount", "l_tax", F.col("l_returnflag").alias("label_text"))


def priced_lines(spark, sf):
    return keyed_lines(spark, sf).select("line", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                                         binary_target(F.col("l_extendedprice") / F.col("l_quantity") - F.lit(1500.0)).alias("result"))


@query()
def grid_search(spark, sf):
    return train.grid_search(flagged_lines(spark, sf), "label_text", "line")


@query(f"""SELECT criterion, max_depth, min_samples_split, label, CAST(ceil(n * 0.2) AS BIGINT) AS support FROM (
 SELECT l_returnflag AS label, count(*) AS n FROM {{lineitem}} GROUP BY l_returnflag),
 (VALUES {", ".join(str(c) for c in fv.TREE_GRID)}) g(criterion, max_depth, min_samples_split)""")
def grid_reports(spark, sf):
    """Test rows of each class in the report of every configuration."""
    return train.grid_results(flagged_lines(spark, sf), "label_text", "line")[1].select("criterion", "max_depth", "min_samples_split", "label", "support")


@query()
def train_logistic_cv(spark, sf):
    return train.train_logistic_cv(priced_lines(spark, sf), "result", "line")[1]


@query("""SELECT CAST(fold AS INTEGER) AS fold_idx, CAST(y AS VARCHAR) AS label, (n - fold + 4) // 5 AS support FROM (
 SELECT CASE WHEN l_extendedprice / l_quantity > 1500.0 THEN 1 ELSE 0 END AS y, count(*) AS n FROM {lineitem} GROUP BY 1), range(5) r(fold)""")
def fold_reports(spark, sf):
    """Test rows of each class in the report of every fold."""
    return train.logistic_cv_results(priced_lines(spark, sf), "result", "line")[2].select("fold_idx", "label", "support")


# ---- grids, folds and final models on labels that follow from a feature: what a right fit gives is known ----
LEVEL = "CASE WHEN l_linenumber <= 2 THEN 'low' WHEN l_linenumber <= 5 THEN 'mid' ELSE 'top' END"
GRID_METRICS = [c.split()[0] for c in train.GRID_SCHEMA.split(", ")[3:]]


@query(f"""SELECT criterion, max_depth, min_samples_split, {", ".join(f"share AS {m}" for m in GRID_METRICS)} FROM (
 SELECT avg(CASE WHEN {LEVEL} = level THEN 1.0 ELSE 0.0 END) AS share FROM (SELECT *, {LEVEL} AS level FROM {{lineitem}})),
 (VALUES {", ".join(str(c) for c in fv.TREE_GRID)}) g(criterion, max_depth, min_samples_split)""")
def grid_exact(spark, sf):
    """All metrics of every configuration where the class is a rule of one feature that a tree of depth 2 can hold."""
    rows = keyed_lines(spark, sf).select("line", F.col("l_linenumber").cast("double").alias("number"), "l_tax", F.expr(LEVEL).alias("level"))
    return train.grid_search(rows, "level", "line")


@query(f"""SELECT CAST(fold AS INTEGER) AS fold_idx, {", ".join(f"share AS {m}" for m in train.FOLD_METRICS)} FROM (
 SELECT avg(CASE WHEN (l_linestatus = 'F') = flag THEN 1.0 ELSE 0.0 END) AS share FROM (SELECT *, l_linestatus = 'F' AS flag FROM {{lineitem}})), range(5) r(fold)""")
def logistic_exact(spark, sf):
    """All metrics of every fold where the class is one feature."""
    rows = keyed_lines(spark, sf).select("line", F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0).alias("flag"), "l_tax",
                                         binary_target(F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0)).alias("result"))
    return train.train_logistic_cv(rows, "result", "line")[1]


NOISY = """CASE WHEN l_quantity > 45 THEN 'C' WHEN l_quantity < 6 THEN 'B' WHEN l_linenumber <= 2 THEN 'A' WHEN l_linenumber <= 4 THEN 'B' ELSE 'C' END"""


@query(f"""WITH r AS (SELECT l_linenumber AS number, {NOISY} AS label FROM {{lineitem}}), n AS (SELECT number, label, count(*) AS n FROM r GROUP BY ALL)
 SELECT number, label, n, predicted FROM n JOIN (SELECT number, arg_max(label, n) AS predicted FROM n GROUP BY number) USING (number)""")
def final_tree(spark, sf):
    """Every line labelled by the winning tree, fitted on all rows: it predicts the most frequent class of each value."""
    rows = keyed_lines(spark, sf).select("line", F.col("l_linenumber").cast("double").alias("number"), F.expr(NOISY).alias("label_text"))
    best = train.best_config(train.grid_search(rows, "label_text", "line", [c for c in fv.TREE_GRID if c[1] >= 4])).first()
    scored = train.fit_best_tree(rows, "label_text", "line", best).transform(rows)
    return scored.groupBy(F.col("number").cast("int").alias("number"), F.col("label_text").alias("label"), F.col("predicted_label").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH r AS (SELECT l_linestatus = 'F' AS flag, CASE WHEN (l_linestatus = 'F') = (l_quantity > 15) THEN 1 ELSE 0 END AS result FROM {lineitem}),
 n AS (SELECT flag, result, count(*) AS n FROM r GROUP BY ALL) SELECT flag, CAST(result AS INTEGER) AS result, n, CAST(p AS INTEGER) AS predicted
 FROM n JOIN (SELECT flag, arg_max(result, n) AS p FROM n GROUP BY flag) USING (flag)""")
def final_logistic(spark, sf):
    """Every line scored by the logistic model fitted on all rows: it predicts the most frequent class of each value."""
    flag = F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0)
    hit = (F.col("l_linestatus") == "F") == (F.col("l_quantity") > 15)
    rows = keyed_lines(spark, sf).select("line", flag.alias("flag"), F.when(hit, 1).otherwise(0).alias("result"))
    scored = train.train_logistic_cv(rows, "result", "line")[0].transform(rows)
    return scored.groupBy((F.col("flag") == 1).alias("flag"), "result", F.col("prediction").cast("int").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
