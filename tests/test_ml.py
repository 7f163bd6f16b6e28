import random
import threading
import time

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from perispark import fixed_values as fv
from perispark.ml import folds, metrics, prep, train


@pytest.fixture(scope="module")
def cases(spark):
    """Feature rows whose ICU stay follows age and department."""
    rnd = random.Random(7)
    data = []
    for i in range(240):
        age, dept = rnd.uniform(20, 90), rnd.choice(["A", "B", None])
        stay = max(0.0, 1.0 * round((age - 50) / 10 + (2 if dept == "B" else 0) + rnd.uniform(-1, 1)))
        data.append((i, age if i % 9 else None, rnd.choice(["M", "F"]), 20.0 + i % 10, float(i % 4), dept, "o", "x", "g", 10.0 + i % 3, None, None, None, None, None, stay))
    names = ["age", "sex", "bmi", "asa", "department", "optype", "approach", "ane_type", *[f"preop_{x}" for x in fv.PREOP_LABS], "icu_days"]
    kinds = {n: "string" for n in fv.CATEGORICAL_FEATURES}
    return spark.createDataFrame(data, "caseid long, " + ", ".join(f"{n} {kinds.get(n, 'double')}" for n in names)).repartition(4).cache()


def preds(spark, pairs):
    return spark.createDataFrame(pairs, "y int, yhat int")


# ---- metrics ----
def test_binary_metrics(spark):
    r = metrics.binary_metrics(preds(spark, [(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)])).first()
    assert r.accuracy == 0.6 and r.precision == 0.5 and r.recall == 0.5 and r.f1 == 0.5
    assert r.balanced_accuracy == pytest.approx((0.5 + 2 / 3) / 2)
    none = metrics.binary_metrics(preds(spark, [(1, 0), (0, 0)])).first()
    assert (none.precision, none.recall, none.f1, none.balanced_accuracy) == (0.0, 0.0, 0.0, 0.5)
    one_class = metrics.binary_metrics(preds(spark, [(0, 0), (0, 1)])).first()
    assert one_class.balanced_accuracy == 0.5 and one_class.recall == 0.0


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0)], "y double, yhat double")
    r = metrics.regression_metrics(df).first()
    assert r.rmse == pytest.approx((5 / 3) ** 0.5) and r.mae == 1.0 and r.r2 == pytest.approx(1 - 5 / 8)
    assert metrics.regression_metrics(df.where("y = 1")).first().r2 is None


@pytest.mark.parametrize("buckets", [1, 3, 64])
def test_auc_and_average_precision(spark, buckets):
    rnd = random.Random(2)
    data = [(rnd.randint(0, 1), rnd.choice([0.1, 0.2, 0.2, 0.5, rnd.random()])) for _ in range(300)]
    df = spark.createDataFrame(data, "y int, score double").repartition(4)
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap = 0.0
    for t in sorted({s for _, s in data}, reverse=True):
        at = sum(1 for p in pos if p == t)
        ap += at / len(pos) * sum(p >= t for p in pos) / sum(s >= t for _, s in data)
    assert metrics.roc_auc(df, buckets=buckets).first().roc_auc == pytest.approx(auc)
    assert metrics.average_precision(df, buckets=buckets).first().average_precision == pytest.approx(ap)


def test_auc_of_one_class(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.6)], "y int, score double")
    assert metrics.roc_auc(df).first().roc_auc is None
    assert metrics.average_precision(df).first().average_precision == 1.0


def test_auc_of_tied_scores(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5)], "y int, score double")
    assert metrics.roc_auc(df).first().roc_auc == 0.5


def test_multiclass(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "x")], "y string, yhat string")
    report = {r.label: (r.precision, r.recall, r.f1, r.support) for r in metrics.class_report(df).collect()}
    assert report == {"a": (1.0, 0.5, pytest.approx(2 / 3), 2), "b": (0.5, 1.0, pytest.approx(2 / 3), 1), "c": (0.0, 0.0, 0.0, 1), "x": (0.0, 0.0, 0.0, 0)}
    m = metrics.multiclass_metrics(df).first()
    assert m.accuracy == 0.5 and m.balanced_accuracy == 0.5 and m.precision_macro == 0.375 and m.recall_weighted == 0.5
    matrix = {r.true_label: (r.pred_a, r.pred_b, r.pred_z) for r in metrics.confusion_matrix(df, ["a", "b", "z"]).collect()}
    assert matrix == {"a": (1, 1, 0), "b": (0, 1, 0), "z": (0, 0, 0)}


def test_fold_summary(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 1.0)], "fold int, f1 double")
    r = metrics.summarise_folds(df, ["f1"]).first()
    assert (r.n_folds, r.f1_mean, r.f1_std) == (2, 0.75, 0.25)


# ---- folds ----
@pytest.mark.parametrize("buckets", [1, 16, 16_384])
def test_folds_are_balanced_and_repeatable(spark, buckets):
    df = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") % 7 == 0, "rare").otherwise("often").alias("y"))
    a = folds.assign_folds(df, 5, "k", "y", buckets=buckets)
    counts = {}
    for r in a.groupBy("y", "fold").count().collect():
        counts.setdefault(r.y, []).append(r["count"])
    assert all(len(v) == 5 and max(v) - min(v) <= 1 for v in counts.values())
    b = folds.assign_folds(df.repartition(9), 5, "k", "y", buckets=buckets)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert a.columns == ["k", "y", "fold"]
    other = folds.assign_folds(df, 5, "k", "y", seed=1, buckets=buckets)
    assert sorted(map(tuple, a.collect())) != sorted(map(tuple, other.collect()))
    with pytest.raises(ValueError):
        folds.assign_folds(df, 1, "k")


def test_plain_folds_and_split(spark):
    df = spark.range(103).toDF("k")
    assert sorted(r["count"] for r in folds.assign_folds(df, 5, "k").groupBy("fold").count().collect()) == [20, 20, 21, 21, 21]
    labelled = df.withColumn("y", F.col("k") % 2)
    got = {(r.y, r.is_test): r["count"] for r in folds.stratified_split(labelled, "k", "y", 0.2).groupBy("y", "is_test").count().collect()}
    assert got == {(0, True): 11, (0, False): 41, (1, True): 11, (1, False): 40}


# ---- preparation ----
def test_exact_median(spark):
    df = spark.createDataFrame([(float(v), float(v % 3) if v % 2 else None) for v in range(100)], "a double, b double")
    got = prep.exact_median(df, ["a", "b"])
    odd = sorted(v % 3 for v in range(100) if v % 2)
    assert got == {"a": 49.5, "b": (odd[24] + odd[25]) / 2}


def test_preprocessor(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "b"), (3.0, "a"), (None, "b"), (5.0, None)], "x double, c string")
    fitted = prep.fit_preprocessor(df, ["x"], ["c"])
    assert fitted.medians == {"x": 3.0} and fitted.modes == {"c": "b"} and sorted((r.value, r.code) for r in fitted.codes.collect()) == [("a", 0.0), ("b", 1.0)]
    seen = spark.createDataFrame([(None, "a"), (5.0, None), (1.0, "it's new")], "x double, c string")
    want = [(pytest.approx(-2 / 2 ** 0.5), -1.0), (0.0, 0.0), (pytest.approx(2 / 2 ** 0.5), 1.0)]
    assert sorted((r.f_x, r.f_c) for r in prep.apply_preprocessor(seen, fitted).collect()) == want
    fitted.save(spark, str(tmp_path))
    assert sorted((r.f_x, r.f_c) for r in prep.Preprocessor.load(spark, str(tmp_path)).transform(seen).collect()) == want


def test_constant_feature_and_ties(spark):
    df = spark.createDataFrame([(2.0, "z"), (2.0, "a")], "x double, c string")
    fitted = prep.fit_preprocessor(df, ["x"], ["c"])
    assert fitted.modes == {"c": "a"}
    assert [r.f_x for r in prep.apply_preprocessor(df, fitted).collect()] == [0.0, 0.0]


def test_features_without_values_are_constant(spark):
    df = spark.createDataFrame([(None, None, 1.0), (None, None, 3.0)], "x double, c string, y double")
    fitted = prep.fit_preprocessor(df, ["x", "y"], ["c"])
    assert [(r.f_x, r.f_c) for r in prep.apply_preprocessor(df, fitted).collect()] == [(0.0, -1.0)] * 2
    assert sorted(r.f_y for r in prep.apply_preprocessor(df, fitted).collect()) == [-1.0, 1.0]


def test_very_many_categories(spark):
    df = spark.range(20_000).select(F.format_string("c%05d", "id").alias("c"))
    fitted = prep.fit_preprocessor(df, [], ["c"])
    assert prep.apply_preprocessor(df, fitted).where("f_c <> CAST(substring(c, 2) AS DOUBLE)").count() == 0
    assert fitted.codes.count() == 20_000


def test_load_matrix(spark):
    df = spark.createDataFrame([("1", "2.5", "1"), ("3", "4", "0")], ["Age ", "Max HR", "Result"])
    assert [tuple(r) for r in prep.load_matrix(df).collect()] == [(1.0, 2.5, 1), (3.0, 4.0, 0)]
    assert prep.load_matrix(df).columns == ["age", "max_hr", "result"]
    with pytest.raises(ValueError, match="null values"):
        prep.load_matrix(df.union(spark.createDataFrame([("x", "1", "1")], df.columns)))
    with pytest.raises(ValueError, match="empty"):
        prep.load_matrix(df.where("false"))
    with pytest.raises(ValueError, match="target"):
        prep.load_matrix(df, "gone")
    with pytest.raises(ValueError, match="no feature"):
        prep.load_matrix(df.select("Result"))


def test_pick_target(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Class", "a", "Species"])
    table, target = prep.pick_target(df)
    assert target == "species" and table.columns == ["class", "a", "species"]
    assert prep.pick_target(df.select("Class", "a"))[1] == "class"
    assert prep.pick_target(spark.createDataFrame([(1, 2)], ["p", "q"]))[1] == "q"


# ---- models ----
@pytest.fixture(scope="module")
def fitted(cases):
    return {task: train.train_set(cases, task, k=3, trees=5) for task in ("regression", "classification")}


def test_train_sets(fitted, spark):
    for task, kinds, found in (("regression", {"LinearRegression", "RandomForestRegressor", "GBTRegressor"}, {"rmse", "mae", "r2"}),
                               ("classification", {"LogisticRegression", "RandomForestClassifier", "GBTClassifier"}, {"auc", "f1", "accuracy"})):
        models, runs = fitted[task]
        assert set(models) == kinds
        values = {(r.model, r.metric): r.value for r in runs.collect()}
        assert {m for _, m in values} == {f"{x}_{s}" for x in found for s in ("mean", "std")}
        assert len(values) == 18
    aucs = [r.value for r in fitted["classification"][1].where("metric = 'auc_mean'").collect()]
    assert min(aucs) > 0.8


def test_best_run(fitted, spark):
    runs = fitted["regression"][1]
    best = train.best_run(runs, train.REGRESSION, "rmse_mean", True).first()
    assert best.value == min(r.value for r in runs.where("metric = 'rmse_mean'").collect())
    assert train.best_model(runs, train.REGRESSION) == best.model
    with pytest.raises(ValueError, match="no runs"):
        train.best_model(runs, "other")


def test_scoring_with_saved_models(fitted, cases, tmp_path):
    reg, cls = fitted["regression"], fitted["classification"]
    train.save_models({**reg[0], **cls[0]}, str(tmp_path))
    regressor = train.load_model(str(tmp_path), train.best_model(reg[1], train.REGRESSION))
    classifier = train.load_model(str(tmp_path), train.best_model(cls[1], train.CLASSIFICATION))
    scored = train.predict_icu(cases, regressor, classifier)
    rows = scored.collect()
    assert len(rows) == 240 and {r.verdict for r in rows} == {"ICU required", "No ICU needed"}
    assert all(r.predicted_needs_icu == (r.verdict == "ICU required") for r in rows)
    one = train.predict_icu(cases.drop("preop_hb", "icu_days"), regressor, classifier, caseid=5).collect()
    assert len(one) == 1 and one[0].caseid == 5 and one[0].actual_icu_days is None


def test_fold_without_values_of_a_feature(cases):
    """A feature with one value only is empty in the training part of one fold."""
    rare = cases.withColumn("preop_alb", F.when(F.col("caseid") == 7, 3.3)).withColumn("approach", F.when(F.col("caseid") == 7, "Open"))
    models, runs = train.train_set(rare, "regression", k=3, trees=2)
    assert len(models) == 3 and runs.where("value IS NULL").count() == 0


def test_training_repeats(cases, fitted):
    again = train.train_set(cases, "regression", k=3, trees=5)[1]
    key = lambda r: (r.model, r.metric)
    a, b = sorted(again.collect(), key=key), sorted(fitted["regression"][1].collect(), key=key)
    assert [r.value for r in a] == pytest.approx([r.value for r in b])


def test_grid(spark):
    df = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("z"))
    df = df.withColumn("species", F.when(F.col("x") < 3, "low").when(F.col("x") < 7, "mid").otherwise("top"))
    results = train.grid_search(df, "species", "k")
    assert results.count() == 8
    best = train.best_config(results).first()
    assert best.f1_macro == 1.0 and best.max_depth == 2
    model = train.fit_best_tree(df, "species", "k", best)
    assert model.transform(df).where("predicted_label <> species").count() == 0


def test_logistic_cv(spark):
    df = spark.range(400).select(F.col("id").alias("k"), (F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("z"))
    df = df.withColumn("result", (F.col("x") + F.col("z") / 10 > 9.8).cast("int"))
    model, per_fold = train.train_logistic_cv(df, "result", "k", k=4)
    reports = train.logistic_cv_results(df, "result", "k", k=4)[2]
    assert reports.agg(F.sum("support")).first()[0] == 400 and reports.count() == 8
    assert per_fold.count() == 4 and per_fold.agg(F.min("roc_auc")).first()[0] > 0.98
    assert model.transform(df).where("prediction = result").count() > 380


# ---- preparation of all folds in one pass ----
def mixed(spark, n=600):
    rnd = random.Random(11)
    data = [(i, rnd.choice([None, rnd.gauss(5, 2), 1.0, -0.0]), rnd.choice([None, 2.5, 1e9 + rnd.random()]), rnd.choice(["a", "b", None, f"v{i}"]), f"w{rnd.randrange(700)}",
             rnd.choice([None, "x"]) if i != 3 else "once", i % 4) for i in range(n)]
    return spark.createDataFrame(data, "k long, x double, y double, c string, d string, e string, fold int").repartition(5)


def test_folds_in_one_pass_equal_single_fits(spark):
    df, numeric, cats = mixed(spark), ["x", "y"], ["c", "d", "e"]
    fitted, dictionary = prep.fit_folds(df, numeric, cats, 4)
    assert len(fitted) == 5 and fitted[0].joined == ["d"] or "c" in fitted[0].joined
    for i, got in enumerate(fitted):
        want = prep.fit_preprocessor(df if i == 4 else df.where(F.col("fold") != i), numeric, cats)
        assert got.medians == want.medians and got.modes == want.modes and got.mode_codes == want.mode_codes
        assert got.means == pytest.approx(want.means) and got.stds == pytest.approx(want.stds)
        assert sorted(map(tuple, got.codes.collect())) == sorted(map(tuple, want.codes.collect()))
        rows = df.toPandas() if i == 4 else df.where(F.col("fold") != i).toPandas()
        assert got.medians["x"] == rows["x"].median() and got.means["x"] == pytest.approx(rows["x"].fillna(rows["x"].median()).mean())
        assert got.stds["y"] == pytest.approx(rows["y"].fillna(rows["y"].median()).std(ddof=0))
        assert {r.value: r.code for r in got.codes.where("feature = 'c'").collect()} == {v: float(j) for j, v in enumerate(sorted(rows["c"].dropna().unique()))}
        known = prep.look_up(df, got.joined, dictionary, ["k"], "_codes_")
        vectors = {r.k: list(r.v) for r in known.select("k", got.vector(i).alias("v")).collect()}
        for keyed in ([], ["k"]):
            rowwise = {r.k: [r[f] for f in got.features] for r in got.transform(df, keyed).collect()}
            assert rowwise == vectors
        assert got.transform(df, ["k"])._jdf.queryExecution().optimizedPlan().toString().count("Join ") <= 1


def test_look_up_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "q"), (3, "zz", "b"), (4, "a", "b")], "k int, c string, feature string")
    words = spark.createDataFrame([("c", "a", 1.0), ("feature", "b", 7.0), ("c", "b", 9.0)], "feature string, value string, found double")
    got = prep.look_up(df, ["c", "feature"], words, ["k"], "_")
    assert got.columns == ["k", "c", "feature", "_c", "_feature"]
    assert sorted(map(tuple, got.collect())) == [(1, "a", None, 1.0, None), (2, None, "q", None, None), (3, "zz", "b", None, 7.0), (4, "a", "b", 1.0, 7.0)]


def test_partitions_follow_the_rows(cases, monkeypatch):
    seen = []
    whole = train.estimators

    class Watched:
        def __init__(self, kind):
            self.kind = kind

        def fit(self, df):
            seen.append((df.rdd.getNumPartitions(), df.count()))
            return self.kind.fit(df)

    monkeypatch.setattr(train, "estimators", lambda *a, **b: {n: Watched(e) for n, e in list(whole(*a, **b).items())[:1]})
    train.train_set(cases, "regression", k=3, trees=2, rows_per_partition=100, cached_bytes=1)
    assert [n for _, n in seen] == [160, 160, 160, 240] and {p for p, _ in seen} == {3}
    seen.clear()
    train.train_set(cases, "regression", k=3, trees=2)
    assert {p for p, _ in seen} == {1} and len(seen) == 4


def test_no_more_partitions_than_cores_need(cases, monkeypatch):
    """Four fits side by side and a forest on four cores: two partitions each are eight tasks and more."""
    seen, whole = [], train.estimators

    class Watched:
        def __init__(self, kind):
            self.kind = kind

        def fit(self, df):
            seen.append((df.rdd.getNumPartitions(), df.count()))
            return self.kind.fit(df)

    monkeypatch.setattr(train, "estimators", lambda *a, **b: {n: Watched(e) for n, e in list(whole(*a, **b).items())[:1]})
    train.train_set(cases, "regression", k=3, trees=2, rows_per_partition=20)
    assert {p for p, _ in seen} == {2} and sorted(n for _, n in seen) == [160, 160, 160, 240]
    seen.clear()
    monkeypatch.setattr(train, "MOST_ROWS", 80)
    train.train_set(cases, "regression", k=3, trees=2, rows_per_partition=20)
    assert {p for p, _ in seen} == {3}
    monkeypatch.undo()
    assert [train._partitions(n, 100_000, 6, 12) for n in (0, 1, 75_000, 250_000, 750_000, 4_500_000)] == [1, 1, 1, 3, 4, 9]


def test_forests_wait_for_room(cases, monkeypatch):
    """Forests keep most of a row, so fewer of them than of other fits run at the same time."""
    lock, now, most, linear = threading.Lock(), [0], [0], train.estimators("regression")["LinearRegression"]

    class Watched:
        def fit(self, df):
            with lock:
                now[0] += 1
                most[0] = max(most[0], now[0])
            time.sleep(0.5)
            model = linear.fit(df)
            with lock:
                now[0] -= 1
            return model

    monkeypatch.setattr(train, "estimators", lambda *a, **b: {"RandomForestRegressor": Watched()})
    assert train._side_by_side(240, 9, 1000, 4, 1_000_000) == (4, 1)
    train.train_set(cases, "regression", k=3, trees=1000, cached_bytes=1_000_000)
    assert most == [1]


def test_forests_keep_nodes_and_grow_the_same_trees(spark):
    df = spark.range(0, 3000, 1, 3).select(F.array(*[F.round(F.randn(i), 1) for i in range(4)]).alias("v"))
    df = df.select(array_to_vector("v").alias("features"), F.round(F.col("v")[0] * F.col("v")[1] + F.col("v")[2]).alias("y")).cache()
    for task, name, label in (("regression", "RandomForestRegressor", F.col("y")), ("classification", "RandomForestClassifier", (F.col("y") > 0).cast("double"))):
        forest = train.estimators(task, trees=5)[name]
        assert forest.getCacheNodeIds() and forest.getCheckpointInterval() == -1
        rows = df.withColumn("label", label)
        tree = lambda kind: kind.fit(rows).toDebugString.split("\n", 1)[1]
        assert tree(forest) == tree(forest.copy().setCacheNodeIds(False))


def test_sets_trained_at_once_share_the_cache(spark, cases, tmp_path, monkeypatch):
    from perispark.ml.store import ModelStore

    seen = []

    def stop(*a, **b):
        seen.append(b["cached_bytes"])
        raise ValueError("enough")

    monkeypatch.setattr(train, "train_set", stop)
    for call in (lambda kept: kept.predict(cases, k=3, trees=2), lambda kept: kept.train(cases, "regression", k=3, trees=2)):
        with pytest.raises(ValueError, match="enough"):
            call(ModelStore(spark, str(tmp_path)))
    assert set(seen[:-1]) == {train.CACHED_BYTES // 2} and seen[-1] == train.CACHED_BYTES


# ---- stored runs and models ----
def test_scoring_fits_nothing_once_models_are_stored(spark, cases, tmp_path, monkeypatch):
    from perispark.ml.store import ModelStore

    kept, fits = ModelStore(spark, str(tmp_path)), []
    whole = train.estimators

    def watched(*a, **b):
        fits.append(a)
        return whole(*a, **b)

    monkeypatch.setattr(train, "estimators", watched)
    first = kept.predict(cases, k=3, trees=2)
    assert len(fits) == 2 * (1 + 4)  # names once, then every fold and all rows
    fits.clear()
    again = ModelStore(spark, str(tmp_path)).predict(cases, k=3, trees=2)
    assert fits == [] and sorted(map(str, again.collect())) == sorted(map(str, first.collect()))
    assert again.count() == 240
    kept.predict(cases.where("caseid <> 3"), k=3, trees=2)  # other rows are another training
    assert len(fits) == 10
    runs = kept.runs()
    assert runs.select("training").distinct().count() == 4 and runs.count() == 4 * 18
    training = kept.trained(cases, "regression", k=3, trees=2)
    assert kept.parameters().where(F.col("training") == training).where("param = 'n_samples'").first().value == "240"
    best = train.best_model(kept.runs(training), train.REGRESSION)
    assert best == train.best_run(kept.runs(training), train.REGRESSION, "rmse_mean", True).first().model


def test_runs_are_appended_once(spark, tmp_path):
    from perispark.ml.store import ModelStore

    kept = ModelStore(spark, str(tmp_path))
    assert kept.runs().count() == 0
    grid = spark.createDataFrame([("gini", 2, 5, 0.5, 0.25)], "criterion string, max_depth int, min_samples_split int, accuracy double, f1_macro double")
    for _ in range(2):
        kept.append(train.grid_runs(grid, "grid"), "one")
    kept.append(train.fold_runs(spark.createDataFrame([(0, 0.5), (1, 1.0)], "fold_idx int, f1 double"), "cv", "logistic", ["f1"]), "two")
    assert sorted((r.training, r.run_id, r.metric, r.value) for r in kept.runs().collect()) == [
        ("one", "grid-gini-2-5", "accuracy", 0.5), ("one", "grid-gini-2-5", "f1_macro", 0.25), ("two", "cv-logistic", "f1_mean", 0.75), ("two", "cv-logistic", "f1_std", 0.25)]
    assert kept.runs("two").count() == 2


# ---- split and grid on counts ----
def test_split_takes_the_first_ranks_of_every_label(spark):
    """Null and repeated keys, a null label, a label of one row and one of one key only."""
    data = [(i % 700 if i % 50 else None, "abc"[i % 3] if i % 7 else None, float(i)) for i in range(2000)] + [(9, "one", 1.0)] + [(4, "same", 1.0)] * 11
    df = spark.createDataFrame(data, "k long, t string, x double").repartition(5)
    for size, buckets in ((0.2, 16_384), (0.35, 2), (0.0, 4), (1.0, 4)):
        want = folds._ranked(df, "k", "t", 42, buckets).withColumn("is_test", F.col("_rank") < F.ceil(F.col("_n") * F.lit(size)))
        got = folds.stratified_split(df, "k", "t", size, buckets=buckets)
        assert got.columns == ["k", "t", "x", "is_test"] and got.count() == len(data)
        for by in (["t"], ["k", "t"]):
            count = lambda rows: sorted(map(str, rows.groupBy(*by, "is_test").agg(F.count(F.lit(1)).alias("n")).collect()))
            assert count(got) == count(want)


def grid_by_rows(df, target, key, grid):
    """Every configuration fitted and scored row by row."""
    index, assembler = train._labelled(df, target, key)
    rows = assembler.transform(index.transform(train.stratified_split(df, key, target))).cache()
    found = {}
    for config in grid:
        scored = train._tree(config, 42).fit(rows.where("NOT is_test")).transform(rows.where("is_test"))
        found[config] = train.multiclass_metrics(scored, "label", "prediction").first().asDict()
    return found


GRID = [("gini", 3, 2), ("entropy", 4, 2), ("log_loss", 5, 60)]


def test_grid_on_counts_equals_grid_on_rows(spark):
    rnd = random.Random(3)
    data = [(i, float(rnd.randrange(9)), float(rnd.randrange(40)), rnd.choice("pqr")) for i in range(3000)]
    df = spark.createDataFrame(data, "k long, x double, z double, t string").withColumn("t", F.expr("CASE WHEN x + z > 30 THEN 'p' WHEN z < 8 THEN 'q' ELSE t END"))
    df = df.unionByName(df.where("k % 4 = 0"))  # repeated rows count each time
    want = grid_by_rows(df, "t", "k", GRID)
    for r in train.grid_search(df, "t", "k", GRID).collect():
        got = r.asDict()
        config = (got.pop("criterion"), got.pop("max_depth"), got.pop("min_samples_split"))
        assert got == pytest.approx(want[config])


def test_grid_fits_no_more_rows_than_bins(spark, monkeypatch):
    df = spark.range(40_000).select(F.col("id").alias("k"), F.rand(5).alias("x"), (F.col("id") % 7).cast("double").alias("z"))
    df = df.withColumn("t", F.expr("CASE WHEN x < 0.25 THEN 'low' WHEN x < 0.5 AND z < 3 THEN 'mid' ELSE 'top' END")).cache()
    seen, whole = [], train._tree

    def watched(config, seed):
        tree = whole(config, seed)
        fit = tree.fit
        tree.fit = lambda rows: (seen.append(rows.count()), fit(rows))[1]
        return tree

    monkeypatch.setattr(train, "_tree", watched)
    results, reports = train.grid_results(df, "t", "k", GRID)
    assert len(seen) == 3 and max(seen) <= 32 * 7 * 3 < 32_000
    assert reports.agg(F.sum("support")).first()[0] == sum(-(-n // 5) for (n,) in df.groupBy("t").agg(F.count(F.lit(1))).select("count(1)").collect()) * 3
    monkeypatch.setattr(train, "_tree", whole)
    want = grid_by_rows(df, "t", "k", GRID)
    for r in results.collect():
        assert r.accuracy == pytest.approx(want[(r.criterion, r.max_depth, r.min_samples_split)]["accuracy"], abs=0.02)


def test_grid_refuses_missing_values(spark):
    df = spark.range(100).select(F.col("id").alias("k"), F.when(F.col("id") > 3, 1.0).alias("x"), (F.col("id") % 2).cast("string").alias("t"))
    with pytest.raises(Exception):
        train.grid_search(df, "t", "k", GRID[:1])


# ---- boosted trees from sums over blocks ----
def uneven(spark, n, parts, seed=0):
    """Continuous, few-valued, mostly zero, constant and all-zero features; a target that needs several of them."""
    df = spark.range(0, n, 1, parts).select(F.array(F.randn(seed), F.randn(seed + 1), F.round(F.rand(seed + 2) * 5), F.when(F.rand(seed + 3) < 0.6, 0.0).otherwise(F.rand(seed + 4)),
                                                    F.lit(1.0), F.lit(0.0)).alias("v"))
    return df.select(array_to_vector("v").alias("features"), F.round(F.col("v")[0] * F.col("v")[1] * 2 + F.col("v")[2] + F.col("v")[3]).alias("label")).cache()


def test_boosted_trees_are_those_of_spark(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.regression import GBTRegressor

    from perispark.ml.boosting import BoostedTrees

    trees = lambda model: model.toDebugString.split("\n", 1)[1]
    settings = {"maxIter": 3, "maxDepth": 4, "stepSize": 0.3, "seed": 42}
    tables = [uneven(spark, 1, 1), uneven(spark, 700, 1), uneven(spark, 15_000, 3, 9)]  # the last one has its bins from a sample
    kind = GBTRegressor(**settings)
    for rows, model in zip(tables, BoostedTrees(kind).fit_all(tables)):
        want = kind.fit(rows)
        assert trees(model) == trees(want) and model.treeWeights == want.treeWeights and model.numFeatures == 6
        assert model.transform(rows).select("prediction").collect() == want.transform(rows).select("prediction").collect()
    rows, kind = tables[1].withColumn("label", (F.col("label") > 2).cast("double")), GBTClassifier(**settings)
    got, want = [m.transform(rows).select("probability", "prediction").collect() for m in (BoostedTrees(kind).fit(rows), kind.fit(rows))]
    assert [r.prediction for r in got] == [r.prediction for r in want]
    assert [list(r.probability) for r in got] == [pytest.approx(list(r.probability)) for r in want]
    stump = BoostedTrees(GBTRegressor(maxIter=1, maxDepth=0)).fit(tables[1])
    assert stump.transform(tables[1]).select("prediction").distinct().first()[0] == pytest.approx(tables[1].agg(F.avg("label")).first()[0])


def test_boosted_folds_grow_in_one_job_a_level(cases, monkeypatch):
    """Two trees of six levels at most: twelve jobs for all four fits, or for each alone if there is no room."""
    from perispark.ml import boosting

    seen, whole = [], boosting._level_sums
    monkeypatch.setattr(boosting, "_level_sums", lambda blocks, levels, *a: (seen.append(len(levels)), whole(blocks, levels, *a))[1])
    runs = train.train_set(cases, "regression", k=3, trees=2)[1].collect()
    assert len(seen) <= 12 and max(seen) == 4
    seen.clear()
    alone = train.train_set(cases, "regression", k=3, trees=2, cached_bytes=1)[1].collect()
    assert set(seen) == {1} and {(r.model, r.metric): r.value for r in alone if "GBT" in r.model} == {(r.model, r.metric): r.value for r in runs if "GBT" in r.model}


def test_boosting_refuses_what_is_no_number_and_leaves_no_checkpoints(spark):
    from pathlib import Path

    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.regression import GBTRegressor

    from perispark.ml.boosting import BoostedTrees
    from perispark.session import use_checkpoint_dir

    rows = uneven(spark, 60, 2)
    for bad, kind in ((rows.withColumn("label", F.lit(float("nan"))), GBTRegressor()), (rows.withColumn("label", F.lit(None).cast("double")), GBTRegressor()),
                      (rows, GBTClassifier()), (rows.where("false"), GBTRegressor())):
        with pytest.raises(Exception):
            BoostedTrees(kind).fit(bad)
    stored = lambda: {p.name for p in Path(use_checkpoint_dir(spark).removeprefix("file:")).glob("rdd-*")}
    before = stored()
    BoostedTrees(GBTRegressor(maxIter=4, maxDepth=2, checkpointInterval=1)).fit(rows)
    assert stored() == before


def test_limits_of_bins(spark):
    import numpy as np

    from perispark.ml.boosting import feature_limits

    assert feature_limits(np.array([3.0, 0.0, 1.0, 3.0]), 4.0, 32).tolist() == [0.5, 2.0]
    assert feature_limits(np.zeros(5), 5.0, 32).tolist() == [] == feature_limits(np.full(5, 2.0), 5.0, 32).tolist()
    assert feature_limits(np.arange(1.0, 101.0), 100.0, 4).tolist() == [25.5, 50.5, 75.5]


def test_exponential_of_residuals():
    import numpy as np

    from perispark.ml.boosting import _exp

    x = np.concatenate([np.linspace(-30, 30, 4001), [0.0, -0.0, 700.0, -700.0]])
    assert np.abs(_exp(x) / np.exp(x) - 1).max() <= 2.0 ** -52 and _exp(np.array([0.0]))[0] == 1.0
    with np.errstate(over="ignore"):
        assert _exp(np.array([1e9, -1e9])).tolist() == [float("inf"), 0.0]
