"""Evaluation metrics as aggregations. Only the matrix axes and label lists ever reach the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perispark.operators.ordering import running_totals


def _ratio(a: Column, b: Column) -> Column:
    """``a / b``, 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def regression_metrics(df: DataFrame, y: str = "y", yhat: str = "yhat", by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE and R² (null when the target does not vary), per group of ``by``."""
    err = F.col(y) - F.col(yhat)
    return df.groupBy(*by).agg(F.avg(err * err).alias("_mse"), F.avg(F.abs(err)).alias("mae"), F.var_pop(y).alias("_var")).select(
        *by, F.sqrt("_mse").alias("rmse"), "mae", (F.lit(1.0) - F.try_divide("_mse", "_var")).alias("r2")
    )


def binary_metrics(df: DataFrame, y: str = "y", yhat: str = "yhat", by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, balanced accuracy, precision, recall and F1 of 0/1 labels from one pass of counts."""
    yes, hit = F.col(y) == 1, F.col(yhat) == 1
    counts = df.groupBy(*by).agg(
        F.count_if(yes & hit).alias("tp"), F.count_if(~yes & hit).alias("fp"),
        F.count_if(yes & ~hit).alias("fn"), F.count_if(~yes & ~hit).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    recall, specificity = F.try_divide(tp, tp + fn), F.try_divide(tn, tn + fp)
    # a class that does not occur is left out of the mean
    balanced = F.when(recall.isNull(), specificity).when(specificity.isNull(), recall).otherwise((recall + specificity) / 2)
    return counts.select(
        *by,
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        balanced.alias("balanced_accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(tp * 2, tp * 2 + fp + fn).alias("f1"),
    )


def _by_score(df: DataFrame, y: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score, combined before the shuffle."""
    return (
        df.select(F.col(y).cast("int").alias("_y"), F.col(score).cast("double").alias("_s"))
        .where(F.col("_y").isNotNull() & F.col("_s").isNotNull())
        .groupBy("_s")
        .agg(F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") == 0).alias("neg"))
    )


def roc_auc(df: DataFrame, y: str = "y", score: str = "score", buckets: int | None = None) -> DataFrame:
    """Area under the ROC curve: chance that a positive outscores a negative, ties counting half."""
    ranked = running_totals(_by_score(df, y, score), "_s", ["neg"], buckets=buckets)
    wins = F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2)
    return ranked.agg(
        F.try_divide(F.sum(wins), F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("roc_auc")
    )


def average_precision(df: DataFrame, y: str = "y", score: str = "score", buckets: int | None = None) -> DataFrame:
    """Precision at every distinct threshold weighted by the recall gained there (no interpolation)."""
    ranked = running_totals(_by_score(df, y, score), "_s", ["pos", "neg"], descending=True, buckets=buckets)
    precision = F.try_divide("cum_pos", F.col("cum_pos") + F.col("cum_neg"))
    return ranked.agg(F.try_divide(F.sum(F.col("pos") * precision), F.sum("pos")).alias("average_precision"))


def _cells(df: DataFrame, y: str, yhat: str, weight: str | None = None) -> DataFrame:
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return df.groupBy(F.col(y).cast("string").alias("y"), F.col(yhat).cast("string").alias("yhat")).agg(n.alias("n"))


def class_report(df: DataFrame, y: str = "y", yhat: str = "yhat", weight: str | None = None) -> DataFrame:
    """Precision, recall, F1 and support of every label that is true or predicted somewhere.

    ``weight`` names a whole number of rows that a row stands for.
    """
    zero = F.lit(0).cast("long")
    hits = F.when(F.col("y") == F.col("yhat"), F.col("n")).otherwise(zero)
    sides = _cells(df, y, yhat, weight).select(F.inline(F.array(
        F.struct(F.col("y").alias("label"), F.col("n").alias("support"), zero.alias("predicted"), hits.alias("tp")),
        F.struct(F.col("yhat").alias("label"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("tp")),
    )))
    counts = sides.groupBy("label").agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    return counts.select(
        "label", _ratio(F.col("tp"), F.col("predicted")).alias("precision"), _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(F.col("tp") * 2, F.col("predicted") + F.col("support")).alias("f1"), "support", "predicted", "tp",
    )


def multiclass_metrics(df: DataFrame, y: str = "y", yhat: str = "yhat", weight: str | None = None) -> DataFrame:
    """Accuracy, balanced accuracy and macro- and support-weighted precision, recall and F1."""
    report = class_report(df, y, yhat, weight)
    total = F.sum("support")
    out = [
        F.try_divide(F.sum("tp"), total).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
    ]
    for m in ("precision", "recall", "f1"):
        out.append(F.avg(m).alias(f"{m}_macro"))
        out.append(F.try_divide(F.sum(F.col(m) * F.col("support")), total).alias(f"{m}_weighted"))
    return report.agg(*out)


def confusion_matrix(df: DataFrame, labels: Sequence, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """One row ``true_label`` and one column ``pred_<label>`` per label, also for labels that never occur."""
    texts = [str(x) for x in labels]
    counted = _cells(df, y, yhat).where(F.col("y").isin(*texts)).groupBy(F.col("y").alias("_y")).agg(
        *[F.sum(F.when(F.col("yhat") == t, F.col("n"))).alias(f"_{i}") for i, t in enumerate(texts)]
    )
    axis = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(t) for t in texts])).alias("true_label"))
    return axis.join(counted, F.col("true_label") == F.col("_y"), "left").select(
        "true_label", *[F.coalesce(F.col(f"_{i}"), F.lit(0)).cast("long").alias(f"pred_{t}") for i, t in enumerate(texts)]
    )


def class_balance(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def summarise_folds(df: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Number of folds, mean and population deviation of every metric."""
    out = [F.count(F.lit(1)).alias("n_folds")]
    for m in metrics:
        out += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return df.groupBy(*by).agg(*out)
