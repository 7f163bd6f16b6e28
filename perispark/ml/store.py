"""Stored runs and models: metrics of every training in one append-only table, fitted pipelines beside it.

A training is named by a fingerprint of its rows and settings, so the same rows and settings find the models that were fitted
on them, and scoring does not train. Models are saved first and their runs appended last: a run in the table always has
its models.
"""

from __future__ import annotations

import hashlib
import json
import threading
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perispark import fixed_values as fv
from perispark.ml import train
from perispark.sources.lake import Lake

FORMAT = 1  # of saved models; a new one leaves the old ones unused
LAYER, RUNS, PARAMETERS = "ml", "runs", "run_parameters"
RUN_COLUMNS = ["training", "experiment", "run_id", "model", "metric", "value"]


def fingerprint(df: DataFrame, columns: Sequence[str], settings: dict) -> str:
    """Name of a training: row count, two order-free sums of row hashes, and the settings. One aggregation."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in columns]
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*cells).cast("decimal(38,0)")).alias("a"),
                 F.sum(F.xxhash64(F.lit(1), *cells).cast("decimal(38,0)")).alias("b")).first()
    return hashlib.md5(json.dumps([FORMAT, row.n, str(row.a), str(row.b), list(columns), sorted(settings.items())], default=str).encode()).hexdigest()


class ModelStore:
    """Runs and models under one folder that every executor can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.lake = spark, root.rstrip("/"), Lake(spark, f"{root.rstrip('/')}/tables")
        self.one_writer = threading.Lock()  # trainings of one store run side by side, its tables have one writer at a time

    def append(self, runs: DataFrame, training: str) -> None:
        """Add runs (experiment, run_id, model, metric, value) of a training to the table."""
        rows = runs.withColumn("training", F.lit(training)).select("training", "experiment", "run_id", "model", "metric", F.col("value").cast("double").alias("value"))
        with self.one_writer:
            self.lake.write(rows.coalesce(1), LAYER, RUNS, mode="append")  # a few rows a training

    def runs(self, training: str | None = None) -> DataFrame:
        """All stored runs, or those of one training; repeated appends of a run count once."""
        if not self.lake.exists(LAYER, RUNS):
            return self.spark.createDataFrame([], "training string, experiment string, run_id string, model string, metric string, value double")
        found = self.lake.read(LAYER, RUNS).dropDuplicates(RUN_COLUMNS)
        return found if training is None else found.where(F.col("training") == training)

    def parameters(self) -> DataFrame:
        return self.lake.read(LAYER, PARAMETERS)

    def _training(self, features: DataFrame, task: str, settings: dict) -> str:
        columns = [c for c in ("caseid", fv.ICU_TARGET, *fv.NUMERIC_FEATURES, *fv.CATEGORICAL_FEATURES) if c in features.columns]
        return fingerprint(features, columns, {"task": task, **settings})

    def train(self, features: DataFrame, task: str, training: str | None = None, at_once: int = 1, **settings) -> tuple[str, DataFrame]:
        """Train and store a model set; return (training, runs). ``at_once`` sets are trained side by side and share the cache."""
        training = training or self._training(features, task, settings)
        models, runs = train.train_set(features, task, **{"cached_bytes": train.CACHED_BYTES // at_once, **settings})
        train.save_models(models, f"{self.root}/models/{training}")
        parameters = train.run_parameters(features, task, k=settings.get("k", 5)).withColumn("training", F.lit(training))
        with self.one_writer:
            self.lake.write(parameters.coalesce(1), LAYER, PARAMETERS, mode="append")
        self.append(runs, training)
        return training, runs

    def trained(self, features: DataFrame, task: str, at_once: int = 1, **settings) -> str:
        """Name of the stored training of these rows and settings; trains only if there is none."""
        training = self._training(features, task, settings)
        if self.runs(training).isEmpty():
            self.train(features, task, training, at_once, **settings)
        return training

    def best(self, training: str, task: str) -> train.TrainedModel:
        """The best model of a training by its stored runs."""
        name = train.best_model(self.runs(training), train.REGRESSION if task == "regression" else train.CLASSIFICATION)
        return train.load_model(f"{self.root}/models/{training}", name)

    def predict(self, features: DataFrame, caseid: int | None = None, **settings) -> DataFrame:
        """Every case (or one) scored by the best stored model of each task."""
        tasks = ("regression", "classification")
        with ThreadPoolExecutor(len(tasks)) as pool:
            best = dict(zip(tasks, pool.map(lambda task: self.best(self.trained(features, task, len(tasks), **settings), task), tasks)))
        return train.predict_icu(features, best["regression"], best["classification"], caseid)
