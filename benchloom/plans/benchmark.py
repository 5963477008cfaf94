"""Benchmark runs: split, encode, scale, balance, fit, score, cross-validate, rank."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from inspect import signature
from typing import Any

import numpy as np
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from benchloom.functions.columns import numeric_columns, real
from benchloom.models.base import VECTOR, assemble, predict_classification, with_vector
from benchloom.models.panel import panel
from benchloom.models.registry import get_classification_models, get_regression_models
from benchloom.models.series_registry import get_timeseries_models
from benchloom.operators.balance import apply_balancing
from benchloom.operators.encode import CategoryEncoder, encode_target
from benchloom.operators.metrics import auc_or_default, classification_metrics, confusion_array, forecast_metrics, regression_metrics
from benchloom.operators.ordering import positions
from benchloom.operators.scale import Scaler, fit_scaler
from benchloom.operators.series import time_split
from benchloom.operators.split import kfold_assign, split_data, stratified_fold_assign
from benchloom.operators.validate import _validate, prepared
from benchloom.session import checkpointed

log = logging.getLogger(__name__)

PROBLEM_TYPES = ("classification", "regression", "timeseries")

CLASSIFICATION_SCHEMA = (
    "model string, accuracy double, precision double, recall double, f1 double, auc double, cv_mean double, cv_std double, "
    "cv_scores array<double>, confusion_matrix array<array<bigint>>, error string"
)
REGRESSION_SCHEMA = (
    "model string, mse double, rmse double, mae double, r2 double, cv_mean double, cv_std double, cv_scores array<double>, error string"
)
SERIES_SCHEMA = "model string, mse double, rmse double, mae double, mape double, n_series bigint, n_failed bigint, error string"


@dataclass
class BenchmarkResult:
    """Leaderboard, predictions of every model in one long table, and the prepared data."""

    problem_type: str
    results: DataFrame
    predictions: DataFrame | None
    train: DataFrame
    test: DataFrame
    scaler: Scaler | None = None
    features: list[str] = field(default_factory=list)


def _union(parts: Sequence[DataFrame]) -> DataFrame | None:
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


def _board(spark, rows: list[dict], schema: str) -> DataFrame:
    names = [f.split()[0] for f in schema.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def _run_models(models: Mapping[str, Any], predict, validate) -> tuple[list[DataFrame], dict[str, dict], list[dict]]:
    """Predictions and CV summaries of the models that ran; a failing model gives an error row and the run goes on."""
    predictions, cv, failed = [], {}, []
    for name, estimator in models.items():
        try:
            # written out once per model: scoring reads it several times, and a failure stays with its model
            done = checkpointed(predict(estimator).select(F.lit(name).alias("model"), "*"))
            cv[name] = validate(estimator)
            predictions.append(done)
        except Exception as e:  # noqa: BLE001 - any failure of a model belongs into its row
            log.warning("model %s failed: %s", name, e)
            failed.append({"model": name, "error": str(e).strip() or type(e).__name__, "cv_scores": []})
            cv.pop(name, None)
    return predictions, cv, failed


def _with_cv(metrics: Sequence, cv: Mapping[str, dict]) -> list[dict]:
    out = []
    for r in metrics:
        row = r.asDict()
        c = cv[row["model"]]
        out.append({**row, "cv_mean": c["mean"], "cv_std": c["std"], "cv_scores": c["scores"]})
    return out


def benchmark_classification(
    train: DataFrame,
    test: DataFrame,
    models: Mapping[str, Any] | None = None,
    threshold: float = 0.5,
    cv_folds: int = 5,
    balancing: str = "none",
    seed: int = 42,
    parallelism: int = 2,
    legacy_auc_default: bool = False,
    balance_inside_fold: bool = False,
    scale_inside_fold: bool = False,
) -> tuple[DataFrame, DataFrame | None]:
    """(leaderboard by AUC, predictions).  Tables hold row_id, label, features; labels are 0 and 1.

    Cross-validation runs on the unbalanced training rows, as established users of this benchmark expect.
    ``balance_inside_fold`` rebalances the training part of every fold instead, ``scale_inside_fold`` standardises
    every fold with the statistics of its own training part.
    """
    models = models if models is not None else get_classification_models(seed)
    classes = [r[0] for r in train.select("label").distinct().limit(3).collect()]
    if len(classes) > 2:
        raise ValueError("the label has more than two classes; precision, recall and AUC are defined for two")
    train, test = train.persist(), test.persist()
    try:
        balanced = apply_balancing(train, balancing, "label", seed)
        if balanced is not train:
            balanced = checkpointed(balanced)
        folds = stratified_fold_assign(train, "row_id", "label", cv_folds, seed)
        folds = checkpointed(folds) if balance_inside_fold or scale_inside_fold else prepared(folds, *models.values())

        def predict(estimator) -> DataFrame:
            return predict_classification(estimator.fit(balanced), test, threshold).select("row_id", "label", "pred", "prob")

        def validate(estimator) -> dict:
            wrapped = _Balanced(estimator, balancing, seed) if balance_inside_fold else estimator
            wrapped = _Standardized(wrapped) if scale_inside_fold else wrapped
            return _validate(wrapped, folds, cv_folds, "roc_auc", parallelism)

        parts, cv, failed = _run_models(models, predict, validate)
        predictions = _union(parts)
        rows = failed
        if predictions is not None:
            scores = classification_metrics(predictions, "label", "pred", "prob", by=["model"])
            scores = scores.withColumn("auc", auc_or_default(F.col("auc"), legacy_auc_default))
            scores = scores.join(confusion_array(predictions, "label", "pred", by=["model"]), "model")
            rows = _with_cv(scores.collect(), cv) + failed
        board = _board(train.sparkSession, rows, CLASSIFICATION_SCHEMA)
    finally:
        train.unpersist()
        test.unpersist()
    return board.orderBy(F.col("auc").desc_nulls_last(), "model"), predictions


class _Balanced:
    """Rebalances whatever it is fitted on."""

    def __init__(self, estimator, technique: str, seed: int):
        self.estimator, self.technique, self.seed = estimator, technique, seed

    def fit(self, df: DataFrame):
        return self.estimator.fit(apply_balancing(df.select("row_id", "label", "features"), self.technique, "label", self.seed))


class _Standardized:
    """Standardises with the statistics of whatever it is fitted on."""

    def __init__(self, estimator):
        self.estimator = estimator

    def fit(self, df: DataFrame):
        stats = with_vector(df).agg(Summarizer.metrics("mean", "variance", "count").summary(F.col(VECTOR)).alias("s")).first()["s"]
        n = stats["count"]
        dev = np.sqrt(stats["variance"].toArray() * (n - 1) / n)
        mean, dev = F.array(*[F.lit(float(m)) for m in stats["mean"]]), F.array(*[F.lit(float(d) or 1.0) for d in dev])

        def scaled(rows: DataFrame) -> DataFrame:
            centred = F.zip_with("features", mean, lambda x, m: x - m)
            return rows.withColumn("features", F.zip_with(centred, dev, lambda x, d: x / d))

        return _StandardizedModel(self.estimator.fit(scaled(df)), scaled)


class _StandardizedModel:
    def __init__(self, model, scaled):
        self.model, self.scaled = model, scaled

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.scaled(df))


def benchmark_regression(
    train: DataFrame,
    test: DataFrame,
    models: Mapping[str, Any] | None = None,
    cv_folds: int = 5,
    seed: int = 42,
    parallelism: int = 2,
    scale_inside_fold: bool = False,
) -> tuple[DataFrame, DataFrame | None]:
    """(leaderboard by R2, predictions)."""
    models = models if models is not None else get_regression_models(seed)
    train, test = train.persist(), test.persist()
    try:
        folds = kfold_assign(train, "row_id", cv_folds, seed)
        folds = checkpointed(folds) if scale_inside_fold else prepared(folds, *models.values())
        parts, cv, failed = _run_models(
            models,
            lambda e: e.fit(train).transform(test).select("row_id", "label", "prediction"),
            lambda e: _validate(_Standardized(e) if scale_inside_fold else e, folds, cv_folds, "r2", parallelism),
        )
        predictions = _union(parts)
        rows = failed
        if predictions is not None:
            rows = _with_cv(regression_metrics(predictions, "label", "prediction", by=["model"]).collect(), cv) + failed
        board = _board(train.sparkSession, rows, REGRESSION_SCHEMA)
    finally:
        train.unpersist()
        test.unpersist()
    return board.orderBy(F.col("r2").desc_nulls_last(), "model"), predictions


def benchmark_timeseries(
    train: DataFrame, test: DataFrame, models: Mapping[str, Any] | None = None, seasonal_periods: int = 12
) -> tuple[DataFrame, DataFrame | None]:
    """(leaderboard by RMSE over the whole panel, predictions key, t, step, y, yhat).

    Panels hold key, t, y.  Forecast step h of a series is compared with its h-th test row.  A series with a test row
    that has no forecast counts in n_failed, its yhat stays NULL there; models with failed series come after complete ones,
    and say so in `error`.
    """
    models = models if models is not None else get_timeseries_models(seasonal_periods)
    numbered = positions(test, ["key"], ["t"], "step").withColumn("step", F.col("step").cast("int")).persist()
    train = train.persist()
    try:
        lengths = numbered.groupBy("key").agg(F.max("step").alias("steps"))
        steps = lengths.agg(F.max("steps")).first()[0] or 0
        parts, rows = [], []
        for name, model in models.items():
            try:
                fitted = model.fit(train)
                own = {"lengths": lengths} if "lengths" in signature(fitted.forecast).parameters else {}
                predicted = fitted.forecast(steps, **own)
                joined = numbered.join(predicted, ["key", "step"], "left").select(F.lit(name).alias("model"), "key", "t", "step", "y", "yhat")
                done = checkpointed(joined)
                if done.filter(F.col("yhat").isNotNull()).isEmpty():
                    raise ValueError("no series could be forecast")
                parts.append(done)
            except Exception as e:  # noqa: BLE001
                log.warning("model %s failed: %s", name, e)
                rows.append({"model": name, "error": str(e).strip() or type(e).__name__})
        predictions = _union(parts)
        if predictions is not None:
            scored = predictions.filter(real("yhat").isNotNull())
            coverage = predictions.groupBy("model", "key").agg(F.count_if(real("yhat").isNull()).alias("gaps")).groupBy("model").agg(
                F.count("*").alias("n_series"), F.count_if(F.col("gaps") > 0).alias("n_failed")
            )
            seen = {r["model"]: r.asDict() for r in coverage.collect()}
            own = [r.asDict() | seen[r["model"]] for r in forecast_metrics(scored, "y", "yhat", by=["model"]).collect()]
            for r in own:
                r["error"] = f"no forecast for {r['n_failed']} of {r['n_series']} series" if r["n_failed"] else None
            rows = own + rows
        board = _board(train.sparkSession, rows, SERIES_SCHEMA)
    finally:
        numbered.unpersist()
        train.unpersist()
    incomplete = F.coalesce(F.col("n_failed") > 0, F.lit(True))
    return board.orderBy(incomplete, F.col("rmse").asc_nulls_last(), "model"), predictions


def prepare_tabular(
    df: DataFrame, target: str, row_id: str, stratify: bool, test_size: float = 0.3, scale: bool = True, seed: int = 42
) -> tuple[DataFrame, DataFrame, Scaler | None, list[str]]:
    """Split, encode and scale: (train, test, scaler, features) with row_id, label, features ARRAY<DOUBLE>.

    Dictionaries and scaling come from the training rows only.
    """
    features = [c for c in df.columns if c not in (target, row_id)]
    # counts, dictionaries, scaling and both parts read the table: derive it once
    df = checkpointed(df)
    train, test = split_data(df, row_id, target, test_size, seed, stratify)
    train, test = encode_target(train, test, target)
    encoder = CategoryEncoder().fit(train.drop(target, row_id))
    train, test = encoder.transform(train), encoder.transform(test)
    usable = [c for c in features if c in numeric_columns(train)]
    scaler = None
    if scale:
        scaler = fit_scaler(train, usable)
        train, test = scaler.transform(train), scaler.transform(test)
    return assemble(train, target, row_id, usable), assemble(test, target, row_id, usable), scaler, usable


def run_benchmark(
    problem_type: str,
    df: DataFrame,
    target: str | None = None,
    row_id: str | None = None,
    models: Mapping[str, Any] | None = None,
    test_size: float = 0.3,
    cv_folds: int = 5,
    threshold: float = 0.5,
    balancing: str = "none",
    scale: bool = True,
    seasonal_periods: int = 12,
    train_ratio: float = 0.8,
    seed: int = 42,
    t: str | None = None,
    keys: Sequence[str] = (),
    parallelism: int = 2,
    scale_inside_fold: bool = False,
    balance_inside_fold: bool = False,
    legacy_auc_default: bool = False,
) -> BenchmarkResult:
    """One call for all problem types.

    Tabular problems need a ``row_id`` column that identifies rows and a ``target`` (the last column by default).
    Series problems need ``t``, the order of the values; ``target`` is the value, ``keys`` tell series apart.
    """
    kind = str(problem_type).lower()
    if kind not in PROBLEM_TYPES:
        raise ValueError(f"unknown problem type {problem_type!r}; use one of {', '.join(PROBLEM_TYPES)}")
    if kind == "timeseries":
        if t is None:
            raise ValueError("a series needs an order column: pass t=...")
        values = [c for c in numeric_columns(df) if c != t and c not in keys]
        if target is None and not values:
            raise ValueError("the table has no numeric column to read a series from")
        split = checkpointed(time_split(panel(df, t, target or values[0], keys), ["key"], "t", train_ratio))
        train = split.filter(F.col("split") == "train").drop("split")
        test = split.filter(F.col("split") == "test").drop("split")
        board, predictions = benchmark_timeseries(train, test, models, seasonal_periods)
        return BenchmarkResult(kind, board, predictions, train, test)
    target = target or df.columns[-1]
    if row_id is None:
        raise ValueError("tabular problems need a row key: pass row_id=...")
    train, test, scaler, features = prepare_tabular(df, target, row_id, kind == "classification", test_size, scale, seed)
    if kind == "classification":
        board, predictions = benchmark_classification(
            train, test, models, threshold, cv_folds, balancing, seed, parallelism, legacy_auc_default, balance_inside_fold, scale_inside_fold
        )
    else:
        board, predictions = benchmark_regression(train, test, models, cv_folds, seed, parallelism, scale_inside_fold)
    return BenchmarkResult(kind, board, predictions, train, test, scaler, features)
