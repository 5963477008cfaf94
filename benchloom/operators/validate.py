"""Cross-validation of any estimator with ``fit(df).transform(df)`` -> prediction, prob."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from benchloom.functions.columns import col
from benchloom.operators.metrics import DEFAULT_AUC, auc_roc, classification_metrics, regression_metrics
from benchloom.operators.split import kfold_assign, stratified_fold_assign
from benchloom.session import checkpointed

CLASSIFICATION_SCORES = ("accuracy", "precision", "recall", "f1", "roc_auc")
REGRESSION_SCORES = ("r2", "mse", "rmse", "mae")


def cv_predictions(estimator, folds: DataFrame, k: int, parallelism: int = 2, keep: Sequence[str] = ("row_id", "label", "fold")) -> DataFrame:
    """Out-of-fold predictions of all folds in one table: keep, prediction, prob.

    An estimator with ``fit_folds`` fits the models of all folds from one scan. Those of others are fitted from a small driver
    thread pool; each fit is itself a distributed job.
    """
    if from_sums(estimator) and (models := estimator.fit_folds(folds, k)) is not None:
        return models.transform(folds).select(*[col(c) for c in keep], "prediction", "prob")

    def one(i: int) -> DataFrame:
        model = estimator.fit(folds.filter(F.col("fold") != i))
        held_out = folds.filter(F.col("fold") == i)
        return model.transform(held_out).select(*[col(c) for c in keep], "prediction", "prob")

    with ThreadPool(max(1, parallelism)) as pool:
        parts = pool.map(inheritable_thread_target(folds.sparkSession)(one), range(k))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def from_sums(estimator) -> bool:
    """Does the estimator fit all folds from one scan?"""
    return hasattr(estimator, "fit_folds")


def prepared(folds: DataFrame, *estimators) -> DataFrame:
    """Folds as the estimators read them: written once, unless all of them take two scans only."""
    return folds if all(map(from_sums, estimators)) else checkpointed(folds)


def fold_scores(predictions: DataFrame, scoring: str, label: str = "label") -> DataFrame:
    """(fold, score) of tagged predictions - one grouped aggregate for all folds."""
    if scoring == "roc_auc":
        out = auc_roc(predictions, label, "prob", by=["fold"])
        return out.select("fold", F.coalesce("auc", F.lit(DEFAULT_AUC)).alias("score"))
    if scoring in CLASSIFICATION_SCORES:
        return classification_metrics(predictions, label, "prediction", by=["fold"]).select("fold", F.col(scoring).alias("score"))
    if scoring in REGRESSION_SCORES:
        return regression_metrics(predictions, label, "prediction", by=["fold"]).select("fold", F.col(scoring).alias("score"))
    raise ValueError(f"unknown scoring {scoring!r}")


def summarize_scores(scores: Sequence[float]) -> dict:
    """Scores with their mean and population standard deviation."""
    values = [float(s) for s in scores]
    return {"scores": values, "mean": float(np.mean(values)), "std": float(np.std(values))}


def _validate(estimator, folds: DataFrame, k: int, scoring: str, parallelism: int) -> dict:
    rows = fold_scores(cv_predictions(estimator, folds, k, parallelism), scoring).orderBy("fold").collect()
    return summarize_scores([r["score"] for r in rows])


def kfold_validation(estimator, df: DataFrame, k: int = 5, scoring: str = "r2", seed: int = 42, parallelism: int = 2) -> dict:
    """Shuffled k-fold: {'scores', 'mean', 'std'} (std with ddof = 0)."""
    return _validate(estimator, prepared(kfold_assign(df, "row_id", k, seed), estimator), k, scoring, parallelism)


def stratified_kfold(estimator, df: DataFrame, k: int = 5, scoring: str = "roc_auc", seed: int = 42, parallelism: int = 2) -> dict:
    """Stratified k-fold: {'scores', 'mean', 'std'}."""
    return _validate(estimator, prepared(stratified_fold_assign(df, "row_id", "label", k, seed), estimator), k, scoring, parallelism)


def manual_kfold_metrics(predictions: DataFrame, problem_type: str = "classification", label: str = "label") -> DataFrame:
    """Per fold: accuracy, f1, auc of a classifier, or r2, rmse of a regressor, from tagged predictions."""
    if problem_type == "classification":
        out = classification_metrics(predictions, label, "prediction", "prob", by=["fold"])
        return out.select("fold", "accuracy", "f1", F.coalesce("auc", F.lit(DEFAULT_AUC)).alias("auc"))
    if problem_type == "regression":
        return regression_metrics(predictions, label, "prediction", by=["fold"]).select("fold", "r2", "rmse")
    raise ValueError(f"unknown problem type {problem_type!r}")


def manual_kfold(estimator, df: DataFrame, k: int = 5, problem_type: str = "classification", seed: int = 42, parallelism: int = 2) -> DataFrame:
    """Fit k fold models and return their metrics per fold."""
    if problem_type == "classification":
        folds = stratified_fold_assign(df, "row_id", "label", k, seed)
    else:
        folds = kfold_assign(df, "row_id", k, seed)
    return manual_kfold_metrics(cv_predictions(estimator, prepared(folds, estimator), k, parallelism), problem_type)


def fold_listing(scores: DataFrame, column: str = "cv_scores", model: str = "model") -> DataFrame:
    """(model, fold, score) rows of a leaderboard's score lists, folds named 'Fold 1', 'Fold 2', ..."""
    out = scores.select(col(model).alias("model"), F.posexplode(col(column)).alias("i", "score"))
    return out.select("model", F.concat(F.lit("Fold "), (F.col("i") + 1).cast("string")).alias("fold"), "score")
