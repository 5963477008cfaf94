"""benchloom - explore, prepare and benchmark predictive models as Spark jobs."""

from benchloom.operators.balance import apply_balancing, combined, smote, undersample
from benchloom.operators.encode import encode_categorical, encode_target, encode_train_test
from benchloom.operators.metrics import (
    classification_metrics,
    confusion_matrix,
    forecast_metrics,
    precision_recall_curve,
    regression_metrics,
    roc_curve,
)
from benchloom.operators.profile import check_imbalance
from benchloom.operators.scale import scale_features
from benchloom.operators.series import denormalize_series, lag_windows, normalize_series, time_split
from benchloom.operators.split import kfold_assign, split_data, stratified_fold_assign
from benchloom.operators.threshold import apply_threshold, optimize_threshold, threshold_sweep
from benchloom.operators.validate import kfold_validation, manual_kfold, stratified_kfold
from benchloom.plans.benchmark import (
    BenchmarkResult,
    benchmark_classification,
    benchmark_regression,
    benchmark_timeseries,
    run_benchmark,
)
from benchloom.plans.report import rank_models

__all__ = [
    "BenchmarkResult", "apply_balancing", "apply_threshold", "benchmark_classification", "benchmark_regression",
    "benchmark_timeseries", "check_imbalance", "classification_metrics", "combined", "confusion_matrix",
    "denormalize_series", "encode_categorical", "encode_target", "encode_train_test", "forecast_metrics", "kfold_assign",
    "kfold_validation", "lag_windows", "manual_kfold", "normalize_series", "optimize_threshold", "precision_recall_curve",
    "rank_models", "regression_metrics", "roc_curve", "run_benchmark", "scale_features", "smote", "split_data",
    "stratified_fold_assign", "stratified_kfold", "threshold_sweep", "time_split", "undersample",
]
