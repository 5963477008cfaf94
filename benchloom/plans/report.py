"""Views of a leaderboard: ranking, comparison, top five, recommendation, forecast table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from benchloom.functions.columns import col, numeric_columns

# Metric order for automatic ranking, metrics where less is better, tier limits, top-k of the radar.
AUTO_METRICS = ("auc", "r2", "rmse")
LESS_IS_BETTER = ("rmse", "mse", "mae", "mape")
AUC_TIERS = (0.95, 0.85)
R2_TIERS = (0.85, 0.70)
MAPE_TIERS = (5.0, 10.0)
TOP_MODELS = 5
CLASSIFICATION_VIEW = ("accuracy", "precision", "recall", "f1", "auc")
TIERS = ("excellent", "good", "weak")


def rank_models(board: DataFrame, metric: str | None = None, ascending: bool | None = None) -> DataFrame:
    """Add ``rank``: best first, missing values last, equal values by model name.

    Series models with failed series (n_failed) come after complete ones. Without a metric the first of auc, r2, rmse present decides (and ``ascending`` is ignored); with none of them the
    table comes back unchanged.
    """
    if metric is None:
        metric = next((m for m in AUTO_METRICS if m in board.columns), None)
        if metric is None:
            return board
        ascending = None
    elif metric not in board.columns:
        raise KeyError(metric)
    if ascending is None:
        ascending = metric in LESS_IS_BETTER
    order = col(metric).asc_nulls_last() if ascending else col(metric).desc_nulls_last()
    # a model without a forecast for some series is not compared with those that have all of them
    partial = [F.col("n_failed") > 0] if "n_failed" in board.columns else []
    # one row per model: the window is as small as the registry
    return board.withColumn("rank", F.row_number().over(Window.orderBy(*partial, order, "model"))).orderBy("rank")


def compare_metric(board: DataFrame, metric: str) -> DataFrame:
    """(model, metric, value) for one metric."""
    return board.select("model", F.lit(metric).alias("metric"), col(metric).alias("value"))


def cv_intervals(board: DataFrame) -> DataFrame:
    """(model, cv_mean, cv_low, cv_high): mean plus and minus one standard deviation."""
    return board.select(
        "model", "cv_mean", (F.col("cv_mean") - F.col("cv_std")).alias("cv_low"), (F.col("cv_mean") + F.col("cv_std")).alias("cv_high")
    )


def leaderboard_long(board: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """(model, metric, value) for several metrics."""
    items = F.array(*[F.struct(F.lit(m).alias("metric"), col(m).cast("double").alias("value")) for m in metrics])
    return board.select("model", F.explode(items).alias("r")).select("model", "r.*")


def top_models(board: DataFrame, metrics: Sequence[str] = CLASSIFICATION_VIEW, n: int = TOP_MODELS, metric: str | None = None) -> DataFrame:
    """(rank, model, metric, value) of the n best models, missing values as 0."""
    best = rank_models(board, metric).filter(F.col("rank") <= n)
    items = F.array(*[F.struct(F.lit(m).alias("metric"), F.coalesce(col(m).cast("double"), F.lit(0.0)).alias("value")) for m in metrics])
    return best.select("rank", "model", F.explode(items).alias("r")).select("rank", "model", "r.*")


def _tier(value: Column, limits: Sequence[float], less: bool) -> Column:
    first = value < limits[0] if less else value >= limits[0]
    second = value < limits[1] if less else value >= limits[1]
    return F.when(first, TIERS[0]).when(second, TIERS[1]).otherwise(TIERS[2])


def recommendation(board: DataFrame, problem_type: str) -> DataFrame:
    """One row (model, metric, value, tier) for the best model.

    Series are ranked by RMSE and rated by MAPE; a MAPE of 0 or none at all gives the lowest tier.
    """
    kind = problem_type.lower()
    metric, limits, less = {
        "classification": ("auc", AUC_TIERS, False),
        "regression": ("r2", R2_TIERS, False),
        "timeseries": ("mape", MAPE_TIERS, True),
    }[kind]
    ranked = rank_models(board, "rmse" if kind == "timeseries" else metric).filter(F.col("rank") == 1)
    value = col(metric)
    rated = F.nullif(value, F.lit(0.0)) if kind == "timeseries" else value
    return ranked.select("model", F.lit(metric).alias("metric"), value.alias("value"), _tier(rated, limits, less).alias("tier"))


def forecast_table(train: DataFrame, predictions: DataFrame) -> DataFrame:
    """(key, t, series, value): training values, actual test values and every model's forecast on one axis."""
    past = train.select("key", "t", F.lit("train").alias("series"), F.col("y").alias("value"))
    actual = predictions.select("key", "t", F.lit("actual").alias("series"), F.col("y").alias("value")).distinct()
    future = predictions.select("key", "t", F.col("model").alias("series"), F.col("yhat").alias("value"))
    return past.unionByName(actual).unionByName(future)


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Numbers rounded for display."""
    floats = [c for c in numeric_columns(df) if dict(df.dtypes)[c] in ("double", "float")]
    return df.select(*[F.round(col(c), digits).alias(c) if c in floats else col(c) for c in df.columns])
