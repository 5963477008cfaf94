"""k-nearest-neighbour classifier and regressor on the exact neighbour join."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame, functions as F

from benchloom.functions.columns import col
from benchloom.operators.neighbors import knn_join, vote

# The names under which distances can be asked for.
METRIC_NAMES = {"minkowski": "euclidean", "euclidean": "euclidean", "manhattan": "manhattan", "chebyshev": "chebyshev"}


class _KNN(Estimator):
    def __init__(self, n_neighbors: int = 5, weights: str = "uniform", metric: str = "minkowski", block_rows: int | None = None):
        super().__init__()
        if metric not in METRIC_NAMES:
            raise ValueError(f"unknown metric {metric!r}; use one of {', '.join(METRIC_NAMES)}")
        self.n_neighbors, self.weights, self.metric, self.block_rows = n_neighbors, weights, METRIC_NAMES[metric], block_rows

    def _fit(self, df: DataFrame) -> Model:
        return self.model_class(self, df.select("row_id", "label", "features"))


class _KNNModel(Model):
    def __init__(self, settings: _KNN, train: DataFrame):
        super().__init__()
        self.settings, self.train = settings, train

    def neighbors(self, df: DataFrame) -> DataFrame:
        s = self.settings
        return knn_join(df, self.train, s.n_neighbors, metric=s.metric, payload=["label"], block_rows=s.block_rows)


class KNNClassifierModel(_KNNModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        near = self.neighbors(df)
        if self.settings.weights == "uniform":
            near = near.withColumn("_w", F.lit(1.0))
        else:
            best = near.groupBy(F.col("query_id").alias("_q")).agg(F.min("distance").alias("_best"))
            near = near.join(best, F.col("query_id") == F.col("_q")).withColumn(
                "_w", F.when(F.col("_best") == 0, (F.col("distance") == 0).cast("double")).otherwise(1.0 / F.nullif(F.col("distance"), F.lit(0.0)))
            )
        votes = near.groupBy("query_id", "label").agg(F.sum("_w").alias("w"))
        result = votes.groupBy("query_id").agg(
            F.max(F.struct(F.col("w"), (-F.col("label")).alias("neg"))).alias("top"),
            (F.coalesce(F.sum(F.when(F.col("label") == 1, F.col("w"))), F.lit(0.0)) / F.sum("w")).alias("prob"),
        )
        result = result.select(F.col("query_id").alias("_q"), (-F.col("top.neg")).alias("prediction"), "prob")
        return df.join(result, F.col("row_id") == F.col("_q"), "left").select(*[col(c) for c in df.columns], "prediction", "prob")


class KNNRegressorModel(_KNNModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        result = vote(self.neighbors(df), "label", self.settings.weights).select(F.col("query_id").alias("_q"), F.col("prob").alias("prediction"))
        return df.join(result, F.col("row_id") == F.col("_q"), "left").select(
            *[col(c) for c in df.columns], "prediction", F.lit(None).cast("double").alias("prob")
        )


class KNNClassifier(_KNN):
    model_class = KNNClassifierModel


class KNNRegressor(_KNN):
    model_class = KNNRegressorModel
