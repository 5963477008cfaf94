"""Common shape of the tabular models.

Input: row_id BIGINT, label DOUBLE, features ARRAY<DOUBLE>.  Output: the input plus ``prediction`` and ``prob``
(the probability of class 1, NULL for regressors and for classifiers without one).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, functions as F

from benchloom.functions.columns import col
from benchloom.operators.threshold import apply_threshold

VECTOR = "_vector"


def assemble(df: DataFrame, label: str, row_id: str, columns: Sequence[str]) -> DataFrame:
    """(row_id, label, features) from plain columns."""
    return df.select(
        col(row_id).cast("bigint").alias("row_id"),
        col(label).cast("double").alias("label"),
        F.array(*[col(c).cast("double") for c in columns]).alias("features"),
    )


def with_vector(df: DataFrame) -> DataFrame:
    return df.withColumn(VECTOR, array_to_vector("features"))


class TabularModel(Model):
    """A fitted Spark ML model behind the common columns."""

    def __init__(self, inner: Model, has_prob: bool):
        super().__init__()
        self.inner, self.has_prob = inner, has_prob

    def _transform(self, df: DataFrame) -> DataFrame:
        out = self.inner.transform(with_vector(df))
        prob = vector_to_array("probability")[1] if self.has_prob else F.lit(None).cast("double")
        return out.select(*[col(c) for c in df.columns], F.col("prediction").cast("double").alias("prediction"), prob.alias("prob"))


class TabularEstimator(Estimator):
    """Wraps a Spark ML estimator; ``build`` sees the training rows, for penalties that depend on them."""

    def __init__(self, name: str, build: Callable[[DataFrame], Estimator], has_prob: bool, params: dict | None = None):
        super().__init__()
        self.name, self.build, self.has_prob, self.settings = name, build, has_prob, dict(params or {})

    def _fit(self, df: DataFrame) -> Model:
        src = with_vector(df).select("label", VECTOR).persist()
        try:
            inner = self.build(src).setFeaturesCol(VECTOR).setLabelCol("label").fit(src)
        finally:
            src.unpersist()
        return TabularModel(inner, self.has_prob)

    def __repr__(self) -> str:
        return f"{self.name}({', '.join(f'{k}={v!r}' for k, v in self.settings.items())})"


def linear_weights(model: Model) -> tuple[np.ndarray, float] | None:
    """(coefficients, intercept) of a fitted linear regression, None for any other model."""
    inner = getattr(model, "inner", None)
    if not isinstance(inner, LinearRegressionModel):
        return None
    return inner.coefficients.toArray(), float(inner.intercept)


def train_model(estimator: Estimator, df: DataFrame) -> Model:
    return estimator.fit(df)


def predict_classification(model: Model, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Adds pred, prob: the thresholded probability of class 1, or the plain prediction where there is none."""
    out = model.transform(df)
    pred = F.when(F.col("prob").isNotNull(), apply_threshold(F.col("prob"), threshold)).otherwise(F.col("prediction").cast("int"))
    return out.withColumn("pred", pred)
