"""Gaussian naive Bayes with adjustable smoothing: one aggregate to fit, plain expressions to predict."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from benchloom.functions.columns import col
from benchloom.models.base import VECTOR, with_vector
from benchloom.models.fold_sums import FoldModels, naive_bayes_folds

MAX_CLASSES = 1000


class GaussianNB(Estimator):
    """The model has classes x features numbers and lives on the driver; `max_classes` says how many classes it may have."""

    def __init__(self, var_smoothing: float = 1e-9, max_classes: int = MAX_CLASSES):
        super().__init__()
        self.var_smoothing, self.max_classes = var_smoothing, max_classes

    def _fit(self, df: DataFrame) -> "GaussianNBModel":
        stats = Summarizer.metrics("mean", "variance", "count").summary(F.col(VECTOR))
        per_class = with_vector(df).filter(F.col("label").isNotNull()).groupBy("label").agg(stats.alias("s"))
        # classes x features numbers: the model itself
        rows = per_class.select("label", "s.mean", "s.variance", "s.count").limit(self.max_classes + 1).collect()
        if not rows:
            raise ValueError("no labelled rows to fit on")
        if len(rows) > self.max_classes:
            raise ValueError(f"more than {self.max_classes} classes")
        rows.sort(key=lambda r: r["label"])
        n = np.array([r["count"] for r in rows], dtype=float)
        mean = np.array([r["mean"].toArray() for r in rows])
        var = np.array([r["variance"].toArray() for r in rows]) * ((n - 1) / n)[:, None]
        # the smoothing term is a share of the largest variance of a feature over all rows
        total_mean = (mean * n[:, None]).sum(axis=0) / n.sum()
        total_var = ((var + (mean - total_mean) ** 2) * n[:, None]).sum(axis=0) / n.sum()
        return GaussianNBModel([r["label"] for r in rows], n / n.sum(), mean, var + self.var_smoothing * total_var.max())


    def fit_folds(self, folds: DataFrame, k: int) -> FoldModels:
        """The models of a cross-validation, each without one fold, from one scan."""
        return naive_bayes_folds(folds, k, self.var_smoothing, self.max_classes)


class GaussianNBModel(Model):
    def __init__(self, classes: list[float], prior: np.ndarray, mean: np.ndarray, var: np.ndarray):
        super().__init__()
        self.classes, self.prior, self.mean, self.var = classes, prior, mean, var

    def _logit(self, i: int) -> Column:
        const = math.log(self.prior[i]) - 0.5 * float(np.log(2 * math.pi * self.var[i]).sum())
        mean = F.array(*[F.lit(float(m)) for m in self.mean[i]])
        scale = F.array(*[F.lit(float(1.0 / v)) for v in self.var[i]])
        squares = F.zip_with(F.zip_with(F.col("features"), mean, lambda x, m: x - m), scale, lambda d, s: d * d * s)
        return F.lit(const) - 0.5 * F.aggregate(squares, F.lit(0.0), lambda a, x: a + x)

    def _transform(self, df: DataFrame) -> DataFrame:
        labels = F.array(*[F.lit(float(c)) for c in self.classes])
        out = df.withColumn("_logits", F.array(*[self._logit(i) for i in range(len(self.classes))]))
        out = out.withColumn("_top", F.array_max("_logits"))
        out = out.withColumn("_exp", F.transform("_logits", lambda x: F.exp(x - F.col("_top"))))
        total = F.aggregate("_exp", F.lit(0.0), lambda a, x: a + x)
        prob = F.col("_exp")[self.classes.index(1.0)] / total if 1.0 in self.classes else F.lit(0.0)
        return out.select(
            *[col(c) for c in df.columns],
            F.element_at(labels, F.array_position("_logits", F.col("_top")).cast("int")).alias("prediction"),
            prob.alias("prob"),
        )
