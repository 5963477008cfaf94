"""Models of all folds of a cross-validation from one scan.

The sums that a model needs are taken per fold; what a fold's model may see is the sum of the other folds. Predictions of all
folds are one pass, too: the parameters are a table with one row per fold.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from benchloom.functions.columns import col
from benchloom.models.base import VECTOR, with_vector
from benchloom.operators.gram import collected, pair_sums, shifts


class FoldModels:
    """Parameters per fold and the columns that predict with them."""

    def __init__(self, params: DataFrame, predict, prob):
        self.params, self.predict, self.prob = params, predict, prob

    def transform(self, folds: DataFrame) -> DataFrame:
        """Every row is predicted by the model that has not seen its fold."""
        names = [c for c in self.params.columns if c != "fold"]
        both = folds.join(F.broadcast(self.params), "fold")  # one row per fold
        return both.withColumn("prediction", self.predict).withColumn("prob", self.prob).select(*[col(c) for c in folds.columns], "prediction", "prob").drop(*names)


def ridge_folds(folds: DataFrame, k: int, alpha: float) -> FoldModels | None:
    """Least squares with alpha * |w|^2, without the rows of each fold; None where labels or features are missing."""
    first = folds.select(F.size("features").alias("d")).first()
    if first is None:
        return None
    size = first.d + 1
    values = F.concat(F.col("features").cast("array<double>"), F.array(F.col("label").cast("double")))
    shift = shifts(folds, values, size)
    own = collected(pair_sums(folds, values, size, shift, F.col("fold")), size)
    if any((m["n"] != m["n"][0, 0]).any() for m in own.values()):
        return None
    rows = []
    for f in range(k):
        others = [m for g, m in own.items() if g != f]
        if not others:
            return None
        n = sum(m["n"][0, 0] for m in others)
        mean = sum(np.diag(m["sx"]) for m in others) / n
        cov = sum(m["sxy"] for m in others) - n * np.outer(mean, mean)
        w = np.linalg.solve(cov[:-1, :-1] + alpha * np.eye(size - 1), cov[:-1, -1]) if alpha else np.linalg.lstsq(cov[:-1, :-1], cov[:-1, -1], rcond=None)[0]
        mean = mean + shift
        rows.append((f, w.tolist(), float(mean[-1] - w @ mean[:-1])))
    params = folds.sparkSession.createDataFrame(rows, "fold int, _w array<double>, _b double")
    dot = F.aggregate(F.zip_with("features", "_w", lambda x, w: x * w), F.lit(0.0), lambda s, x: s + x)
    return FoldModels(params, F.col("_b") + dot, F.lit(None).cast("double"))


def naive_bayes_folds(folds: DataFrame, k: int, var_smoothing: float, max_classes: int) -> FoldModels:
    """Gaussian naive Bayes without the rows of each fold, from mean, variance and count per fold and class."""
    stats = Summarizer.metrics("mean", "variance", "count").summary(F.col(VECTOR))
    own = with_vector(folds).filter(F.col("label").isNotNull()).groupBy("fold", "label").agg(stats.alias("s"))
    got = own.select("fold", "label", "s.mean", "s.variance", "s.count").limit(k * max_classes + 1).collect()  # folds x classes rows
    if len(got) > k * max_classes:
        raise ValueError(f"more than {max_classes} classes")
    classes = sorted({r["label"] for r in got})
    if not classes:
        raise ValueError("no labelled rows to fit on")
    d = len(got[0]["mean"])
    n, mean, inner = np.zeros((k, len(classes))), np.zeros((k, len(classes), d)), np.zeros((k, len(classes), d))
    for r in got:
        at = r["fold"], classes.index(r["label"])
        n[at], mean[at], inner[at] = r["count"], r["mean"].toArray(), r["variance"].toArray() * (r["count"] - 1)
    rows = []
    for f in range(k):
        keep = np.arange(k) != f
        count = n[keep].sum(axis=0)
        at = (n[keep, :, None] * mean[keep]).sum(axis=0) / np.maximum(count, 1)[:, None]
        spread = (inner[keep] + n[keep, :, None] * (mean[keep] - at) ** 2).sum(axis=0)
        whole = (count[:, None] * at).sum(axis=0) / count.sum()
        total = (spread + count[:, None] * (at - whole) ** 2).sum(axis=0) / count.sum()
        var = spread / np.maximum(count, 1)[:, None] + var_smoothing * total.max()
        const = [
            math.log(c / count.sum()) - 0.5 * float(np.log(2 * math.pi * v).sum()) if c else -math.inf for c, v in zip(count, var, strict=True)
        ]
        rows.append((f, const, at.tolist(), (1 / var).tolist()))
    params = folds.sparkSession.createDataFrame(rows, "fold int, _const array<double>, _mean array<array<double>>, _scale array<array<double>>")

    def logit(p):
        squares = F.zip_with(F.zip_with("features", p["_mean"], lambda x, m: x - m), p["_scale"], lambda g, s: g * g * s)
        return p["_const"] - 0.5 * F.aggregate(squares, F.lit(0.0), lambda s, x: s + x)

    logits = F.transform(F.arrays_zip("_const", "_mean", "_scale"), logit)
    top = F.array_max(logits)
    weight = F.transform(logits, lambda x: F.exp(x - top))
    labels = F.array(*[F.lit(float(c)) for c in classes])
    prediction = F.element_at(labels, F.array_position(logits, top).cast("int"))
    prob = F.lit(0.0)
    if 1.0 in classes:
        prob = F.element_at(weight, classes.index(1.0) + 1) / F.aggregate(weight, F.lit(0.0), lambda s, x: s + x)
    return FoldModels(params, prediction, prob)
