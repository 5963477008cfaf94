"""Windowed autoregression: the last w values predict the next one, pooled over all series of a panel."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Estimator
from pyspark.sql import DataFrame, functions as F

from benchloom.models.base import linear_weights
from benchloom.models.panel import last_values
from benchloom.models.registry import ridge
from benchloom.operators.series import denormalize_series, lag_windows, normalize_series, series_range
from benchloom.session import checkpointed

CHECKPOINT_EVERY = 8


class WindowRegression:
    """Any tabular regressor on lag windows; forecasts feed each prediction back into the window.

    A linear model is its coefficients, so all steps of a series are one small recursion within a task. Other models are asked once
    for each step.
    """

    def __init__(self, window_size: int = 12, estimator: Estimator | None = None, scale: bool = False):
        self.window_size, self.estimator, self.scale = window_size, estimator or ridge(1.0), scale
        self.model = self.tails = self.ranges = None

    def fit(self, train: DataFrame) -> "WindowRegression":
        out = type(self)(self.window_size, self.estimator, self.scale)
        if self.scale:
            out.ranges = series_range(train, ["key"], "y")
            train = normalize_series(train, ["key"], "y", out.ranges, "y")
        rows = lag_windows(train, ["key"], "t", "y", self.window_size)
        rows = rows.select(F.xxhash64("key", "t").alias("row_id"), F.col("target").alias("label"), F.col("window").alias("features"))
        out.model = self.estimator.fit(rows)
        out.tails = last_values(train, self.window_size).filter(F.size("tail") == self.window_size)
        return out

    def forecast(self, steps: int, lengths: DataFrame | None = None) -> DataFrame:
        """(key, step, yhat); with `lengths` (key, steps) each series only as far as it says, `steps` at most."""
        weights = linear_weights(self.model)
        out = self._step_by_step(steps) if weights is None else self._recursion(steps, *weights, lengths)
        if weights is None and lengths is not None:
            out = out.join(lengths, "key").filter(F.col("step") <= F.col("steps")).drop("steps")
        return denormalize_series(out, ["key"], "yhat", self.ranges, "yhat") if self.scale else out

    def _recursion(self, steps: int, w: np.ndarray, b: float, lengths: DataFrame | None) -> DataFrame:
        tails = self.tails.select("key", "tail")
        tails = tails.withColumn("steps", F.lit(steps)) if lengths is None else tails.join(lengths.select("key", "steps"), "key")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                wanted = np.minimum(pdf["steps"].to_numpy(), steps)
                if pdf.empty or not wanted.max():
                    continue
                window, path = np.stack(pdf["tail"].to_numpy()).astype(float), []
                for _ in range(int(wanted.max())):
                    path.append(window @ w + b)
                    window = np.hstack([window[:, 1:], path[-1][:, None]])
                path = np.stack(path, axis=1)
                row, step = np.nonzero(np.arange(path.shape[1]) < wanted[:, None])
                yield pd.DataFrame({"key": pdf["key"].to_numpy()[row], "step": step + 1, "yhat": path[row, step]})

        return tails.mapInPandas(run, "key string, step int, yhat double")

    def _step_by_step(self, steps: int) -> DataFrame:
        # one row per series: its current window and the path so far
        state = self.tails.select("key", F.xxhash64("key").alias("row_id"), F.col("tail").alias("features"), F.array().cast("array<double>").alias("path"))
        for i in range(steps):
            moved = self.model.transform(state)
            state = moved.select(
                "key", "row_id",
                F.concat(F.slice("features", 2, self.window_size - 1), F.array("prediction")).alias("features"),
                F.concat("path", F.array("prediction")).alias("path"),
            )
            if (i + 1) % CHECKPOINT_EVERY == 0:
                state = checkpointed(state)
        return state.select("key", F.posexplode("path").alias("i", "yhat")).select("key", (F.col("i") + 1).alias("step"), "yhat")
