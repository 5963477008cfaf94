"""Decision thresholds: apply one, sweep a grid, pick the best."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from benchloom.functions.columns import col, ratio_or_zero, real

# The search grid 0.01 ... 0.99 and the analysis grid 0.10 ... 0.95.
SEARCH_START, SEARCH_STEP, SEARCH_POINTS = 0.01, 0.01, 99
ANALYSIS_START, ANALYSIS_STEP, ANALYSIS_POINTS = 0.10, 0.05, 18
METRICS = ("f1", "recall", "precision", "accuracy")


def grid(start: float, step: float, points: int) -> list[float]:
    return [start + step * i for i in range(points)]


def search_grid() -> list[float]:
    return grid(SEARCH_START, SEARCH_STEP, SEARCH_POINTS)


def analysis_grid() -> list[float]:
    return grid(ANALYSIS_START, ANALYSIS_STEP, ANALYSIS_POINTS)


def apply_threshold(prob: Column, threshold: float = 0.5) -> Column:
    """1 where prob >= threshold, else 0."""
    return (prob >= F.lit(float(threshold))).cast("int")


def _passed(prob: Column, thresholds: Sequence[float]) -> Column:
    """How many thresholds of an ascending grid the score reaches."""
    n = len(thresholds)
    step = (thresholds[-1] - thresholds[0]) / (n - 1) if n > 1 else 1.0
    even = step > 0 and all(abs(t - (thresholds[0] + i * step)) < step / 8 for i, t in enumerate(thresholds))
    if even and n > 1:
        # the nearest grid point is the only one whose comparison is in doubt
        near = F.least(F.greatest(F.round((prob - thresholds[0]) / F.lit(step)).cast("int"), F.lit(0)), F.lit(n - 1))
        at = F.element_at(F.array(*[F.lit(float(t)) for t in thresholds]), near + 1)
        return near + (prob >= at).cast("int")
    out = F.lit(0)
    for t in thresholds:
        out = out + (prob >= F.lit(float(t))).cast("int")
    return out


def threshold_sweep(
    df: DataFrame, label: str = "label", prob: str = "prob", thresholds: Sequence[float] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """(by, threshold, accuracy, precision, recall, f1) for every threshold.

    One pass for the whole grid: a row is counted once under the number of thresholds it reaches, and the
    metrics follow from suffix sums over at most len(grid) + 1 counters.
    """
    # thresholds keep their given order only in the output; the counting needs them ascending
    thresholds = sorted(float(t) for t in (thresholds if thresholds is not None else analysis_grid()))
    keys = [col(b) for b in by]
    y = col(label) == 1
    score = real(prob)  # NaN counts as missing
    reached = _passed(score, thresholds)
    counted = (
        df.filter(score.isNotNull()).groupBy(*keys, reached.alias("reached"))
        .agg(F.count_if(y).alias("p"), F.count_if(~y).alias("n"))
        .groupBy(*keys)
        .agg(F.sum("p").alias("pos"), F.sum("n").alias("neg"), F.collect_list(F.struct("reached", "p", "n")).alias("cells"))
    )
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(t).alias("threshold")) for i, t in enumerate(thresholds)])
    rows = counted.select(*keys, "pos", "neg", "cells", F.explode(steps).alias("s"))
    above = lambda f: F.aggregate(
        F.filter("cells", lambda c: c["reached"] > F.col("s.i")), F.lit(0).cast("bigint"), lambda acc, c: acc + c[f]
    )
    rows = rows.withColumn("tp", above("p")).withColumn("fp", above("n"))
    tp, fp, pos, neg = F.col("tp"), F.col("fp"), F.col("pos"), F.col("neg")
    return rows.select(
        *keys,
        F.col("s.threshold").alias("threshold"),
        ratio_or_zero(tp + neg - fp, pos + neg).alias("accuracy"),
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, pos).alias("recall"),
        ratio_or_zero(2 * tp, tp + fp + pos).alias("f1"),
    )


def best_of_sweep(sweep: DataFrame, metrics: Sequence[str] = METRICS, by: Sequence[str] = ()) -> DataFrame:
    """(by, metric, threshold, score): the best threshold for each metric, the lowest among equals; 0.5 when every score is 0."""
    unknown = [m for m in metrics if m not in METRICS]
    if unknown:
        raise ValueError(f"unknown metric {unknown[0]!r}; use one of {', '.join(METRICS)}")
    keys = [col(b) for b in by]
    best = sweep.groupBy(*keys).agg(
        *[F.max(F.struct(F.col(m).alias("score"), (-F.col("threshold")).alias("neg"))).alias(f"_{m}") for m in metrics]
    )
    items = []
    for m in metrics:
        score = F.coalesce(F.col(f"_{m}.score"), F.lit(0.0))
        threshold = F.when(score > 0, -F.col(f"_{m}.neg")).otherwise(0.5)
        items.append(F.struct(F.lit(m).alias("metric"), threshold.alias("threshold"), score.alias("score")))
    return best.select(*keys, F.explode(F.array(*items)).alias("r")).select(*keys, "r.*")


def optimize_threshold(
    df: DataFrame,
    label: str = "label",
    prob: str = "prob",
    metric: str = "f1",
    thresholds: Sequence[float] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """(by, threshold, score) for one metric, searched on the grid 0.01 ... 0.99 unless given."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; use one of {', '.join(METRICS)}")
    sweep = threshold_sweep(df, label, prob, thresholds if thresholds is not None else search_grid(), by)
    return best_of_sweep(sweep, [metric], by).drop("metric")
