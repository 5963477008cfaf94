"""Inputs that used to give wrong answers."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from benchloom import rank_models, run_benchmark
from benchloom.models.panel import Baseline, ar1_forecast, naive_forecast, panel, seasonal_naive_forecast
from benchloom.operators.quantiles import exact_quantiles
from benchloom.operators.threshold import threshold_sweep
from benchloom.sources.tables import read_csv


def test_quantiles_end_with_infinities_and_huge_spans(spark):
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") == n - 1, math.inf).when(F.col("id") == n - 2, -math.inf).otherwise(F.col("id").cast("double")).alias("inf"),
        F.when(F.col("id") % 2 == 0, F.lit(1.7e308)).otherwise(F.lit(-1.7e308)).alias("huge"),
        F.pow(F.lit(10.0), (F.col("id") - n / 2) / 60.0).alias("orders"), F.lit(3.5).alias("flat"),
    )
    cols, probs = ["inf", "huge", "orders", "flat"], [0.0, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, cols, probs, small_rows=0)
    values = {c: np.sort([r[c] for r in df.select(c).collect()]) for c in cols}
    for c in cols:
        for p, q in zip(probs, got[c], strict=True):
            lo, hi = values[c][math.floor((n - 1) * p)], values[c][math.ceil((n - 1) * p)]
            part = (n - 1) * p % 1
            assert q == pytest.approx(lo if lo == hi or part == 0 else (1 - part) * lo + part * hi), (c, p)


def test_failed_series_are_counted_and_ranked_last(spark):
    rows = [("long", t, 100.0 + (t % 12) * 10) for t in range(60)] + [("short", t, 1000.0 * t) for t in range(8)]
    df = spark.createDataFrame(rows, "k string, t long, y double")
    models = {"seasonal": Baseline(seasonal_naive_forecast, m=12), "naive": Baseline(naive_forecast)}
    run = run_benchmark("timeseries", df, "y", t="t", keys=["k"], models=models)
    board = {r.model: r for r in run.results.collect()}
    assert (board["seasonal"].n_series, board["seasonal"].n_failed) == (2, 1) and "1 of 2" in board["seasonal"].error
    assert (board["naive"].n_failed, board["naive"].error) == (0, None)
    assert [r.model for r in rank_models(run.results).collect()] == ["naive", "seasonal"]


def test_panel_names_differ(spark):
    rows = [(None, "a"), ("a", None), ("a|b", "c"), ("a", "b|c"), ("\\N", "a"), ("a\\", "b"), ("", "a")]
    df = spark.createDataFrame([(*r, k, 1.0) for k, r in enumerate(rows)] + [("x", "y", 9, float("nan"))], "p string, q string, t int, y double")
    assert panel(df, "t", "y", ["p", "q"]).select("key").distinct().count() == len(rows)


def test_decimal_comma_with_schema(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("a;b;c\n1,5;x;2\n;y;3\n-0,25;z;4\n")
    rows = read_csv(spark, str(path), sep=";", decimal=",", schema="a double, b string, c int").collect()
    assert [tuple(r) for r in rows] == [(1.5, "x", 2), (None, "y", 3), (-0.25, "z", 4)]
    path.write_text("a\nno number\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_csv(spark, str(path), sep=";", decimal=",", schema="a double").collect()


def test_sweep_ignores_nan(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, float("nan")), (0, None)], "label int, prob double")
    assert {r.accuracy for r in threshold_sweep(df, thresholds=[0.5]).collect()} == {1.0}


def test_ar1_equals_the_recursion(spark):
    y = [1.0, 2.0, 2.5, 2.4, 3.0, 2.9, 3.3, 3.1]
    train = spark.createDataFrame([("s", t, v) for t, v in enumerate(y)] + [("line", t, float(t)) for t in range(6)], "key string, t int, y double")
    got = {(r.key, r.step): r.yhat for r in ar1_forecast(train, 6).collect()}
    slope, intercept = np.polyfit(y[:-1], y[1:], 1)
    last = y[-1]
    for h in range(1, 7):
        last = intercept + slope * last
        assert got["s", h] == pytest.approx(last)
        assert got["line", h] == pytest.approx(5.0 + h)


def test_split_is_stratified_with_any_number_of_classes(spark, monkeypatch):
    from benchloom.operators import split

    df = spark.range(600).select("id", F.when(F.col("id") % 40 == 7, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(23))).alias("label"))
    want = {r.id: r.split for r in split.split_flag(df, "id", "label", 0.3).collect()}
    monkeypatch.setattr(split, "BROADCAST_ROWS", 5)
    got = {r.id: r.split for r in split.split_flag(df, "id", "label", 0.3).collect()}
    assert got == want and set(got.values()) == {"train", "test"}
