import numpy as np
import pytest
from pyspark.sql import functions as F

from benchloom import rank_models, run_benchmark
from benchloom.models import registry
from benchloom.models.naive_bayes import GaussianNB
from benchloom.models.panel import Baseline, drift_forecast, naive_forecast, seasonal_naive_forecast
from benchloom.plans import report
from benchloom.sources.builtin import airline_passengers, simulated_fraud


class Broken:
    def fit(self, df):
        raise RuntimeError("cannot fit this")


def test_classification(spark):
    df = simulated_fraud(spark, 1500).withColumn("kind", F.when(F.col("row_id") % 3 == 0, "x").otherwise("y"))
    df = df.select("row_id", "feature_0", "feature_1", "kind", "fraud")
    models = {"nb": GaussianNB(), "broken": Broken(), "lr": registry.logistic_regression()}
    run = run_benchmark("Classification", df, "fraud", "row_id", models=models, cv_folds=3, balancing="undersample")
    board = {r.model: r for r in run.results.collect()}
    assert run.features == ["feature_0", "feature_1", "kind"]
    assert board["broken"].error == "cannot fit this" and board["broken"].auc is None
    assert board["nb"].auc > 0.95 and len(board["nb"].cv_scores) == 3 and board["nb"].cv_mean == pytest.approx(np.mean(board["nb"].cv_scores))
    assert sum(map(sum, board["lr"].confusion_matrix)) == 450
    assert [r.model for r in run.results.collect()][-1] == "broken"
    assert run.predictions.filter("model = 'nb'").count() == 450
    assert rank_models(run.results).first()["rank"] == 1


def test_regression_and_multiclass(spark):
    df = spark.range(400).withColumn("x", F.col("id") % 17).withColumn("z", F.col("id") % 3).withColumn("y", F.col("x") * 2.0 + F.col("id") % 5)
    run = run_benchmark("regression", df, "y", "id", models={"ridge": registry.ridge(), "bad": Broken()}, cv_folds=3, scale_inside_fold=True)
    first, second = run.results.collect()
    assert first.model == "ridge" and first.r2 > 0.95 and second.error
    with pytest.raises(ValueError):
        run_benchmark("classification", df.select("id", "x", "z"), "z", "id", models={})
    with pytest.raises(ValueError):
        run_benchmark("clustering", df, "y", "id")
    with pytest.raises(ValueError):
        run_benchmark("regression", df, "y")


def test_series(spark):
    models = {
        "naive": Baseline(naive_forecast), "season": Baseline(seasonal_naive_forecast, m=12), "drift": Baseline(drift_forecast), "broken": Broken(),
    }
    run = run_benchmark("timeseries", airline_passengers(spark), "y", t="t", keys=["key"], models=models)
    rows = run.results.collect()
    assert [r.model for r in rows][-1] == "broken" and rows[0].rmse <= rows[1].rmse <= rows[2].rmse
    assert run.train.count() == 115 and run.predictions.filter("model = 'naive'").count() == 29
    table = report.forecast_table(run.train, run.predictions)
    assert {r["series"]: r["count"] for r in table.groupBy("series").count().collect()} == {"train": 115, "actual": 29, "naive": 29, "season": 29, "drift": 29}


def test_ranking_rules(spark):
    board = spark.createDataFrame(
        [("a", 0.9, 3.0), ("b", None, 1.0), ("c", 0.96, None), ("d", 0.9, 2.0)], "model string, auc double, rmse double"
    )
    assert [r.model for r in rank_models(board).collect()] == ["c", "a", "d", "b"]
    assert [r.model for r in rank_models(board, ascending=True).collect()] == ["c", "a", "d", "b"]  # ignored without a metric
    assert [r.model for r in rank_models(board, "rmse").collect()] == ["b", "d", "a", "c"]
    assert [r.model for r in rank_models(board, "rmse", False).collect()] == ["a", "d", "b", "c"]
    with pytest.raises(KeyError):
        rank_models(board, "f1")
    plain = board.select("model")
    assert rank_models(plain) is plain
    best = report.recommendation(board, "classification").first()
    assert (best.model, best.tier) == ("c", "excellent")
    top = report.top_models(board, ["auc", "rmse"], n=2).collect()
    assert {(r.model, r.metric, r.value) for r in top} == {("c", "auc", 0.96), ("c", "rmse", 0.0), ("a", "auc", 0.9), ("a", "rmse", 3.0)}


@pytest.mark.parametrize("mape,tier", [(4.9, "excellent"), (9.9, "good"), (10.0, "weak"), (0.0, "weak"), (None, "weak")])
def test_series_tiers(spark, mape, tier):
    board = spark.createDataFrame([("m", 1.0, mape), ("n", 2.0, 1.0)], "model string, rmse double, mape double")
    assert report.recommendation(board, "timeseries").first()["tier"] == tier


@pytest.mark.parametrize("r2,tier", [(0.85, "excellent"), (0.7, "good"), (0.69, "weak")])
def test_regression_tiers(spark, r2, tier):
    board = spark.createDataFrame([("m", r2)], "model string, r2 double")
    assert report.recommendation(board, "regression").first()["tier"] == tier


def test_views(spark):
    board = spark.createDataFrame([("m", 0.51239, 0.8, 0.1)], "model string, f1 double, cv_mean double, cv_std double")
    assert tuple(report.cv_intervals(board).first()) == pytest.approx(("m", 0.8, 0.7, 0.9))
    assert report.rounded(board).first()["f1"] == 0.5124
    assert tuple(report.compare_metric(board, "f1").first()) == ("m", "f1", 0.51239)
