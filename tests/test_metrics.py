import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from benchloom.operators import metrics, threshold, validate


@pytest.fixture(scope="module")
def scored():
    rng = np.random.default_rng(2)
    label = (rng.random(300) < 0.35).astype(int)
    prob = np.round(np.clip(rng.normal(0.4 + 0.2 * label, 0.2), 0, 1), 2)  # many equal scores
    return pd.DataFrame({"row_id": range(300), "label": label, "prob": prob, "pred": (prob >= 0.5).astype(int)})


def brute_auc(p):
    pos, neg = p[p.label == 1]["prob"].to_numpy(), p[p.label == 0]["prob"].to_numpy()
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


@pytest.mark.parametrize("per_chunk", [10**6, 9])
def test_auc(spark, scored, per_chunk):
    df = spark.createDataFrame(scored)
    assert metrics.auc_roc(df, rows_per_chunk=per_chunk).first()["auc"] == pytest.approx(brute_auc(scored))
    assert metrics.auc_roc(df.withColumn("prob", -F.col("prob")), rows_per_chunk=per_chunk).first()["auc"] == pytest.approx(1 - brute_auc(scored))
    grouped = metrics.auc_roc(df.withColumn("g", F.col("row_id") % 2), by=["g"], rows_per_chunk=per_chunk)
    for r in grouped.collect():
        assert r.auc == pytest.approx(brute_auc(scored[scored.row_id % 2 == r.g]))


def test_classification_metrics(spark, scored):
    r = metrics.classification_metrics(spark.createDataFrame(scored), prob="prob").first()
    tp = int(((scored.label == 1) & (scored.pred == 1)).sum())
    assert r.accuracy == pytest.approx((scored.label == scored.pred).mean())
    assert r.precision == pytest.approx(tp / scored.pred.sum()) and r.recall == pytest.approx(tp / scored.label.sum())
    assert r.f1 == pytest.approx(2 * r.precision * r.recall / (r.precision + r.recall))


def test_degenerate_classes(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], "label int, pred int, prob double")
    r = metrics.classification_metrics(df, prob="prob").first()
    assert (r.accuracy, r.precision, r.recall, r.f1, r.auc) == (1.0, 0.0, 0.0, 0.0, 0.5)
    assert metrics.classification_metrics(df).first()["auc"] is None
    half = spark.createDataFrame([(0.0,), (None,)], "auc double")
    assert [r[0] for r in half.select(metrics.auc_or_default(F.col("auc"))).collect()] == [0.0, 0.5]
    assert [r[0] for r in half.select(metrics.auc_or_default(F.col("auc"), legacy=True)).collect()] == [0.5, 0.5]


def test_confusion_is_dense(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (1, 1)], "label int, pred int")
    got = {(r.label, r.pred): r.n for r in metrics.confusion_matrix(df).collect()}
    assert len(got) == 9 and got[(0, 2)] == 1 and got[(2, 2)] == 0
    assert metrics.confusion_array(df).first()[0] == [[1, 0, 1], [0, 1, 0], [0, 0, 0]]


@pytest.mark.parametrize("per_chunk", [10**6, 5])
def test_curves(spark, scored, per_chunk):
    df = spark.createDataFrame(scored)
    pos, neg = (scored.label == 1).sum(), (scored.label == 0).sum()
    pts = []
    for t in sorted(scored.prob.unique(), reverse=True):
        hit = scored[scored.prob >= t]
        pts.append((t, int((hit.label == 0).sum()), int((hit.label == 1).sum())))
    keep = [i for i in range(len(pts)) if i in (0, len(pts) - 1) or any(pts[i + 1][j] - 2 * pts[i][j] + pts[i - 1][j] for j in (1, 2))]
    want = [(np.inf, 0.0, 0.0)] + [(pts[i][0], pts[i][1] / neg, pts[i][2] / pos) for i in keep]
    got = [tuple(r) for r in metrics.roc_curve(df, rows_per_chunk=per_chunk).orderBy(F.desc("threshold")).collect()]
    assert np.array(got) == pytest.approx(np.array(want))
    pr = metrics.precision_recall_curve(df, rows_per_chunk=per_chunk).orderBy(F.asc_nulls_last("threshold")).collect()
    assert len(pr) == len(pts) + 1 and tuple(pr[-1]) == (None, 1.0, 0.0)
    assert [r.recall for r in pr[:-1]] == pytest.approx([tp / pos for _, _, tp in pts][::-1])


@pytest.mark.parametrize("grid", [threshold.analysis_grid(), threshold.search_grid(), [0.2, 0.21, 0.9], [0.5]])
def test_sweep_is_one_pass_but_equal_to_many(spark, scored, grid):
    got = threshold.threshold_sweep(spark.createDataFrame(scored), thresholds=grid).orderBy("threshold").collect()
    assert len(got) == len(grid)
    for r, t in zip(got, grid):
        pred = scored.prob >= t
        tp = int((pred & (scored.label == 1)).sum())
        assert r.accuracy == pytest.approx((pred == scored.label).mean())
        assert r.precision == pytest.approx(tp / pred.sum() if pred.sum() else 0)
        assert r.recall == pytest.approx(tp / scored.label.sum())


def test_optimal_threshold(spark, scored):
    df = spark.createDataFrame(scored)
    best = threshold.optimize_threshold(df, metric="recall").first()
    assert best.threshold == 0.01 and best.score == pytest.approx(threshold.threshold_sweep(df, thresholds=[0.01]).first()["recall"])
    none = spark.createDataFrame([(0, 0.9)], "label int, prob double")
    assert tuple(threshold.optimize_threshold(none).first()) == (0.5, 0.0)
    with pytest.raises(ValueError):
        threshold.optimize_threshold(df, metric="auc")


def test_regression_and_forecast_metrics(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0), (4.0, 5.0)], "y double, yhat double")
    r = metrics.regression_metrics(df).first()
    assert tuple(r) == pytest.approx((1.0, 1.0, 1.0, 1 - 3 / 8))
    assert metrics.forecast_metrics(df).first()["mape"] == pytest.approx(37.5)
    flat = spark.createDataFrame([(3.0, 3.0), (3.0, 3.0)], "y double, yhat double")
    assert metrics.regression_metrics(flat).first()["r2"] == 1.0
    assert metrics.regression_metrics(flat.withColumn("yhat", F.lit(4.0))).first()["r2"] == 0.0
    zero = flat.withColumn("y", F.lit(0.0))
    assert metrics.forecast_metrics(zero).first()["mape"] is None


def test_fold_metrics(spark, scored):
    folds = spark.createDataFrame(scored).withColumn("fold", (F.col("row_id") % 3).cast("int")).withColumn("prediction", F.col("pred"))
    for r in validate.manual_kfold_metrics(folds).collect():
        part = scored[scored.row_id % 3 == r.fold]
        assert r.auc == pytest.approx(brute_auc(part)) and r.accuracy == pytest.approx((part.label == part.pred).mean())
    assert validate.summarize_scores([1.0, 3.0]) == {"scores": [1.0, 3.0], "mean": 2.0, "std": 1.0}
    board = spark.createDataFrame([("m", [0.5, 0.7])], "model string, cv_scores array<double>")
    assert [tuple(r) for r in validate.fold_listing(board).collect()] == [("m", "Fold 1", 0.5), ("m", "Fold 2", 0.7)]
