"""Sums of products for wide tables, and cross-validation from fold sums."""

import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from benchloom.models import registry
from benchloom.models.naive_bayes import GaussianNB
from benchloom.operators import profile, validate
from benchloom.operators.gram import pair_sums, shifts
from benchloom.operators.split import kfold_assign, stratified_fold_assign
from benchloom.plans.benchmark import benchmark_classification


def wide(spark, rows, columns, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, columns)) @ rng.normal(size=(columns, columns)) * 3 + 1e6
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 3], x[:, 4] = 0.1, np.where(rng.random(rows) < 0.5, np.nan, 7.3)
    x[0, 5] = np.inf
    pdf = pd.DataFrame(x, columns=[f"c {i}" for i in range(columns)])
    return pdf, spark.createDataFrame(pdf).repartition(3)


def test_wide_correlations_equal_pandas(spark):
    pdf, df = wide(spark, 200, 20)
    got = {(r.a, r.b): r.r for r in profile.correlations(df).collect()}
    want = pdf.replace([np.inf, -np.inf], np.nan).corr(min_periods=2)
    assert len(got) == 400
    for a in pdf.columns:
        for b in pdf.columns:
            if "c 3" in (a, b) or "c 4" in (a, b):
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(want.loc[a, b], abs=1e-9), (a, b)
    matrix = profile.correlation_matrix(df).collect()
    assert {r["column"] for r in matrix} == set(pdf.columns) and matrix[0].asDict().keys() == {"column", *pdf.columns}


def test_few_and_many_columns_agree(spark, monkeypatch):
    _, df = wide(spark, 150, 8)
    plain = {(r.a, r.b): r.r for r in profile.correlations(df.drop("c 3", "c 4", "c 5")).collect()}
    monkeypatch.setattr(profile, "WIDE", 1)
    for (a, b), r in {(r.a, r.b): r.r for r in profile.correlations(df.drop("c 3", "c 4", "c 5")).collect()}.items():
        assert r == (None if plain[a, b] is None else pytest.approx(plain[a, b], abs=1e-9))


def test_three_hundred_columns_plan_in_seconds(spark):
    df = spark.range(2000).select(*[(F.xxhash64("id", F.lit(i)) % 1000).cast("double").alias(f"c{i}") for i in range(300)])
    start = time.time()
    out = profile.correlations(df)
    out.explain()
    assert time.time() - start < 30
    assert out.where("a = b").agg(F.min("r"), F.count("r")).first() == (pytest.approx(1.0), 300)


def test_sums_of_nothing(spark):
    empty = spark.createDataFrame([], "v array<double>")
    assert shifts(empty, F.col("v"), 3).tolist() == [0, 0, 0]
    assert pair_sums(empty, F.col("v"), 3, np.zeros(3)).collect() == []
    nulls = spark.createDataFrame([([None, 1.0, 2.0],), ([None, 3.0, None],)], "v array<double>")
    cells = {(r.i, r.j): r.n for r in pair_sums(nulls, F.col("v"), 3, np.zeros(3)).collect()}
    assert cells == {(0, 0): 0, (0, 1): 0, (0, 2): 0, (1, 1): 2, (1, 2): 1, (2, 2): 1}


def labelled(spark, n=300, regression=False):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 4)) * [1, 10, 0.1, 3] + 50
    y = x @ [1.0, -0.5, 20.0, 0.3] + rng.normal(size=n) if regression else (x[:, 0] + x[:, 3] / 3 + rng.normal(size=n) > 67).astype(float)
    rows = [(int(i), float(b), a.tolist()) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "row_id long, label double, features array<double>")


class Refitted:
    """The same estimator without its short cut."""

    def __init__(self, inner):
        self.fit = inner.fit


@pytest.mark.parametrize("alpha", [0.0, 1.0, 250.0])
def test_ridge_folds_equal_refits(spark, alpha):
    folds = kfold_assign(labelled(spark, regression=True), "row_id", 4).cache()
    model = registry.ridge(alpha)
    quick, slow = (
        {r.row_id: r.prediction for r in validate.cv_predictions(m, folds, 4).collect()} for m in (model, Refitted(model))
    )
    assert len(quick) == 300 and all(quick[i] == pytest.approx(slow[i], abs=1e-5) for i in slow)


def test_naive_bayes_folds_equal_refits(spark):
    folds = stratified_fold_assign(labelled(spark), "row_id", "label", 3).cache()
    quick, slow = (
        {r.row_id: (r.prediction, r.prob) for r in validate.cv_predictions(m, folds, 3).collect()} for m in (GaussianNB(), Refitted(GaussianNB()))
    )
    assert len(quick) == 300 and all(quick[i] == pytest.approx(slow[i], abs=1e-9) for i in slow)


def test_a_class_in_one_fold_only(spark):
    rows = [(k, float(k % 2), [float(k), 1.0], k % 3) for k in range(30)] + [(99, 2.0, [500.0, 1.0], 0)]
    folds = spark.createDataFrame(rows, "row_id long, label double, features array<double>, fold int")
    quick, slow = (
        {r.row_id: (r.prediction, r.prob) for r in validate.cv_predictions(m, folds, 3).collect()} for m in (GaussianNB(), Refitted(GaussianNB()))
    )
    assert len(quick) == 31 and all(quick[i] == pytest.approx(slow[i], abs=1e-9) for i in slow)


def test_missing_values_are_left_to_the_estimator(spark):
    rows = [(k, float(k), [float(k), None if k == 3 else 1.0]) for k in range(20)]
    folds = kfold_assign(spark.createDataFrame(rows, "row_id long, label double, features array<double>"), "row_id", 2)
    assert registry.ridge().fit_folds(folds, 2) is None
    assert registry.ridge().fit_folds(folds.limit(0), 2) is None


def test_folds_are_written_only_where_models_need_it(spark, monkeypatch):
    written = []
    monkeypatch.setattr(validate, "checkpointed", lambda d: written.append(1) or d)
    train = labelled(spark)
    board, _ = benchmark_classification(train, train, {"Naive Bayes": GaussianNB()}, cv_folds=3)
    assert not written and board.first()["cv_mean"] > 0.7
    scores = [board.first()["cv_scores"], validate.stratified_kfold(Refitted(GaussianNB()), train, 3)["scores"]]
    assert written and scores[0] == pytest.approx(scores[1])


def test_the_number_of_classes_is_a_parameter(spark):
    folds = kfold_assign(labelled(spark, 30), "row_id", 3).withColumn("label", F.col("row_id").cast("double"))
    assert GaussianNB(max_classes=30).fit(folds).transform(folds).count() == 30
    for run in (lambda m: m.fit(folds), lambda m: m.fit_folds(folds, 3)):
        with pytest.raises(ValueError):
            run(GaussianNB(max_classes=9))
