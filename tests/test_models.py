import numpy as np
import pytest
from pyspark.sql import functions as F

from benchloom.models import registry
from benchloom.models.base import predict_classification
from benchloom.models.kernel import SVMClassifier, minimize_lbfgs
from benchloom.models.knn import KNNClassifier, KNNRegressor
from benchloom.models.naive_bayes import GaussianNB
from benchloom.operators.metrics import auc_roc, regression_metrics
from benchloom.operators.validate import kfold_validation, manual_kfold, stratified_kfold


def table(spark, x, y):
    rows = [(i, float(t), [float(a) for a in v]) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "row_id bigint, label double, features array<double>").repartition(4).cache()


@pytest.fixture(scope="module")
def linear(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 3)) * [1.0, 2.0, 0.5]
    y = x @ [1.5, -2.0, 0.0] + 3 + rng.normal(size=200) * 0.3
    return x, y, table(spark, x, y)


@pytest.fixture(scope="module")
def rings(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 2))
    y = ((x**2).sum(axis=1) > 1.5).astype(float)
    return x, y, table(spark, x, y)


def coefficients(model):
    return np.append(model.inner.coefficients.toArray(), model.inner.intercept)


def test_ridge_is_the_closed_form(linear):
    x, y, df = linear
    xc, yc = x - x.mean(0), y - y.mean()
    for alpha in (1.0, 50.0):
        w = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
        assert coefficients(registry.ridge(alpha).fit(df)) == pytest.approx(np.append(w, y.mean() - x.mean(0) @ w), abs=1e-6)


def test_lasso_meets_its_optimality_conditions(linear):
    x, y, df = linear
    w = registry.lasso(0.5).fit(df).inner.coefficients.toArray()
    grad = (x - x.mean(0)).T @ (y - y.mean() - (x - x.mean(0)) @ w) / len(y)
    for wi, g in zip(w, grad):
        assert g == pytest.approx(0.5 * np.sign(wi), abs=1e-3) if wi else abs(g) <= 0.5 + 1e-6


def test_logistic_meets_its_optimality_conditions(rings):
    x, y, df = rings
    for c in (1.0, 0.1):
        w = coefficients(registry.logistic_regression(C=c).fit(df))
        p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
        assert c * (x.T @ (p - y)) + w[:-1] == pytest.approx(np.zeros(2), abs=1e-2)
        assert (p - y).sum() == pytest.approx(0, abs=1e-2)


def test_naive_bayes_against_numpy(rings):
    x, y, df = rings
    got = {r.row_id: r.prob for r in GaussianNB(1e-3).fit(df).transform(df).collect()}
    logits = []
    for c in (0.0, 1.0):
        part = x[y == c]
        var = part.var(0) + 1e-3 * x.var(0).max()
        logits.append(np.log((y == c).mean()) - 0.5 * (np.log(2 * np.pi * var) + (x - part.mean(0)) ** 2 / var).sum(1))
    want = 1 / (1 + np.exp(logits[0] - logits[1]))
    assert [got[i] for i in range(len(x))] == pytest.approx(list(want), abs=1e-9)


def test_knn_models(spark, rings, linear):
    x, y, df = rings
    model = KNNClassifier(1).fit(df)
    assert model.transform(df).filter("prediction != label").count() == 0
    three = spark.createDataFrame([(0, 0.0, [0.0]), (1, 1.0, [1.0]), (2, 2.0, [2.0])], "row_id bigint, label double, features array<double>")
    tie = KNNClassifier(3).fit(three).transform(three.filter("row_id = 2")).first()
    assert tie["prediction"] == 0.0 and tie["prob"] == pytest.approx(1 / 3)  # equal votes: the smaller class
    near = KNNClassifier(3, weights="distance").fit(three).transform(three).orderBy("row_id").collect()
    assert [r.prediction for r in near] == [0.0, 1.0, 2.0]
    _, _, lin = linear
    r2 = regression_metrics(KNNRegressor(3).fit(lin).transform(lin), "label", "prediction").first()["r2"]
    assert r2 > 0.8
    with pytest.raises(ValueError):
        KNNClassifier(metric="cosine")


@pytest.mark.parametrize("name", ["random_forest_classifier", "decision_tree_classifier", "gradient_boosting_classifier", "stochastic_boosting_classifier"])
def test_tree_classifiers_learn_rings(rings, name):
    _, _, df = rings
    settings = {"max_depth": 8} if name == "decision_tree_classifier" else {"max_depth": 4, "n_estimators": 8}
    model = getattr(registry, name)(**settings).fit(df)
    out = predict_classification(model, df)
    assert auc_roc(out, prob="prob").first()["auc"] > 0.95 and set(df.columns) <= set(out.columns)


def test_rbf_svm_learns_rings_and_linear_does_not(rings):
    _, _, df = rings
    rbf = auc_roc(SVMClassifier().fit(df).transform(df)).first()["auc"]
    line = auc_roc(SVMClassifier(kernel="linear").fit(df).transform(df)).first()["auc"]
    assert rbf > 0.95 > line
    with pytest.raises(ValueError):
        SVMClassifier(kernel="sigmoid")


def test_poly_svm(rings):
    _, _, df = rings
    assert auc_roc(SVMClassifier(kernel="poly", coef0=1.0).fit(df).transform(df)).first()["auc"] > 0.95


@pytest.mark.parametrize("name", ["random_forest_regressor", "decision_tree_regressor", "gradient_boosting_regressor", "stochastic_boosting_regressor", "svr"])
def test_regressors_learn_a_line(linear, name):
    _, _, df = linear
    small = {"n_estimators": 15, "max_depth": 4} if "forest" in name or "boosting" in name else {}
    out = getattr(registry, name)(**small).fit(df).transform(df)
    assert regression_metrics(out, "label", "prediction").first()["r2"] > 0.7


def test_minimizer():
    a = np.diag([1.0, 10.0, 100.0])
    b = np.array([1.0, 2.0, 3.0])
    x = minimize_lbfgs(lambda v: (0.5 * v @ a @ v - b @ v, a @ v - b), np.zeros(3), 100)
    assert x == pytest.approx(np.linalg.solve(a, b), abs=1e-4)


def test_threshold_prediction(rings):
    _, _, df = rings
    model = GaussianNB().fit(df)
    for t in (0.2, 0.9):
        assert predict_classification(model, df, t).filter(F.col("pred") != (F.col("prob") >= t).cast("int")).count() == 0


def test_registries_and_builders():
    assert len(registry.get_classification_models()) == 8 and len(registry.get_regression_models()) == 8
    built = registry.build_models("classification", ["K-Nearest Neighbors", "no such"], {"K-Nearest Neighbors": {"n_neighbors": 3, "junk": 1}})
    assert list(built) == ["K-Nearest Neighbors"] and built["K-Nearest Neighbors"].n_neighbors == 3
    assert registry.build_models("clustering", ["SVM"]) == {}


def test_cross_validation(rings, linear):
    _, _, df = rings
    cv = stratified_kfold(GaussianNB(), df, k=3)
    assert len(cv["scores"]) == 3 and cv["mean"] > 0.9 and cv["std"] == pytest.approx(np.std(cv["scores"]))
    _, _, lin = linear
    assert kfold_validation(registry.ridge(), lin, k=4)["mean"] > 0.95
    assert manual_kfold(registry.ridge(), lin, 3, "regression").filter("r2 > 0.9").count() == 3
