"""Feature maps against their kernels, and the kernels of the regressor."""

import numpy as np
import pytest

from benchloom.models import registry
from benchloom.models.kernel import PolynomialFeatures, RandomFourierFeatures, SVRegressor, SVMClassifier
from benchloom.operators.metrics import auc_roc


@pytest.mark.parametrize("coef0", [0.0, 0.7])
def test_few_monomials_give_the_polynomial_kernel(coef0):
    x = np.random.default_rng(1).normal(size=(30, 4))
    mapper = PolynomialFeatures(4, 0.3, coef0=coef0)
    assert mapper.exact and mapper.width == (35 if coef0 else 20)
    assert mapper.project(x) @ mapper.project(x).T == pytest.approx((0.3 * x @ x.T + coef0) ** 3)


def test_many_monomials_are_sketched_without_bias():
    x = np.random.default_rng(2).normal(size=(12, 64)) / 8
    kernel = (x @ x.T + 0.5) ** 3
    got = []
    for seed in range(60):
        mapper = PolynomialFeatures(64, 1.0, 512, seed, coef0=0.5)
        assert not mapper.exact and mapper.width == 512
        got.append(mapper.project(x) @ mapper.project(x).T)
    assert np.abs(np.mean(got, axis=0) - kernel).max() < 0.1 * kernel.max()
    assert np.std(got, axis=0).max() < 0.4 * kernel.max()


def test_fourier_features_give_the_rbf_kernel():
    x = np.random.default_rng(3).normal(size=(20, 5))
    z = RandomFourierFeatures(5, 0.2, 8192).project(x)
    distance = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-0.2 * distance)).max() < 0.08


def table(spark, x, y):
    return spark.createDataFrame([(i, float(b), [float(v) for v in a]) for i, (a, b) in enumerate(zip(x, y, strict=True))], "row_id long, label double, features array<double>")


@pytest.mark.parametrize("kernel", ["linear", "poly", "rbf"])
def test_regression_by_kernel(spark, kernel):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 2))
    y = {"linear": 2 * x[:, 0] - x[:, 1] + 3, "poly": x[:, 0] ** 3 - 2 * x[:, 0] * x[:, 1] ** 2 + 1, "rbf": np.sin(2 * x[:, 0]) + x[:, 1] ** 2}[kernel]
    model = registry.svr(C=10.0, kernel=kernel).fit(table(spark, x, y))
    got = model.transform(table(spark, x, y)).collect()
    error = np.array([r.prediction - r.label for r in got])
    assert 1 - (error**2).mean() / y.var() > (0.95 if kernel == "rbf" else 0.97)
    if kernel != "rbf":
        assert np.quantile(np.abs(error), 0.9) < 0.2  # most rows lie in the tube of 0.1 or at its edge


def test_kernels_without_a_distributed_form_are_refused():
    with pytest.raises(ValueError):
        SVRegressor(kernel="sigmoid")
    with pytest.raises(ValueError):
        registry.svm_classifier(kernel="sigmoid")


def test_cubic_boundary(spark):
    x = np.random.default_rng(5).normal(size=(500, 2))
    df = table(spark, x, x[:, 0] ** 3 - 3 * x[:, 0] * x[:, 1] ** 2 > 0)  # six sectors, odd
    assert auc_roc(SVMClassifier(C=10.0, kernel="poly").fit(df).transform(df)).first()["auc"] > 0.97
    assert auc_roc(SVMClassifier(kernel="linear").fit(df).transform(df)).first()["auc"] < 0.7


def test_features_are_made_in_bounded_pieces():
    from benchloom.models import kernel

    x = np.random.default_rng(6).normal(size=(5000, 64))
    mapper = PolynomialFeatures(64, 0.1)
    found = list(mapper.pieces(x))
    assert [at for at, _ in found][1:] == list(np.cumsum([len(z) for _, z in found]))[:-1]
    assert max(z.size for _, z in found) <= kernel.PIECE < 5000 * mapper.width
    assert np.allclose(np.vstack([z for _, z in found]), mapper.project(x))


def test_fits_keep_narrow_rows_in_bounded_partitions(spark, monkeypatch):
    from benchloom.models import kernel

    rng = np.random.default_rng(7)
    x = rng.normal(size=(500, 2))
    one = table(spark, x, x[:, 0]).coalesce(1)
    whole = registry.svr().fit(one)
    kept = []
    frame = type(one)
    monkeypatch.setattr(frame, "persist", lambda self, f=frame.persist: kept.append(self) or f(self))
    monkeypatch.setattr(kernel, "TASK_ROWS", 100)
    cut = registry.svr().fit(one)
    registry.svm_classifier().fit(one.withColumn("label", (one.label > 0).cast("double")))
    for df in kept:
        sizes = df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
        assert sum(sizes) == 500 and max(sizes) <= 110
    assert len(kept) == 2 and max(len(r.features) for r in kept[0].collect()) == 2
    assert np.allclose(cut.theta, whole.theta, atol=1e-3)
