"""Model registries and hyper-parameter builders."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from inspect import signature

from pyspark.ml import Estimator
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from benchloom.models.fold_sums import ridge_folds
from benchloom.models.histogram_trees import HistogramBoosting, HistogramTree
from benchloom.models.base import TabularEstimator
from benchloom.models.kernel import SVMClassifier, SVRegressor
from benchloom.models.knn import KNNClassifier, KNNRegressor
from benchloom.models.naive_bayes import GaussianNB

# The depth Spark allows at most (stands for "no limit"), and the names of split criteria.
UNLIMITED_DEPTH = 30
IMPURITY = {"gini": "gini", "entropy": "entropy", "log_loss": "entropy"}
FEATURE_SUBSET = {"sqrt": "sqrt", "log2": "log2", None: "all", "None": "all"}

try:  # the second-order boosting library is optional
    from xgboost.spark import SparkXGBClassifier, SparkXGBRegressor
except ImportError:
    SparkXGBClassifier = SparkXGBRegressor = None


def _tree(max_depth: int | None, min_samples_split: int) -> dict:
    return {"maxDepth": max_depth or UNLIMITED_DEPTH, "minInstancesPerNode": max(1, min_samples_split // 2)}


# ------------------------------------------------------------------ classification

def logistic_regression(C: float = 1.0, max_iter: int = 1000, solver: str = "lbfgs", seed: int = 42) -> Estimator:
    """L2-penalised logistic regression; ``solver`` is accepted, the optimum does not depend on it."""
    build = lambda df: LogisticRegression(regParam=1.0 / (C * df.count()), elasticNetParam=0.0, standardization=False, maxIter=max_iter)
    return TabularEstimator("LogisticRegression", build, True, {"C": C, "max_iter": max_iter, "solver": solver})


def random_forest_classifier(
    n_estimators: int = 100, max_depth: int | None = None, min_samples_split: int = 2, max_features: str | None = "sqrt", seed: int = 42
) -> Estimator:
    build = lambda df: RandomForestClassifier(
        numTrees=n_estimators, featureSubsetStrategy=FEATURE_SUBSET[max_features], seed=seed, **_tree(max_depth, min_samples_split)
    )
    return TabularEstimator("RandomForestClassifier", build, True, {"n_estimators": n_estimators, "max_depth": max_depth})


def decision_tree_classifier(max_depth: int | None = None, min_samples_split: int = 2, criterion: str = "gini", seed: int = 42) -> Estimator:
    build = lambda df: DecisionTreeClassifier(impurity=IMPURITY[criterion], seed=seed, **_tree(max_depth, min_samples_split))
    bounded = TabularEstimator("DecisionTreeClassifier", build, True, {"max_depth": max_depth, "criterion": criterion})
    if IMPURITY[criterion] == "gini" and _needs_own_tree(max_depth, min_samples_split):
        return TwoClassTree(HistogramTree(True, max_depth, min_samples_split), bounded)
    return bounded


def _needs_own_tree(max_depth: int | None, min_samples_split: int) -> bool:
    """Spark's trees stop at depth 30 and know a least number of rows for leaves only."""
    return max_depth is None or max_depth > 30 or min_samples_split > 2


class TwoClassTree(Estimator):
    """The tree with exact rules for labels 0 and 1, Spark's for more classes."""

    def __init__(self, own: HistogramTree, bounded: TabularEstimator):
        super().__init__()
        self.own, self.bounded = own, bounded

    def _fit(self, df: DataFrame):
        more = df.filter((F.col("label") != 0) & (F.col("label") != 1)).limit(1)
        return self.own.fit(df) if more.isEmpty() else self.bounded.fit(df)


def svm_classifier(C: float = 1.0, kernel: str = "rbf", gamma: str | float = "scale", seed: int = 42) -> Estimator:
    return SVMClassifier(C, kernel, gamma, seed=seed)


def knn_classifier(n_neighbors: int = 5, weights: str = "uniform", metric: str = "minkowski", seed: int = 42) -> Estimator:
    return KNNClassifier(n_neighbors, weights, metric)


def naive_bayes(var_smoothing: float = 1e-9, seed: int = 42) -> Estimator:
    return GaussianNB(var_smoothing)


def gradient_boosting_classifier(n_estimators: int = 100, learning_rate: float = 0.1, max_depth: int = 3, seed: int = 42) -> Estimator:
    build = lambda df: GBTClassifier(maxIter=n_estimators, stepSize=learning_rate, maxDepth=max_depth, seed=seed)
    return TabularEstimator("GBTClassifier", build, True, {"n_estimators": n_estimators, "learning_rate": learning_rate, "max_depth": max_depth})


def stochastic_boosting_classifier(
    n_estimators: int = 100, learning_rate: float = 0.1, max_depth: int = 6, subsample: float = 1.0, seed: int = 42
) -> Estimator:
    settings = {"n_estimators": n_estimators, "learning_rate": learning_rate, "max_depth": max_depth, "subsample": subsample}
    if SparkXGBClassifier is not None:
        return TabularEstimator("SparkXGBClassifier", lambda df: _xgb(SparkXGBClassifier, settings, seed), True, settings)
    return HistogramBoosting(True, n_estimators, learning_rate, max_depth, subsample, seed=seed)


# ------------------------------------------------------------------ regression

def ridge(alpha: float = 1.0, seed: int = 42) -> Estimator:
    """sum of squares + alpha |w|^2; Spark's penalty is per row and in units of the label's deviation."""

    def build(df: DataFrame) -> Estimator:
        n, dev = df.agg(F.count("*"), F.stddev_pop("label")).first()
        return LinearRegression(elasticNetParam=0.0, solver="normal", standardization=False, regParam=alpha * (dev or 1.0) / n)

    return RidgeEstimator("Ridge", build, False, {"alpha": alpha})


class RidgeEstimator(TabularEstimator):
    def fit_folds(self, folds: DataFrame, k: int):
        """The models of a cross-validation, each without one fold, from one scan; None where values are missing."""
        return ridge_folds(folds, k, self.settings["alpha"])


def lasso(alpha: float = 1.0, max_iter: int = 2000, seed: int = 42) -> Estimator:
    build = lambda df: LinearRegression(elasticNetParam=1.0, regParam=alpha, standardization=False, maxIter=max_iter, tol=1e-9)
    return TabularEstimator("Lasso", build, False, {"alpha": alpha})


def random_forest_regressor(
    n_estimators: int = 100, max_depth: int | None = None, min_samples_split: int = 2, max_features: str | None = None, seed: int = 42
) -> Estimator:
    build = lambda df: RandomForestRegressor(
        numTrees=n_estimators, featureSubsetStrategy=FEATURE_SUBSET[max_features], seed=seed, **_tree(max_depth, min_samples_split)
    )
    return TabularEstimator("RandomForestRegressor", build, False, {"n_estimators": n_estimators, "max_depth": max_depth})


def decision_tree_regressor(max_depth: int | None = None, min_samples_split: int = 2, seed: int = 42) -> Estimator:
    if _needs_own_tree(max_depth, min_samples_split):
        return HistogramTree(False, max_depth, min_samples_split)
    build = lambda df: DecisionTreeRegressor(seed=seed, **_tree(max_depth, min_samples_split))
    return TabularEstimator("DecisionTreeRegressor", build, False, {"max_depth": max_depth})


def svr(C: float = 1.0, kernel: str = "rbf", gamma: str | float = "scale", seed: int = 42) -> Estimator:
    return SVRegressor(C, gamma, seed=seed, kernel=kernel)


def knn_regressor(n_neighbors: int = 5, weights: str = "uniform", metric: str = "minkowski", seed: int = 42) -> Estimator:
    return KNNRegressor(n_neighbors, weights, metric)


def gradient_boosting_regressor(n_estimators: int = 100, learning_rate: float = 0.1, max_depth: int = 3, seed: int = 42) -> Estimator:
    build = lambda df: GBTRegressor(maxIter=n_estimators, stepSize=learning_rate, maxDepth=max_depth, seed=seed)
    return TabularEstimator("GBTRegressor", build, False, {"n_estimators": n_estimators, "learning_rate": learning_rate, "max_depth": max_depth})


def stochastic_boosting_regressor(
    n_estimators: int = 100, learning_rate: float = 0.1, max_depth: int = 6, subsample: float = 1.0, seed: int = 42
) -> Estimator:
    settings = {"n_estimators": n_estimators, "learning_rate": learning_rate, "max_depth": max_depth, "subsample": subsample}
    if SparkXGBRegressor is not None:
        return TabularEstimator("SparkXGBRegressor", lambda df: _xgb(SparkXGBRegressor, settings, seed), False, settings)
    return HistogramBoosting(False, n_estimators, learning_rate, max_depth, subsample, seed=seed)


class _xgb:  # noqa: N801
    """Gives the optional library's estimators the setters of Spark ML."""

    def __init__(self, kind, settings: dict, seed: int):
        self.kind, self.kwargs = kind, {**settings, "random_state": seed}

    def setFeaturesCol(self, name: str):  # noqa: N802
        self.kwargs["features_col"] = name
        return self

    def setLabelCol(self, name: str):  # noqa: N802
        return self.kind(label_col=name, **self.kwargs)


# The names under which models are listed and asked for.
CLASSIFIERS: dict[str, Callable[..., Estimator]] = {
    "Logistic Regression": logistic_regression,
    "Random Forest": random_forest_classifier,
    "Decision Tree": decision_tree_classifier,
    "SVM": svm_classifier,
    "K-Nearest Neighbors": knn_classifier,
    "Naive Bayes": naive_bayes,
    "Gradient Boosting": gradient_boosting_classifier,
    "XGBoost": stochastic_boosting_classifier,
}
REGRESSORS: dict[str, Callable[..., Estimator]] = {
    "Ridge Regression": ridge,
    "Lasso Regression": lasso,
    "Random Forest": random_forest_regressor,
    "Decision Tree": decision_tree_regressor,
    "SVR": svr,
    "K-Nearest Neighbors": knn_regressor,
    "Gradient Boosting": gradient_boosting_regressor,
    "XGBoost": stochastic_boosting_regressor,
}


def _make(factories: Mapping[str, Callable], names: Iterable[str], params: Mapping[str, Mapping] | None, **common) -> dict:
    """Known names only; parameters a factory does not have are left out."""
    out = {}
    for name in names:
        if name not in factories:
            continue
        factory = factories[name]
        known = signature(factory).parameters
        given = {k: v for k, v in {**common, **(params or {}).get(name, {})}.items() if k in known}
        out[name] = factory(**given)
    return out


def get_classification_models(seed: int = 42) -> dict[str, Estimator]:
    return _make(CLASSIFIERS, CLASSIFIERS, None, seed=seed)


def get_regression_models(seed: int = 42) -> dict[str, Estimator]:
    return _make(REGRESSORS, REGRESSORS, None, seed=seed)


def build_models(problem_type: str, names: Iterable[str], params: Mapping[str, Mapping] | None = None, seed: int = 42) -> dict[str, Estimator]:
    """Models by name with user parameters; an unknown problem type has no models."""
    factories = {"classification": CLASSIFIERS, "regression": REGRESSORS}.get(problem_type, {})
    return _make(factories, names, params, seed=seed)
