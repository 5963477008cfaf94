"""Kernel machines by explicit feature maps, which turn a kernel into a linear problem that scales with the rows, not
with their square: random Fourier features for rbf (Rahimi & Recht, NIPS 2007); for the polynomial kernel (gamma x y)^3 all weighted
monomials where they are few, else a tensor sketch (Pham & Pagh, KDD 2013).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from benchloom.functions.columns import col, matrix
from benchloom.models.base import VECTOR, with_vector
from benchloom.session import bounded_batches

KERNELS = ("linear", "rbf", "poly")
RANDOM_FEATURES = 256
EPSILON = 0.1
TASK_ROWS, TASK_BYTES = 1 << 16, 16 << 20  # of one partition that a fit reads again and again
PIECE = 1 << 18  # numbers that a feature map holds at once


def dealt(df: DataFrame, rows: int, width: int) -> DataFrame:
    """Rows of `width` numbers in partitions of bounded rows and bytes, however the files are cut; few rows stay as they are."""
    parts = -(-rows // max(1, min(TASK_ROWS, TASK_BYTES // (8 * max(1, width)))))
    return df.repartition(parts) if parts > 1 else df


def kernel_gamma(df: DataFrame, gamma: str | float) -> float:
    """'scale' = 1 / (features x variance of all values), 'auto' = 1 / features, or a number."""
    if not isinstance(gamma, str):
        return float(gamma)
    row = df.select(F.size("features").alias("d"), F.explode("features").alias("v")).agg(F.max("d").alias("d"), F.var_pop("v").alias("v")).first()
    if gamma == "auto":
        return 1.0 / row["d"]
    if gamma == "scale":
        return 1.0 / (row["d"] * row["v"]) if row["v"] else 1.0
    raise ValueError(f"unknown gamma {gamma!r}; use 'scale', 'auto' or a number")


class FeatureMap:
    """A function `project` of rows of numbers to rows of `width` numbers, as a column."""

    width: int

    def project(self, x: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def pieces(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(number of the first row, rows of features), a bounded number of rows at a time."""
        step = max(1, PIECE // max(self.width, x.shape[1]))
        for at in range(0, len(x), step):
            yield at, self.project(x[at : at + step])

    def transform(self, df: DataFrame, out: str = "features") -> DataFrame:
        mapper, width = self, self.width
        bounded_batches(df.sparkSession)

        @F.arrow_udf("array<double>")
        def apply(vectors: pa.Array) -> pa.Array:
            x = matrix(vectors)
            values = np.empty((len(x), width))
            for at, z in mapper.pieces(x):
                values[at : at + len(z)] = z
            return pa.ListArray.from_arrays(np.arange(0, len(x) * width + 1, width, dtype=np.int32), values.ravel())

        return df.withColumn(out, apply("features"))


class Unchanged(FeatureMap):
    def __init__(self, dim: int):
        self.width = dim

    def project(self, x: np.ndarray) -> np.ndarray:
        return x


class PolynomialFeatures(FeatureMap):
    """Inner products are (gamma x y + coef0) ** degree: exact by weighted monomials where these are at most `size`, else on
    average."""

    def __init__(self, dim: int, gamma: float, size: int = RANDOM_FEATURES, seed: int = 42, degree: int = 3, coef0: float = 0.0):
        self.scale, self.constant = np.sqrt(gamma), np.sqrt(coef0)
        dim += coef0 > 0
        self.exact = math.comb(dim + degree - 1, degree) <= size
        if self.exact:
            self.terms = np.array(list(combinations_with_replacement(range(dim), degree)))
            orders = [math.factorial(degree) // math.prod(map(math.factorial, Counter(t).values())) for t in self.terms.tolist()]
            self.weights, self.width = np.sqrt(np.array(orders, dtype=float)), len(orders)
        else:
            rng = np.random.default_rng(seed)
            self.width = size
            self.places = rng.integers(0, size, size=(degree, dim))
            self.signs = rng.choice([-1.0, 1.0], size=(degree, dim))

    def project(self, x: np.ndarray) -> np.ndarray:
        x = x * self.scale
        if self.constant:
            x = np.hstack([x, np.full((len(x), 1), self.constant)])
        if self.exact:
            return np.prod(x[:, self.terms], axis=2) * self.weights
        # a count sketch of each factor; multiplied as polynomials, they sketch the tensor of all products
        spectrum = 1.0
        for place, sign in zip(self.places, self.signs, strict=True):
            sketch = np.zeros((x.shape[1], self.width))
            sketch[np.arange(x.shape[1]), place] = sign
            spectrum = spectrum * np.fft.rfft(x @ sketch, axis=1)
        return np.fft.irfft(spectrum, n=self.width, axis=1)


def feature_map(kernel: str, df: DataFrame, dim: int, gamma: str | float, size: int, seed: int, coef0: float = 0.0) -> FeatureMap:
    if kernel == "linear":
        return Unchanged(dim)
    if kernel == "poly":
        return PolynomialFeatures(dim, kernel_gamma(df, gamma), size, seed, coef0=coef0)
    return RandomFourierFeatures(dim, kernel_gamma(df, gamma), size, seed)


class RandomFourierFeatures(FeatureMap):
    """x -> sqrt(2 / D) cos(x W + b) with W ~ N(0, 2 gamma), b ~ U(0, 2 pi), fixed by the seed."""

    def __init__(self, dim: int, gamma: float, size: int = RANDOM_FEATURES, seed: int = 42):
        rng = np.random.default_rng(seed)
        self.w = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(dim, size))
        self.b = rng.uniform(0.0, 2.0 * np.pi, size=size)
        self.width = size

    def project(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(2.0 / len(self.b)) * np.cos(x @ self.w + self.b)


class SVMClassifier(Estimator):
    """Support vector machine: linear, rbf or poly (degree 3), Platt-scaled probability."""

    def __init__(self, C: float = 1.0, kernel: str = "rbf", gamma: str | float = "scale", size: int = RANDOM_FEATURES, seed: int = 42, coef0: float = 0.0):
        super().__init__()
        self.coef0 = coef0
        if kernel not in KERNELS:
            raise ValueError(f"kernel {kernel!r} has no distributed form; use one of {', '.join(KERNELS)}")
        self.C, self.kernel, self.gamma, self.size, self.seed = C, kernel, gamma, size, seed

    def _fit(self, df: DataFrame) -> "SVMModel":
        n, dim = df.agg(F.count("*"), F.max(F.size("features"))).first()
        rff = None if self.kernel == "linear" else feature_map(self.kernel, df, dim, self.gamma, self.size, self.seed, self.coef0)
        df = dealt(df.select("label", "features"), n, rff.width if rff else dim)
        src = with_vector(rff.transform(df) if rff else df).select("label", VECTOR).persist()
        svc = LinearSVC(featuresCol=VECTOR, labelCol="label", regParam=1.0 / (self.C * n), standardization=False, maxIter=100)
        try:
            inner = svc.fit(src)
            scored = inner.transform(src).select("label", array_to_vector(F.array(vector_to_array("rawPrediction")[1])).alias("_margin"))
            platt = LogisticRegression(featuresCol="_margin", labelCol="label").fit(scored)
        finally:
            src.unpersist()
        return SVMModel(rff, inner, float(platt.coefficients[0]), float(platt.intercept))


class SVMModel(Model):
    def __init__(self, rff: FeatureMap | None, inner: Model, slope: float, offset: float):
        super().__init__()
        self.rff, self.inner, self.slope, self.offset = rff, inner, slope, offset

    def _transform(self, df: DataFrame) -> DataFrame:
        src = df.withColumn("_plain", F.col("features"))
        out = self.inner.transform(with_vector(self.rff.transform(src) if self.rff else src))
        margin = vector_to_array("rawPrediction")[1]
        return out.withColumn("features", F.col("_plain")).select(
            *[col(c) for c in df.columns], "prediction", (1.0 / (1.0 + F.exp(-(F.lit(self.slope) * margin + F.lit(self.offset))))).alias("prob")
        )


class SVRegressor(Estimator):
    """Support vector regression: a feature map, then a linear fit of the epsilon-insensitive loss.

    Minimises mean(loss) + |w|^2 / (2 C n).  Every step is one job in which tasks add up loss and gradient of
    their rows; the driver only holds the coefficients.  What is kept between steps is the narrower of the rows and their
    features, in partitions of bounded size; features of narrow rows are made again in every step.
    """

    def __init__(
        self, C: float = 1.0, gamma: str | float = "scale", epsilon: float = EPSILON, size: int = 128, seed: int = 42, max_iter: int = 40,
        kernel: str = "rbf", coef0: float = 0.0,
    ):
        super().__init__()
        if kernel not in KERNELS:
            raise ValueError(f"kernel {kernel!r} has no distributed form; use one of {', '.join(KERNELS)}")
        self.kernel, self.coef0 = kernel, coef0
        self.C, self.gamma, self.epsilon, self.size, self.seed, self.max_iter = C, gamma, epsilon, size, seed, max_iter

    def _fit(self, df: DataFrame) -> "SVRModel":
        n, dim, mean, dev = df.agg(F.count("*"), F.max(F.size("features")), F.avg("label"), F.stddev_pop("label")).first()
        rff = feature_map(self.kernel, df, dim, self.gamma, self.size, self.seed, self.coef0)
        width = rff.width
        src = dealt(df.select("label", "features"), n, min(dim, width))
        mapper: FeatureMap = rff
        if width < dim:
            src, mapper = rff.transform(src), Unchanged(width)
        src = src.persist()
        # the corner of the loss is rounded over a small share of the label's spread, which makes it smooth
        rounding = max(1e-3 * (dev or 1.0), 1e-9)
        epsilon, reg = self.epsilon, 1.0 / (self.C * n)

        def loss(theta: np.ndarray) -> tuple[float, np.ndarray]:
            def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                total, grad = 0.0, np.zeros(width + 1)
                for batch in batches:
                    if not batch.num_rows:
                        continue
                    labels = batch.column("label").to_numpy(zero_copy_only=False)
                    for at, x in mapper.pieces(matrix(batch.column("features"))):
                        r = x @ theta[:-1] + theta[-1] - labels[at : at + len(x)]
                        over = np.abs(r) - epsilon
                        soft = np.clip(over, 0.0, rounding)
                        total += float((soft * soft / (2 * rounding) + np.maximum(over - rounding, 0.0)).sum())
                        g = np.sign(r) * soft / rounding
                        grad[:-1] += g @ x
                        grad[-1] += g.sum()
                yield pa.RecordBatch.from_pydict({"total": [total], "grad": [grad]}, schema=pa.schema([("total", pa.float64()), ("grad", pa.list_(pa.float64()))]))

            rows = src.mapInArrow(partial, "total double, grad array<double>")
            parts = rows.select("total", F.posexplode("grad").alias("i", "g")).groupBy("i").agg(F.sum("total").alias("t"), F.sum("g").alias("g"))
            summed = {r["i"]: r for r in parts.collect()}
            grad = np.array([summed[i]["g"] for i in range(width + 1)]) / n
            grad[:-1] += reg * theta[:-1]
            return summed[0]["t"] / n + 0.5 * reg * float(theta[:-1] @ theta[:-1]), grad

        start = np.zeros(width + 1)
        start[-1] = mean
        try:
            theta = minimize_lbfgs(loss, start, self.max_iter)
        finally:
            src.unpersist()
        return SVRModel(rff, theta)


class SVRModel(Model):
    def __init__(self, rff: FeatureMap, theta: np.ndarray):
        super().__init__()
        self.rff, self.theta = rff, theta

    def _transform(self, df: DataFrame) -> DataFrame:
        rff, theta = self.rff, self.theta

        bounded_batches(df.sparkSession)

        @F.arrow_udf("double")
        def predict(vectors: pa.Array) -> pa.Array:
            found = [z @ theta[:-1] + theta[-1] for _, z in rff.pieces(matrix(vectors))]
            return pa.array(np.concatenate(found) if found else np.zeros(0))

        return df.withColumn("prediction", predict("features")).withColumn("prob", F.lit(None).cast("double"))


def minimize_lbfgs(f, x: np.ndarray, max_iter: int, memory: int = 8, tol: float = 1e-6) -> np.ndarray:
    """Limited-memory BFGS with step halving for a smooth convex function f -> (value, gradient)."""
    value, grad = f(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(max_iter):
        if np.linalg.norm(grad) <= tol * max(1.0, abs(value)):
            break
        q, alphas = grad.copy(), []
        for s, y in reversed(pairs):
            a = (s @ q) / (y @ s)
            alphas.append(a)
            q -= a * y
        if pairs:
            s, y = pairs[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, np.linalg.norm(grad))
        for (s, y), a in zip(pairs, reversed(alphas)):
            q += s * (a - (y @ q) / (y @ s))
        step, slope = 1.0, grad @ q
        while True:
            new_value, new_grad = f(x - step * q)
            if new_value <= value - 1e-4 * step * slope or step < 1e-6:
                break
            step *= 0.5
        if step < 1e-6:
            break
        s, y = -step * q, new_grad - grad
        if s @ y > 1e-12:
            pairs = (pairs + [(s, y)])[-memory:]
        x, value, grad = x - step * q, new_value, new_grad
    return x
