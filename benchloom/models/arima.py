"""ARIMA(p, d, q) for panels of series, by exact maximum likelihood at any length.

The likelihood of a stretch of values is a small quadratic form of the state before it (see ``arma_filter``), and forms of
neighbouring stretches join exactly. Parameters are found by a damped Newton search whose state is a row of numbers: a round
evaluates all candidates that its derivatives need, then moves the state. Series of at most ``stretch_rows`` counted rows
do all rounds inside one group. Longer ones are packed into stretches once, and each round of all searches is one Spark
job over the stretches. Both run the same functions, so the estimate does not depend on where a series is cut.

A series that cannot be fitted has a row with an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from benchloom.models.arma_filter import Stretch, join, objective, stretch, system, unflatten
from benchloom.models.panel import STRETCH_ROWS, packed_stretches, split_by_length
from benchloom.operators.ordering import BROADCAST_ROWS
from benchloom.session import checkpointed, fan_out

DEFAULT_ORDER = (1, 1, 1)
STEP = 2e-4  # of the differences that stand for derivatives
ROUNDS = 60
LONGEST_STEP = 1.5
SETTLED = 1e-13  # expected gain per value below which a search ends
FLAT = 1e-7  # slope per value below which it ends: at a unit root the likelihood only levels out
STARTS = (0.1, -0.4, 0.6, -1.2, 1.5)

FIT_SCHEMA = (
    "key string, p int, d int, q int, n bigint, constant double, ar array<double>, ma array<double>, "
    "sigma2 double, loglik double, aic double, state array<double>, ends array<double>, error string"
)
FIT_NAMES = [f.split()[0] for f in FIT_SCHEMA.split(", ")]
Order = tuple[int, int, int]


def stationary(z: np.ndarray) -> np.ndarray:
    """Unconstrained values -> coefficients of a stationary autoregression, by partial autocorrelations.  Batched on axis 0."""
    r = z / np.sqrt(1.0 + z * z)
    out = np.zeros_like(r)
    for k in range(r.shape[1]):
        prev = out[:, :k].copy()
        out[:, :k] = prev - r[:, k : k + 1] * prev[:, ::-1]
        out[:, k] = r[:, k]
    return out


class Search:
    """Damped Newton search for the parameters of one series under one order; all that it knows is `vector`.

    The constant (without differencing only) is counted in standard deviations from the mean.
    """

    FIXED = 8  # round, done, damping, value, sum of squares, log of variances, center, scale

    def __init__(self, order: Order, vector: np.ndarray):
        self.order, self.v = order, np.array(vector, dtype=float)
        self.k, self.r = free_parameters(order), max(order[0], order[2] + 1)

    @classmethod
    def begin(cls, order: Order, center: float, scale: float) -> "Search":
        k, r = free_parameters(order), max(order[0], order[2] + 1)
        out = cls(order, np.zeros(cls.FIXED + 3 * k + k * k + r))
        out.v[2], out.v[3], out.v[6], out.v[7] = 1e-3, math.inf, center, scale
        return out

    def _slice(self, number: int) -> slice:
        sizes = [self.k, self.k, self.k, self.k * self.k, self.r]
        at = self.FIXED + sum(sizes[:number])
        return slice(at, at + sizes[number])

    theta, trial, gradient, curvature, state = (
        property(lambda self, n=n: self.v[self._slice(n)], lambda self, x, n=n: self.v.__setitem__(self._slice(n), np.ravel(x))) for n in range(5)
    )

    @property
    def done(self) -> bool:
        return bool(self.v[1])

    def candidates(self) -> np.ndarray:
        """The first round tries starts, later ones the trial point and what its derivatives need."""
        if self.k and self.v[0] == 0:
            coefficients = self.order[0] + self.order[2]
            grid = np.array([[STARTS[(i * (j + 1) + j) % len(STARTS)] for j in range(coefficients)] for i in range(3 * len(STARTS))])
            return np.hstack([grid, np.zeros((len(grid), self.k - coefficients))]) if coefficients else np.zeros((1, self.k))
        e = STEP * np.eye(self.k)
        one = [x for i in range(self.k) for x in (e[i], -e[i])]
        two = [e[i] + e[j] for i in range(self.k) for j in range(i)]
        return self.trial + np.stack([np.zeros(self.k), *one, *two])

    def models(self, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p, d, q = self.order
        const = self.v[6] + self.v[7] * candidates[:, -1] if d == 0 else np.zeros(len(candidates))
        return const, stationary(candidates[:, :p]), -stationary(candidates[:, p : p + q])

    def form(self, z: np.ndarray, before: int = 0) -> Stretch:
        with np.errstate(all="ignore"):
            return stretch(z, *self.models(self.candidates()), before)

    def advance(self, whole: Stretch, n: int) -> None:
        """Move on, given the form of the whole series for the candidates of this round."""
        values, tried = objective(whole, n), self.candidates()
        if self.k and self.v[0] == 0:
            self.trial = tried[np.argmin(values)]
            self.v[0] = 1
            return
        better = values[0] < self.v[3]
        if better:
            self.v[3], self.v[4], self.v[5] = values[0], whole.square[0], whole.log_f[0]
            self.theta, self.state = self.trial, whole.offset[0]
            self._differentiate(values)
            self.v[2] = self.v[2] / 8 if self.v[0] > 1 else self.v[2]
        else:
            self.v[2] = max(8 * self.v[2], 1e-4)
        self.v[0] += 1
        if not self.k or not values[0] < 1e10 or self.v[0] > ROUNDS:
            self.v[1] = 1
            return
        h = self.curvature.reshape(self.k, self.k)
        roots, turn = np.linalg.eigh(h)
        step = -turn @ ((turn.T @ self.gradient) / (np.maximum(np.abs(roots), 1e-7) + self.v[2]))
        size = np.linalg.norm(step)
        step *= min(1.0, (LONGEST_STEP + 0.5 * np.abs(self.theta).max()) / max(size, 1e-300))
        self.trial = self.theta + step
        if -(self.gradient @ step) < SETTLED or np.abs(self.gradient).max() < FLAT or size < 1e-9:
            self.v[1] = 1

    def _differentiate(self, values: np.ndarray) -> None:
        up, down, mixed = values[1 : 2 * self.k : 2], values[2 : 2 * self.k + 1 : 2], values[2 * self.k + 1 :]
        h = np.diag((up - 2 * values[0] + down) / STEP**2)
        at = 0
        for i in range(self.k):
            for j in range(i):
                h[i, j] = h[j, i] = (mixed[at] - up[i] - up[j] + values[0]) / STEP**2
                at += 1
        self.gradient, self.curvature = (up - down) / (2 * STEP), h

    def result(self, n: int, rows: int, ends: Sequence[float]) -> dict:
        if not np.isfinite(self.v[3]) or self.v[3] >= 1e10:
            raise ValueError("the likelihood is not finite")
        const, ar, ma = self.models(self.theta.reshape(1, -1))
        loglik = -n * float(self.v[3])
        return {
            "n": rows, "constant": float(const[0]), "ar": ar[0].tolist(), "ma": ma[0].tolist(), "sigma2": float(self.v[4]) / n,
            "loglik": loglik, "aic": -2 * loglik + 2 * (self.k + 1), "state": self.state.tolist(), "ends": list(ends),
        }


def free_parameters(order: Order) -> int:
    return order[0] + order[2] + (order[1] == 0)


def differenced(y: np.ndarray, d: int) -> tuple[np.ndarray, list[float]]:
    """(y differenced d times, the last values that summing up again needs)."""
    ends, z = [], np.asarray(y, dtype=float)
    for _ in range(d):
        ends.append(float(z[-1]) if len(z) else math.nan)
        z = np.diff(z)
    return z, ends


def check_length(rows: int, order: Order) -> int:
    """The number of values after differencing."""
    n = rows - order[1]
    if n <= order[0] + order[2] + 2:
        raise ValueError(f"{rows} values are too few for order {order}")
    return n


def fit_arima(y: np.ndarray, order: Order) -> dict:
    """Exact maximum likelihood of one series; a constant only without differencing."""
    n = check_length(len(y), order)
    z, ends = differenced(y, order[1])
    search = Search.begin(order, float(np.mean(y)), float(np.std(y)) or 1.0)
    while not search.done:
        search.advance(search.form(z), n)
    return search.result(n, len(y), ends)


def forecast_path(fit: dict, steps: int) -> np.ndarray:
    ar, ma = np.array([fit["ar"]], dtype=float).reshape(1, -1), np.array([fit["ma"]], dtype=float).reshape(1, -1)
    t = system(ar, ma)[0][0]
    state, out = np.array(fit["state"], dtype=float), []
    for _ in range(steps):
        out.append(state[0] + fit["constant"])
        state = t @ state
    path = np.array(out)
    for last in reversed(fit["ends"]):
        path = last + np.cumsum(path)
    return path


def _row(key: str, order: Order, values: dict) -> dict:
    return {"key": key, **dict(zip("pdq", order, strict=True)), "error": None, **values}


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame([{c: r.get(c) for c in FIT_NAMES} for r in rows], columns=FIT_NAMES).astype({"n": "Int64"})


def _fit_groups(train: DataFrame, orders: Sequence[Order], keys: int) -> DataFrame:
    """Series as groups; with few series the orders are dealt out to several copies."""
    copies = max(1, min(len(orders), -(-2 * fan_out(train.sparkSession) // max(1, keys))))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        key, y, rows = pdf["key"].iloc[0], pdf.sort_values("t")["y"].to_numpy(), []
        for order in orders[int(pdf["part"].iloc[0]) :: copies]:
            try:
                rows.append(_row(key, order, fit_arima(y, order)))
            except (ValueError, np.linalg.LinAlgError) as e:
                rows.append(_row(key, order, {"error": str(e)}))
        return _frame(rows)

    tall = train.select("key", "t", "y", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("part"))
    return tall.repartition(fan_out(train.sparkSession), "key", "part").groupBy("key", "part").applyInPandas(fit, FIT_SCHEMA)


def fit_orders(train: DataFrame, orders: Sequence[Order], stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """Fits of every series under every order (see FIT_SCHEMA); failed fits carry an error."""
    orders = list(dict.fromkeys(map(tuple, orders)))
    stretch_rows = max(stretch_rows, max(d for _, d, _ in orders) + 8)
    short, keys, long = split_by_length(train, stretch_rows)
    fits = _fit_groups(short, orders, keys)
    return fits if long is None else fits.unionByName(_fit_long(long, orders, stretch_rows))


# ------------------------------------------------------------------ long series

SEARCH = "key string, p int, d int, q int, n bigint, search array<double>, ends array<double>"
FORM = "key string, p int, d int, q int, chunk bigint, n bigint, search array<double>, form array<double>, ends array<double>"


def _fit_long(train: DataFrame, orders: Sequence[Order], size: int) -> DataFrame:
    lead = max(d for _, d, _ in orders)
    packed = packed_stretches(train, lead, size)
    sums = train.groupBy("key").agg(F.count("*").alias("n"), F.avg("y").alias("center"), F.stddev_pop("y").alias("scale"))

    def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame(
                [{"key": r.key, **dict(zip("pdq", o, strict=True)), "n": r.n, "search": Search.begin(o, r.center, r.scale or 1.0).v, "ends": []}
                 for r in pdf.itertuples() for o in orders],
                columns=["key", "p", "d", "q", "n", "search", "ends"],
            )

    def evaluate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                rows = []
                for p, d, q, vector in zip(r.p, r.d, r.q, r.search, strict=True):
                    search = Search((p, d, q), vector)
                    z, ends = differenced(np.asarray(r.y)[lead - d if r.chunk else 0 :], d)
                    form = search.form(z, r.chunk * size - d if r.chunk else 0)
                    rows.append({
                        "key": r.key, "p": p, "d": d, "q": q, "chunk": r.chunk, "n": r.n, "search": search.v, "form": form.flat(), "ends": ends,
                    })
                yield pd.DataFrame(rows)

    def advance(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = list(pdf.sort_values("chunk").itertuples())
        first = rows[0]
        search = Search((first.p, first.d, first.q), first.search)
        c, whole = len(search.candidates()), None
        for r in rows:
            own = unflatten(r.form, c, search.r)
            whole = own if whole is None else join(whole, own)
        search.advance(whole, int(first.n) - int(first.d))
        return pd.DataFrame([{"key": first.key, "p": first.p, "d": first.d, "q": first.q, "n": first.n, "search": search.v, "ends": rows[-1].ends}])

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                order = (r.p, r.d, r.q)
                try:
                    rows.append(_row(r.key, order, Search(order, r.search).result(check_length(r.n, order), r.n, r.ends)))
                except ValueError as e:
                    rows.append(_row(r.key, order, {"error": str(e)}))
            yield _frame(rows)

    parts = fan_out(train.sparkSession)
    by = ["key", "p", "d", "q"]
    active = checkpointed(sums.mapInPandas(begin, SEARCH))
    done = None
    while True:
        count = active.count()
        if not count:
            break
        asked = active.groupBy("key").agg(F.collect_list(F.struct("p", "d", "q", "search")).alias("s"), F.first("n").alias("n"))
        asked = asked.select("key", "n", *[F.col(f"s.{c}").alias(c) for c in ("p", "d", "q", "search")])
        # the searches come to the stretches, which stay where they are
        forms = packed.join(F.broadcast(asked) if count <= BROADCAST_ROWS else asked, "key").mapInPandas(evaluate, FORM)
        moved = checkpointed(forms.repartition(parts, *by).groupBy(*by).applyInPandas(advance, SEARCH))
        ended = F.col("search")[1] > 0
        done = moved.filter(ended) if done is None else done.unionByName(moved.filter(ended))
        active = moved.filter(~ended)
    return done.mapInPandas(finish, FIT_SCHEMA)


# ------------------------------------------------------------------ series models

def forecast_fits(fits: DataFrame, steps: int) -> DataFrame:
    """(key, step, yhat) of one fit per key: a few numbers per series."""

    def path(batches):
        for pdf in batches:
            for r in pdf.to_dict("records"):
                yield pd.DataFrame({"key": r["key"], "step": np.arange(1, steps + 1), "yhat": forecast_path(r, steps)})

    return fits.filter(F.col("error").isNull()).mapInPandas(path, "key string, step int, yhat double")


def best_orders(fits: DataFrame, orders: Sequence[Order] | None = None) -> DataFrame:
    """The fit with the least AIC per key, the first order (p, d, q) of equals; DEFAULT_ORDER where none has one.

    `orders`: those that may be picked by AIC (all by default).
    """
    listed = F.lit(True) if orders is None else F.struct("p", "d", "q").isin(*[F.struct(*map(F.lit, o)) for o in orders])
    usable = F.col("error").isNull() & ~F.isnan("aic") & listed
    default = F.struct("p", "d", "q") == F.struct(*map(F.lit, DEFAULT_ORDER))
    rank = F.struct((~usable).alias("other"), F.when(usable, F.col("aic")).alias("aic"), "p", "d", "q")
    picked = fits.filter(usable | default).groupBy("key").agg(F.min_by(F.struct(*[F.col(c) for c in fits.columns]), rank).alias("b"))
    return picked.select("b.*")


class ARIMA:
    def __init__(self, order: Order = DEFAULT_ORDER, stretch_rows: int = STRETCH_ROWS):
        self.order, self.stretch_rows = tuple(order), stretch_rows
        self.fits: DataFrame | None = None

    def fit(self, train: DataFrame) -> "ARIMA":
        out = type(self)(self.order, self.stretch_rows)
        out.fits = fit_orders(train, [self.order], self.stretch_rows)
        return out

    def forecast(self, steps: int) -> DataFrame:
        return forecast_fits(self.fits, steps)


class ARIMACalibrated:
    """Order search by AIC over p, d, q up to the given limits; each series gets its own order.

    A series for which no order gives an AIC is fitted with DEFAULT_ORDER, or has that fit's error.
    """

    def __init__(self, max_p: int = 3, max_d: int = 2, max_q: int = 3, stretch_rows: int = STRETCH_ROWS):
        self.limits, self.stretch_rows = (max_p, max_d, max_q), stretch_rows
        self.fits: DataFrame | None = None

    def fit(self, train: DataFrame) -> "ARIMACalibrated":
        out = type(self)(*self.limits, self.stretch_rows)
        orders = list(product(*[range(n + 1) for n in self.limits]))
        out.fits = best_orders(fit_orders(train, [*orders, DEFAULT_ORDER], self.stretch_rows), orders)
        return out

    def forecast(self, steps: int) -> DataFrame:
        return forecast_fits(self.fits, steps)
