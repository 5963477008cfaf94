import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from benchloom.models import arima, panel, smoothing
from benchloom.models.arma_filter import join, stretch, system, unflatten
from benchloom.models.series_registry import build_timeseries_models, get_timeseries_models
from benchloom.models.window_ar import WindowRegression
from benchloom.operators import series
from benchloom.session import checkpointed
from benchloom.sources.builtin import AIRLINE_PASSENGERS, airline_passengers

AIR = np.array(AIRLINE_PASSENGERS, dtype=float)


@pytest.fixture(scope="module")
def air(spark):
    return airline_passengers(spark).cache()


def plain_holt_winters(y, a, b, g, trend, seasonal, m):
    level, second = y[:m].mean(), y[m : 2 * m].mean()
    slope = (second / level) ** (1 / m) if trend == "mul" else (second - level) / m
    season = list(y[:m] / level if seasonal == "mul" else y[:m] - level)
    sse = 0.0
    for i, v in enumerate(y):
        base = level * slope if trend == "mul" else level + slope
        s = season[i]
        sse += (v - (base * s if seasonal == "mul" else base + s)) ** 2
        new = a * (v / s if seasonal == "mul" else v - s) + (1 - a) * base
        slope = b * (new / level if trend == "mul" else new - level) + (1 - b) * slope
        season.append(g * (v / base if seasonal == "mul" else v - base) + (1 - g) * s)
        level = new
    return level, slope, season[-m:], sse


@pytest.mark.parametrize("trend,seasonal", smoothing.CALIBRATION)
def test_holt_winters_recursion(air, trend, seasonal):
    got = smoothing.holt_winters_fixed(air, 0.3, 0.1, 0.4, trend, seasonal, 12).first()
    level, slope, season, sse = plain_holt_winters(AIR, 0.3, 0.1, 0.4, trend, seasonal, 12)
    assert (got.level, got.slope, got.sse) == pytest.approx((level, slope, sse)) and got.season == pytest.approx(season)


def test_long_series_run_in_stretches(air):
    both = air.unionByName(air.filter("t <= 101").select(F.lit("other").alias("key"), "t", (F.col("y") * 2).alias("y")))
    both = both.unionByName(air.filter("t <= 20").select(F.lit("short").alias("key"), "t", "y"))
    for seasonal in ("add", "mul"):
        whole = smoothing.holt_winters_fixed(both, 0.3, 0.1, 0.4, "add", seasonal, 12).orderBy("key").collect()
        cut = smoothing.holt_winters_fixed(both, 0.3, 0.1, 0.4, "add", seasonal, 12, stretch_rows=48).orderBy("key").collect()
        for a, b in zip(whole, cut, strict=True):
            assert (a.error is None) == (b.error is None) == (a.key != "short")
            if a.error is None:
                assert (b.n, b.level, b.slope, b.sse) == pytest.approx((a.n, a.level, a.slope, a.sse)) and b.season == pytest.approx(a.season)


@pytest.mark.parametrize(("trend", "seasonal"), [("add", "add"), (None, None), ("add", None), (None, "add")])
def test_additive_forms_take_one_pass_a_round_however_many_stretches(spark, monkeypatch, trend, seasonal):
    t = np.arange(1203)
    y = 50 + np.cumsum(np.random.default_rng(6).normal(size=1203)) + 10 * np.sin(t * 2 * np.pi / 12)
    df = spark.createDataFrame(pd.DataFrame({"key": "k", "t": t, "y": y}))
    whole = smoothing.fit_states(df, [(trend, seasonal)], 12).first()
    passes, scan = [], smoothing._one_scan
    monkeypatch.setattr(smoothing, "_one_scan", lambda *a: passes.append(1) or scan(*a))
    for rows in (240, 24):
        cut = smoothing.fit_states(df, [(trend, seasonal)], 12, stretch_rows=rows).first()
        assert (cut.trend, cut.seasonal, cut.n) == (trend, seasonal, 1203)
        assert (cut.sse, cut.alpha, cut.beta, cut.gamma) == pytest.approx((whole.sse, whole.alpha, whole.beta, whole.gamma), rel=1e-8)
        assert [cut.level, cut.slope, *cut.season] == pytest.approx([whole.level, whole.slope, *whole.season], abs=1e-6)
    assert len(passes) == 2 * smoothing.ROUNDS


def test_multiplicative_season_needs_no_pass_for_each_stretch(spark, monkeypatch):
    t = np.arange(14403)
    y = (50 + np.cumsum(np.random.default_rng(6).normal(size=len(t))) * 0.1) * (1 + 0.2 * np.sin(t * 2 * np.pi / 12))
    counts = []
    for n in (5403, 14403):  # 4 and 9 stretches, each longer than the memory of the recursion
        df = spark.createDataFrame(pd.DataFrame({"key": "k", "t": t[:n], "y": y[:n]}))
        whole = smoothing.holt_winters_fixed(df, 0.3, 0.1, 0.2, "add", "mul", 12).first()
        passes = []
        monkeypatch.setattr(smoothing, "checkpointed", lambda d, p=passes: p.append(1) or checkpointed(d))
        cut = smoothing.holt_winters_fixed(df, 0.3, 0.1, 0.2, "add", "mul", 12, stretch_rows=1800).first()
        counts.append(len(passes))
        assert [cut.sse, cut.level, cut.slope, *cut.season] == pytest.approx([whole.sse, whole.level, whole.slope, *whole.season], rel=1e-7)
    assert counts[0] == counts[1]


def test_only_the_chosen_form_is_fitted(air):
    both = air.unionByName(air.select(F.lit("other").alias("key"), "t", (F.col("y") * 2).alias("y")))
    choice = both.select("key").distinct().withColumns({"trend": F.lit("add"), "seasonal": F.when(F.col("key") == "other", "add").otherwise("mul")})
    every = {(r.key, r.trend, r.seasonal): r for r in smoothing.fit_states(both, smoothing.CALIBRATION, 12).collect()}
    for rows in (1000, 72):
        own = smoothing.fit_states(both, smoothing.CALIBRATION, 12, rows, choice).collect()
        assert sorted((r.key, r.trend, r.seasonal) for r in own) == [("airline", "add", "mul"), ("other", "add", "add")]
        assert all(r.sse == pytest.approx(every[r.key, r.trend, r.seasonal].sse, rel=1e-6) for r in own)


def test_fit_beats_fixed_parameters_and_forecasts(air):
    fitted = smoothing.fit_states(air, [("add", "mul")], 12)
    row = fitted.first()
    assert row.sse < smoothing.holt_winters_fixed(air, 0.3, 0.1, 0.4, "add", "mul", 12).first()["sse"]
    f = smoothing.forecast_states(fitted, 14).orderBy("step").collect()
    assert f[0].yhat == pytest.approx((row.level + row.slope) * row.season[0])
    assert f[13].yhat == pytest.approx((row.level + 14 * row.slope) * row.season[1])


def test_calibration_picks_the_best_configuration(air):
    choice = smoothing.calibrate(air, 12).first()
    errors = []
    states = smoothing.fit_states(air.filter("t <= 132"), smoothing.CALIBRATION, 12)
    for r in smoothing.forecast_states(states, 12).toPandas().groupby(["trend", "seasonal"]):
        yhat = r[1].sort_values("step")["yhat"].to_numpy()
        errors.append((((AIR[132:] - yhat) ** 2).mean(), r[0]))
    assert (choice.trend, choice.seasonal) == min(errors)[1] and choice.mse == pytest.approx(min(errors)[0])
    model = smoothing.HoltWintersCalibrated(12).fit(air)
    assert model.forecast(6).count() == 6


def test_short_series_fail_softly(air):
    state = smoothing.fit_states(air.filter("t <= 20"), [("add", "add")], 12).first()
    assert state.error and state.level is None


def test_arima_matches_published_likelihood(air):
    # the well-known fit of this series: log-likelihood -694.34, AIC 1394.68, ar -0.4742, ma 0.8635
    r = arima.fit_orders(air, [(1, 1, 1)]).first()
    assert (r.loglik, r.aic) == pytest.approx((-694.341, 1394.683), abs=0.01)
    assert (r.ar[0], r.ma[0]) == pytest.approx((-0.4742, 0.8635), abs=2e-3)


def test_arima_forecast_undoes_differences():
    y = np.arange(30.0) * 2 + np.tile([0.1, -0.1], 15)
    fit = arima.fit_arima(y, (0, 1, 0))
    assert arima.forecast_path(fit, 3) == pytest.approx([y[-1]] * 3)
    fit2 = arima.fit_arima(y, (0, 2, 0))
    step = y[-1] - y[-2]
    assert arima.forecast_path(fit2, 2) == pytest.approx([y[-1] + step, y[-1] + 2 * step])
    with pytest.raises(ValueError):
        arima.fit_arima(y[:4], (1, 1, 1))


@pytest.mark.parametrize("order", [(1, 0, 1), (2, 1, 0), (0, 1, 2), (0, 2, 1)])
def test_fits_do_not_depend_on_stretches(spark, order):
    rng = np.random.default_rng(8)
    e = rng.normal(size=1501)
    z = np.zeros(1500)
    for i in range(1500):
        z[i] = (0.6 * z[i - 1] if i else 0) + e[i + 1] + 0.3 * e[i]
    y = z + 5 if order[1] == 0 else np.cumsum(z) + 0.2 * np.arange(1500)
    df = spark.createDataFrame(pd.DataFrame({"key": "k", "t": np.arange(1500), "y": y}))
    whole = arima.fit_orders(df, [order]).first()
    path = arima.forecast_path(whole.asDict(), 5)
    for rows in (300, 30):  # 5 and 50 stretches
        cut = arima.fit_orders(df, [order], stretch_rows=rows).first()
        assert cut.error is None and cut.n == 1500
        assert (cut.loglik, cut.aic, cut.sigma2) == pytest.approx((whole.loglik, whole.aic, whole.sigma2), rel=1e-9)
        assert cut.ar + cut.ma + [cut.constant] == pytest.approx(whole.ar + whole.ma + [whole.constant], abs=1e-5)
        assert arima.forecast_path(cut.asDict(), 5) == pytest.approx(path, abs=1e-5)


def test_no_parameters_are_fitted_in_one_round(spark):
    rng = np.random.default_rng(9)
    y = np.cumsum(rng.normal(size=800)) + 10
    df = spark.createDataFrame(pd.DataFrame({"key": "k", "t": np.arange(800), "y": y}))
    fits = arima.fit_orders(df, [(0, 1, 0), (1, 1, 1), (0, 2, 1)], stretch_rows=300)
    got = arima.forecast_fits(fits.filter("d = 1 AND p = 0"), 2).orderBy("step").collect()
    assert [r.yhat for r in got] == pytest.approx([y[-1]] * 2)
    other = arima.forecast_fits(fits.filter("p = 1"), 1).first()["yhat"]
    assert other == pytest.approx(y[-1], abs=1.0)
    assert arima.best_orders(fits).first()["d"] == 1


def plain_filter(y, const, ar, ma):
    """Sum of squares, log of variances and last state by the Kalman filter, value by value."""
    t, w = (x[0] for x in system(np.array([ar]), np.array([ma])))
    r = len(w)
    cov = np.linalg.solve(np.eye(r * r) - np.kron(t, t), np.outer(w, w).reshape(-1)).reshape(r, r)
    state, squares, logs = np.zeros(r), 0.0, 0.0
    for v in y:
        f, gain = cov[0, 0], t @ cov[:, 0] / cov[0, 0]
        error = v - const - state[0]
        squares, logs = squares + error**2 / f, logs + np.log(f)
        state, cov = t @ state + gain * error, t @ cov @ t.T + np.outer(w, w) - np.outer(gain, gain) * f
    return squares, logs, state


@pytest.mark.parametrize(("ar", "ma"), [([], []), ([0.5], [0.4]), ([0.2, -0.5, 0.3], [0.6]), ([], [0.5, 0.9995 - 0.5]), ([0.97], [-0.3, 0.2, 0.1])])
def test_stretches_join_to_the_plain_filter(ar, ma):
    y = np.random.default_rng(3).normal(size=2000).cumsum() * 0.1
    many = [np.tile(x, (2, 1)) if len(x) else np.zeros((2, 0)) for x in (ar, ma)]
    squares, logs, state = plain_filter(y, 0.3, ar, ma)
    for cuts in ([0, 2000], [0, 3, 500, 501, 1100, 2000], list(range(0, 2001, 40))):
        whole = None
        for a, b in zip(cuts, cuts[1:], strict=False):
            own = stretch(y[a:b], np.full(2, 0.3), *many, before=a)
            own = unflatten(own.flat(), 2, len(state))
            whole = own if whole is None else join(whole, own)
        assert whole.square == pytest.approx([squares] * 2, rel=1e-9) and whole.log_f == pytest.approx([logs] * 2, abs=1e-6)
        assert whole.offset[1] == pytest.approx(state, abs=1e-8)


def test_series_without_a_usable_order_fall_back(spark):
    rows = [("flat", i, 5.0) for i in range(30)] + [("tiny", i, float(i)) for i in range(2)] + [("real", i, float(i % 7)) for i in range(60)]
    df = spark.createDataFrame(rows, "key string, t long, y double")
    best = {r.key: r for r in arima.ARIMACalibrated(1, 0, 1).fit(df).fits.collect()}
    assert (best["real"].p, best["real"].d, best["real"].q) != (1, 1, 1) and best["real"].error is None
    assert (best["tiny"].p, best["tiny"].d, best["tiny"].q) == (1, 1, 1) and "too few" in best["tiny"].error
    assert (best["flat"].p, best["flat"].d, best["flat"].q) == (1, 1, 1)


def test_failed_orders_carry_an_error(air):
    both = air.filter("t <= 5").withColumn("key", F.lit("short")).unionByName(air)
    rows = {r.key: r for r in arima.fit_orders(both, [(2, 1, 2)]).collect()}
    assert rows["short"].error and rows["short"].ar is None and rows["airline"].error is None
    assert {r.key for r in arima.forecast_fits(arima.fit_orders(both, [(2, 1, 2)]), 1).collect()} == {"airline"}


def test_order_search(air):
    fits = arima.fit_orders(air, [(0, 1, 1), (1, 1, 1), (2, 1, 2)])
    best = arima.best_orders(fits).first()
    assert (best.p, best.d, best.q) == (2, 1, 2)
    assert arima.ARIMACalibrated(1, 1, 1).fit(air).forecast(3).count() == 3


def test_baselines(spark):
    df = spark.createDataFrame([("k", i, float(v)) for i, v in enumerate([1, 5, 2, 6, 3, 7])], "key string, t int, y double")
    assert [r.yhat for r in panel.naive_forecast(df, 2).collect()] == [7.0, 7.0]
    assert [r.yhat for r in panel.seasonal_naive_forecast(df, 3, 2).orderBy("step").collect()] == [3.0, 7.0, 3.0]
    assert [r.yhat for r in panel.drift_forecast(df, 2).orderBy("step").collect()] == pytest.approx([8.2, 9.4])
    slope, icept = np.polyfit([1, 5, 2, 6, 3], [5, 2, 6, 3, 7], 1)
    got = [r.yhat for r in panel.ar1_forecast(df, 2).orderBy("step").collect()]
    assert got == pytest.approx([icept + slope * 7, icept + slope * (icept + slope * 7)])


@pytest.mark.parametrize("scale", [False, True])
def test_window_regression(spark, scale):
    t = np.arange(80)
    df = spark.createDataFrame(pd.DataFrame({"key": "k", "t": t, "y": 50 + 10 * np.sin(2 * np.pi * t / 8)}))
    got = WindowRegression(8, scale=scale).fit(df).forecast(10).orderBy("step").toPandas()["yhat"]
    assert np.abs(got - (50 + 10 * np.sin(2 * np.pi * np.arange(80, 90) / 8))).max() < 1.5


@pytest.mark.parametrize("scale", [False, True])
def test_linear_windows_recur_within_a_task(spark, scale, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(k, i, float(v)) for k, n in (("a", 60), ("b", 45), ("short", 3)) for i, v in enumerate(rng.normal(size=n).cumsum())]
    model = WindowRegression(5, scale=scale).fit(spark.createDataFrame(rows, "key string, t int, y double"))
    quick = {(r.key, r.step): r.yhat for r in model.forecast(11).collect()}
    lengths = spark.createDataFrame([("a", 4), ("b", 30), ("short", 2)], "key string, steps int")
    own = {(r.key, r.step): r.yhat for r in model.forecast(11, lengths).collect()}
    monkeypatch.setattr("benchloom.models.window_ar.linear_weights", lambda model: None)
    slow = {(r.key, r.step): r.yhat for r in model.forecast(11).collect()}
    assert len(quick) == 22 and all(quick[k] == pytest.approx(slow[k], abs=1e-9) for k in slow)
    assert own == {k: pytest.approx(v, abs=1e-9) for k, v in quick.items() if k[0] == "b" or k[1] <= 4}
    assert {(r.key, r.step) for r in model.forecast(11, lengths).collect()} == set(own)


def test_windows_split_and_scaling(spark):
    rows = [("hot", i, float(i * i)) for i in range(40)] + [("b", i, 5.0) for i in range(5)] + [("c", 0, 1.0)]
    df = spark.createDataFrame(rows, "key string, t int, y double")
    whole = series.lag_windows(df, ["key"], "t", "y", 3)
    cut = series.lag_windows(df, ["key"], "t", "y", 3, rows_per_chunk=7)
    as_set = lambda d: {(r.key, r.t, tuple(r.window), r.target) for r in d.collect()}
    assert as_set(whole) == as_set(cut) and whole.count() == 37 + 2
    parts = series.time_split(df, ["key"], "t", 0.8)
    assert {(r["key"], r["split"]): r["count"] for r in parts.groupBy("key", "split").count().collect()} == {
        ("hot", "train"): 32, ("hot", "test"): 8, ("b", "train"): 4, ("b", "test"): 1, ("c", "test"): 1}
    train = parts.filter("split = 'train'")
    ranges = series.series_range(train, ["key"], "y")
    norm = series.normalize_series(train, ["key"], "y", ranges)
    r = norm.filter("key = 'hot'").agg(F.min("y_norm"), F.max("y_norm")).first()
    assert tuple(r) == (0.0, 1.0) and norm.filter("key = 'b'").first()["y_norm"] == 0.0
    back = series.denormalize_series(norm, ["key"], "y_norm", ranges, "back")
    assert back.filter("abs(back - y) > 1e-9").count() == 0
    one = series.time_split(df.filter("key = 'b'").drop("key"), [], "t", 0.5)
    assert one.filter("split = 'train'").count() == 2


def test_load_series(spark):
    df = spark.createDataFrame([(2, "a", 5.0), (1, "b", None), (3, "c", 7.0)], "o int, s string, v double")
    assert [tuple(r) for r in series.load_series(df, ["o"]).orderBy("t").collect()] == [(1, 5.0), (2, 7.0)]
    with pytest.raises(ValueError):
        series.load_series(df.select("o", "s"), ["o"])


def test_registry():
    assert list(get_timeseries_models(4)) == ["Holt-Winters", "Holt-Winters Calibrado", "ARIMA(1,1,1)", "ARIMA Calibrado", "LSTM"]
    built = build_timeseries_models(["ARIMA(1,1,1)", "LSTM", "x"], {"ARIMA(1,1,1)": {"p": 2}, "LSTM": {"units": 9}}, 6)
    assert built["ARIMA(1,1,1)"].order == (2, 1, 1) and built["LSTM"].window_size == 6
