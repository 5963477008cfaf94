"""Series model queries on the monthly panel of orders per priority."""

from __future__ import annotations

from pyspark.sql import functions as F

from benchloom.models import arima, panel, smoothing
from benchloom.models.window_ar import WindowRegression
from benchloom.operators import series
from benchloom.plans.report import forecast_table
from benchloom.operators.ordering import positions
from benchloom.queries.catalog import MONTHLY_SQL, monthly_orders, query, rounded
from benchloom.queries.preparation import TIME_SPLIT_SQL

STEPS = 12
H = f"(SELECT unnest(range(1, {STEPS} + 1))::INTEGER AS step) h"


def _ends_sql(select: str) -> str:
    return (
        f"WITH s AS (SELECT * FROM {MONTHLY_SQL} q), e AS (SELECT key, arg_max(y, t) AS b, arg_min(y, t) AS a, count(*) AS n FROM s GROUP BY 1) "
        f"SELECT key, step, {select} AS yhat FROM e CROSS JOIN {H}"
    )


@query("naive_forecast", _ends_sql("b"))
def naive_forecast(spark, sf):
    return panel.naive_forecast(monthly_orders(spark, sf), STEPS)


@query("drift_forecast", _ends_sql("round(b + step * (b - a) / (n - 1), 6)"))
def drift_forecast(spark, sf):
    return rounded(panel.drift_forecast(monthly_orders(spark, sf), STEPS), ["yhat"])


@query(
    "seasonal_naive",
    f"WITH s AS (SELECT key, y, row_number() OVER (PARTITION BY key ORDER BY t DESC) AS r FROM {MONTHLY_SQL} q) "
    f"SELECT key, step, y AS yhat FROM s JOIN {H} ON r = 12 - (step - 1) % 12",
)
def seasonal_naive(spark, sf):
    return panel.seasonal_naive_forecast(monthly_orders(spark, sf), STEPS, 12)


@query(
    "ar1",
    f"WITH s AS (SELECT key, t, y, lag(y) OVER (PARTITION BY key ORDER BY t) AS x FROM {MONTHLY_SQL} q), "
    "f AS (SELECT key, covar_pop(x, y) / var_pop(x) AS b, avg(y) - covar_pop(x, y) / var_pop(x) * avg(x) AS a FROM s WHERE x IS NOT NULL GROUP BY 1), "
    "e AS (SELECT key, arg_max(y, t) AS last FROM s GROUP BY 1) "
    f"SELECT key, step, round(a * (1 - pow(b, step)) / (1 - b) + pow(b, step) * last, 6) AS yhat FROM f JOIN e USING (key) CROSS JOIN {H}",
)
def ar1(spark, sf):
    return rounded(panel.ar1_forecast(monthly_orders(spark, sf), STEPS), ["yhat"])


def _hw_sql(mul: bool, a: str = "0.3::DOUBLE", g: str = "0.2::DOUBLE") -> str:
    clean, fit = ("y / ss[1]", "(l + b) * ss[1]") if mul else ("(y - ss[1])", "l + b + ss[1]")
    new_level = f"({a} * {clean} + (1 - {a}) * (l + b))"
    new_season = f"{g} * ({'y / (l + b)' if mul else 'y - (l + b)'}) + (1 - {g}) * ss[1]"
    start = "v / l" if mul else "v - l"
    value = "(l + step * b) * ss[(step - 1) % 12 + 1]" if mul else "l + step * b + ss[(step - 1) % 12 + 1]"
    return (
        f"WITH RECURSIVE s AS (SELECT key, y, row_number() OVER (PARTITION BY key ORDER BY t) AS pos, count(*) OVER (PARTITION BY key) AS n FROM {MONTHLY_SQL} q), "
        "i AS (SELECT key, avg(y) FILTER (pos <= 12) AS l, (avg(y) FILTER (pos BETWEEN 13 AND 24) - avg(y) FILTER (pos <= 12)) / 12 AS b, "
        "list(y ORDER BY pos) FILTER (pos <= 12) AS f FROM s WHERE n >= 24 GROUP BY 1), "
        f"hw AS (SELECT key, 0::BIGINT AS pos, l, b, [{start} for v in f] AS ss, 0.0::DOUBLE AS sse FROM i UNION ALL "
        f"SELECT hw.key, s.pos, {new_level}, 0.1::DOUBLE * ({new_level} - l) + (1 - 0.1::DOUBLE) * b, list_append(ss[2:], {new_season}), sse + pow(y - ({fit}), 2) "
        "FROM hw JOIN s ON s.key = hw.key AND s.pos = hw.pos + 1) "
        f"SELECT hw.key, step, round({value}, 6) AS yhat, round(sse, 4) AS sse FROM hw JOIN (SELECT key, max(n) AS n FROM s GROUP BY 1) e ON e.key = hw.key AND hw.pos = e.n CROSS JOIN {H}"
    )


def _hw_fixed(spark, sf, seasonal, trend="add", **options):
    states = smoothing.holt_winters_fixed(monthly_orders(spark, sf), 0.3, 0.1, 0.2, trend, seasonal, 12, **options)
    out = smoothing.forecast_states(states, STEPS).join(states.select("key", "sse"), "key").select("key", "step", "yhat", "sse")
    return rounded(rounded(out, ["yhat"]), ["sse"], 4)


@query("holt_winters_fixed", _hw_sql(False))
def holt_winters_fixed(spark, sf):
    return _hw_fixed(spark, sf, "add")


@query("holt_winters_fixed_mul", _hw_sql(True))
def holt_winters_fixed_mul(spark, sf):
    return _hw_fixed(spark, sf, "mul")


def _plain_sql(trend: bool) -> str:
    """Smoothing without a season; it starts from the first value, with the first step as slope."""
    base = "(l + b)" if trend else "l"
    slope = f"0.1::DOUBLE * (0.3::DOUBLE * y + (1 - 0.3::DOUBLE) * {base} - l) + (1 - 0.1::DOUBLE) * b" if trend else "0.0::DOUBLE"
    return (
        f"WITH RECURSIVE s AS (SELECT key, y, row_number() OVER (PARTITION BY key ORDER BY t) AS pos, count(*) OVER (PARTITION BY key) AS n FROM {MONTHLY_SQL} q), "
        f"i AS (SELECT key, max(y) FILTER (pos = 1) AS l, {'max(y) FILTER (pos = 2) - max(y) FILTER (pos = 1)' if trend else '0.0::DOUBLE'} AS b FROM s WHERE n >= 2 GROUP BY 1), "
        "hw AS (SELECT key, 0::BIGINT AS pos, l, b, 0.0::DOUBLE AS sse FROM i UNION ALL "
        f"SELECT hw.key, s.pos, 0.3::DOUBLE * y + (1 - 0.3::DOUBLE) * {base}, {slope}, sse + pow(y - {base}, 2) FROM hw JOIN s ON s.key = hw.key AND s.pos = hw.pos + 1) "
        f"SELECT hw.key, step, round(l{' + step * b' if trend else ''}, 6) AS yhat, round(sse, 4) AS sse "
        f"FROM hw JOIN (SELECT key, max(n) AS n FROM s GROUP BY 1) e ON e.key = hw.key AND hw.pos = e.n CROSS JOIN {H}"
    )


SEASON_SQL = (
    f"WITH RECURSIVE s AS (SELECT key, y, row_number() OVER (PARTITION BY key ORDER BY t) AS pos, count(*) OVER (PARTITION BY key) AS n FROM {MONTHLY_SQL} q), "
    "i AS (SELECT key, avg(y) FILTER (pos <= 12) AS l, list(y ORDER BY pos) FILTER (pos <= 12) AS f FROM s WHERE n >= 24 GROUP BY 1), "
    "hw AS (SELECT key, 0::BIGINT AS pos, l, [v - l for v in f] AS ss, 0.0::DOUBLE AS sse FROM i UNION ALL "
    "SELECT hw.key, s.pos, 0.3::DOUBLE * (y - ss[1]) + (1 - 0.3::DOUBLE) * l, list_append(ss[2:], 0.2::DOUBLE * (y - l) + (1 - 0.2::DOUBLE) * ss[1]), sse + pow(y - l - ss[1], 2) "
    "FROM hw JOIN s ON s.key = hw.key AND s.pos = hw.pos + 1) "
    "SELECT hw.key, step, round(l + ss[(step - 1) % 12 + 1], 6) AS yhat, round(sse, 4) AS sse "
    f"FROM hw JOIN (SELECT key, max(n) AS n FROM s GROUP BY 1) e ON e.key = hw.key AND hw.pos = e.n CROSS JOIN {H}"
)


@query("smoothing_level", _plain_sql(False))
def smoothing_level(spark, sf):
    return _hw_fixed(spark, sf, None, None)


@query("smoothing_trend", _plain_sql(True))
def smoothing_trend(spark, sf):
    return _hw_fixed(spark, sf, None)


@query("smoothing_season", SEASON_SQL)
def smoothing_season(spark, sf):
    return _hw_fixed(spark, sf, "add", None)


@query("smoothing_in_stretches", _hw_sql(False))
def smoothing_in_stretches(spark, sf):
    """The additive recursion through stretches of two years, as long series run."""
    return _hw_fixed(spark, sf, "add", stretch_rows=24)


@query("holt_winters_fit")
def holt_winters_fit(spark, sf):
    return rounded(smoothing.HoltWinters(12).fit(monthly_orders(spark, sf)).forecast(STEPS), ["yhat"], 4)


@query("holt_winters_calibrated")
def holt_winters_calibrated(spark, sf):
    return rounded(smoothing.HoltWintersCalibrated(12).fit(monthly_orders(spark, sf)).forecast(STEPS), ["yhat"], 4)


@query("arima_fixed")
def arima_fixed(spark, sf):
    return rounded(arima.ARIMA((1, 1, 1)).fit(monthly_orders(spark, sf)).forecast(STEPS), ["yhat"], 4)


@query("arima_grid")
def arima_grid(spark, sf):
    return rounded(arima.ARIMACalibrated(2, 2, 2).fit(monthly_orders(spark, sf)).forecast(STEPS), ["yhat"], 4)


def _walk_sql(d: int) -> str:
    z = "y" if d == 0 else "y - lag(y) OVER w" if d == 1 else "y - 2 * lag(y) OVER w + lag(y, 2) OVER w"
    constant, spread = ("avg(z)", "var_pop(z)") if d == 0 else ("0.0::DOUBLE", "avg(z * z)")
    return (
        f"SELECT key, {d} AS d, max(rows) AS n, {constant} AS constant, {spread} AS sigma2, count(z) AS used, {2 + (d == 0)} - 1 AS free "
        f"FROM (SELECT key, {z} AS z, count(*) OVER (PARTITION BY key) AS rows FROM {MONTHLY_SQL} q WINDOW w AS (PARTITION BY key ORDER BY t)) x GROUP BY key"
    )


@query(
    "arima_walks",
    f"WITH f AS ({' UNION ALL '.join(map(_walk_sql, range(3)))}) SELECT key, d, n, round(constant, 6) AS constant, round(sigma2, 6) AS sigma2, "
    "round(-0.5 * used * (ln(2 * pi() * sigma2) + 1), 6) AS loglik, round(used * (ln(2 * pi() * sigma2) + 1) + 2 * free, 6) AS aic FROM f",
)
def arima_walks(spark, sf):
    """Orders (0, d, 0), where the best fit is known: the mean, the random walk, the walk of the slope."""
    fits = arima.fit_orders(monthly_orders(spark, sf), [(0, d, 0) for d in range(3)])
    return rounded(fits.select("key", "d", "n", "constant", "sigma2", "loglik", "aic"), ["constant", "sigma2", "loglik", "aic"])


@query("window_ar")
def window_ar(spark, sf):
    return rounded(WindowRegression(12).fit(monthly_orders(spark, sf)).forecast(STEPS), ["yhat"], 4)


@query(
    "forecast_long",
    f"WITH {TIME_SPLIT_SQL}, te AS (SELECT key, t, y, row_number() OVER (PARTITION BY key ORDER BY t) AS step FROM p WHERE split = 'test'), "
    "e AS (SELECT key, arg_max(y, t) AS b, arg_min(y, t) AS a, count(*) AS n FROM p WHERE split = 'train' GROUP BY 1) "
    "SELECT key, t, 'train' AS series, y AS value FROM p WHERE split = 'train' UNION ALL SELECT key, t, 'actual', y FROM te "
    "UNION ALL SELECT key, t, 'naive', b FROM te JOIN e USING (key) UNION ALL SELECT key, t, 'drift', round(b + step * (b - a) / (n - 1), 6) FROM te JOIN e USING (key)",
)
def forecast_long(spark, sf):
    parts = series.time_split(monthly_orders(spark, sf), ["key"], "t")
    train = parts.filter(F.col("split") == "train").drop("split")
    test = positions(parts.filter(F.col("split") == "test"), ["key"], ["t"], "step")
    steps = test.agg(F.max("step")).first()[0]
    guesses = panel.naive_forecast(train, steps).withColumn("model", F.lit("naive")).unionByName(
        panel.drift_forecast(train, steps).withColumn("model", F.lit("drift"))
    )
    predictions = test.join(guesses, ["key", "step"]).select("model", "key", "t", "step", "y", "yhat")
    return rounded(forecast_table(train, predictions), ["value"])
