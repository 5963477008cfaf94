"""Registry of series models."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from benchloom.models.arima import ARIMA, ARIMACalibrated
from benchloom.models.registry import _make
from benchloom.models.smoothing import HoltWinters, HoltWintersCalibrated
from benchloom.models.window_ar import WindowRegression


def _holt_winters(trend="add", seasonal="add", seasonal_periods=12):
    return HoltWinters(seasonal_periods, trend, seasonal)


def _holt_winters_calibrated(seasonal_periods=12):
    return HoltWintersCalibrated(seasonal_periods)


def _arima(p=1, d=1, q=1):
    return ARIMA((p, d, q))


def _arima_calibrated(max_p=2, max_d=2, max_q=2):
    return ARIMACalibrated(max_p, max_d, max_q)


def _window(window_size=None, seasonal_periods=12, scale=False):
    return WindowRegression(window_size or min(12, seasonal_periods), scale=scale)


# The names under which series models are listed and asked for.  "LSTM" is asked for by name
# and answered by the windowed regression, which plays its role on Spark.
FORECASTERS = {
    "Holt-Winters": _holt_winters,
    "Holt-Winters Calibrado": _holt_winters_calibrated,
    "ARIMA(1,1,1)": _arima,
    "ARIMA Calibrado": _arima_calibrated,
    "LSTM": _window,
}


def get_timeseries_models(seasonal_periods: int = 12) -> dict:
    return _make(FORECASTERS, FORECASTERS, None, seasonal_periods=seasonal_periods)


def build_timeseries_models(names: Iterable[str], params: Mapping[str, Mapping] | None = None, seasonal_periods: int = 12) -> dict:
    return _make(FORECASTERS, names, params, seasonal_periods=seasonal_periods)
