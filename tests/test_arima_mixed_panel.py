import numpy as np
import pytest

from benchloom.models import arima


def test_one_long_series_does_not_change_the_others(spark):
    rng = np.random.default_rng(5)
    rows = [(k, i, float(v)) for k, n in (("long", 400), ("mid", 60), ("short", 15), ("tiny", 3)) for i, v in enumerate(rng.normal(size=n).cumsum())]
    df = spark.createDataFrame(rows, "key string, t long, y double")
    orders = [(1, 0, 0), (0, 1, 1)]
    exact = {(r.key, r.p, r.d, r.q): r for r in arima.fit_orders(df, orders).collect()}
    mixed = {(r.key, r.p, r.d, r.q): r for r in arima.fit_orders(df, orders, stretch_rows=100).collect()}
    assert set(mixed) == set(exact) and len(mixed) == 8
    for k, r in mixed.items():
        if k[0] == "tiny":
            assert r.error and r.aic is None
        elif k[0] == "long":
            assert r.error is None and r.aic == pytest.approx(exact[k].aic, rel=1e-9) and r.ar + r.ma == pytest.approx(exact[k].ar + exact[k].ma, abs=1e-5)
            assert r.ends == exact[k].ends
        else:
            assert r == exact[k]
    few = df.filter("key IN ('short', 'tiny')")
    lowest = {(r.key, r.p, r.d, r.q): r for r in arima.fit_orders(few, orders, stretch_rows=2).collect()}
    assert all(lowest[k].aic == pytest.approx(exact[k].aic, rel=1e-9) if exact[k].aic else lowest[k].error for k in exact if k[0] in ("short", "tiny"))
