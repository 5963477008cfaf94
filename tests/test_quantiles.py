import numpy as np
import pandas as pd
import pytest

from benchloom.operators import quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("small_rows", [10**9, 0])
@pytest.mark.parametrize("finish", [10_000, 5])
def test_exact_quantiles(spark, monkeypatch, small_rows, finish):
    monkeypatch.setattr(quantiles, "FINISH_ROWS", finish)
    rng = np.random.default_rng(1)
    n = 900
    pdf = pd.DataFrame({
        "normal": rng.normal(size=n),
        "hot": np.where(np.arange(n) < n // 3, 7.5, rng.exponential(size=n) * 1e6),
        "few": rng.integers(0, 4, n).astype(float),
        "same": 3.0,
        "none": [None] * n,
    })
    pdf["none"] = pdf["none"].astype(float)
    pdf.loc[::7, "normal"] = np.nan
    got = quantiles.exact_quantiles(spark.createDataFrame(pdf), list(pdf.columns), PROBS, small_rows)
    for c in ("normal", "hot", "few", "same"):
        assert got[c] == pytest.approx(list(pdf[c].quantile(PROBS)), rel=1e-12)
    assert got["none"] == [None] * len(PROBS)
