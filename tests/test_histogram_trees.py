"""Trees on histograms against plain growth on the rows themselves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from benchloom.models import registry
from benchloom.models.histogram_trees import HistogramBoosting, HistogramTree, _drawn, find_cuts


def table(spark, x, y, ids=None):
    rows = [(int(i), None if b is None else float(b), [float(v) for v in a]) for i, a, b in zip(ids if ids is not None else range(len(x)), x, y, strict=True)]
    return spark.createDataFrame(rows, "row_id long, label double, features array<double>").repartition(3)


def plain_tree(x, g, h, lam, least, depth, min_split):
    """Values per row by exhaustive search over all cuts."""
    out = np.zeros(len(g))

    def grow(rows, left):
        G, H = g[rows].sum(), h[rows].sum()
        best = None
        if left != 0 and len(rows) >= min_split:
            for j in range(x.shape[1]):
                for cut in np.unique(x[rows, j])[:-1]:
                    low = x[rows, j] <= cut
                    a, b = rows[low], rows[~low]
                    if h[a].sum() < least or h[b].sum() < least:
                        continue
                    gain = g[a].sum() ** 2 / (h[a].sum() + lam) + g[b].sum() ** 2 / (h[b].sum() + lam) - G**2 / (H + lam)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, a, b)
        if best is None:
            out[rows] = -G / (H + lam)
        else:
            grow(best[1], left - 1)
            grow(best[2], left - 1)

    grow(np.arange(len(g)), depth)
    return out


def data(n=220, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 9, n), rng.normal(size=n).round(2), rng.integers(0, 2, n)]).astype(float)
    y = x[:, 0] * 2 + np.sin(3 * x[:, 1]) * 4 + x[:, 2] * x[:, 0] + rng.normal(size=n) * 0.3
    return x, y


@pytest.mark.parametrize("classify", [True, False])
def test_boosting_equals_plain_growth(spark, classify):
    x, y = data()
    y = (y > np.median(y)).astype(float) if classify else y
    model = HistogramBoosting(classify, 12, 0.3, 3).fit(table(spark, x, y))
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())) if classify else y.mean())
    for _ in range(12):
        p = 1 / (1 + np.exp(-margin)) if classify else margin
        g, h = p - y, p * (1 - p) if classify else np.ones(len(y))
        margin = margin + 0.3 * plain_tree(x, g, h, 1.0, 1.0, 3, 2)
    assert model.raw(x) == pytest.approx(margin, abs=1e-8)
    out = {r.row_id: r for r in model.transform(table(spark, x, y)).collect()}
    got = np.array([out[i].prob if classify else out[i].prediction for i in range(len(y))])
    assert got == pytest.approx(1 / (1 + np.exp(-margin)) if classify else margin, abs=1e-8)
    assert all((r.prob is None) != classify for r in out.values())


@pytest.mark.parametrize("min_split", [2, 25])
def test_trees_follow_the_split_rule_without_a_depth_bound(spark, min_split):
    x, y = data(120)
    tree = registry.decision_tree_regressor(min_samples_split=min_split)
    assert isinstance(tree, HistogramTree)
    got = tree.fit(table(spark, x, y)).raw(x)
    assert got == pytest.approx(y.mean() + plain_tree(x, y.mean() - y, np.ones(len(y)), 0.0, 0.0, -1, min_split), abs=1e-8)


def test_trees_grow_deeper_than_thirty_levels(spark):
    x = np.arange(36.0)[:, None]
    steps = 2.0 ** np.arange(36)  # every split cuts off the largest value: depth 35
    model = registry.decision_tree_regressor().fit(table(spark, x, steps))
    assert model.raw(x) == pytest.approx(steps, abs=1e-3) and len(model.trees[0].feature) == 71


def test_classification_trees(spark):
    x, y = data(150)
    y = (y > np.median(y)).astype(float)
    out = registry.decision_tree_classifier().fit(table(spark, x, y)).transform(table(spark, x, y)).collect()
    assert all(r.prediction == r.label and r.prob in (0.0, 1.0) for r in out)
    three = registry.decision_tree_classifier().fit(table(spark, x, np.arange(150) % 3)).transform(table(spark, x[:9], np.arange(9) % 3))
    assert three.filter("prediction > 1").count() > 0


def test_missing_values_many_values_and_nulls(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=3000), np.full(3000, 4.0)])
    y = (x[:, 0] > 0.3).astype(float)
    x[:100, 0] = np.nan
    y[:100] = 1.0
    df = table(spark, x, [None if k % 50 == 0 else v for k, v in enumerate(y)])
    cuts = find_cuts(df, 2)
    assert 200 < len(cuts[0]) <= 255 and len(cuts[1]) == 0
    model = HistogramBoosting(True, 5, 1.0, 3).fit(df)
    out = model.transform(df).filter("label is not null and prediction <> label")
    assert out.count() < 40  # quantiles come within a hair of the step
    assert model.raw(np.array([[np.nan, 4.0]]))[0] > 0
    with pytest.raises(ValueError):
        HistogramBoosting(True).fit(df.limit(0))
    with pytest.raises(ValueError):
        HistogramBoosting(True).fit(df.withColumn("label", F.lit(2.0)))
    same = HistogramBoosting(True, 2).fit(df.withColumn("label", F.lit(1.0))).transform(df.limit(3)).collect()
    assert all(r.prediction == 1.0 for r in same)


def test_subsamples_are_drawn_by_row_and_tree(spark):
    ids = np.arange(20000)
    a, b = _drawn(ids, 0, 42), _drawn(ids, 1, 42)
    assert abs(a.mean() - 0.5) < 0.01 and abs(np.corrcoef(a, b)[0, 1]) < 0.03 and (a == _drawn(ids, 0, 42)).all()
    x, y = data()
    one, other = (HistogramBoosting(False, 4, 0.3, 2, subsample=0.5).fit(table(spark, x, y)).raw(x) for _ in range(2))
    whole = HistogramBoosting(False, 4, 0.3, 2).fit(table(spark, x, y)).raw(x)
    assert one == pytest.approx(other) and np.abs(one - whole).max() > 1e-3
