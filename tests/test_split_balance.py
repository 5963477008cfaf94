import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from benchloom.operators import balance, encode, scale, split


def labelled(spark, sizes):
    rows, i = [], 0
    for label, n in sizes.items():
        for _ in range(n):
            rows.append((i, label))
            i += 1
    return spark.createDataFrame(rows, "row_id bigint, label int")


@pytest.mark.parametrize("sizes", [{0: 70, 1: 30}, {0: 97, 1: 3}, {0: 5, 1: 5, 2: 7}])
def test_stratified_split(spark, sizes):
    df = labelled(spark, sizes)
    train, test = split.split_data(df, "row_id", "label")
    total = sum(sizes.values())
    assert test.count() == math.ceil(total * 0.3) and train.count() + test.count() == total
    assert not set(r.row_id for r in train.collect()) & set(r.row_id for r in test.collect())
    got = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    for c, n in sizes.items():
        assert abs(got[c] - n * train.count() / total) < 1


def test_split_falls_back_without_enough_rows(spark):
    flagged = split.split_flag(labelled(spark, {0: 9, 1: 1}), "row_id", "label")
    assert flagged.filter("split = 'test'").count() == 3
    text = split.split_flag(labelled(spark, {0: 6, 1: 4}).withColumn("k", F.col("row_id").cast("string")), ["k"], "label")
    assert text.filter("split = 'train'").count() == 7


def test_folds(spark):
    df = labelled(spark, {0: 53, 1: 18})
    plain = split.kfold_assign(df, "row_id", 5).groupBy("fold").count().toPandas()
    assert sorted(plain["count"]) == [14, 14, 14, 14, 15]
    strat = split.stratified_fold_assign(df, "row_id", "label", 5).groupBy("fold", "label").count().toPandas()
    for _, part in strat.groupby("label"):
        assert part["count"].max() - part["count"].min() <= 1
    totals = strat.groupby("fold")["count"].sum()
    assert totals.max() - totals.min() <= 1
    with pytest.raises(ValueError):
        split.stratified_fold_assign(df, "row_id", "label", 60)


def test_quota_remainders():
    assert split.class_quotas({0: 5, 1: 5}, 7) == {0: 4, 1: 3}
    assert sum(split.class_quotas({0: 33, 1: 33, 2: 34}, 70).values()) == 70


def test_encoding(spark):
    train = spark.createDataFrame([("b", True, 1), ("a", False, 2), (None, True, 3)], "c string, f boolean, n int")
    test = spark.createDataFrame([("z", True, 9), ("nan", None, 8)], "c string, f boolean, n int")
    a, b = encode.encode_train_test(train, test)
    assert [tuple(r) for r in a.orderBy("n").collect()] == [(1.0, 1.0, 1), (0.0, 0.0, 2), (2.0, 1.0, 3)]
    assert [tuple(r) for r in b.orderBy("n").collect()] == [(2.0, -1.0, 8), (-1.0, 1.0, 9)]
    many = spark.range(500).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("c"), "id")
    want = {f"v{i}": n for n, i in enumerate(sorted(range(500), key=lambda i: f"v{i}"))}
    for per_chunk in (1000, 40):
        coded = encode.CategoryEncoder(["c"], rows_per_chunk=per_chunk).fit(many).transform(many.withColumn("t", F.col("c")))
        assert {r.t: r.c for r in coded.collect()} == want
    y_tr, y_te = encode.encode_target(train, test, "n")
    assert dict(y_tr.dtypes)["n"] == "double" and y_te.count() == 2


def test_scaling(spark):
    train = spark.createDataFrame(pd.DataFrame({"a": [1.0, 2, 3, 4], "k": [7.0] * 4}))
    test = spark.createDataFrame(pd.DataFrame({"a": [10.0], "k": [8.0]}))
    a, b, scaler = scale.scale_features(train, test)
    x = np.array([1.0, 2, 3, 4])
    assert sorted(r.a for r in a.collect()) == pytest.approx(list((x - x.mean()) / x.std()))
    assert b.first()["k"] == 1.0 and scaler.divisor["k"] == 1.0
    m, n, _ = scale.scale_features(train, test, kind="minmax")
    assert {r.k for r in m.collect()} == {0.0} and n.first()["a"] == 3.0
    with pytest.raises(ValueError):
        scale.fit_scaler(train, kind="robust")


def vectors(spark, sizes, dim=3, seed=0):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for label, n in sizes.items():
        for _ in range(n):
            rows.append((i, label, [float(v) for v in rng.normal(size=dim) + label]))
            i += 1
    return spark.createDataFrame(rows, "row_id bigint, label int, features array<double>")


def sizes_of(df):
    return {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}


def test_smote_fills_up_every_class(spark):
    df = vectors(spark, {0: 40, 1: 6, 2: 12})
    out = balance.smote(df).cache()
    assert sizes_of(out) == {0: 40, 1: 40, 2: 40}
    assert out.select("row_id").distinct().count() == 120
    base = {r.row_id: np.array(r.features) for r in df.filter("label = 1").collect()}
    for r in out.filter("label = 1 AND row_id < 0").collect():
        p = np.array(r.features)
        # on a segment between two rows of the class
        gaps = [np.linalg.norm(p - a) + np.linalg.norm(p - b) - np.linalg.norm(a - b) for i, a in base.items() for j, b in base.items() if i != j]
        assert min(gaps) < 1e-9


def test_smote_limits(spark):
    lone = vectors(spark, {0: 5, 1: 1})
    assert sizes_of(balance.smote(lone)) == {0: 5, 1: 1}
    tiny = vectors(spark, {0: 9, 1: 2})
    assert sizes_of(balance.smote(tiny)) == {0: 9, 1: 9}  # k is clamped to 1
    assert sizes_of(balance.smote(tiny, strategy=0.5)) == {0: 9, 1: 4}
    with pytest.raises(ValueError):
        balance.smote(vectors(spark, {0: 9, 1: 6}), strategy=0.5)
    with pytest.raises(ValueError):
        balance.smote_plan({0: 3, 1: 2, 2: 2}, 0.9)


def test_undersample_and_dispatch(spark):
    df = vectors(spark, {0: 20, 1: 8})
    assert sizes_of(balance.undersample(df)) == {0: 8, 1: 8}
    assert sizes_of(balance.undersample(df, strategy=0.5)) == {0: 16, 1: 8}
    with pytest.raises(ValueError):
        balance.undersample(df, strategy=0.3)
    assert sizes_of(balance.apply_balancing(df, "UNDER")) == {0: 8, 1: 8}
    assert sizes_of(balance.apply_balancing(df, "combined")) == {0: 10, 1: 10}
    assert balance.apply_balancing(df, "other") is df
