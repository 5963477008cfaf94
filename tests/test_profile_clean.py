import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from benchloom.functions.columns import numeric_columns
from benchloom.operators import clean, distributions as dist, profile, project


@pytest.fixture(scope="module")
def table(spark):
    rows = [(1, "a", 1.0, True, None), (2, "b", 2.0, False, None), (3, None, None, True, None), (3, None, None, True, None), (4, "b", 2.0, None, None)]
    return spark.createDataFrame(rows, "id int, cat string, x double, flag boolean, empty double")


def test_types_and_missing(table):
    got = {r["column"]: r for r in profile.types_and_nulls(table).collect()}
    assert (got["cat"].non_null, got["cat"].nulls, got["cat"].null_pct) == (3, 2, 40.0)
    assert {r["column"] for r in profile.missing_values(table).collect()} == {"cat", "x", "flag", "empty"}
    assert profile.missing_values(table, only_missing=False).count() == 5


def test_kpis_count_null_rows_as_equal(table):
    r = profile.dataset_kpis(table).first()
    assert (r["rows"], r["columns"], r["duplicate_rows"], r["total_nulls"]) == (5, 5, 1, 10)


def test_numeric_columns_and_bool(table):
    assert numeric_columns(table) == ["id", "x", "empty"]
    assert numeric_columns(table, include_bool=True) == ["id", "x", "flag", "empty"]
    assert project.only_numeric(table).columns == ["id", "x", "empty"]


def test_summary_matches_pandas(spark):
    pdf = pd.DataFrame({"a": [1.0, 2, 3, 4, 100], "b": [5.0, np.nan, 7, 9, 9]})
    df = spark.createDataFrame(pdf)
    for small in (100, 0):
        got = profile.summary(df, small_rows=small).toPandas().set_index("column")
        for c in pdf:
            d = pdf[c].describe()
            assert got.loc[c, ["count", "mean", "std", "min", "q1", "median", "q3", "max"]].tolist() == pytest.approx(d.tolist())
    assert {(r["statistic"], r["value"]) for r in profile.statistic(df, "max").collect()} == {("max", 100.0), ("max", 9.0)}
    with pytest.raises(ValueError):
        profile.statistic(df, "mad")
    assert profile.series_statistics(df, "a").first()["std"] == pytest.approx(pdf["a"].std(ddof=0))


def test_value_counts(table):
    assert [tuple(r) for r in profile.value_counts(table, "cat").collect()] == [("b", 2), ("a", 1)]
    assert [tuple(r) for r in profile.value_counts_share(table, "cat").collect()] == [("b", 2, 40.0), ("a", 1, 20.0)]
    assert {tuple(r) for r in profile.unique_values(table, "cat", legacy_null_zero=True).collect()} == {("a", 1), ("b", 2), (None, 0)}


@pytest.mark.parametrize("minor,severity,flag", [(9, "Alto", True), (29, "Moderado", True), (30, "Bajo", False)])
def test_imbalance_limits(spark, minor, severity, flag):
    df = spark.range(100 + minor).select((F.col("id") < minor).cast("int").alias("y"))
    r = profile.check_imbalance(df, "y").first()
    assert (r["severity"], r["is_imbalanced"], r["min_count"], r["max_count"]) == (severity, flag, minor, 100)


def test_correlation_of_constants_and_pairs(spark):
    pdf = pd.DataFrame({"a": [1.0, 2, 3, 4], "b": [2.0, np.nan, 6, 9], "c": [5.0] * 4})
    got = {(r.a, r.b): r.r for r in profile.correlations(spark.createDataFrame(pdf)).collect()}
    assert got[("a", "b")] == pytest.approx(pdf["a"].corr(pdf["b"]))
    assert got[("a", "a")] == pytest.approx(1.0)
    assert got[("a", "c")] is None


def test_histogram_edges_and_nulls(spark):
    pdf = pd.DataFrame({"v": [0.0, 1, 2, 3, 30, 30, None], "k": [4.0] * 7})
    got = dist.histogram(spark.createDataFrame(pdf)).toPandas()
    v = got[got["column"] == "v"].sort_values("bin")
    want, _ = np.histogram(pdf["v"].dropna(), bins=30)
    assert v["n"].tolist() == want.tolist()
    k = got[got["column"] == "k"].sort_values("bin")
    want, edges = np.histogram(pdf["k"], bins=30)
    assert k["n"].tolist() == want.tolist() and k["lo"].iloc[0] == 3.5
    assert (v["density"] * (v["hi"] - v["lo"])).sum() == pytest.approx(1.0)


def test_kde_is_a_density(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"v": rng.normal(size=400), "k": [1.0] * 400})
    got = dist.kde(spark.createDataFrame(pdf)).toPandas().sort_values("i")
    assert set(got["column"]) == {"v"}  # a constant has no curve
    x, y = got["x"].to_numpy(), got["density"].to_numpy()
    bw = pdf["v"].std() * 400 ** (-0.2)
    want = np.exp(-0.5 * ((x[:, None] - pdf["v"].to_numpy()) / bw) ** 2).sum(axis=1) / (400 * bw * np.sqrt(2 * np.pi))
    assert y == pytest.approx(want)
    clipped = dist.kde(spark.createDataFrame(pdf), ["v"], clip=True).toPandas()
    assert clipped["x"].min() == pytest.approx(pdf["v"].min())


def test_box_plot_and_outliers(spark):
    pdf = pd.DataFrame({"id": range(8), "v": [1.0, 2, 3, 4, 5, 6, 50, -40]})
    df = spark.createDataFrame(pdf)
    r = dist.box_plot(df, ["v"]).first()
    assert (r["whisker_lo"], r["whisker_hi"], r["n_outliers"]) == (1.0, 6.0, 2)
    assert {(x.row_id, x.value) for x in dist.outliers(df, "id").collect()} == {(6, 50.0), (7, -40.0)}


def test_pair_scatter(spark):
    df = spark.range(600).withColumn("a", F.col("id") * 2).withColumn("b", F.col("id") * 3)
    got = dist.pair_scatter(df, "id")
    assert got.count() == 500 and got.select("a", "b").distinct().count() == 1
    assert dist.pair_scatter(df, "id", rows=None).count() == 600
    with pytest.raises(ValueError):
        dist.pair_scatter(df.select("id", "a"), "id")


def test_projection_helpers(table, spark):
    assert project.drop_columns(table, ["x", "nope"]).columns == ["id", "cat", "flag", "empty"]
    with pytest.raises(KeyError):
        project.drop_columns(table, ["nope"], strict=True)
    with pytest.raises(ValueError):
        project.drop_columns(table, ["x"], target="x")
    assert project.rename_columns(table, {"x": "y", "nope": "z"}).columns == ["id", "cat", "y", "flag", "empty"]
    assert project.hide_internal(table.withColumn("_p", F.lit(1))).columns == table.columns
    board = spark.createDataFrame([("m", 0.5), ("n", None)], "model string, auc double")
    ok, bad = project.split_by_metric(board, "auc")
    assert (ok.first()["model"], bad.first()["model"]) == ("m", "n")
    assert project.rows_of_model(board, "n").count() == 1
    texts = spark.createDataFrame([("1", "1"), ("2.5", "x"), (None, None)], "a string, b string")
    assert dict(project.display_types(texts).dtypes) == {"a": "double", "b": "string"}


def test_fills(table):
    assert [r.x for r in clean.fill_mean(table, ["x"]).orderBy("id").collect()] == pytest.approx([1.0, 2.0, 5 / 3, 5 / 3, 2.0])
    for small in (100, 0):
        assert [r.x for r in clean.fill_median(table, ["x"], small).orderBy("id").collect()] == [1.0, 2.0, 2.0, 2.0, 2.0]
    mode = clean.fill_mode(table).orderBy("id").collect()
    assert [r.cat for r in mode] == ["a", "b", "b", "b", "b"]
    assert [r.empty for r in mode] == [0.0] * 5
    zero = clean.fill_zero(table).orderBy("id").collect()
    assert zero[2].cat == "0" and zero[2].x == 0.0 and zero[4].flag is False


def test_mode_takes_the_smallest_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert {r.c for r in clean.fill_mode(df).collect()} == {"a", "b"}
    assert clean.fill_mode(df).filter("c = 'a'").count() == 3


def test_duplicates_and_nulls(table):
    assert clean.drop_duplicates(table).count() == 4
    assert tuple(clean.duplicates_report(table).first()) == (5, 4, 1)
    some = table.drop("empty")
    assert tuple(clean.nulls_report(some).first()) == (5, 3, 2)
    assert clean.drop_nulls(some).count() == 2


def test_one_hot(spark):
    df = spark.createDataFrame([("b", 1.9), ("a", 2.1), (None, 3.0)], "c string, v double")
    got = clean.one_hot(df)
    assert got.columns == ["v", "c_b"] and [tuple(r) for r in got.orderBy("v").collect()] == [(1, 1), (2, 0), (3, 0)]
    assert clean.one_hot(df, cast_all_int=False).first()["v"] == 1.9
    numbers = df.select("v")
    assert clean.one_hot(numbers).first()["v"] == 1.9 and clean.one_hot(numbers, always_cast=True).first()["v"] == 1
    with pytest.raises(ValueError):
        clean.one_hot(df, limit=1)
