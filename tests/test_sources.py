import pytest

from benchloom.sources import builtin, tables


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
def test_separators(spark, tmp_path, sep):
    path = write(tmp_path, "a.csv", f" a {sep}b\n1{sep}2.5\n3{sep}x\n")
    df = tables.read_csv(spark, path, sep)
    assert df.columns == ["a", "b"] and dict(df.dtypes)["a"] == "int" and df.count() == 2


def test_decimal_comma(spark, tmp_path):
    path = write(tmp_path, "a.csv", "a;b;c\n1,5;x,1;2\n-3,25;y;\n")
    df = tables.read_csv(spark, path, ";", decimal=",")
    assert dict(df.dtypes) == {"a": "double", "b": "string", "c": "double"}
    assert [tuple(r) for r in df.collect()] == [(1.5, "x,1", 2.0), (-3.25, "y", None)]


def test_index_column_and_presets(spark, tmp_path):
    one = write(tmp_path, "one.csv", "i,a\nr1,1\nr2,2\n")
    assert tables.read_csv(spark, one, index_column="keep").columns == ["row_id", "a"]
    assert tables.read_csv_preset(spark, one, 1).columns == ["a"]
    two = write(tmp_path, "two.csv", "a;b\n1;2\n")
    assert tables.read_csv_preset(spark, two, 2).columns == ["a", "b"]
    with pytest.raises(ValueError):
        tables.read_csv_preset(spark, two, 3)
    with pytest.raises(ValueError):
        tables.read_csv(spark, two, "#")


def test_json_target_and_sink(spark, tmp_path):
    df = tables.read_json(spark, write(tmp_path, "a.json", '[{"x": 1, "y": 2.0}, {"x": 3, "y": null}]'))
    assert df.count() == 2 and tables.split_target(df) == (["x"], "y")
    assert tables.split_target(df, "x") == (["y"], "x")
    with pytest.raises(KeyError):
        tables.split_target(df, "z")
    out = str(tmp_path / "out")
    tables.write_result(df, out)
    assert tables.read_parquet(spark, out).count() == 2


def test_builtin_tables(spark):
    a = builtin.airline_passengers(spark)
    assert a.count() == 144 and a.agg({"y": "sum"}).first()[0] == 40363.0
    f = builtin.simulated_fraud(spark, 1000)
    assert len(f.columns) == 22 and f.filter("fraud = 1").count() == 20
    means = f.groupBy("fraud").agg({"feature_3": "avg"}).collect()
    means = {r[0]: r[1] for r in means}
    assert means[1] - means[0] == pytest.approx(2.5, abs=0.8)
