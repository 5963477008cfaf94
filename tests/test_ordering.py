import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from benchloom.functions.hashing import uniform
from benchloom.operators import ordering


def md5(seed, purpose, i):
    return hashlib.md5(f"{seed}|{purpose}|{i}".encode()).hexdigest()


def test_uniform_is_reproducible(spark):
    got = [r.u for r in spark.range(5).orderBy("id").select(uniform(42, "x", F.col("id")).alias("u")).collect()]
    assert got == [int(md5(42, "x", i)[:8], 16) / 2**32 for i in range(5)]


def test_hash_rank_per_group(spark):
    df = spark.range(500).withColumn("g", F.when(F.col("id") < 400, "hot").when(F.col("id") < 490, "b"))
    got = ordering.hash_rank(df, ["id"], 1, "p", by=["g"]).toPandas()
    for _, part in got.groupby(got["g"].fillna("none")):
        want = sorted(part["id"], key=lambda i: (md5(1, "p", i), i))
        assert list(part.sort_values("rank")["id"]) == want
        assert sorted(part["rank"]) == list(range(1, len(part) + 1))


@pytest.mark.parametrize("ranked_rows", [100_000, 3])
def test_mark_smallest(spark, monkeypatch, ranked_rows):
    monkeypatch.setattr(ordering, "RANKED_ROWS", ranked_rows)
    df = spark.range(300).withColumn("g", (F.col("id") % 3 == 0).cast("int"))
    got = ordering.mark_smallest(df, ["id"], 7, "q", {0: 50, 1: 100}, {0: 200, 1: 100}, by="g").toPandas()
    zeros = sorted(got[got.g == 0]["id"], key=lambda i: (md5(7, "q", i), i))
    assert set(got[got.selected & (got.g == 0)]["id"]) == set(zeros[:50])
    assert got[got.g == 1]["selected"].all()
    plain = ordering.mark_smallest(df, ["id"], 7, "q", 17, 300).toPandas()
    assert set(plain[plain.selected]["id"]) == set(sorted(range(300), key=lambda i: (md5(7, "q", i), i))[:17])
    assert not ordering.mark_smallest(df, ["id"], 7, "q", 0, 300).filter("selected").count()
    assert ordering.mark_smallest(df, ["id"], 7, "q", 300, 300).filter("selected").count() == 300


def test_mark_smallest_many_groups(spark, monkeypatch):
    monkeypatch.setattr(ordering, "LITERAL_GROUPS", 2)
    df = spark.range(90).withColumn("g", F.col("id") % 5)
    got = ordering.mark_smallest(df, ["id"], 7, "q", {g: g * 5 for g in range(5)}, {g: 18 for g in range(5)}, by="g").toPandas()
    assert got.groupby("g")["selected"].sum().to_dict() == {0: 0, 1: 5, 2: 10, 3: 15, 4: 18}


def test_ordered_scan_in_chunks_equals_plain_window(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"k": ["hot"] * 70 + list("ab") * 15, "t": rng.permutation(100), "v": rng.integers(0, 9, 100)})
    df = spark.createDataFrame(pdf)
    kwargs = dict(keys=["k"], order=["t"], sums={"s": F.col("v")}, lead=["v"])
    whole = ordering.ordered_scan(df, **kwargs).toPandas().sort_values(["k", "t"]).reset_index(drop=True)
    cut = ordering.ordered_scan(df, rows_per_chunk=7, **kwargs).toPandas().sort_values(["k", "t"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(whole, cut[whole.columns])
    want = pdf.sort_values(["k", "t"]).reset_index(drop=True)
    assert list(whole["s"]) == list(want.groupby("k")["v"].cumsum())
    assert list(whole["next_v"].fillna(-1)) == list(want.groupby("k")["v"].shift(-1).fillna(-1))


def test_chunks_are_bounded(spark):
    chunked, n = ordering.order_chunks(spark.range(1000), ["id"], rows_per_chunk=100)
    sizes = chunked.groupBy("_chunk").count().toPandas()["count"]
    assert n == 10 and sizes.max() < 300
