"""Encoding, scaling, splitting, folds, series preparation, balancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from benchloom.operators import balance, encode, scale, series, split
from benchloom.queries.catalog import (
    MONTHLY_SQL, load, monthly_orders, query, rounded, sql_plain_split, sql_split,
)
from benchloom.sources.builtin import synthetic_imbalanced


@query(
    "label_encode",
    "SELECT p_partkey, (dense_rank() OVER (ORDER BY p_type) - 1)::DOUBLE AS p_type, (dense_rank() OVER (ORDER BY p_brand) - 1)::DOUBLE AS p_brand, p_size FROM part",
)
def label_encode(spark, sf):
    coded, _ = encode.encode_categorical(load(spark, sf, "part").select("p_partkey", "p_type", "p_brand", "p_size"))
    return coded


@query(
    "encode_unseen",
    "WITH train AS (SELECT * FROM orders WHERE year(o_orderdate) < 1999), d AS (SELECT v, (row_number() OVER (ORDER BY v) - 1)::DOUBLE AS code FROM "
    "(SELECT DISTINCT year(o_orderdate)::VARCHAR AS v FROM train) x) "
    "SELECT o_orderkey, coalesce(code, -1)::DOUBLE AS order_year FROM orders LEFT JOIN d ON year(o_orderdate)::VARCHAR = d.v",
)
def encode_unseen(spark, sf):
    # the years after 1998 do not occur in the training part
    orders = load(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").cast("string").alias("order_year"))
    encoder = encode.CategoryEncoder().fit(orders.filter(F.col("order_year") < "1999"))
    return encoder.transform(orders)


@query(
    "encode_target",
    "WITH train AS (SELECT * FROM orders WHERE year(o_orderdate) < 1999), d AS (SELECT v, (row_number() OVER (ORDER BY v) - 1)::DOUBLE AS code FROM "
    "(SELECT DISTINCT o_orderpriority AS v FROM train) x) "
    "SELECT o_orderkey, coalesce(code, -1)::DOUBLE AS o_orderpriority FROM orders LEFT JOIN d ON o_orderpriority = d.v WHERE NOT year(o_orderdate) < 1999",
)
def encode_target(spark, sf):
    orders = load(spark, sf, "orders")
    early = F.year("o_orderdate") < 1999
    cols = ["o_orderkey", "o_orderpriority"]
    _, test = encode.encode_target(orders.filter(early).select(*cols), orders.filter(~early).select(*cols), "o_orderpriority")
    return test


SCALE_COLUMNS = ["l_quantity", "l_extendedprice"]


def _scale_sql(offset: str, divisor: str) -> str:
    cols = ", ".join(
        f"round((x.{c} - (SELECT {offset.format(c=c)} FROM tr)) / coalesce(nullif((SELECT {divisor.format(c=c)} FROM tr), 0), 1), 6) AS {c}" for c in SCALE_COLUMNS
    )
    return f"WITH tr AS (SELECT * FROM lineitem WHERE l_returnflag <> 'R') SELECT {cols}, l_returnflag FROM lineitem x"


def _scaled(spark, sf, kind):
    # statistics from the lines that were not returned, applied to all
    lines = load(spark, sf, "lineitem").select(*SCALE_COLUMNS, "l_returnflag")
    scaler = scale.fit_scaler(lines.filter(F.col("l_returnflag") != "R"), SCALE_COLUMNS, kind)
    return rounded(scaler.transform(lines), SCALE_COLUMNS)


@query("standard_scale", _scale_sql("avg({c})", "stddev_pop({c})"))
def standard_scale(spark, sf):
    return _scaled(spark, sf, "standard")


@query("minmax_scale", _scale_sql("min({c})", "max({c}) - min({c})"))
def minmax_scale(spark, sf):
    return _scaled(spark, sf, "minmax")


@query("stratified_split", f"WITH {sql_split('orders', 'o_orderkey', 'o_orderstatus')} SELECT o_orderkey, o_orderstatus, split FROM parts")
def stratified_split(spark, sf):
    return split.split_flag(load(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus")


@query("plain_split", f"WITH {sql_plain_split('events', 'event_id')} SELECT event_id, split FROM parts")
def plain_split(spark, sf):
    return split.split_flag(load(spark, sf, "events").select("event_id"), "event_id")


@query(
    "kfold_assign",
    "SELECT event_id, ((row_number() OVER (ORDER BY md5('42|fold|' || event_id), event_id) - 1) % 5)::INTEGER AS fold FROM events",
)
def kfold_assign(spark, sf):
    return split.kfold_assign(load(spark, sf, "events").select("event_id"), "event_id")


@query(
    "stratified_folds",
    "SELECT o_orderkey, o_orderstatus, ((row_number() OVER (ORDER BY o_orderstatus, md5('42|fold|' || o_orderkey), o_orderkey) - 1) % 5)::INTEGER AS fold FROM orders",
)
def stratified_folds(spark, sf):
    return split.stratified_fold_assign(load(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus")


TIME_SPLIT_SQL = (
    f"p AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY key ORDER BY t) <= floor(count(*) OVER (PARTITION BY key) * 0.8::DOUBLE) "
    f"THEN 'train' ELSE 'test' END AS split FROM {MONTHLY_SQL} s)"
)


@query("time_split", f"WITH {TIME_SPLIT_SQL} SELECT key, t, y, split FROM p")
def time_split(spark, sf):
    return series.time_split(monthly_orders(spark, sf), ["key"], "t")


def _normalized(spark, sf):
    parts = series.time_split(monthly_orders(spark, sf), ["key"], "t")
    ranges = series.series_range(parts.filter(F.col("split") == "train"), ["key"], "y")
    return series.normalize_series(parts, ["key"], "y", ranges), ranges


@query(
    "normalize_series",
    f"WITH {TIME_SPLIT_SQL}, r AS (SELECT key, min(y) AS a, max(y) AS b FROM p WHERE split = 'train' GROUP BY 1) "
    "SELECT p.key, t, y, split, round((y - a) / coalesce(nullif(b - a, 0), 1), 6) AS y_norm FROM p JOIN r USING (key)",
)
def normalize_series(spark, sf):
    return rounded(_normalized(spark, sf)[0], ["y_norm"])


@query("denormalize_series", f"SELECT key, t, round(y, 6) AS y FROM {MONTHLY_SQL} s")
def denormalize_series(spark, sf):
    norm, ranges = _normalized(spark, sf)
    back = series.denormalize_series(norm.select("key", "t", "y_norm"), ["key"], "y_norm", ranges)
    return rounded(back.select("key", "t", "y"), ["y"])


def _lag_sql(w: int) -> str:
    return (
        f"SELECT key, t, list_aggregate(win, 'string_agg', ',') AS win, target FROM (SELECT key, t, y AS target, "
        f"list(y::BIGINT) OVER (PARTITION BY key ORDER BY t ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) AS win FROM {MONTHLY_SQL} s) x WHERE len(win) = {w}"
    )


@query("lag_windows", _lag_sql(12))
def lag_windows(spark, sf):
    out = series.lag_windows(monthly_orders(spark, sf), ["key"], "t", "y", 12)
    text = F.array_join(F.transform("window", lambda v: v.cast("bigint").cast("string")), ",")
    return out.select("key", "t", text.alias("win"), "target")


@query("lag_windows_chunked", _lag_sql(12))
def lag_windows_chunked(spark, sf):
    # the same windows with series cut into stretches, as for series that no task may hold
    out = series.lag_windows(monthly_orders(spark, sf), ["key"], "t", "y", 12, rows_per_chunk=50)
    text = F.array_join(F.transform("window", lambda v: v.cast("bigint").cast("string")), ",")
    return out.select("key", "t", text.alias("win"), "target")


@query(
    "undersample",
    "WITH c AS (SELECT toxic, count(*) AS n FROM labels GROUP BY 1) SELECT doc_id, toxic FROM (SELECT doc_id, toxic, "
    "row_number() OVER (PARTITION BY toxic ORDER BY md5('42|under|' || doc_id), doc_id) AS r FROM labels) x WHERE r <= (SELECT min(n) FROM c)",
)
def undersample(spark, sf):
    return balance.undersample(load(spark, sf, "labels").select("doc_id", "toxic"), "toxic", row_id="doc_id")


def imbalanced_embeddings(spark, sf):
    """Class 0 against all others: row_id, label, features."""
    return load(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row_id"), (F.col("label") == 0).cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("features")
    )


IMBALANCED_SQL = "(SELECT vec_id AS row_id, CASE WHEN label = 0 THEN 1 ELSE 0 END AS label, embedding::DOUBLE[] AS features FROM embeddings)"


def _u(purpose: str) -> str:
    return f"(('0x' || substr(md5('42|{purpose}|1|' || i), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def _smote_ctes(target: str) -> str:
    """New rows for class 1, which is the smaller one; ``target`` is the number of rows it should have."""
    return f"""
e AS (SELECT * FROM {IMBALANCED_SQL} s),
z AS (SELECT count(*) FILTER (label = 1) AS n1, count(*) FILTER (label = 0) AS n0 FROM e),
k AS (SELECT least(5, least(n0, n1) - 1) AS k, n1, n0, ({target})::BIGINT - n1 AS n_new FROM z),
m AS (SELECT row_id, features, row_number() OVER (ORDER BY md5('42|smote|' || row_id), row_id) AS pos FROM e WHERE label = 1),
nn AS (SELECT * FROM (SELECT a.row_id, b.features AS other, row_number() OVER (PARTITION BY a.row_id ORDER BY list_distance(a.features, b.features), b.row_id) AS rank
       FROM m a JOIN m b ON a.row_id <> b.row_id) x WHERE rank <= (SELECT k FROM k)),
dr AS (SELECT i, floor({_u('row')} * n1)::BIGINT + 1 AS pos, floor({_u('nn')} * k)::BIGINT + 1 AS rank, {_u('lam')} AS lam
       FROM k, LATERAL (SELECT unnest(range(1, n_new + 1)) AS i) r),
fresh AS (SELECT -i AS row_id, 1 AS label, [v[1] + lam * (v[2] - v[1]) for v in list_zip(m.features, nn.other)] AS features
          FROM dr JOIN m USING (pos) JOIN nn ON nn.row_id = m.row_id AND nn.rank = dr.rank),
grown AS (SELECT row_id, label, features FROM e UNION ALL SELECT row_id, label, features FROM fresh)"""


SMOTE_OUT = "row_id, label, round(features[1], 6) AS f1, round(features[2], 6) AS f2, round(features[64], 6) AS f64, round(list_sum(features), 5) AS total"


def _vector_view(df):
    total = F.aggregate("features", F.lit(0.0), lambda a, v: a + v)
    return df.select(
        "row_id", "label", F.round(F.col("features")[0], 6).alias("f1"), F.round(F.col("features")[1], 6).alias("f2"),
        F.round(F.col("features")[63], 6).alias("f64"), F.round(total, 5).alias("total"),
    )


@query("smote", f"WITH {_smote_ctes('n0')} SELECT {SMOTE_OUT} FROM grown")
def smote(spark, sf):
    return _vector_view(balance.smote(imbalanced_embeddings(spark, sf)))


@query(
    "combined_balance",
    f"WITH {_smote_ctes('floor(0.5::DOUBLE * n0 - n1) + n1')}, c AS (SELECT label, count(*) AS n FROM grown GROUP BY 1) "
    f"SELECT {SMOTE_OUT} FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42|under|' || row_id), row_id) AS r FROM grown) g "
    "WHERE r <= (SELECT min(n) FROM c)",
)
def combined_balance(spark, sf):
    return _vector_view(balance.apply_balancing(imbalanced_embeddings(spark, sf), "combined"))


def _normal_sql(j: int) -> str:
    u = lambda p: f"(('0x' || substr(md5('42|f{j}{p}|' || row_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"
    return f"sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {u('_r')})) * cos(6.283185307179586::DOUBLE * {u('_a')})"


@query(
    "synthetic_fraud",
    "WITH b AS (SELECT event_id AS row_id, CASE WHEN row_number() OVER (ORDER BY md5('42|fraud|' || event_id), event_id) <= "
    "ceil(0.02::DOUBLE * count(*) OVER ()) THEN 1 ELSE 0 END AS fraud FROM events) SELECT row_id, "
    + ", ".join(f"round({_normal_sql(j)} + fraud * 2.5::DOUBLE, 6) AS feature_{j}" for j in range(20))
    + ", fraud FROM b",
)
def synthetic_fraud(spark, sf):
    out = synthetic_imbalanced(load(spark, sf, "events"), "event_id")
    return rounded(out, [f"feature_{j}" for j in range(20)])
