"""Projection and cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from benchloom.operators import clean, project
from benchloom.operators.series import load_series
from benchloom.operators.threshold import apply_threshold
from benchloom.queries.catalog import DOCS_SQL, LINES_SQL, SCORED_SQL, labelled_documents, load, query, rounded, scored_documents, sparse_lines


@query("drop_columns", "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def drop_columns(spark, sf):
    return project.drop_columns(load(spark, sf, "orders"), ["o_custkey", "o_orderdate", "no_such_column"])


@query("rename_columns", "SELECT doc_id AS id, quality AS label, toxic FROM labels")
def rename_columns(spark, sf):
    return project.rename_columns(load(spark, sf, "labels"), {"doc_id": "id", "quality": "label", "no_such_column": "x"})


@query("only_numeric", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def only_numeric(spark, sf):
    return project.only_numeric(load(spark, sf, "customer"))


@query("preview_rows", "SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id LIMIT 10")
def preview_rows(spark, sf):
    return project.preview(load(spark, sf, "events").select("event_id", "user_id", "event_type", "value"), ["event_id"])


@query("apply_threshold", f"SELECT row_id, CASE WHEN prob >= 0.3::DOUBLE THEN 1 ELSE 0 END AS pred FROM {SCORED_SQL} s")
def apply_threshold_query(spark, sf):
    return scored_documents(spark, sf).select("row_id", apply_threshold(F.col("prob"), 0.3).alias("pred"))


@query("display_types", "SELECT o_orderkey::DOUBLE AS key_text, o_totalprice, o_orderpriority FROM orders")
def display_types(spark, sf):
    orders = load(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("key_text"), "o_totalprice", "o_orderpriority")
    return project.display_types(orders)


@query("series_load", "SELECT row_number() OVER (ORDER BY o_orderkey) AS t, o_custkey::DOUBLE AS y FROM orders WHERE o_custkey IS NOT NULL")
def series_load(spark, sf):
    return load_series(load(spark, sf, "orders"), ["o_orderkey"])


@query("drop_duplicates", "SELECT DISTINCT l_quantity, l_discount, l_tax, l_returnflag FROM lineitem")
def drop_duplicates(spark, sf):
    return clean.drop_duplicates(load(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag"))


@query(
    "duplicates_report",
    "WITH s AS (SELECT user_id, event_type FROM events), a AS (SELECT count(*) AS n FROM s), d AS (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM s) x) "
    "SELECT a.n AS rows_before, d.n AS rows_after, a.n - d.n AS removed FROM a, d",
)
def duplicates_report(spark, sf):
    return clean.duplicates_report(load(spark, sf, "events").select("user_id", "event_type"))


@query("drop_nulls", f"SELECT * FROM {DOCS_SQL} s WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def drop_nulls(spark, sf):
    return clean.drop_nulls(labelled_documents(spark, sf))


@query(
    "nulls_report",
    f"SELECT (count(*) - count(l_discount) + count(*) - count(l_tax))::BIGINT AS nulls, count(*) FILTER (l_discount IS NULL OR l_tax IS NULL) AS rows_removed, "
    f"count(*) FILTER (l_discount IS NOT NULL AND l_tax IS NOT NULL) AS rows_left FROM {LINES_SQL} s",
)
def nulls_report(spark, sf):
    return clean.nulls_report(sparse_lines(spark, sf))




def _fill_sql(agg: str) -> str:
    return (
        f"SELECT l_quantity, l_extendedprice, round(coalesce(l_discount, (SELECT {agg.format(c='l_discount')} FROM {LINES_SQL} a)), 6) AS l_discount, "
        f"round(coalesce(l_tax, (SELECT {agg.format(c='l_tax')} FROM {LINES_SQL} b)), 6) AS l_tax, l_returnflag FROM {LINES_SQL} s"
    )


@query("fill_mean", _fill_sql("avg({c})"))
def fill_mean(spark, sf):
    return rounded(clean.fill_mean(sparse_lines(spark, sf)), ["l_discount", "l_tax"])


@query("fill_median", _fill_sql("quantile_cont({c}, 0.5)"))
def fill_median(spark, sf):
    return rounded(clean.fill_median(sparse_lines(spark, sf)), ["l_discount", "l_tax"])


@query(
    "fill_mode",
    f"SELECT doc_id, lang, source, n_chars, "
    f"coalesce(quality, (SELECT quality FROM labels WHERE quality IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS quality, "
    f"coalesce(toxic, (SELECT toxic FROM labels WHERE toxic IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS toxic FROM {DOCS_SQL} s",
)
def fill_mode(spark, sf):
    return clean.fill_mode(labelled_documents(spark, sf))


@query("fill_zero", f"SELECT doc_id, lang, source, n_chars, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic FROM {DOCS_SQL} s")
def fill_zero(spark, sf):
    return clean.fill_zero(labelled_documents(spark, sf))


@query(
    "one_hot_drop_first",
    "SELECT o_orderkey::BIGINT AS o_orderkey, trunc(o_totalprice)::BIGINT AS o_totalprice, "
    "CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END::BIGINT AS \"o_orderstatus_O\", CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END::BIGINT AS \"o_orderstatus_P\" FROM orders",
)
def one_hot_drop_first(spark, sf):
    return clean.one_hot(load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"))
