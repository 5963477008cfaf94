"""Catalogue of ready-made queries over the star-schema tables, each with independent SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from benchloom.functions.columns import col
from benchloom.sources.tables import read_parquet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.select(*[F.round(col(c), digits).alias(c) if c in columns else col(c) for c in df.columns])


# ------------------------------------------------------------------ shared inputs

def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their labels; documents nobody labelled have NULL labels."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(load(spark, sf_dir, "labels"), "doc_id", "left")


DOCS_SQL = "(SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every labelled document with a score that grows with its length: row_id, label, prob, pred."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "n_chars")
    size = F.col("n_chars").cast("double")
    out = load(spark, sf_dir, "labels").join(docs, "doc_id").select(
        F.col("doc_id").alias("row_id"), F.col("quality").alias("label"), (F.floor(F.lit(200.0) * size / (size + 2000.0)) / F.lit(200.0)).alias("prob")
    )
    return out.withColumn("pred", (F.col("prob") >= 0.5).cast("int"))


SCORED_SQL = (
    "(SELECT *, CASE WHEN prob >= 0.5::DOUBLE THEN 1 ELSE 0 END AS pred FROM (SELECT l.doc_id AS row_id, l.quality AS label, "
    "floor(200.0::DOUBLE * d.n_chars / (d.n_chars::DOUBLE + 2000.0::DOUBLE)) / 200.0::DOUBLE AS prob "
    "FROM labels l JOIN documents d USING (doc_id)) x)"
)


def sparse_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with 'no discount' and 'no tax' read as missing."""
    return load(spark, sf_dir, "lineitem").select(
        "l_quantity", "l_extendedprice",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), F.nullif("l_tax", F.lit(0.0)).alias("l_tax"), "l_returnflag",
    )


LINES_SQL = (
    "(SELECT l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax, l_returnflag FROM lineitem)"
)


def monthly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per priority and month: key, t (running month number), y."""
    orders = load(spark, sf_dir, "orders")
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    return orders.groupBy(F.col("o_orderpriority").alias("key"), month.cast("bigint").alias("t")).agg(F.count("*").cast("double").alias("y"))


MONTHLY_SQL = (
    "(SELECT o_orderpriority AS key, (year(o_orderdate) * 12 + month(o_orderdate))::BIGINT AS t, count(*)::DOUBLE AS y "
    "FROM orders GROUP BY 1, 2)"
)


def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as a two-class table: row_id, label (first five classes or not), features ARRAY<DOUBLE>."""
    return load(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"), (F.col("label") < 5).cast("double").alias("label"), F.col("embedding").cast("array<double>").alias("features")
    )


EMBEDDED_SQL = (
    "(SELECT vec_id AS row_id, CASE WHEN label < 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, embedding::DOUBLE[] AS features FROM embeddings)"
)


def sql_split(source: str, row_id: str, label: str, test_size: float = 0.3, seed: int = 42) -> str:
    """CTEs ending in ``parts``: the source with its exact stratified split."""
    return f"""
src AS (SELECT * FROM {source}),
cls AS (SELECT {label} AS y, count(*) AS n FROM src GROUP BY 1),
tot AS (SELECT sum(n)::BIGINT AS n_all, ceil(sum(n)::BIGINT * {test_size}::DOUBLE)::BIGINT AS n_test FROM cls),
quo AS (SELECT y, (n * (n_all - n_test)) // n_all AS base, (n * (n_all - n_test)) % n_all AS rest, n_all - n_test AS n_train FROM cls, tot),
quota AS (SELECT y, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, y) <= n_train - sum(base) OVER () THEN 1 ELSE 0 END AS q FROM quo),
parts AS (SELECT src.*, CASE WHEN row_number() OVER (PARTITION BY {label} ORDER BY md5('{seed}|split|' || {row_id}), {row_id}) <= q
          THEN 'train' ELSE 'test' END AS split FROM src JOIN quota ON src.{label} = quota.y)"""


def sql_plain_split(source: str, row_id: str, test_size: float = 0.3, seed: int = 42) -> str:
    return f"""
src AS (SELECT * FROM {source}),
tot AS (SELECT count(*) - ceil(count(*) * {test_size}::DOUBLE)::BIGINT AS n_train FROM src),
parts AS (SELECT src.*, CASE WHEN row_number() OVER (ORDER BY md5('{seed}|split|' || {row_id}), {row_id}) <= n_train
          THEN 'train' ELSE 'test' END AS split FROM src, tot)"""
