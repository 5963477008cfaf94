"""Projections and filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from benchloom.functions.columns import col, numeric_columns, string_columns


def drop_columns(df: DataFrame, columns: Sequence[str], strict: bool = False, target: str | None = None) -> DataFrame:
    """Drop columns; unknown names are ignored unless ``strict``.  The target column cannot be dropped."""
    missing = [c for c in columns if c not in df.columns]
    if strict and missing:
        raise KeyError(f"no such columns: {missing}")
    if target is not None and target in columns:
        raise ValueError(f"the target column {target!r} cannot be dropped")
    return df.drop(*columns)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; unknown names are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def only_numeric(df: DataFrame) -> DataFrame:
    return df.select(*[col(c) for c in numeric_columns(df)])


def hide_internal(df: DataFrame) -> DataFrame:
    """Leave out columns whose name starts with an underscore."""
    return df.select(*[col(c) for c in df.columns if not c.startswith("_")])


def preview(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first n rows in an explicit order."""
    return df.orderBy(*[col(o) for o in order]).limit(n)


def rows_of_model(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("model") == name)


def split_by_metric(df: DataFrame, metric: str) -> tuple[DataFrame, DataFrame]:
    """Rows with and rows without a value of the metric (models that ran, models that failed)."""
    return df.filter(col(metric).isNotNull()), df.filter(col(metric).isNull())


def display_types(df: DataFrame) -> DataFrame:
    """String columns become DOUBLE when every non-null value parses as a number, and stay strings otherwise."""
    texts = string_columns(df)
    if not texts:
        return df
    bad = df.agg(
        *[F.count_if(col(c).isNotNull() & col(c).try_cast("double").isNull()).alias(f"b{i}") for i, c in enumerate(texts)]
    ).first()
    numeric = {c for i, c in enumerate(texts) if bad[f"b{i}"] == 0}
    return df.select(*[col(c).try_cast("double").alias(c) if c in numeric else col(c) for c in df.columns])
