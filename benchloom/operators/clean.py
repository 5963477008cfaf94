"""Cleaning: duplicates, missing values, one-hot columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from benchloom.functions.columns import col, numeric_columns, real, string_columns
from benchloom.operators.quantiles import SMALL_ROWS, exact_quantiles

ONE_HOT_LIMIT = 1000


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def duplicates_report(df: DataFrame) -> DataFrame:
    """rows_before, rows_after, removed."""
    after = df.distinct().agg(F.count("*")).scalar()
    return df.agg(F.count("*").alias("rows_before")).select(
        "rows_before", after.alias("rows_after"), (F.col("rows_before") - after).alias("removed")
    )


def drop_nulls(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def nulls_report(df: DataFrame) -> DataFrame:
    """nulls, rows_removed, rows_left - counted in one pass."""
    any_null = F.lit(False)
    nulls = F.lit(0).cast("bigint")
    for c in df.columns:
        any_null = any_null | col(c).isNull()
        nulls = nulls + F.when(col(c).isNull(), 1).otherwise(0)
    return df.agg(
        F.coalesce(F.sum(nulls), F.lit(0)).alias("nulls"),
        F.count_if(any_null).alias("rows_removed"),
        F.count_if(~any_null).alias("rows_left"),
    )


def fill_mean(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Numeric nulls take the column mean (filled columns become DOUBLE)."""
    columns = list(columns) if columns is not None else numeric_columns(df)
    means = df.agg(*[F.avg(real(c)).alias(f"m{i}") for i, c in enumerate(columns)]).select(F.struct("*")).scalar()
    index = {c: i for i, c in enumerate(columns)}
    return df.select(
        *[F.coalesce(real(c), means.getField(f"m{index[c]}")).alias(c) if c in index else col(c) for c in df.columns]
    )


def fill_median(df: DataFrame, columns: Sequence[str] | None = None, small_rows: int = SMALL_ROWS) -> DataFrame:
    """Numeric nulls take the exact column median."""
    columns = list(columns) if columns is not None else numeric_columns(df)
    medians = {c: v[0] for c, v in exact_quantiles(df, columns, [0.5], small_rows).items()}
    return df.select(
        *[F.coalesce(real(c), F.lit(medians[c]).cast("double")).alias(c) if c in medians else col(c) for c in df.columns]
    )


def column_mode(df: DataFrame, column: str):
    """The most frequent value as a scalar expression, the smallest one among equals; NULL if there is none.

    Counts are combined map-side, so a value that fills a third of the table is no hot key.
    """
    counts = df.filter(col(column).isNotNull()).groupBy(col(column).alias("v")).agg(F.count("*").alias("n"))
    return counts.agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col("v"))).alias("best")).select("best.v").scalar()


def fill_mode(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls of every column take the column's mode; an all-null column takes 0."""
    columns = list(columns) if columns is not None else df.columns
    out = []
    for f in df.schema.fields:
        if f.name in columns:
            zero = F.lit("0") if isinstance(f.dataType, T.StringType) else F.lit(0).cast(f.dataType) if isinstance(f.dataType, (T.NumericType, T.BooleanType)) else None
            parts = [col(f.name), column_mode(df, f.name)] + ([zero] if zero is not None else [])
            out.append(F.coalesce(*parts).alias(f.name))
        else:
            out.append(col(f.name))
    return df.select(*out)


def fill_zero(df: DataFrame) -> DataFrame:
    """Nulls become 0, "0" or false by column type."""
    return df.na.fill(0).na.fill("0").na.fill(False)


def one_hot(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    cast_all_int: bool = True,
    always_cast: bool = False,
    limit: int = ONE_HOT_LIMIT,
) -> DataFrame:
    """Dummy columns ``<column>_<value>`` for all but the first (sorted) category.

    With ``cast_all_int`` the whole frame is cast to integers afterwards; a frame without categories is left
    as it is unless ``always_cast``.  Each category becomes a column, so a column with more than ``limit``
    categories is refused.
    """
    columns = list(columns) if columns is not None else string_columns(df)
    if not columns and not always_cast:
        return df
    categories = {}
    for c in columns:
        # limit + 1 distinct values are enough to know that the limit is passed
        found = [r[0] for r in df.select(col(c)).filter(col(c).isNotNull()).distinct().limit(limit + 1).collect()]
        if len(found) > limit:
            raise ValueError(f"column {c!r} has more than {limit} categories; label-encode it instead")
        categories[c] = sorted(found)
    keep = [col(c) for c in df.columns if c not in columns]
    dummies = [
        F.when(col(c) == v, 1).otherwise(0).alias(f"{c}_{v}") for c in columns for v in categories[c][1:]
    ]
    out = df.select(*keep, *dummies)
    if cast_all_int:
        out = out.select(*[col(c).cast("bigint").alias(c) for c in out.columns])
    return out
