"""Column-level helpers shared by all operators."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T


def numeric_columns(df: DataFrame, include_bool: bool = False) -> list[str]:
    """Names of the numeric columns; booleans only on request (they take part in correlations, not in summaries)."""
    kinds: tuple = (T.NumericType, T.BooleanType) if include_bool else (T.NumericType,)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def string_columns(df: DataFrame, include_bool: bool = False) -> list[str]:
    kinds: tuple = (T.StringType, T.BooleanType) if include_bool else (T.StringType,)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def q(name: str) -> str:
    """Back-quote a column name for use in an expression string."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(q(name))


def real(name: str, df: DataFrame | None = None) -> Column:
    """The column as DOUBLE, with NaN read as missing."""
    c = col(name).cast("double")
    return F.when(~F.isnan(c), c)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in floating columns, once, right after the scan."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.select(*[F.when(~F.isnan(col(c)), col(c)).alias(c) if c in floats else col(c) for c in df.columns])


def safe_div(a: Column, b: Column) -> Column:
    """a / b in DOUBLE, NULL where b is 0 (the session may run in ANSI mode, where a plain division raises)."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def ratio_or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(safe_div(a, b), F.lit(0.0))


def long_rows(df: DataFrame, items: dict[str, Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """Turn one wide row per input row into one row per item: (names[0]=key, names[1:]=values)."""
    structs = [
        F.struct(F.lit(key).alias(names[0]), *[v.alias(n) for v, n in zip(vals, names[1:])])
        for key, vals in items.items()
    ]
    return df.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """An Arrow column of lists of numbers as the rows of a matrix, without an object for each row; a null number is NaN."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
        vectors = pa.concat_arrays(vectors.chunks) if isinstance(vectors, pa.ChunkedArray) else vectors
    n = len(vectors)
    sizes = pc.min_max(pc.list_value_length(vectors)).as_py()
    if vectors.null_count or sizes["min"] != sizes["max"]:
        raise ValueError("all vectors must have the same number of entries")
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(n, sizes["max"] or 0)
