"""Preparation of series panels: one row per (keys, t), value y.  A single series is a panel without keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from benchloom.functions.columns import col, numeric_columns, real
from benchloom.operators.ordering import ROWS_PER_CHUNK, _same, positions


def _per_key(df: DataFrame, keys: Sequence[str], aggs: Sequence) -> DataFrame:
    return df.groupBy(*[col(k) for k in keys]).agg(*aggs)


def _attach(df: DataFrame, keys: Sequence[str], stats: DataFrame) -> DataFrame:
    """Put per-key statistics next to the rows; without keys the one row of statistics is a scalar subquery."""
    if keys:
        return _same(df, stats, keys, "left")
    packed = stats.select(F.struct("*")).scalar()
    return df.select("*", *[packed.getField(c).alias(c) for c in stats.columns])


def load_series(df: DataFrame, order: Sequence[str], column: str | None = None) -> DataFrame:
    """(t, y) of the first numeric column (or ``column``), nulls left out; t is the position in the given order."""
    numeric = [c for c in numeric_columns(df) if c not in order]
    if column is None:
        if not numeric:
            raise ValueError("the table has no numeric column to read a series from")
        column = numeric[0]
    values = df.select(*[col(o).alias(f"_o{i}") for i, o in enumerate(order)], real(column).alias("y")).filter(F.col("y").isNotNull())
    return positions(values, [], [f"_o{i}" for i in range(len(order))], "t").select("t", "y")


def time_split(
    df: DataFrame, keys: Sequence[str], t: str, ratio: float = 0.8, name: str = "split", rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Add ``split``: the first int(n * ratio) rows of each series are 'train', the rest 'test'."""
    sizes = _per_key(df, keys, [F.floor(F.count("*") * F.lit(float(ratio))).alias("_n_train")])
    out = _attach(positions(df, keys, [t], "_pos", rows_per_chunk), keys, sizes)
    return out.withColumn(name, F.when(F.col("_pos") <= F.col("_n_train"), "train").otherwise("test")).drop("_pos", "_n_train")


def series_range(train: DataFrame, keys: Sequence[str], y: str) -> DataFrame:
    """(keys, y_min, y_max) of the training part."""
    return _per_key(train, keys, [F.min(real(y)).alias("y_min"), F.max(real(y)).alias("y_max")])


def normalize_series(df: DataFrame, keys: Sequence[str], y: str, ranges: DataFrame, name: str = "y_norm") -> DataFrame:
    """(y - min) / (max - min) with the training range; a constant training part has divisor 1."""
    width = F.coalesce(F.nullif(F.col("y_max") - F.col("y_min"), F.lit(0.0)), F.lit(1.0))
    out = _attach(df, keys, ranges)
    return out.withColumn(name, (col(y).cast("double") - F.col("y_min")) / width).drop("y_min", "y_max")


def denormalize_series(df: DataFrame, keys: Sequence[str], y_norm: str, ranges: DataFrame, name: str = "y") -> DataFrame:
    """y_norm * (max - min) + min; a constant training part gives back its constant."""
    out = _attach(df, keys, ranges)
    value = col(y_norm) * (F.col("y_max") - F.col("y_min")) + F.col("y_min")
    return out.withColumn(name, value).drop("y_min", "y_max")


def lag_windows(
    df: DataFrame, keys: Sequence[str], t: str, y: str, window: int = 12, rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """(keys, t, window ARRAY<DOUBLE>, target): the ``window`` values before each row that has as many.

    When the counted rows pass ``rows_per_chunk`` each series is cut into stretches of that many positions; the last
    ``window`` rows of a stretch are repeated in front of the next one, so no task holds a whole series.
    """
    src = df.select(*[col(k) for k in keys], col(t), col(y).cast("double").alias("_y"))
    total = src.count()
    if total <= rows_per_chunk:
        tall = src.withColumn("_c", F.lit(0)).withColumn("_own", F.lit(True))
        order = col(t)
    else:
        length = max(rows_per_chunk, window)
        pos = positions(src, keys, [t], "_pos", rows_per_chunk).withColumn("_pos", F.col("_pos") - 1)
        own = F.floor(F.col("_pos") / length)
        late = F.col("_pos") % length >= length - window
        copies = F.when(late, F.array(own, own + 1)).otherwise(F.array(own))
        tall = pos.withColumn("_c", F.explode(copies)).withColumn("_own", F.col("_c") == own)
        order = F.col("_pos")
    w = Window.partitionBy("_c", *[col(k) for k in keys]).orderBy(order).rowsBetween(-window, -1)
    out = tall.withColumn("window", F.collect_list("_y").over(w))
    return out.filter(F.col("_own") & (F.size("window") == window)).select(
        *[col(k) for k in keys], col(t), "window", F.col("_y").alias("target")
    )
