"""Feature scaling with statistics from the training rows only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from benchloom.functions.columns import col, numeric_columns, real


@dataclass
class Scaler:
    """x -> (x - offset) / divisor per column.

    ``standard``: mean and population standard deviation; ``minmax``: minimum and range.  A constant column
    has divisor 1.  Test rows outside the training range are not clipped.
    """

    kind: str
    offset: dict[str, float]
    divisor: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(
            *[
                ((col(c).cast("double") - F.lit(self.offset[c])) / F.lit(self.divisor[c])).alias(c) if c in self.offset else col(c)
                for c in df.columns
            ]
        )


def fit_scaler(train: DataFrame, columns: Sequence[str] | None = None, kind: str = "standard") -> Scaler:
    columns = list(columns) if columns is not None else numeric_columns(train)
    if kind == "standard":
        pick = lambda v: (F.avg(v), F.stddev_pop(v))
    elif kind == "minmax":
        pick = lambda v: (F.min(v), F.max(v) - F.min(v))
    else:
        raise ValueError(f"unknown scaling {kind!r}; use 'standard' or 'minmax'")
    aggs = []
    for i, c in enumerate(columns):
        a, b = pick(real(c))
        aggs += [a.alias(f"a{i}"), b.alias(f"b{i}")]
    row = train.agg(*aggs).first() if columns else {}
    return Scaler(
        kind,
        {c: row[f"a{i}"] if row[f"a{i}"] is not None else 0.0 for i, c in enumerate(columns)},
        {c: row[f"b{i}"] or 1.0 for i, c in enumerate(columns)},
    )


def scale_features(
    train: DataFrame, test: DataFrame, columns: Sequence[str] | None = None, kind: str = "standard"
) -> tuple[DataFrame, DataFrame, Scaler]:
    scaler = fit_scaler(train, columns, kind)
    return scaler.transform(train), scaler.transform(test), scaler
