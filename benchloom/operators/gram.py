"""Sums of products of many columns at once, with missing values, per group.

Tasks turn their rows into matrices and multiply them, so the plan does not grow with the number of columns; what leaves a
task is one row per group and pair of columns, and Spark adds these up. Values are taken relative to a shift per column (its mean, or
its value where it is constant), which keeps variances exact where means are large.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from benchloom.session import bounded_batches

CELLS = "g int, i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")
SAME = 1e-13  # values that differ by less than this share of their size count as one


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """One row per list of `size` numbers; nulls and infinite values are NaN."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    return np.where(np.isfinite(values), values, np.nan)


def shifts(df: DataFrame, values: Column, size: int) -> np.ndarray:
    """The mean of each column, or its value where it has one only; 0 without values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, low, high = np.zeros(size), np.zeros(size), np.full(size, np.inf), np.full(size, -np.inf)
        for b in batches:
            x = _matrix(b.column(0), size)
            here = ~np.isnan(x)
            n += here.sum(axis=0)
            total += np.where(here, x, 0.0).sum(axis=0)
            low, high = np.fmin(low, np.fmin.reduce(x, axis=0, initial=np.inf)), np.fmax(high, np.fmax.reduce(x, axis=0, initial=-np.inf))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), *map(pa.array, (n, total, low, high))], names=["i", "n", "s", "low", "high"])

    parts = df.select(values.alias("v")).mapInArrow(run, "i int, n double, s double, low double, high double")
    out = np.zeros(size)
    for r in parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("low").alias("low"), F.max("high").alias("high")).collect():
        out[r.i] = 0.0 if not r.n else r.low if r.low == r.high else r.s / r.n
    return out


def pair_sums(df: DataFrame, values: Column, size: int, shift: np.ndarray, group: Column | None = None) -> DataFrame:
    """Per group g and pair i <= j of the numbers in `values` (an array of `size`): over the rows where both are present n,
    and sums of x, y, x^2, y^2, x y, where x and y are the numbers less their shifts."""
    bounded_batches(df.sparkSession)
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for b in batches:
            groups, x = b.column(0).to_numpy(zero_copy_only=False), _matrix(b.column(1), size) - shift
            for g in np.unique(groups).tolist():
                own = x[groups == g]
                here = ~np.isnan(own)
                own, w = np.where(here, own, 0.0), here.astype(np.float64)
                found = [w.T @ w, own.T @ w, (own * own).T @ w, own.T @ own]
                held[g] = found if g not in held else [p + q for p, q in zip(held[g], found, strict=True)]
        for g, (n, sx, sxx, sxy) in held.items():
            cells = [n[upper], sx[upper], sx.T[upper], sxx[upper], sxx.T[upper], sxy[upper]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(upper[0]), g), pa.int32()), *(pa.array(u, pa.int32()) for u in upper), *map(pa.array, cells)],
                names=["g", "i", "j", *SUMS],
            )

    code = F.lit(0) if group is None else group.cast("int")
    parts = df.select(code.alias("g"), values.alias("v")).mapInArrow(run, CELLS)
    return parts.groupBy("g", "i", "j").agg(*[F.sum(c).alias(c) for c in SUMS])


def correlation_of(sums: DataFrame, shift: np.ndarray) -> DataFrame:
    """(i, j, r) from pair sums; NULL where a column is constant over the rows of the pair."""
    scale = F.array(*[F.lit(float(SAME * abs(s))) for s in shift])

    def spread(total: str, squares: str, column: str):
        var = F.col(squares) - F.col(total) * F.col(total) / F.nullif(F.col("n"), F.lit(0.0))
        return F.when(var > F.col("n") * F.pow(F.element_at(scale, F.col(column) + 1), 2), var)

    product = F.col("sxy") - F.col("sx") * F.col("sy") / F.nullif(F.col("n"), F.lit(0.0))
    return sums.select("i", "j", (product / F.sqrt(spread("sx", "sxx", "i")) / F.sqrt(spread("sy", "syy", "j"))).alias("r"))


def collected(sums: DataFrame, size: int) -> dict[int, dict[str, np.ndarray]]:
    """Pair sums as symmetric matrices per group, on the driver: groups x size^2 numbers."""
    out: dict[int, dict[str, np.ndarray]] = {}
    for r in sums.collect():
        own = out.setdefault(r.g, {c: np.zeros((size, size)) for c in ("n", "sx", "sxy")})
        own["n"][r.i, r.j] = own["n"][r.j, r.i] = r.n
        own["sxy"][r.i, r.j] = own["sxy"][r.j, r.i] = r.sxy
        own["sx"][r.i, r.j], own["sx"][r.j, r.i] = r.sx, r.sy
    return out
