"""Plot data: histograms, density curves, box plots, pair scatters.  Only the numbers, no drawing."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from benchloom.functions.columns import col, numeric_columns, real, safe_div
from benchloom.functions.hashing import hash_key
from benchloom.operators.quantiles import SMALL_ROWS, exact_quantiles

# Bins of a histogram, points of a density curve, bandwidths cut off at either end,
# rows and columns of a pair scatter, whisker length in quartile ranges.
HISTOGRAM_BINS = 30
KDE_POINTS = 200
KDE_CUT = 3.0
SCATTER_ROWS = 500
SCATTER_COLUMNS = 8
WHISKER = 1.5


def _tall(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, v) for every non-null value."""
    items = [F.struct(F.lit(c).alias("column"), real(c).alias("v")) for c in columns]
    return df.select(F.explode(F.array(*items)).alias("r")).select("r.*").filter(F.col("v").isNotNull())


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """column, bin, lo, hi, n, density for every bin, empty ones included.

    Equal-width bins on [min, max], the last one closed; a constant column gets the range value +- 0.5.
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    ranges = df.agg(*[f(real(c)).alias(f"{p}{i}") for i, c in enumerate(columns) for p, f in (("a", F.min), ("b", F.max))]).first()
    spec = []
    for i, c in enumerate(columns):
        lo, hi = ranges[f"a{i}"], ranges[f"b{i}"]
        if lo is None:
            continue
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        spec.append((c, float(lo), float(hi)))
    if not spec:
        raise ValueError("no numeric column holds a value")
    slots = []
    for c, lo, hi in spec:
        v = real(c)
        # least() passes over nulls, so missing values are kept out explicitly
        slot = F.when(v.isNotNull(), F.least(F.floor((v - lo) / F.lit(hi - lo) * bins), F.lit(bins - 1))).cast("int")
        slots.append(F.struct(F.lit(c).alias("column"), slot.alias("bin")))
    counted = (
        df.select(F.explode(F.array(*slots)).alias("r")).select("r.*").filter(F.col("bin").isNotNull())
        .groupBy("column", "bin").agg(F.count("*").alias("n"))
    )
    # the frame of all bins is columns x bins rows
    spark = df.sparkSession
    frame = spark.createDataFrame(spec, "column string, a double, b double").select(
        "column", "a", "b", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    width = (F.col("b") - F.col("a")) / bins
    out = frame.join(counted, ["column", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))
    totals = counted.groupBy("column").agg(F.sum("n").alias("total"))
    return out.join(totals, "column").select(
        "column", "bin",
        (F.col("a") + F.col("bin") * width).alias("lo"),
        (F.col("a") + (F.col("bin") + 1) * width).alias("hi"),
        "n",
        safe_div(F.col("n"), F.col("total") * width).alias("density"),
    )


def kde(
    df: DataFrame, columns: Sequence[str] | None = None, points: int = KDE_POINTS, cut: float = KDE_CUT, clip: bool = False
) -> DataFrame:
    """Gaussian density curve with Scott's bandwidth: column, i, x, density.

    The curve is exact: each task sums the kernels of its own rows on the small grid with numpy, and only
    the partial sums (columns x points per task) are shuffled.  ``clip`` limits the grid to the data range.
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    aggs = []
    for i, c in enumerate(columns):
        v = real(c)
        aggs += [F.count(v).alias(f"n{i}"), F.stddev_samp(v).alias(f"s{i}"), F.min(v).alias(f"a{i}"), F.max(v).alias(f"b{i}")]
    row = df.agg(*aggs).first()
    grids = {}
    for i, c in enumerate(columns):
        n, s = row[f"n{i}"], row[f"s{i}"]
        if not n or not s:  # a constant or single value has no density curve
            continue
        bw = s * n ** (-1.0 / 5.0)
        margin = 0.0 if clip else cut * bw
        grids[c] = (np.linspace(row[f"a{i}"] - margin, row[f"b{i}"] + margin, points), bw, n)
    schema = "column string, i int, part double"

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {c: np.zeros(points) for c in grids}
        for pdf in batches:
            for c, (grid, bw, _) in grids.items():
                v = pdf[c].to_numpy(dtype=float)
                v = v[~np.isnan(v)]
                for at in range(0, len(v), 4096):
                    z = (grid[None, :] - v[at : at + 4096, None]) / bw
                    sums[c] += np.exp(-0.5 * z * z).sum(axis=0)
        for c, s in sums.items():
            yield pd.DataFrame({"column": c, "i": np.arange(points, dtype=np.int32), "part": s})

    parts = df.select(*[real(c).alias(c) for c in grids]).mapInPandas(partial, schema)
    frame = [(c, i, float(x), float(n * bw * math.sqrt(2 * math.pi))) for c, (g, bw, n) in grids.items() for i, x in enumerate(g)]
    grid_df = df.sparkSession.createDataFrame(frame, "column string, i int, x double, norm double")
    sums = parts.groupBy("column", "i").agg(F.sum("part").alias("s"))
    return grid_df.join(sums, ["column", "i"]).select("column", "i", "x", (F.col("s") / F.col("norm")).alias("density"))


def histogram_with_kde(df: DataFrame, columns: Sequence[str] | None = None, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Histogram bars and the clipped density curve in one long table: column, kind, i, x, y."""
    bars = histogram(df, columns, bins).select(
        "column", F.lit("bar").alias("kind"), F.col("bin").alias("i"), ((F.col("lo") + F.col("hi")) / 2).alias("x"), F.col("density").alias("y")
    )
    curve = kde(df, columns, clip=True).select("column", F.lit("curve").alias("kind"), "i", "x", F.col("density").alias("y"))
    return bars.unionByName(curve)


def _fences(df: DataFrame, columns: Sequence[str], small_rows: int) -> dict[str, tuple[float, float, float, float, float]]:
    out = {}
    for c, (q1, q2, q3) in exact_quantiles(df, columns, [0.25, 0.5, 0.75], small_rows).items():
        if q1 is not None:
            out[c] = (q1, q2, q3, q1 - WHISKER * (q3 - q1), q3 + WHISKER * (q3 - q1))
    return out


def box_plot(df: DataFrame, columns: Sequence[str] | None = None, small_rows: int = SMALL_ROWS) -> DataFrame:
    """column, q1, median, q3, whisker_lo, whisker_hi, n_outliers."""
    columns = list(columns) if columns is not None else numeric_columns(df)
    fences = _fences(df, columns, small_rows)
    aggs = []
    for i, (c, (_, _, _, lo, hi)) in enumerate(fences.items()):
        v = real(c)
        inside = v.between(lo, hi)
        aggs += [
            F.min(F.when(inside, v)).alias(f"a{i}"), F.max(F.when(inside, v)).alias(f"b{i}"), F.count_if(~inside).alias(f"o{i}"),
        ]
    wide = df.agg(*aggs)
    items = [
        F.struct(
            F.lit(c).alias("column"), F.lit(q1).alias("q1"), F.lit(q2).alias("median"), F.lit(q3).alias("q3"),
            F.col(f"a{i}").alias("whisker_lo"), F.col(f"b{i}").alias("whisker_hi"), F.col(f"o{i}").alias("n_outliers"),
        )
        for i, (c, (q1, q2, q3, _, _)) in enumerate(fences.items())
    ]
    return wide.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def outliers(df: DataFrame, row_id: str, columns: Sequence[str] | None = None, small_rows: int = SMALL_ROWS) -> DataFrame:
    """The points drawn beyond the whiskers: column, row_id, value."""
    columns = list(columns) if columns is not None else [c for c in numeric_columns(df) if c != row_id]
    fences = _fences(df, columns, small_rows)
    items = [
        F.when(~real(c).between(lo, hi), F.struct(F.lit(c).alias("column"), real(c).alias("value")))
        for c, (_, _, _, lo, hi) in fences.items()
    ]
    out = df.select(col(row_id).alias("row_id"), F.explode(F.array_compact(F.array(*items))).alias("r"))
    return out.select("r.column", "row_id", "r.value")


def pair_scatter(
    df: DataFrame,
    row_id: str,
    columns: Sequence[str] | None = None,
    max_columns: int = SCATTER_COLUMNS,
    rows: int | None = SCATTER_ROWS,
    seed: int = 42,
) -> DataFrame:
    """Points for the scatter of every column pair: row_id, a, b, x, y, from at most ``rows`` hashed rows."""
    columns = list(columns) if columns is not None else [c for c in numeric_columns(df) if c != row_id]
    columns = columns[:max_columns]
    if len(columns) < 2:
        raise ValueError("a pair scatter needs at least two numeric columns")
    src = df.select(col(row_id).alias("row_id"), *[real(c).alias(c) for c in columns])
    if rows is not None:
        src = src.orderBy(hash_key(seed, "scatter", F.col("row_id")), "row_id").limit(rows)
    pairs = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), col(a).alias("x"), col(b).alias("y"))
        for i, a in enumerate(columns) for b in columns[i + 1:]
    ]
    return src.select("row_id", F.explode(F.array(*pairs)).alias("p")).select("row_id", "p.*")
