"""Profiling: types, missing values, summaries, value counts, class balance, correlation.

Everything is one aggregate over all columns followed by a reshape of the single result row, so a profile
costs one column-pruned scan however many columns it covers.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, Window, functions as F

from benchloom.functions.columns import col, long_rows, numeric_columns, real, safe_div
from benchloom.operators.gram import correlation_of, pair_sums, shifts
from benchloom.operators.quantiles import SMALL_ROWS, exact_quantiles

# Imbalance limits and the names of the severity levels.
IMBALANCED_BELOW = 0.3
SEVERE_BELOW = 0.1
SEVERITY_HIGH = "Alto"
SEVERITY_MODERATE = "Moderado"
SEVERITY_LOW = "Bajo"


def types_and_nulls(df: DataFrame) -> DataFrame:
    """column, type, non_null, nulls, null_pct (of all rows)."""
    wide = df.agg(F.count("*").alias("n"), *[F.count(col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    items = {
        c: [F.lit(t), F.col(f"c{i}"), F.col("n") - F.col(f"c{i}"), safe_div((F.col("n") - F.col(f"c{i}")) * 100, F.col("n"))]
        for i, (c, t) in enumerate(df.dtypes)
    }
    return long_rows(wide, items, ["column", "type", "non_null", "nulls", "null_pct"])


def missing_values(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """column, nulls, null_pct; by default only columns that have nulls."""
    out = types_and_nulls(df).select("column", "nulls", "null_pct")
    return out.filter(F.col("nulls") > 0) if only_missing else out


def dataset_kpis(df: DataFrame) -> DataFrame:
    """rows, columns, duplicate_rows, total_nulls in one row.

    ``distinct`` treats null as equal to null, which a multi-column count-distinct does not.
    """
    nulls = sum((F.count("*") - F.count(col(c)) for c in df.columns), F.lit(0).cast("bigint"))
    unique = df.distinct().agg(F.count("*")).scalar()
    return df.agg(F.count("*").alias("rows"), nulls.alias("total_nulls")).select(
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        (F.col("rows") - unique).alias("duplicate_rows"),
        "total_nulls",
    )


STATISTICS = ("mean", "median", "std", "min", "max", "q0", "q25", "q50", "q75", "q100")
_PROBS = {"median": 0.5, "q0": 0.0, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q100": 1.0, "q1": 0.25, "q3": 0.75}


def summary(
    df: DataFrame, columns: Sequence[str] | None = None, ddof: int = 1, small_rows: int = SMALL_ROWS
) -> DataFrame:
    """Per numeric column: count, mean, median, std, min, max, q1, q3.  Quartiles are exact."""
    columns = list(columns) if columns is not None else numeric_columns(df)
    if ddof not in (0, 1):
        raise ValueError("ddof must be 0 or 1")
    std = F.stddev_samp if ddof else F.stddev_pop
    probs = [0.25, 0.5, 0.75]
    small = df.count() <= small_rows
    aggs: list[Column] = []
    for i, c in enumerate(columns):
        v = real(c)
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), std(v).alias(f"s{i}"), F.min(v).alias(f"a{i}"), F.max(v).alias(f"b{i}")]
        if small:
            aggs.append(F.percentile(v, F.array(*[F.lit(p) for p in probs])).alias(f"q{i}"))
    wide = df.agg(*aggs)
    if not small:
        exact = exact_quantiles(df, columns, probs, small_rows)
        for i, c in enumerate(columns):
            wide = wide.withColumn(f"q{i}", F.array(*[F.lit(v).cast("double") for v in exact[c]]))
    items = {
        c: [F.col(f"n{i}"), F.col(f"m{i}"), F.col(f"q{i}")[1], F.col(f"s{i}"), F.col(f"a{i}"), F.col(f"b{i}"), F.col(f"q{i}")[0], F.col(f"q{i}")[2]]
        for i, c in enumerate(columns)
    }
    return long_rows(wide, items, ["column", "count", "mean", "median", "std", "min", "max", "q1", "q3"])


def describe(df: DataFrame, columns: Sequence[str] | None = None, small_rows: int = SMALL_ROWS) -> DataFrame:
    """The describe() layout in long form: column, statistic, value."""
    s = summary(df, columns, 1, small_rows)
    names = {"count": "count", "mean": "mean", "std": "std", "min": "min", "25%": "q1", "50%": "median", "75%": "q3", "max": "max"}
    return s.select(
        "column",
        F.explode(F.array(*[F.struct(F.lit(k).alias("statistic"), F.col(v).cast("double").alias("value")) for k, v in names.items()])).alias("r"),
    ).select("column", "r.*")


def statistic(df: DataFrame, name: str, columns: Sequence[str] | None = None, small_rows: int = SMALL_ROWS) -> DataFrame:
    """One statistic for every numeric column: mean, median, std, min, max or a quantile q0/q25/q50/q75/q100."""
    columns = list(columns) if columns is not None else numeric_columns(df)
    simple = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "q0": F.min, "q100": F.max}
    if name in simple:
        wide = df.agg(*[simple[name](real(c)).alias(f"x{i}") for i, c in enumerate(columns)])
        items = {c: [F.lit(name), F.col(f"x{i}")] for i, c in enumerate(columns)}
        return long_rows(wide, items, ["column", "statistic", "value"])
    if name not in _PROBS:
        raise ValueError(f"unknown statistic {name!r}; use one of {', '.join(STATISTICS)}")
    exact = exact_quantiles(df, columns, [_PROBS[name]], small_rows)
    rows = [(c, name, exact[c][0]) for c in columns]
    return df.sparkSession.createDataFrame(rows, "column string, statistic string, value double")


def series_statistics(df: DataFrame, value: str, small_rows: int = SMALL_ROWS) -> DataFrame:
    """Statistics of one series: n, mean, median, std (population), min, max, q1, q3, iqr."""
    s = summary(df, [value], 0, small_rows)
    return s.select(
        F.col("count").alias("n"), "mean", "median", "std", "min", "max", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """value, n - nulls excluded, most frequent first (equal counts by value)."""
    return (
        df.filter(col(column).isNotNull())
        .groupBy(col(column).alias("value"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "value")
    )


def value_counts_share(df: DataFrame, column: str, top: int | None = 30) -> DataFrame:
    """value, n, pct of all rows (nulls stay in the denominator); the ``top`` most frequent values."""
    total = df.agg(F.count("*")).scalar()
    out = value_counts(df, column).withColumn("pct", safe_div(F.col("n") * 100, total))
    return out.limit(top) if top is not None else out


def unique_values(df: DataFrame, column: str, legacy_null_zero: bool = False) -> DataFrame:
    """Every distinct value, null included.  ``legacy_null_zero`` shows the count of null as 0."""
    n = F.count("*")
    if legacy_null_zero:
        n = F.count(col(column))
    return df.groupBy(col(column).alias("value")).agg(n.alias("n"))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """class, n, share of the labelled rows."""
    counts = df.filter(col(label).isNotNull()).groupBy(col(label).alias("class")).agg(F.count("*").alias("n"))
    total = df.agg(F.count(col(label))).scalar()
    return counts.withColumn("share", safe_div(F.col("n"), total))


def check_imbalance(df: DataFrame, label: str) -> DataFrame:
    """One row: n_classes, total, min_count, max_count, ratio, is_imbalanced, severity, classes.

    ``classes`` lists (class, n) sorted by class; flags use the unrounded ratio.
    """
    counts = df.filter(col(label).isNotNull()).groupBy(col(label).alias("class")).agg(F.count("*").alias("n"))
    row = counts.agg(
        F.count("*").alias("n_classes"),
        F.sum("n").alias("total"),
        F.min("n").alias("min_count"),
        F.max("n").alias("max_count"),
        F.array_sort(F.collect_list(F.struct("class", "n"))).alias("classes"),
    )
    ratio = safe_div(F.col("min_count"), F.col("max_count"))
    severity = (
        F.when(ratio < SEVERE_BELOW, SEVERITY_HIGH).when(ratio < IMBALANCED_BELOW, SEVERITY_MODERATE).otherwise(SEVERITY_LOW)
    )
    return row.select(
        "n_classes", "total", "min_count", "max_count",
        ratio.alias("ratio"), (ratio < IMBALANCED_BELOW).alias("is_imbalanced"), severity.alias("severity"), "classes",
    )


WIDE = 16


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every ordered pair over the rows where both are present: a, b, r.

    One aggregate for all pairs; for more than ``WIDE`` columns, whose plan would grow with their square, products of
    matrices.  A constant column gives NULL, not an error.
    """
    columns = list(columns) if columns is not None else numeric_columns(df, include_bool=True)
    if len(columns) > WIDE:
        values = F.array(*[real(c) for c in columns])
        shift = shifts(df, values, len(columns))
        found = correlation_of(pair_sums(df, values, len(columns), shift), shift)
        names = F.array(*map(F.lit, columns))
        name = lambda c: F.element_at(names, F.col(c) + 1)
        both = F.when(F.col("i") == F.col("j"), F.array(F.struct(name("i").alias("a"), name("j").alias("b")))).otherwise(
            F.array(F.struct(name("i").alias("a"), name("j").alias("b")), F.struct(name("j").alias("a"), name("i").alias("b")))
        )
        return found.select(F.explode(both).alias("e"), "r").select("e.a", "e.b", "r")
    pos = {c: i for i, c in enumerate(columns)}
    src = df.select(*[real(c).alias(f"v{i}") for i, c in enumerate(columns)])
    aggs = []
    for i in range(len(columns)):
        for j in range(i, len(columns)):
            both = F.col(f"v{i}").isNotNull() & F.col(f"v{j}").isNotNull()
            x, y = F.when(both, F.col(f"v{i}")), F.when(both, F.col(f"v{j}"))
            r = F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))
            aggs.append(r.alias(f"r{i}_{j}"))
    wide = src.agg(*aggs)
    entries = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{min(pos[a], pos[b])}_{max(pos[a], pos[b])}").alias("r"))
        for a, b in product(columns, columns)
    ]
    return wide.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The correlations as a matrix: one row per column, one column per column (heat-map layout)."""
    columns = list(columns) if columns is not None else numeric_columns(df, include_bool=True)
    long = correlations(df, columns)
    return long.groupBy(F.col("a").alias("column")).agg(
        *[F.max(F.when(F.col("b") == c, F.col("r"))).alias(c) for c in columns]
    )
