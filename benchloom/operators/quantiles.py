"""Exact quantiles (linear interpolation) that stay exact on any number of rows.

The built-in ``percentile`` keeps every distinct value of a column in one aggregation buffer.  That is the
right tool while the counted rows are few; beyond ``SMALL_ROWS`` the wanted order statistics are found by
narrowing value ranges: each pass is one scan with a map-side combined histogram, and only ranges and
counts come back to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from benchloom.functions.columns import col, real

SMALL_ROWS = 200_000
BUCKETS = 1024
FINISH_ROWS = 10_000


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], small_rows: int = SMALL_ROWS
) -> dict[str, list[float | None]]:
    """Quantiles per column as plain numbers (columns x probs values); nulls and NaN are ignored."""
    if not cols:
        return {}
    values = df.select(*[real(c).alias(f"v{i}") for i, c in enumerate(cols)])
    if values.count() <= small_rows:
        grid = F.array(*[F.lit(float(p)) for p in probs])
        row = values.agg(*[F.percentile(f"v{i}", grid).alias(f"q{i}") for i in range(len(cols))]).first()
        return {c: list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * len(probs) for i, c in enumerate(cols)}
    return _narrow(values, cols, probs)


def _narrow(values: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    aggs = []
    for i in range(len(cols)):
        aggs += [F.count(f"v{i}").alias(f"n{i}"), F.min(f"v{i}").alias(f"a{i}"), F.max(f"v{i}").alias(f"b{i}")]
    base = values.agg(*aggs).first()
    found: dict[tuple[int, int], float] = {}
    # open ranges: (column, low, high) -> (rows below the range, rows inside, wanted ranks)
    open_ranges: dict[tuple[int, float, float], tuple[int, int, set[int]]] = {}
    for i in range(len(cols)):
        n = base[f"n{i}"]
        if n:
            ranks = {r for p in probs for r in (math.floor((n - 1) * p), math.ceil((n - 1) * p))}
            open_ranges[(i, base[f"a{i}"], base[f"b{i}"])] = (0, n, ranks)

    while open_ranges:
        todo, finish = {}, {}
        for key, state in open_ranges.items():
            i, low, high = key
            below, inside, ranks = state
            if low == high:
                found.update({(i, r): low for r in ranks})
            elif inside <= FINISH_ROWS:
                finish[key] = state
            else:
                todo[key] = state
        if finish:
            for (i, low, high), pairs in _values_inside(values, list(finish)).items():
                below, _, ranks = finish[(i, low, high)]
                at = below
                for v, n in pairs:
                    found.update({(i, r): v for r in ranks if at <= r < at + n})
                    at += n
        open_ranges = {}
        if todo:
            for (i, low, high), buckets in _histogram(values, list(todo)).items():
                below, _, ranks = todo[(i, low, high)]
                at = below
                for n, lo, hi in buckets:
                    here = {r for r in ranks if at <= r < at + n}
                    if here:
                        open_ranges[(i, lo, hi)] = (at, n, here)
                    at += n

    out: dict[str, list[float | None]] = {}
    for i, c in enumerate(cols):
        n = base[f"n{i}"]
        out[c] = []
        for p in probs:
            if not n:
                out[c].append(None)
                continue
            h = (n - 1) * p
            lo, hi, part = found[(i, math.floor(h))], found[(i, math.ceil(h))], h - math.floor(h)
            out[c].append(lo if part == 0 or lo == hi else (1 - part) * lo + part * hi)
    return out


def _in_ranges(values: DataFrame, ranges: list[tuple[int, float, float]]) -> DataFrame:
    """Rows (g, v) for the values that fall in the listed closed ranges (a column's ranges do not overlap)."""
    items = [
        F.when(F.col(f"v{i}").between(low, high), F.struct(F.lit(g).alias("g"), F.col(f"v{i}").alias("v")))
        for g, (i, low, high) in enumerate(ranges)
    ]
    return values.select(F.explode(F.array(*items)).alias("r")).filter(F.col("r").isNotNull()).select("r.*")


def _values_inside(values, ranges):
    rows = _in_ranges(values, ranges).groupBy("g", "v").agg(F.count("*").alias("n")).collect()
    out = {r: [] for r in ranges}
    for row in sorted(rows, key=lambda r: (r.g, r.v)):
        out[ranges[row.g]].append((row.v, row.n))
    return out


def _magnitude(v):
    """A whole number that never falls when v rises: the sign with the binary exponent, infinities outermost."""
    size = F.abs(v)
    power = F.when(size == 0, 0).when(size == math.inf, 4000).otherwise(F.floor(F.log2(F.when((size > 0) & (size < math.inf), size))) + 1100)
    return F.when(v < 0, -power).otherwise(power)


def _wide(low: float, high: float) -> bool:
    """Do the bounds differ in sign or by more than 2**10?  Then equal slots would hardly narrow the range."""
    if math.isinf(low) or math.isinf(high) or low <= 0 <= high:
        return True
    return abs(math.frexp(low)[1] - math.frexp(high)[1]) > 10


def _histogram(values, ranges):
    """Counts per slot.  One pass separates orders of magnitude, then each pass narrows a range by BUCKETS, so few are needed."""
    inside = _in_ranges(values, ranges)
    pick = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs]), F.col("g") + 1)
    wide = [_wide(r[1], r[2]) for r in ranges]
    low = pick([0.0 if w else float(r[1]) for w, r in zip(wide, ranges, strict=True)])
    high = pick([1.0 if w else float(r[2]) for w, r in zip(wide, ranges, strict=True)])
    even = F.when(~pick(wide), F.least(F.floor((F.col("v") - low) / (high - low) * BUCKETS), F.lit(BUCKETS - 1)))
    slot = F.coalesce(even, _magnitude(F.col("v")))
    rows = (
        inside.groupBy("g", slot.alias("slot"))
        .agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .collect()
    )
    out = {r: [] for r in ranges}
    for row in sorted(rows, key=lambda r: (r.g, r.slot)):
        out[ranges[row.g]].append((row.n, row.lo, row.hi))
    return out
