"""Series models work on panels (key STRING, t, y DOUBLE) and forecast (key, step, yhat)."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from benchloom.functions.columns import col, real
from benchloom.operators.ordering import BROADCAST_ROWS, positions
from benchloom.operators.series import lag_windows
from benchloom.session import bounded_batches, checkpointed, fan_out

STRETCH_ROWS = 1_000_000  # longer series are cut into stretches of so many values


def panel(df: DataFrame, t: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Canonical panel columns; without keys the table is one series.  NULL and NaN values are left out.

    Different key values give different names: a NULL is written \\N, and | and \\ within a value get a \\ in front.
    """
    key = F.concat_ws("|", *[_key_text(k) for k in keys]) if keys else F.lit("series")
    return df.select(key.alias("key"), col(t).alias("t"), real(y).alias("y")).filter(F.col("y").isNotNull())


def _key_text(name: str):
    return F.coalesce(F.regexp_replace(col(name).cast("string"), r"([\\|])", r"\\$1"), F.lit("\\N"))


def split_by_length(df: DataFrame, most: int) -> tuple[DataFrame, int, DataFrame | None]:
    """(series of at most `most` counted rows, how many they are, the longer ones or None)."""
    sizes = df.groupBy("key").agg(F.count("*").alias("n"))
    longest, keys = sizes.agg(F.max("n"), F.count("*")).first()
    if (longest or 0) <= most:
        return df, keys, None
    long = checkpointed(sizes.filter(F.col("n") > most).select("key"))
    count = long.count()
    long = F.broadcast(long) if count <= BROADCAST_ROWS else long
    return df.join(long, "key", "left_anti"), keys - count, df.join(long, "key", "left_semi")


def packed_stretches(train: DataFrame, lead: int, size: int) -> DataFrame:
    """(key, chunk, y): the values of a stretch in order, behind the last `lead` values of the one before."""
    bounded_batches(train.sparkSession)
    numbered = positions(train, ["key"], ["t"], "_pos", size)
    at, within = F.floor((F.col("_pos") - 1) / size), (F.col("_pos") - 1) % size
    chunk = F.explode(F.when(within >= size - lead, F.array(at, at + 1)).otherwise(F.array(at)))
    rows = numbered.select("key", "_pos", "y", chunk.alias("chunk"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values("_pos")
        chunk = int(pdf["chunk"].iloc[0])
        if y["_pos"].iloc[-1] <= chunk * size:  # only what the stretch before has lent: the series ends there
            return pd.DataFrame({"key": [], "chunk": [], "y": []}, dtype=object)
        return pd.DataFrame([{"key": pdf["key"].iloc[0], "chunk": chunk, "y": y["y"].to_numpy()}])

    spread = rows.repartition(fan_out(train.sparkSession), "key", "chunk")
    return checkpointed(spread.groupBy("key", "chunk").applyInPandas(pack, "key string, chunk bigint, y array<double>"))


def last_values(df: DataFrame, n: int) -> DataFrame:
    """(key, tail ARRAY<DOUBLE>): the last n values in time order.  Tasks keep only n rows per key before the shuffle."""
    w = Window.partitionBy("key").orderBy(F.desc("t"))
    tail = df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n)
    return tail.groupBy("key").agg(F.array_sort(F.collect_list(F.struct((-F.col("_r")).alias("o"), "y"))).alias("s")).select(
        "key", F.col("s.y").alias("tail")
    )


def _steps(steps: int):
    return F.explode(F.sequence(F.lit(1), F.lit(int(steps)))).alias("step")


def naive_forecast(train: DataFrame, steps: int) -> DataFrame:
    """The last value, repeated."""
    last = train.groupBy("key").agg(F.max_by("y", "t").alias("yhat"))
    return last.select("key", _steps(steps), "yhat")


def seasonal_naive_forecast(train: DataFrame, steps: int, m: int = 12) -> DataFrame:
    """The last season, repeated."""
    tail = last_values(train, m).filter(F.size("tail") == m)
    return tail.select("key", "tail", _steps(steps)).select("key", "step", F.element_at("tail", (F.col("step") - 1) % m + 1).alias("yhat"))


def drift_forecast(train: DataFrame, steps: int) -> DataFrame:
    """The straight line through the first and the last value."""
    ends = train.groupBy("key").agg(
        F.max_by("y", "t").alias("b"), F.min_by("y", "t").alias("a"), F.count("*").alias("n")
    ).filter(F.col("n") > 1)
    return ends.select("key", "a", "b", "n", _steps(steps)).select(
        "key", "step", (F.col("b") + F.col("step") * (F.col("b") - F.col("a")) / (F.col("n") - 1)).alias("yhat")
    )


def ar1_fit(train: DataFrame) -> DataFrame:
    """(key, slope, intercept, last): least squares of y on its previous value, from plain sums."""
    pairs = lag_windows(train, ["key"], "t", "y", 1).select("key", F.col("window")[0].alias("x"), F.col("target").alias("z"))
    sums = pairs.groupBy("key").agg(
        F.covar_pop("x", "z").alias("cov"), F.var_pop("x").alias("var"), F.avg("x").alias("mx"), F.avg("z").alias("mz")
    )
    slope = F.coalesce(F.col("cov") / F.nullif(F.col("var"), F.lit(0.0)), F.lit(0.0))
    last = train.groupBy("key").agg(F.max_by("y", "t").alias("last"))
    return sums.join(last, "key").select("key", slope.alias("slope"), (F.col("mz") - slope * F.col("mx")).alias("intercept"), "last")


def ar1_forecast(train: DataFrame, steps: int) -> DataFrame:
    """The recursion yhat = intercept + slope * yhat, summed up: slope ** h and a geometric series."""
    fitted = ar1_fit(train).select("*", _steps(steps))
    power = F.pow("slope", F.col("step"))
    series = F.when(F.abs(F.col("slope") - 1) < 1e-9, F.col("step").cast("double")).otherwise((1 - power) / F.nullif(1 - F.col("slope"), F.lit(0.0)))
    return fitted.select("key", "step", (power * F.col("last") + F.col("intercept") * series).alias("yhat"))


class Baseline:
    """Wraps a forecasting function as a series model."""

    def __init__(self, function, **settings):
        self.function, self.settings = function, settings
        self.train: DataFrame | None = None

    def fit(self, train: DataFrame) -> "Baseline":
        out = Baseline(self.function, **self.settings)
        out.train = train
        return out

    def forecast(self, steps: int) -> DataFrame:
        return self.function(self.train, steps, **self.settings)
