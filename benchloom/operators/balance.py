"""Class rebalancing: synthetic over-sampling, random under-sampling, both.

Tables hold (row_id BIGINT, label, features ARRAY<DOUBLE>).  Synthetic rows are numbered
downwards from 0 (or from the smallest id, if negative), so they do not collide with real rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from benchloom.functions.columns import col
from benchloom.functions.hashing import uniform
from benchloom.operators.neighbors import knn_join
from benchloom.operators.ordering import BROADCAST_ROWS, hash_rank, mark_smallest
from benchloom.session import checkpointed


def _sizes(df: DataFrame, label: str) -> dict:
    """Rows per class.  The number of classes is checked before they are brought to the driver."""
    counts = df.filter(col(label).isNotNull()).groupBy(col(label).alias("c")).agg(F.count("*").alias("n"))
    rows = counts.limit(BROADCAST_ROWS + 1).collect()
    if len(rows) > BROADCAST_ROWS:
        raise ValueError("the label has too many distinct values to be a class label")
    return {r["c"]: r["n"] for r in sorted(rows, key=lambda r: r["c"])}


def smote_plan(sizes: dict, strategy: str | float = "auto") -> dict:
    """New rows per class: up to the majority size, or to ratio x majority for a two-class label."""
    if not sizes:
        return {}
    majority = max(sizes, key=lambda c: sizes[c])
    if strategy == "auto":
        return {c: sizes[majority] - n for c, n in sizes.items() if c != majority and sizes[majority] > n}
    if isinstance(strategy, str):
        raise ValueError(f"unknown sampling strategy {strategy!r}")
    if len(sizes) != 2:
        raise ValueError("a ratio is only defined for two classes")
    minority = next(c for c in sizes if c != majority)
    new = int(strategy * sizes[majority] - sizes[minority])
    if new < 0:
        raise ValueError(f"the ratio {strategy} is below the present ratio of the classes")
    return {minority: new} if new else {}


def smote(
    df: DataFrame,
    label: str = "label",
    strategy: str | float = "auto",
    seed: int = 42,
    k: int = 5,
    row_id: str = "row_id",
    vector: str = "features",
    block_rows: int | None = None,
) -> DataFrame:
    """Add synthetic minority rows x_s + lambda * (x_nn - x_s) between a row and one of its k nearest class mates.

    Draws are counted per class by a distributed range; seed row, neighbour and lambda come from hashes of the
    draw number.  Only rows that were drawn are joined with their neighbours.
    """
    sizes = _sizes(df, label)
    src = df.select(col(row_id).cast("bigint").alias("row_id"), col(label).alias("label"), col(vector).cast("array<double>").alias("features"))
    plan = smote_plan(sizes, strategy)
    safe_k = min(k, min(sizes.values()) - 1) if sizes else 0
    if safe_k < 1 or not plan:
        return src
    spark = df.sparkSession
    kind = src.schema["label"].dataType
    draws, before = None, 0
    for c, new in plan.items():
        part = spark.range(1, new + 1).select(
            F.lit(c).cast(kind).alias("label"), F.col("id").alias("i"), (F.col("id") + before).alias("number"), F.lit(sizes[c]).alias("n_c")
        )
        before += new
        draws = part if draws is None else draws.unionByName(part)
    key = [F.col("label"), F.col("i")]
    draws = draws.select(
        "label", "number",
        (F.floor(uniform(seed, "row", *key) * F.col("n_c")) + 1).alias("pos"),
        (F.floor(uniform(seed, "nn", *key) * safe_k) + 1).alias("rank"),
        uniform(seed, "lam", *key).alias("lam"),
    )
    minority = src.filter(F.col("label").isin(list(plan)))
    numbered = checkpointed(hash_rank(minority, ["row_id"], seed, "smote", by=["label"], name="pos"))
    drawn = draws.join(numbered, ["label", "pos"]).select("label", "number", "rank", "lam", "row_id", F.col("features").alias("x"))
    seeds = numbered.join(draws.select("label", "pos").distinct(), ["label", "pos"], "left_semi")
    near = knn_join(seeds, numbered, safe_k, group="label", exclude_self=True, block_rows=block_rows)
    near = near.select(F.col("query_id").alias("row_id"), "rank", "neighbor_id")
    other = numbered.select(F.col("row_id").alias("neighbor_id"), F.col("features").alias("x_nn"))
    new_rows = (
        drawn.join(near, ["row_id", "rank"]).join(other, "neighbor_id")
        .withColumn("features", F.zip_with("x", "x_nn", lambda a, b: a + F.col("lam") * (b - a)))
    )
    lowest = F.least(F.lit(0).cast("bigint"), src.agg(F.min("row_id")).scalar())
    return src.unionByName(new_rows.select((lowest - F.col("number")).alias("row_id"), "label", "features"))


def undersample_quota(sizes: dict, strategy: str | float = "auto") -> dict:
    """Rows kept per class: the minority size, or minority / ratio for the majority of a two-class label."""
    low = min(sizes.values())
    if strategy == "auto":
        return {c: low for c in sizes}
    if isinstance(strategy, str):
        raise ValueError(f"unknown sampling strategy {strategy!r}")
    if len(sizes) != 2:
        raise ValueError("a ratio is only defined for two classes")
    minority = min(sizes, key=lambda c: sizes[c])
    majority = next(c for c in sizes if c != minority)
    keep = int(low / strategy)
    if keep > sizes[majority]:
        raise ValueError(f"the ratio {strategy} is below the present ratio of the classes")
    return {minority: low, majority: keep}


def undersample(
    df: DataFrame, label: str = "label", strategy: str | float = "auto", seed: int = 42, row_id: str = "row_id"
) -> DataFrame:
    """Keep a random (hash-ordered) subset of the larger classes."""
    sizes = _sizes(df, label)
    if not sizes:
        return df
    marked = mark_smallest(df, [row_id], seed, "under", undersample_quota(sizes, strategy), sizes, by=label, name="_keep")
    return marked.filter("_keep").drop("_keep")


def combined(
    df: DataFrame, label: str = "label", smote_ratio: float = 0.5, under_ratio: float = 1.0, seed: int = 42, k: int = 5
) -> DataFrame:
    """Over-sample to one ratio, then under-sample to another."""
    return undersample(smote(df, label, smote_ratio, seed, k), "label", under_ratio, seed)


def apply_balancing(df: DataFrame, technique: str = "none", label: str = "label", seed: int = 42) -> DataFrame:
    """'smote', 'undersample' (or 'under'), 'combined'; anything else leaves the table as it is."""
    technique = str(technique).lower()
    if technique == "smote":
        return smote(df, label, seed=seed)
    if technique in ("undersample", "under"):
        return undersample(df, label, seed=seed)
    if technique == "combined":
        return combined(df, label, seed=seed)
    return df
