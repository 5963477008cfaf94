"""Train/test split and fold assignment, exact in size and independent of partitioning."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from benchloom.functions.columns import col
from benchloom.operators.ordering import BROADCAST_ROWS, _same, hash_rank, mark_smallest, ordered_scan, positions
from benchloom.session import checkpointed


def _class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(col(label)).agg(F.count("*").alias("n"))


def class_quotas(sizes: dict, n_train: int) -> dict:
    """Training rows of each class by largest remainders (equal remainders: smaller class)."""
    total = sum(sizes.values())
    quota = {c: n * n_train // total for c, n in sizes.items()}
    rest = n_train - sum(quota.values())
    order = sorted(sizes, key=lambda c: (-(sizes[c] * n_train % total), c is not None, c))
    for c in order[:rest]:
        quota[c] += 1
    return quota


def _quota_table(df: DataFrame, label: str, test_size: float) -> DataFrame | None:
    """(label, _quota): `class_quotas` for any number of classes; None where the classes cannot be split in proportion."""
    counts = checkpointed(_class_counts(df, label))
    total, classes, least = counts.agg(F.sum("n"), F.count("*"), F.min("n")).first()
    n_test = math.ceil(total * test_size)
    n_train = total - n_test
    if least < 2 or min(n_train, n_test) < classes:
        return None
    share = F.col("n").cast("decimal(19,0)") * F.lit(n_train).cast("decimal(19,0)")
    parts = counts.select(
        col(label), F.floor(share / F.lit(total)).cast("bigint").alias("_floor"), (-(share % F.lit(total).cast("decimal(19,0)"))).alias("_less")
    )
    rest = n_train - parts.agg(F.sum("_floor")).first()[0]
    placed = positions(parts, [], ["_less", label], "_place", total=classes)
    return placed.select(col(label), (F.col("_floor") + (F.col("_place") <= rest).cast("bigint")).alias("_quota"))


def split_flag(
    df: DataFrame,
    row_id: str | Sequence[str],
    label: str | None = None,
    test_size: float = 0.3,
    seed: int = 42,
    stratify: bool = True,
    name: str = "split",
) -> DataFrame:
    """Add ``split`` = 'train' / 'test' with exactly ceil(rows * test_size) test rows.

    With ``stratify`` every class is split in proportion; like the usual libraries this falls back to a plain
    split when a class has fewer than two rows or a side has fewer rows than there are classes.
    """
    ids = [row_id] if isinstance(row_id, str) else list(row_id)
    sizes: dict = {}
    if label is not None and stratify:
        rows = _class_counts(df, label).limit(BROADCAST_ROWS + 1).collect()
        if len(rows) > BROADCAST_ROWS:
            # too many classes to list: ranks within classes and a table of quotas give the same split with a shuffle
            quotas = _quota_table(df, label, test_size)
            if quotas is not None:
                ranked = _same(hash_rank(df, ids, seed, "split", [label], "_rank"), quotas, [label], "inner")
                side = F.when(F.col("_rank") <= F.col("_quota"), "train").otherwise("test")
                return ranked.withColumn(name, side).drop("_rank", "_quota")
        else:
            sizes = {r[0]: r["n"] for r in rows}
    total = sum(sizes.values()) if sizes else df.count()
    n_test = math.ceil(total * test_size)
    n_train = total - n_test
    if sizes and min(sizes.values()) >= 2 and min(n_train, n_test) >= len(sizes):
        flagged = mark_smallest(df, ids, seed, "split", class_quotas(sizes, n_train), sizes, by=label, name="_train")
    else:
        flagged = mark_smallest(df, ids, seed, "split", n_train, total, name="_train")
    return flagged.withColumn(name, F.when(F.col("_train"), "train").otherwise("test")).drop("_train")


def split_data(
    df: DataFrame, row_id: str | Sequence[str], label: str | None = None, test_size: float = 0.3, seed: int = 42, stratify: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(train, test) DataFrames."""
    flagged = split_flag(df, row_id, label, test_size, seed, stratify)
    return (
        flagged.filter(F.col("split") == "train").drop("split"),
        flagged.filter(F.col("split") == "test").drop("split"),
    )


def kfold_assign(df: DataFrame, row_id: str | Sequence[str], k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Add a fold number 0..k-1; fold sizes differ by at most one row."""
    ids = [row_id] if isinstance(row_id, str) else list(row_id)
    ranked = hash_rank(df, ids, seed, "fold", name="_rank")
    return ranked.withColumn(name, ((F.col("_rank") - 1) % k).cast("int")).drop("_rank")


def stratified_fold_assign(
    df: DataFrame, row_id: str | Sequence[str], label: str, k: int = 5, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Add a fold number 0..k-1; sizes differ by at most one row per class and in total.

    Rows are numbered class after class; the number is the class's offset plus the rank within the class, and
    ranks come from hash buckets, so a class with a third of all rows is not sorted in one task.
    """
    ids = [row_id] if isinstance(row_id, str) else list(row_id)
    counts = _class_counts(df, label)
    largest, classes = counts.agg(F.max("n"), F.count("*")).first()
    largest = largest or 0
    if k > largest:
        raise ValueError(f"{k} folds asked for, but no class has that many rows (largest: {largest})")
    ranked = hash_rank(df, ids, seed, "fold", by=[label], name="_rank")
    offsets = ordered_scan(counts, [], [label], sums={"_upto": F.col("n")}, total=classes).select(col(label), (F.col("_upto") - F.col("n")).alias("_offset"))
    if classes <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    out = _same(ranked, offsets, [label], "inner")
    return out.withColumn(name, ((F.col("_offset") + F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_offset")
