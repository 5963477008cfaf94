"""Trees grown level by level on histograms of gradients and Hessians.

Features are coded once into at most ``BINS`` bins: one per value where a feature has few values, else between approximate
quantiles. A level is one pass: tasks find the node of each row and add up gradient, Hessian and rows per node, feature and bin;
Spark adds the cells, and one small group per node picks the split. Only splits come to the driver, which holds the
model. The pass emits cells that have rows, so a deep level costs no more than the table itself.

* ``HistogramBoosting``: second-order boosting (Chen & Guestrin, KDD 2016): split gain and leaf values with an L2 penalty,
  least Hessian per child, row subsampling by a hash of the row id.
* ``HistogramTree``: one tree on the label itself; for labels 0 and 1 the gain is that of the Gini index. ``min_samples_split``
  is a rule on the node that is split, and without ``max_depth`` a tree grows until its leaves are pure.

A missing value counts as less than all others. Equal gains: the first feature, the lowest cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame, functions as F

from benchloom.functions.columns import col
from benchloom.session import checkpointed, fan_out

BINS = 256
KEEP = 10  # trees after which the margins are written out
CODED = "id bigint, label double, bins binary, margin double"
CELLS = "node int, cell bigint, g double, h double, n double"


@dataclass
class Tree:
    """Node k: rows with code <= cut of a feature go to left[k], others to right[k]; a leaf (feature -1) has a value."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        at = len(self.feature)
        for values, new in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
            values += [new, new]
        self.feature[node], self.cut[node], self.left[node], self.right[node] = feature, cut, at, at + 1
        return at, at + 1

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        """The leaf of each row of codes."""
        feature, cut, left, right = map(np.asarray, (self.feature, self.cut, self.left, self.right))
        at = np.zeros(len(codes), dtype=np.int64)
        while True:
            inner = np.flatnonzero(feature[at] >= 0)
            if not len(inner):
                return at
            k = at[inner]
            at[inner] = np.where(codes[inner, feature[k]] <= cut[k], left[k], right[k])

    def predict(self, codes: np.ndarray) -> np.ndarray:
        return np.asarray(self.value)[self.nodes(codes)]


def coded(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin numbers: how many cuts a value is above; missing values are in bin 0."""
    out = np.zeros(x.shape, dtype=np.uint8)
    for j, own in enumerate(cuts):
        out[:, j] = np.searchsorted(own, np.where(np.isnan(x[:, j]), -np.inf, x[:, j]), side="left")
    return out


def _rows(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def find_cuts(df: DataFrame, size: int, bins: int = BINS) -> list[np.ndarray]:
    """Per feature, the values that splits may compare with: all but the largest of few values, else quantiles."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray | None] = [np.zeros(0)] * size
        for b in batches:
            x = _rows(b.column(0), size)
            for j, own in enumerate(held):
                if own is not None:
                    values = np.unique(np.concatenate([own, x[~np.isnan(x[:, j]), j]]))
                    held[j] = values if len(values) <= bins else None
        flat = [(j, v) for j, own in enumerate(held) for v in ([None] if own is None else own.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array([j for j, _ in flat], pa.int32()), pa.array([v for _, v in flat], pa.float64())], names=["j", "v"])

    found = df.select("features").mapInArrow(distinct, "j int, v double").groupBy("j").agg(
        F.max(F.col("v").isNull()).alias("many"), F.count_distinct("v").alias("n"), F.collect_set("v").alias("values")
    )
    few = found.select("j", F.when(~F.col("many") & (F.col("n") <= bins), F.col("values")).alias("values")).collect()  # features x bins
    cuts = [np.zeros(0)] * size
    many = []
    for r in few:
        if r["values"] is None:
            many.append(r.j)
        else:
            cuts[r.j] = np.sort(np.array(r["values"]))[:-1]
    if many:
        wide = df.select(*[F.nanvl(F.col("features")[j], F.lit(None).cast("double")).alias(f"f{j}") for j in many])
        probs = [k / bins for k in range(1, bins)]
        for j, values in zip(many, wide.approxQuantile([f"f{j}" for j in many], probs, 1 / (4 * bins)), strict=True):
            cuts[j] = np.unique(np.array(values))
    return cuts


class Grower:
    """Grows trees on a coded table (id, label, bins, margin).

    `residual`: slopes are taken at the value of the parent, so that sums stay small where few rows are left.
    """

    def __init__(
        self, size: int, n_bins: int, lam: float, gamma: float, min_child: float, min_split: int, max_depth: int | None, residual: bool = False,
    ):
        self.residual, self.size, self.n_bins, self.lam, self.gamma = residual, size, n_bins, lam, gamma
        self.min_child, self.min_split, self.max_depth = min_child, min_split, max_depth

    def cells(self, rows: DataFrame, tree: Tree, open_nodes: list[int], slopes) -> DataFrame:
        """Sums of gradient, Hessian and rows per open node and (feature, bin)."""
        size, bins, residual = self.size, self.n_bins, self.residual
        values = np.asarray(tree.value)
        is_open = np.zeros(len(tree.feature), dtype=bool)
        is_open[open_nodes] = True

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids, label, codes, margin = _unpacked(b, size)
                node = tree.nodes(codes)
                g, h, used = slopes(ids, label, codes, margin + values[node] if residual else margin)
                here = np.flatnonzero(is_open[node] & used)
                if not len(here):
                    continue
                key = (node[here, None] * size + np.arange(size)) * bins + codes[here]
                keys, place = np.unique(key, return_inverse=True)
                sums = [np.bincount(place.reshape(-1), np.repeat(v[here], size), len(keys)) for v in (g, h, np.ones(len(ids)))]
                own, cell = np.divmod(keys, size * bins)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int32()), pa.array(cell, pa.int64()), *map(pa.array, sums)], names=["node", "cell", "g", "h", "n"]
                )

        parts = rows.mapInArrow(run, CELLS)
        return parts.groupBy("node", "cell").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")])

    def best(self, cells: DataFrame) -> list:
        """One row per node: its sums, and feature, cut and gain of the best split (feature -1 without one)."""
        size, bins, lam, gamma, least, min_split = self.size, self.n_bins, self.lam, self.gamma, self.min_child, self.min_split

        def pick(pdf: pd.DataFrame) -> pd.DataFrame:
            table = np.zeros((3, size * bins))
            table[:, pdf["cell"].to_numpy()] = pdf[["g", "h", "n"]].to_numpy().T
            table = table.reshape(3, size, bins)
            total = table[:, 0].sum(axis=1)
            g, h, n = np.cumsum(table, axis=2)[:, :, :-1]
            other_g, other_h, other_n = (t - own for t, own in zip(total, (g, h, n), strict=True))
            with np.errstate(all="ignore"):
                gain = 0.5 * (g * g / (h + lam) + other_g * other_g / (other_h + lam) - total[0] ** 2 / (total[1] + lam)) - gamma
            allowed = (n > 0) & (other_n > 0) & (h >= least) & (other_h >= least) & (total[2] >= min_split)
            gain = np.where(allowed & np.isfinite(gain), gain, -np.inf)
            at = int(np.argmax(gain)) if gain.size else 0
            good = gain.size and gain.reshape(-1)[at] > 1e-12 * max(1.0, total[0] ** 2 / (total[1] + lam))
            feature, cut = divmod(at, bins - 1) if good else (-1, 0)
            return pd.DataFrame([{"node": pdf["node"].iloc[0], "g": total[0], "h": total[1], "n": total[2], "feature": feature, "cut": cut}])

        # a node is a group of at most features x bins cells
        spread = cells.repartition(fan_out(cells.sparkSession), "node")
        return spread.groupBy("node").applyInPandas(pick, "node int, g double, h double, n double, feature int, cut int").collect()

    def grow(self, rows: DataFrame, slopes, shrink: float) -> Tree:
        tree, open_nodes, depth = Tree(), [0], 0
        while open_nodes:
            found = self.best(self.cells(rows, tree, open_nodes, slopes))
            open_nodes = []
            for r in found:
                own = -shrink * r.g / (r.h + self.lam) if r.h + self.lam > 0 else 0.0
                tree.value[r.node] = tree.value[r.node] + own if self.residual else own
                if r.feature >= 0 and (self.max_depth is None or depth < self.max_depth):
                    children = tree.split(r.node, r.feature, r.cut)
                    for child in children:
                        tree.value[child] = tree.value[r.node]
                    open_nodes += children
            depth += 1
        return tree


def _unpacked(b: pa.RecordBatch, size: int):
    ids, label, margin = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3))
    codes = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint8).reshape(-1, size)
    return ids, label, codes, margin


def _coded_table(df: DataFrame, cuts: list[np.ndarray], base: float) -> DataFrame:
    size = len(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = coded(_rows(b.column(2), size), cuts)
            packed = pa.array([row.tobytes() for row in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), packed, pa.array(np.full(len(codes), base))], names=["id", "label", "bins", "margin"])

    labelled = df.filter(F.col("label").isNotNull())
    return labelled.select(col("row_id").cast("bigint"), col("label").cast("double"), "features").mapInArrow(run, CODED)


def _with_margins(rows: DataFrame, trees: list[Tree], size: int) -> DataFrame:
    """Add what the trees say to the margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, _, codes, margin = _unpacked(b, size)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(margin + sum(t.predict(codes) for t in trees))], names=["id", "label", "bins", "margin"])

    return rows.mapInArrow(run, CODED)


class HistogramModel(Model):
    def __init__(self, trees: list[Tree], cuts: list[np.ndarray], base: float, kind: str):
        super().__init__()
        self.trees, self.cuts, self.base, self.kind = trees, cuts, base, kind

    def raw(self, x: np.ndarray) -> np.ndarray:
        codes = coded(x, self.cuts)
        return self.base + sum((t.predict(codes) for t in self.trees), np.zeros(len(x)))

    def _transform(self, df: DataFrame) -> DataFrame:
        trees, size, kind = self.raw, len(self.cuts), self.kind

        @F.pandas_udf("double")
        def raw(features: pd.Series) -> pd.Series:
            step = max(1, 2_000_000 // size)
            parts = [trees(np.stack(features.iloc[at : at + step].to_numpy()).astype(float)) for at in range(0, len(features), step)]
            return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

        out = df.withColumn("_raw", raw("features"))
        if kind == "regression":
            prediction, prob = F.col("_raw"), F.lit(None).cast("double")
        else:
            prob = F.col("_raw") if kind == "share" else 1 / (1 + F.exp(-F.col("_raw")))
            prediction = (prob > 0.5).cast("double")
        return out.select(*[col(c) for c in df.columns], prediction.alias("prediction"), prob.alias("prob"))


def _start(df: DataFrame, classify: bool) -> tuple[int, float]:
    r = df.filter(F.col("label").isNotNull()).agg(
        F.max(F.size("features")).alias("d"), F.avg("label").alias("mean"), F.min("label").alias("low"), F.max("label").alias("high"),
        F.count_if((F.col("label") != 0) & (F.col("label") != 1)).alias("odd"),
    ).first()
    if r.d is None:
        raise ValueError("no labelled rows to fit on")
    if classify and r.odd:
        raise ValueError("labels are 0 and 1")
    return r.d, r.mean


class HistogramBoosting(Estimator):
    """Second-order boosting for labels 0 and 1 (`classify`, log loss) or numbers (squared error)."""

    def __init__(
        self, classify: bool, n_estimators: int = 100, learning_rate: float = 0.1, max_depth: int = 6, subsample: float = 1.0,
        reg_lambda: float = 1.0, gamma: float = 0.0, min_child_weight: float = 1.0, seed: int = 42,
    ):
        super().__init__()
        self.classify, self.n, self.rate, self.depth, self.share = classify, n_estimators, learning_rate, max_depth, subsample
        self.lam, self.gamma, self.min_child, self.seed = reg_lambda, gamma, min_child_weight, seed

    def _slopes(self, number: int, pending: list[Tree]):
        classify, share, seed = self.classify, self.share, self.seed

        def slopes(ids, label, codes, margin):
            margin = margin + sum(t.predict(codes) for t in pending)
            if classify:
                p = 1 / (1 + np.exp(-margin))
                g, h = p - label, p * (1 - p)
            else:
                g, h = margin - label, np.ones(len(label))
            return g, h, np.ones(len(ids), bool) if share >= 1 else _drawn(ids, number, seed) < share

        return slopes

    def _fit(self, df: DataFrame) -> HistogramModel:
        size, mean = _start(df, self.classify)
        cuts = find_cuts(df, size)
        base = float(np.log(mean / (1 - mean))) if self.classify and 0 < mean < 1 else 0.0 if self.classify else float(mean)
        rows = checkpointed(_coded_table(df, cuts, base))
        grower = Grower(size, max(map(len, cuts)) + 1, self.lam, self.gamma, self.min_child, 2, self.depth)
        trees: list[Tree] = []
        pending: list[Tree] = []
        for number in range(self.n):
            tree = grower.grow(rows, self._slopes(number, list(pending)), self.rate)
            trees.append(tree)
            pending.append(tree)
            if len(pending) == KEEP and number + 1 < self.n:
                rows, pending = checkpointed(_with_margins(rows, pending, size)), []
        return HistogramModel(trees, cuts, base, "logistic" if self.classify else "regression")


def _drawn(ids: np.ndarray, number: int, seed: int) -> np.ndarray:
    """A uniform number for each row and tree, by the finalizer of a 64-bit mix."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) + np.uint64((seed * 1_000_003 + number + 1) & 0xFFFFFFFF) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


class HistogramTree(Estimator):
    """One tree on the label itself: the mean in each leaf, which is the share of ones where labels are 0 and 1 (`classify`)."""

    def __init__(self, classify: bool, max_depth: int | None = None, min_samples_split: int = 2):
        super().__init__()
        self.classify, self.depth, self.min_split = classify, max_depth, max(2, min_samples_split)

    def _fit(self, df: DataFrame) -> HistogramModel:
        size, mean = _start(df, self.classify)
        cuts = find_cuts(df, size)
        rows = checkpointed(_coded_table(df, cuts, float(mean)))
        grower = Grower(size, max(map(len, cuts)) + 1, 0.0, 0.0, 0.0, self.min_split, self.depth, residual=True)
        tree = grower.grow(rows, lambda ids, label, codes, margin: (margin - label, np.ones(len(label)), np.ones(len(label), bool)), 1.0)
        return HistogramModel([tree], cuts, float(mean), "share" if self.classify else "regression")
