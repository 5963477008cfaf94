"""Approximate nearest neighbours by bucketed random projections with several probes.

A table of buckets cuts a few random directions into intervals; rows in one interval of all of them share a bucket. A query
looks into its own bucket of each table and into those next to it that it is closest to (multi-probe, Lv et al., VLDB
2007). What meets in a bucket is measured exactly, so every distance returned is right; a neighbour is missed where no probe
leads to its bucket. For Euclidean distance, where exact search can rule out too little.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from benchloom.functions.columns import col
from benchloom.functions.hashing import hash_key
from benchloom.operators.neighbor_tree import meet
from benchloom.operators.neighbors import BLOCK_ROWS, _best, _block
from benchloom.session import checkpointed

SAMPLE = 2000  # rows that the default width is read from


class Projections:
    """`tables` x `bits` random directions, cut into intervals of one width."""

    def __init__(self, size: int, tables: int, bits: int, width: float, seed: int):
        rng = np.random.default_rng(seed)
        self.tables, self.bits, self.width = tables, bits, width
        self.directions = rng.normal(size=(size, tables * bits))
        self.offsets = rng.random(tables * bits) * width
        self.mix = rng.integers(1, 1 << 62, size=bits) | 1

    def _places(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = (x @ self.directions + self.offsets) / self.width
        at = at.reshape(len(x), self.tables, self.bits)
        return np.floor(at).astype(np.int64), at - np.floor(at)

    def _keys(self, places: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (places * self.mix).sum(axis=-1)

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables): the bucket of each row."""
        return self._keys(self._places(x)[0])

    def probes(self, x: np.ndarray, n: int) -> np.ndarray:
        """(rows, tables, 1 + n): the own bucket, then the nearest by the squared distances to the walls crossed (one or two)."""
        places, within = self._places(x)
        gaps = np.concatenate([within, 1 - within], axis=2) ** 2  # below, above
        moves = [(i,) for i in range(2 * self.bits)] + [
            (i, j) for i in range(2 * self.bits) for j in range(i) if (i - j) % self.bits
        ]
        steps = np.zeros((len(moves), self.bits), dtype=np.int64)
        for k, move in enumerate(moves):
            for i in move:
                steps[k, i % self.bits] += 1 if i >= self.bits else -1
        cost = np.stack([sum(gaps[:, :, i] for i in move) for move in moves], axis=2)
        nearest = np.argsort(cost, axis=2, kind="stable")[:, :, : max(0, min(n, len(moves)))]
        all_places = np.concatenate([places[:, :, None, :], places[:, :, None, :] + steps[nearest]], axis=2)
        return self._keys(all_places)


def _width(base: DataFrame, k: int) -> tuple[int, float]:
    """(dimension, a width of a few times the distance to the k-th neighbour), from the first SAMPLE rows in hash order."""
    rows = base.orderBy(hash_key(7, "width", F.col("bid")), "bid").limit(SAMPLE).select("vec").collect()
    if not rows:
        raise ValueError("the base side has no rows")
    x = np.array([r.vec for r in rows], dtype=float)
    square = (x * x).sum(axis=1)
    d = np.sqrt(np.maximum(square[:, None] + square[None, :] - 2 * x @ x.T, 0.0))
    near = np.sort(d, axis=1)[:, min(k, len(x) - 1)]
    return x.shape[1], 4 * float(np.median(near)) or 1.0


def similar_rows(
    queries: DataFrame, base: DataFrame, k: int, query_id: str = "row_id", base_id: str = "row_id", vector: str = "features",
    payload: Sequence[str] = (), exclude_self: bool = False, tables: int = 12, bits: int | None = None, probes: int = 16,
    width: float | None = None, seed: int = 7,
) -> DataFrame:
    """(query_id, neighbor_id, distance, rank, *payload) as ``knn_join`` gives them, up to neighbours that no probe finds.

    More tables, more probes, fewer bits or a larger width find more and cost more. Buckets of any size are met in blocks, so
    none is cut short. Queries without anything in their buckets have no rows.
    """
    payload = list(payload)
    q = queries.select(col(query_id).cast("bigint").alias("qid"), col(vector).cast("array<double>").alias("vec"))
    b = base.select(
        col(base_id).cast("bigint").alias("bid"), col(vector).cast("array<double>").alias("vec"), *[col(p).cast("double").alias(p) for p in payload]
    )
    q, b = checkpointed(q), checkpointed(b)
    size, guess = _width(b, k)
    bits = bits or min(12, max(1, round(math.log2(max(2, b.count() / BLOCK_ROWS)))))
    projections = Projections(size, tables, bits, width or guess, seed)

    def keyed(df: DataFrame, keys: DataFrame | None, n: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for r in batches:
                x = r.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, size)
                found = projections.probes(x, n) if n else projections.buckets(x)[:, :, None]
                flat = pa.array(found.reshape(-1), pa.int64())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * found.shape[1] * found.shape[2], pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([*r.columns, lists], names=[*r.schema.names, "keys"])

        names = ["vec", *[c for c in df.columns if c != "vec"]]
        out = df.select(*names)
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields)
        tall = out.mapInArrow(run, f"{fields}, keys array<bigint>").select(*names, F.posexplode("keys").alias("p", "bucket"))
        return tall.withColumn("slot", F.floor(F.col("p") / (n + 1)).cast("int")).drop("p")

    n = min(probes, 2 * bits + 2 * bits * (bits - 1))
    wanted = keyed(q, None, n).distinct()
    rows = checkpointed(keyed(b, None, 0))
    sizes = rows.groupBy("slot", "bucket").agg(F.count("*").alias("n"))
    block, schema = _block(k, "euclidean", payload, exclude_self)
    near = meet(wanted, rows, sizes, ["slot", "bucket"], block, schema, BLOCK_ROWS)
    # several buckets may hold the same neighbour
    once = Window.partitionBy("qid", "neighbor_id").orderBy("distance")
    best = _best(near.withColumn("_n", F.row_number().over(once)).filter("_n = 1").drop("_n"), k)
    return best.select(F.col("qid").alias("query_id"), "neighbor_id", "distance", "rank", *payload)
