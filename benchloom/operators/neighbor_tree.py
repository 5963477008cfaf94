"""A two-level pivot tree for the exact nearest-neighbour join of large tables.

Base rows go to the cell of the nearest of a few top pivots, and within it to the leaf of the nearest of the cell's own
pivots, whose number follows the rows of the cell: leaves stay small however many rows there are. Every row is compared with
the top pivots and with the pivots of a few cells only. A search first visits the nearest leaves that hold enough rows, which
bounds the k-th distance; then the other leaves that the triangle inequality does not rule out, first by cell, then by leaf.

Cells and leaves meet queries in groups of bounded size, dealt out by hashes of the ids; the tables of leaves stay in
Spark. The driver knows the top pivots and, for each group and top pivot, three numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from benchloom.operators.ordering import BROADCAST_ROWS
from benchloom.session import checkpointed, fan_out

ROWS = 50_000  # of a cell that one task compares with the pivots of its leaves
AT = ["grp", "cell"]
LEAF = ["grp", "cell", "leaf"]
SEED = 11


def _share(name: str, salt: int) -> Column:
    """A uniform number in [0, 1) from an id."""
    return F.pmod(F.xxhash64(F.col(name), F.lit(salt)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


class PivotTree:
    """Leaves of a base table (grp, cell, bid, vec, payload), whose cells are known to `cells`."""

    def __init__(self, base: DataFrame, cells, distance: Callable, leaf_rows: int, payload: Sequence[str]):
        self.cells, self.distance, self.leaf_rows, self.payload = cells, distance, leaf_rows, list(payload)
        self.spark = base.sparkSession
        counts = [(g, int(c), int(s[0, c])) for g, s in cells.stats.items() for c in np.flatnonzero(s[0])]
        self.sizes = self.spark.createDataFrame(counts, "grp string, cell int, rows bigint")
        self.n_cells = len(counts)
        wanted = F.ceil(F.col("rows") / F.lit(leaf_rows))
        sampled = base.join(_small(self.sizes, self.n_cells), AT).filter(_share("bid", SEED) < wanted / F.col("rows"))
        # about rows / leaf_rows pivots for each cell; a cell without one is a single leaf around no pivot
        pivots = sampled.groupBy(*AT).agg(F.array_sort(F.collect_list(F.struct("bid", "vec"))).alias("p")).select(*AT, F.col("p.vec").alias("pivots"))
        self.pivots = checkpointed(self.sizes.select(*AT).join(pivots, AT, "left"))
        self.rows = checkpointed(self._located(base))
        stats = self.rows.groupBy(*LEAF).agg(F.count("*").alias("n"), F.min("reach").alias("lo"), F.max("reach").alias("hi"))
        self.stats = checkpointed(stats)
        listed = self.stats.groupBy(*AT).agg(F.array_sort(F.collect_list(F.struct("leaf", "n", "lo", "hi"))).alias("s"))
        self.table = checkpointed(self.pivots.join(listed, AT).select(*AT, "pivots", *[F.col(f"s.{c}").alias(c) for c in ("leaf", "n", "lo", "hi")]))

    def _dealt(self, rows: DataFrame, by: str) -> tuple[DataFrame, DataFrame]:
        """Rows with a part number, so that a cell with many of them is several groups, and the number of parts of each cell."""
        counts = checkpointed(rows.groupBy(*AT).agg(F.ceil(F.count("*") / F.lit(ROWS)).cast("int").alias("parts")))
        parts = _small(counts, self.n_cells)
        return rows.join(parts, AT).withColumn("part", F.floor(_share(by, SEED + 1) * F.col("parts")).cast("int")).drop("parts"), counts

    def _with_table(self, rows: DataFrame, by: str, table: DataFrame, work: Callable, schema: str) -> DataFrame:
        dealt, counts = self._dealt(rows, by)
        copies = table.join(_small(counts, self.n_cells), AT).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        n, keys = fan_out(self.spark), [*AT, "part"]
        return dealt.repartition(n, *keys).groupBy(*keys).cogroup(copies.repartition(n, *keys).groupBy(*keys)).applyInPandas(work, schema)

    def _located(self, base: DataFrame) -> DataFrame:
        distance, payload = self.distance, self.payload
        names = ["bid", "vec", "grp", "cell", "leaf", "reach", *payload]

        def locate(rows: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
            if rows.empty:
                return pd.DataFrame({c: [] for c in names}, dtype=object)
            pivots = _stack(table["pivots"].iloc[0])
            if pivots is None:
                rows["leaf"], rows["reach"] = 0, 0.0
            else:
                found = [(d.argmin(axis=1), d.min(axis=1)) for d in _distances(rows["vec"], pivots, distance)]
                rows["leaf"], rows["reach"] = np.concatenate([f[0] for f in found]).astype(np.int32), np.concatenate([f[1] for f in found])
            return rows[names]

        extra = "".join(f", `{p}` double" for p in payload)
        schema = f"bid bigint, vec array<double>, grp string, cell int, leaf int, reach double{extra}"
        return self._with_table(base.select("bid", "vec", *AT, *payload), "bid", self.pivots, locate, schema)

    def leaves(self, queries: DataFrame, bounded: bool) -> DataFrame:
        """(qid, vec, grp, cell, leaf, and the bound where `bounded`) to visit. `queries`: qid, vec, grp, cells (a list), and where `bounded` the
        bound on the k-th distance and `first`, the cells of the first visit, whose nearest leaves are left out."""
        distance, need, kept = self.distance, self.cells.need, ["bound"] if bounded else []
        wide = queries.select(*[c for c in queries.columns if c != "cells"], F.explode("cells").alias("cell"))
        if bounded:
            wide = wide.withColumn("seen", F.array_contains("first", F.col("cell"))).drop("first")

        def choose(rows: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
            if rows.empty or table.empty:
                return pd.DataFrame({c: [] for c in ["qid", "vec", *LEAF, *kept]}, dtype=object)
            one = table.iloc[0]
            pivots, leaf, n = _stack(one["pivots"]), np.asarray(one["leaf"]), np.asarray(one["n"])
            lo, hi = np.asarray(one["lo"]), np.asarray(one["hi"])
            found, at = [], 0
            for d in _distances(rows["vec"], pivots if pivots is not None else np.zeros((1, len(rows["vec"].iloc[0]))), distance):
                d = d[:, leaf] if pivots is not None else np.zeros((len(d), 1))
                part = rows.iloc[at : at + len(d)]
                order = np.argsort(d, axis=1, kind="stable")
                before = np.cumsum(n[order], axis=1) - n[order]
                mask = np.zeros(d.shape, dtype=bool)
                np.put_along_axis(mask, order, before < need, axis=1)
                if bounded:
                    limit = part["bound"].fillna(np.inf).to_numpy()
                    least = np.maximum(d - hi, lo - d) if pivots is not None else d
                    reach = least <= (limit * (1 + 1e-9) + 1e-9)[:, None]
                    mask = reach & ~(mask & part["seen"].to_numpy(dtype=bool)[:, None])
                r, c = np.nonzero(mask)
                found.append(pd.DataFrame({
                    "qid": part["qid"].to_numpy()[r], "vec": part["vec"].to_numpy()[r], "grp": one["grp"], "cell": one["cell"], "leaf": leaf[c],
                    **{name: part[name].to_numpy()[r] for name in kept},
                }))
                at += len(d)
            return pd.concat(found, ignore_index=True)

        schema = "qid bigint, vec array<double>, grp string, cell int, leaf int" + (", bound double" if bounded else "")
        return self._with_table(wide, "qid", self.table, choose, schema)

    def visit(self, wanted: DataFrame, block: Callable, schema: str, block_rows: int) -> DataFrame:
        """Whatever `block(queries, rows)` returns for the queries and rows of each leaf."""
        return meet(wanted, self.rows.drop("reach"), self.stats, LEAF, block, schema, block_rows)


def meet(
    wanted: DataFrame, rows: DataFrame, sizes: DataFrame, keys: Sequence[str], block: Callable, schema: str, block_rows: int,
) -> DataFrame:
    """`block(queries, rows)` for queries (qid) and rows (bid) with equal keys, both cut into blocks of about `block_rows`.

    `sizes`: the number of rows, n, of each key. Every row goes to a key once for each block of its queries.
    """
    wanted = checkpointed(wanted)
    asked = wanted.groupBy(*keys).agg(F.count("*").alias("q"))
    blocks = checkpointed(asked.join(sizes, [*keys]).select(
        *keys, *[F.ceil(F.col(c) / F.lit(block_rows)).cast("int").alias(name) for c, name in (("q", "qsplits"), ("n", "bsplits"))]
    ))
    blocks = _small(blocks, blocks.count())
    by = [*keys, "qblock", "bblock"]

    def cut(table: DataFrame, name: str, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        table = table.join(blocks, [*keys]).withColumn(own, F.pmod(F.xxhash64(name), F.col(mine)).cast("int"))
        return table.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(theirs) - 1))).drop("qsplits", "bsplits")

    n = fan_out(wanted.sparkSession)
    left = cut(wanted, "qid", "qblock", "bblock", "qsplits", "bsplits").repartition(n, *by)
    right = cut(rows, "bid", "bblock", "qblock", "bsplits", "qsplits").repartition(n, *by)
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(block, schema)


def _stack(pivots) -> np.ndarray | None:
    return None if pivots is None or len(pivots) == 0 else np.stack([np.asarray(p, dtype=float) for p in pivots])


def _distances(vectors: pd.Series, pivots: np.ndarray, distance: Callable):
    """Distances to all pivots, a bounded number of rows at a time."""
    step = max(1, 4_000_000 // pivots.size)
    for at in range(0, len(vectors), step):
        yield distance(np.stack(vectors.iloc[at : at + step].to_numpy()).astype(float), pivots)
