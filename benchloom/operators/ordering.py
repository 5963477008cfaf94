"""Ranking and running sums that never put an unbounded group into one task.

Two tools:

* hash order - rows are ranked by a uniform hash, so the leading hex digits cut every group into even
  buckets; ranks are bucket offset + row number within the bucket.  A cut "first n rows by hash" needs no
  sort or shuffle of the data at all: a bucket histogram finds the bucket where the cut falls, only that bucket is
  ranked, and all rows are then compared with the cut key.
* value order - rows are range-partitioned on a unique order key into chunks of bounded size, each chunk
  is handled on its own and chunk totals give the offsets.  Inputs whose counted size fits one chunk take
  the plain window.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from benchloom.functions.columns import col, q
from benchloom.functions.hashing import hash_key
from benchloom.session import checkpointed

ROWS_PER_CHUNK = 1_000_000
HASH_PREFIX = 4  # hex digits: 65,536 buckets per group
HISTOGRAM_DIGITS = 3  # hex digits added per narrowing pass: 4,096 buckets
RANKED_ROWS = 100_000  # a bucket with at most this many counted rows is ranked as it is
LITERAL_GROUPS = 32  # cut keys of at most this many groups become literals, more go into a broadcast table
BROADCAST_ROWS = 100_000  # a lookup with at most this many counted rows is broadcast, a larger one is not


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys where NULL equals NULL; the right side's keys are dropped."""
    renamed = right.select(*[col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    cond = None
    for i, k in enumerate(keys):
        part = col(k).eqNullSafe(F.col(f"_k{i}"))
        cond = part if cond is None else cond & part
    return left.join(renamed, cond, how).drop(*[f"_k{i}" for i in range(len(keys))])


# ------------------------------------------------------------------ hash order

def _with_hash(df: DataFrame, ids: Sequence[str], seed: int, purpose: str) -> DataFrame:
    out = df.withColumn("_h", hash_key(seed, purpose, *[col(i) for i in ids]))
    return out.withColumn("_b", F.substring("_h", 1, HASH_PREFIX))


def _group_text(keys: Sequence[str]) -> Column:
    """The group as one non-null text: windows and joins on it share a partitioning, null-safe joins would not."""
    return F.concat_ws("\u0001", *[F.coalesce(col(k).cast("string"), F.lit("\u0000")) for k in keys])


def hash_rank(
    df: DataFrame, ids: Sequence[str], seed: int, purpose: str, by: Sequence[str] = (), name: str = "rank"
) -> DataFrame:
    """Dense 1-based rank by (hash, ids) within each group of ``by``.

    The rows are shuffled once, by group and hash bucket; the offsets of the buckets (65,536 rows per group) come to them.
    """
    hashed = _with_hash(df, ids, seed, purpose).withColumn("_g", _group_text(by))
    counts = hashed.groupBy("_g", "_b").agg(F.count("*").alias("_n"))
    w = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_g", "_b", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    if not by:
        offsets = F.broadcast(offsets)  # one group: at most 65,536 rows
    inside = Window.partitionBy("_g", "_b").orderBy("_h", *[col(i) for i in ids])
    out = hashed.withColumn("_rn", F.row_number().over(inside)).join(offsets, ["_g", "_b"])
    return out.withColumn(name, F.col("_rn") + F.col("_before")).select(*[col(c) for c in df.columns], name)


def _quota_state(df: DataFrame, by: str, state: Mapping) -> DataFrame:
    """(by, _prefix, _left) as a table of at most one row per group."""
    kind = df.schema[by].dataType.simpleString()
    rows = [(c, prefix, left) for c, (prefix, left, _) in state.items()]
    return F.broadcast(df.sparkSession.createDataFrame(rows, f"{q(by)} {kind}, _prefix string, _left bigint"))


def _cut_keys(slim: DataFrame, ids: Sequence[str], by: str | None, quota: Mapping, sizes: Mapping) -> dict:
    """group -> (hash, *ids) of the row at position ``quota`` of its hash order.

    A histogram of the next hash digits narrows each group to the one bucket that holds the cut; when that is
    small it is ranked.  Every pass is one scan of the slim columns with a map-side combined count.
    """
    # group -> (hash prefix of the bucket, position of the cut inside it, rows inside it)
    state = {c: ("", n, sizes[c]) for c, n in quota.items() if 0 < n < sizes[c]}
    while any(inside > RANKED_ROWS for _, _, inside in state.values()):
        width = max(len(prefix) for prefix, _, _ in state.values()) + HISTOGRAM_DIGITS
        if width > 32 + HISTOGRAM_DIGITS:
            raise ValueError(f"the columns {list(ids)} do not identify a row")
        if by is None:
            inside = slim.filter(F.col("_h").startswith(state[None][0]))
        else:
            inside = _same(slim, _quota_state(slim, by, state), [by], "inner").filter(F.col("_h").startswith(F.col("_prefix")))
        keys = [col(by)] if by else []
        counted = inside.groupBy(*keys, F.substring("_h", 1, width).alias("_p")).agg(F.count("*").alias("_n"))
        # only the bucket with the cut comes back: one row per group
        w = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
        running = counted.withColumn("_upto", F.sum("_n").over(w))
        if by is None:
            left = F.lit(state[None][1])
        else:
            running = _same(running, _quota_state(slim, by, state), [by], "inner")
            left = F.col("_left")
        hit = running.filter((F.col("_upto") >= left) & (F.col("_upto") - F.col("_n") < left))
        hit = hit.select(*keys, "_p", (left - F.col("_upto") + F.col("_n")).alias("_left"), "_n")
        state = {(r[by] if by else None): (r["_p"], r["_left"], r["_n"]) for r in hit.collect()}
    if not state:
        return {}
    if by is None:
        prefix, left, _ = state[None]
        inside = slim.filter(F.col("_h").startswith(prefix)) if prefix else slim
        inside = inside.withColumn("_left", F.lit(left))
        w = Window.orderBy("_h", *[col(i) for i in ids])
    else:
        inside = _same(slim, _quota_state(slim, by, state), [by], "inner").filter(F.col("_h").startswith(F.col("_prefix")))
        w = Window.partitionBy(col(by)).orderBy("_h", *[col(i) for i in ids])
    cut = inside.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == F.col("_left"))
    return {(r[by] if by else None): (r["_h"], *[r[i] for i in ids]) for r in cut.collect()}


def mark_smallest(
    df: DataFrame,
    ids: Sequence[str],
    seed: int,
    purpose: str,
    quota: Mapping | int,
    sizes: Mapping | int,
    by: str | None = None,
    name: str = "selected",
) -> DataFrame:
    """Flag the ``quota`` rows with the smallest (hash, ids), per group of ``by`` when given.

    ``quota`` and ``sizes`` (the counted rows) are numbers, or dicts per group.  The rows are neither sorted nor
    shuffled: once the cut keys are known, the flag is a comparison that every task makes on its own rows.
    """
    kinds = [df.schema[i].dataType for i in ids]
    hashed = df.withColumn("_h", hash_key(seed, purpose, *[col(i) for i in ids]))
    slim = hashed.select(*dict.fromkeys([*([by] if by else []), *ids]), "_h")
    if by is None:
        quota, sizes = {None: int(quota)}, {None: int(sizes)}
    if len(quota) > BROADCAST_ROWS:
        raise ValueError(f"more than {BROADCAST_ROWS} groups in column {by!r}")
    cuts = _cut_keys(slim, ids, by, quota, sizes)
    key = F.struct(F.col("_h"), *[col(i).alias(f"i{n}") for n, i in enumerate(ids)])
    if by is not None and len(quota) > LITERAL_GROUPS:
        kind = df.schema[by].dataType.simpleString()
        spec = f"{q(by)} {kind}, _whole boolean, _c string" + "".join(f", _c{n} {k.simpleString()}" for n, k in enumerate(kinds))
        rows = [(c, n >= sizes[c], *cuts.get(c, (None,) * (len(ids) + 1))) for c, n in quota.items()]
        out = _same(hashed, F.broadcast(df.sparkSession.createDataFrame(rows, spec)), [by], "left")
        bound = F.struct(F.col("_c").alias("_h"), *[F.col(f"_c{n}").alias(f"i{n}") for n in range(len(ids))])
        flag = F.coalesce(F.col("_whole") | (F.col("_c").isNotNull() & (key <= bound)), F.lit(False))
        return out.withColumn(name, flag).drop("_h", "_whole", "_c", *[f"_c{n}" for n in range(len(ids))])
    flag = F.lit(False)
    for c, n in quota.items():
        mine = col(by).eqNullSafe(F.lit(c).cast(df.schema[by].dataType)) if by else F.lit(True)
        if c in cuts:
            values = [F.lit(v).cast(k).alias(f"i{m}") for m, (v, k) in enumerate(zip(cuts[c][1:], kinds))]
            flag = F.when(mine, key <= F.struct(F.lit(cuts[c][0]).alias("_h"), *values)).otherwise(flag)
        else:
            flag = F.when(mine, F.lit(n >= sizes[c] and n > 0)).otherwise(flag)
    return hashed.withColumn(name, flag).drop("_h")


# ------------------------------------------------------------------ value order

def order_chunks(
    df: DataFrame, order: Sequence[str], rows_per_chunk: int = ROWS_PER_CHUNK, total: int | None = None
) -> tuple[DataFrame, int]:
    """Add ``_chunk``: ids that follow the order, each with a bounded number of rows.

    The order columns must identify a row, so that no key is too heavy for a range partition.  Inputs of at
    most ``rows_per_chunk`` rows stay lazy and get the single chunk 0.  ``total`` is the row count, if known.
    """
    if total is None:
        total = df.count()
    if total <= rows_per_chunk:
        return df.withColumn("_chunk", F.lit(0)), 1
    parts = math.ceil(total / rows_per_chunk)
    ranged = df.repartitionByRange(parts, *[col(o) for o in order]).withColumn("_chunk", F.spark_partition_id())
    return checkpointed(ranged), parts


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    lead: Sequence[str] = (),
    rows_per_chunk: int = ROWS_PER_CHUNK,
    total: int | None = None,
) -> DataFrame:
    """Running (inclusive) sums and the next row's values, in order, per key.

    ``lead`` names columns whose next values are returned as ``next_<name>``.
    """
    sums = dict(sums or {})
    chunked, n_chunks = order_chunks(df, [*keys, *order], rows_per_chunk, total)
    chunked = chunked.withColumn("_g", _group_text(keys))
    w = Window.partitionBy("_chunk", "_g").orderBy(*[col(o) for o in order])
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    out = chunked.select(
        *[col(c) for c in chunked.columns],
        *[F.sum(c).over(run).alias(f"_run_{n}") for n, c in sums.items()],
        *([F.lead(F.struct(*[col(c) for c in lead])).over(w).alias("_lead")] if lead else []),
    )
    if n_chunks > 1:
        aggs = [F.sum(c).alias(f"_tot_{n}") for n, c in sums.items()]
        if lead:
            first = F.min_by(F.struct(*[col(c) for c in lead]), F.struct(*[col(o) for o in order]))
            aggs.append(first.alias("_first"))
        per_chunk = chunked.groupBy("_chunk", "_g").agg(*aggs)
        cw = Window.partitionBy("_g").orderBy("_chunk")
        prior = cw.rowsBetween(Window.unboundedPreceding, -1)
        offsets = per_chunk.select(
            "_chunk",
            "_g",
            *[F.coalesce(F.sum(f"_tot_{n}").over(prior), F.lit(0)).alias(f"_off_{n}") for n in sums],
            *([F.lead("_first").over(cw).alias("_next_first")] if lead else []),
        )
        out = out.join(offsets, ["_chunk", "_g"])
        for n in sums:
            out = out.withColumn(f"_run_{n}", F.col(f"_run_{n}") + F.col(f"_off_{n}")).drop(f"_off_{n}")
        if lead:
            out = out.withColumn("_lead", F.coalesce("_lead", "_next_first")).drop("_next_first")
    for n in sums:
        out = out.withColumnRenamed(f"_run_{n}", n)
    for c in lead:
        out = out.withColumn(f"next_{c}", F.col("_lead").getField(c))
    names = [c for c in df.columns if c not in sums]
    return out.select(*[col(c) for c in names], *sums, *[f"next_{c}" for c in lead])


def positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "pos",
    rows_per_chunk: int = ROWS_PER_CHUNK,
    total: int | None = None,
) -> DataFrame:
    """Dense 1-based position of each row in the order of its key."""
    one = F.lit(1).cast("bigint")
    return ordered_scan(df, keys, order, sums={name: one}, rows_per_chunk=rows_per_chunk, total=total)
