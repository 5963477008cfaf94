"""Chat logs: collapse cumulative snapshots, then render.

A conversation that was logged after every turn appears as many conversations, each a prefix of the next. Every turn has a
rolling hash of all turns up to it: the exclusive-or of hashes of (position, role, text), 128 bits, which can be summed in
any order and by parts. A conversation goes when its whole hash and length equal a proper prefix of another one
(anti-join); of equal conversations the smallest id stays.

Running values are taken within stretches of CHUNK turn numbers, and stretch totals give the offsets, so one conversation
may hold any share of the rows. Prefixes are made distinct before the join: a first turn that many share is one row there.

Defined cases: turns are ordered by turn, then role and text (nulls first); a null role or text differs from an empty one; rows
with a null conv_id belong to one conversation of that name; repeated rows are turns of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchloom.llm.common import quoted

CHUNK = 1000


def _hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "pos", F.col("role").isNull(), "role", F.col("text").isNull(), "text")


def turns_of(logs: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, pos (from 1), role, text and the rolling hashes p1, p2."""
    rows = logs.select(
        quoted(conv_id).alias("conv"), quoted(turn).alias("turn"), quoted(role).alias("role"), quoted(text).alias("text"),
        F.coalesce(F.floor(quoted(turn) / CHUNK), F.lit(-(2**62))).alias("chunk"),
    )
    # the key of a conversation as a text, so that null is a name like any other
    rows = rows.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("")))
    inside = Window.partitionBy("key", "chunk").orderBy(F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text"))
    chunks = Window.partitionBy("key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("key", "chunk").agg(F.count("*").alias("n"))
    sizes = sizes.select("key", "chunk", F.coalesce(F.sum("n").over(chunks), F.lit(0)).alias("before"))
    placed = rows.withColumn("place", F.row_number().over(inside)).join(sizes, ["key", "chunk"])
    placed = placed.withColumn("pos", F.col("before") + F.col("place")).withColumns({"h1": _hash(1), "h2": _hash(2)})
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    part = placed.groupBy("key", "chunk").agg(F.bit_xor("h1").alias("t1"), F.bit_xor("h2").alias("t2"))
    part = part.select("key", "chunk", *[F.coalesce(F.bit_xor(t).over(chunks), F.lit(0)).alias(b) for t, b in (("t1", "b1"), ("t2", "b2"))])
    return placed.join(part, ["key", "chunk"]).select(
        "conv", "key", "pos", "role", "text", "h1", "h2",
        F.bit_xor("h1").over(upto).bitwiseXOR(F.col("b1")).alias("p1"), F.bit_xor("h2").over(upto).bitwiseXOR(F.col("b2")).alias("p2"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """key of each conversation that is no prefix of a longer one, the smallest of equal ones."""
    whole = turns.groupBy("key").agg(F.min("conv").alias("conv"), F.count("*").alias("n"), F.bit_xor("h1").alias("f1"), F.bit_xor("h2").alias("f2"))
    kinds = whole.groupBy("n", "f1", "f2").agg(F.min(F.struct(F.col("conv").isNotNull(), "conv", "key"))["key"].alias("key"))
    inner = turns.join(whole.select("key", "n"), "key").where("pos < n").select("pos", "p1", "p2").distinct()
    cond = (kinds.n == inner.pos) & (kinds.f1 == inner.p1) & (kinds.f2 == inner.p2)
    return kinds.join(inner, cond, "left_anti").select("key", "n")


def render(logs: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The turns of maximal conversations: conv_id, position, n_turns, role and piece, the turn in chat markup.

    The pieces of a conversation, in order, are its training text; they are not glued together here, as a conversation may be
    larger than a row.
    """
    turns = turns_of(logs, conv_id, turn, role, text)
    kept = turns.join(maximal(turns), "key")
    piece = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("\n<|end|>\n"))
    return kept.select(
        F.col("conv").alias(conv_id), F.col("pos").cast("long").alias("position"), F.col("n").cast("long").alias("n_turns"), "role", piece.alias("piece")
    )
