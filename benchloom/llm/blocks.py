"""Documents packed into blocks of some megabytes, for work that sends packed arrays instead of single rows."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

LAST = (1 << 63) - 1  # stands for a null id in `ids`

BLOCK = StructType([
    StructField("block", LongType()), StructField("ids", BinaryType()), StructField("has_id", BinaryType()),
    StructField("flags", BinaryType()), StructField("sizes", BinaryType()), StructField("data", BinaryType()),
])


def blocks_of(rows: DataFrame, path: str, buckets: int, block_bytes: int) -> DataFrame:
    """Pack rows (id long, text string, flag int) and store them hashed by block, so that joins on it move no text."""
    packed = rows.select("id", F.coalesce("text", F.lit("")).cast("binary"), F.coalesce("flag", F.lit(0)).cast("int"))

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        held: list[list] = [[], [], []]
        size = 0
        for b in batches:
            for row in zip(*[b.column(i).to_pylist() for i in range(3)], strict=True):
                for own, value in zip(held, row, strict=True):
                    own.append(value)
                size += len(row[1]) + 64
                if size >= block_bytes:
                    yield _block(number, *held)
                    number, held, size = number + 1, [[], [], []], 0
        if held[0]:
            yield _block(number, *held)

    name = table_name(path)
    (
        packed.mapInArrow(run, BLOCK).write.bucketBy(buckets, "block").format("parquet")
        .option("compression", "zstd").option("path", path).saveAsTable(name)
    )
    return rows.sparkSession.table(name)


def table_name(path: str) -> str:
    """The name under which the session knows the blocks stored at a path."""
    return "blocks_" + hashlib.md5(path.encode()).hexdigest()


def forget_blocks(spark: SparkSession, path: str) -> None:
    """Take the name out of the session's catalog; the files are the caller's."""
    spark.sql(f"DROP TABLE IF EXISTS {table_name(path)}")


def _block(number: int, ids: list, parts: list, flags: list) -> pa.RecordBatch:
    own = np.array([LAST if i is None else i for i in ids], dtype=np.int64)
    has = np.array([i is not None for i in ids], dtype=np.uint8)
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    loads = (own.tobytes(), has.tobytes(), np.array(flags, dtype=np.uint8).tobytes(), sizes.tobytes(), b"".join(parts))
    cols = [pa.array([number], pa.int64())] + [pa.array([x], pa.binary()) for x in loads]
    return pa.RecordBatch.from_arrays(cols, names=BLOCK.names)


def each_row(batches) -> Iterator[dict]:
    for b in batches:
        for k in range(b.num_rows):
            yield b.slice(k, 1).to_pylist()[0]


def pack(*arrays: np.ndarray) -> bytes:
    parts = [np.ascontiguousarray(a).tobytes() for a in arrays]
    return struct.pack(f"<{len(parts)}q", *map(len, parts)) + b"".join(parts)


def unpack(data: bytes, *kinds) -> list[np.ndarray]:
    sizes = struct.unpack_from(f"<{len(kinds)}q", data)
    at, out = 8 * len(kinds), []
    for size, kind in zip(sizes, kinds, strict=True):
        out.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out
