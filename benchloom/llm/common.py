"""Small helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import sys
import uuid
from collections.abc import Callable, Hashable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from benchloom.session import bounded_batches, ensure_checkpoint_dir

#: Largest broadcast made here, in bytes; what is larger goes in several passes or through a shuffle.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder, for tables that are written and read again."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder made by `scratch`, through the file system that holds it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a table to the shared folder and read it again: a cut in the lineage that survives lost executors."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns that would clash with new ones; Spark compares names without regard to case."""
    low = {n.lower() for n in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in low])


def quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


#: What an operator keeps in a Python worker from one task to the next; one entry at most.
_KEPT: dict[str, tuple[Hashable, Any]] = {}


def kept(owner: str, key: Hashable, make: Callable[[], Any]):
    """What `make` returns, held in this Python worker for the owner's next tasks with the same key.

    Spark hands a worker from task to task, whatever operator the tasks belong to. So a worker holds one store, and
    `let_go` drops it where a task of another operator begins.
    """
    if owner not in _KEPT or _KEPT[owner][0] != key:
        let_go()
        _KEPT[owner] = key, make()
    return _KEPT[owner][1]


def let_go(but: str | None = None) -> None:
    """Drop what this Python worker holds for other owners than `but`, and give free memory back to the system."""
    if others := [x for x in _KEPT if x != but]:
        for x in others:
            del _KEPT[x]
        gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def add_columns(
    df: DataFrame, needs: Sequence[str], added: StructType, make: Callable[[], Callable], keep: Sequence[str] | None = None,
    owner: str | None = None, piece_bytes: int = 2 << 20,
) -> DataFrame:
    """Add columns computed by Python from whole Arrow batches, row for row.

    `make()` runs once per task and returns a function from the `needs` columns (Python lists) to one list per added
    column. Columns of the input that have the name of an added one are replaced. `keep`: which input columns to
    return (all by default). A column that is kept and needed travels once. `owner`: whose store (`kept`) stays from task
    to task; `piece_bytes`: how much of a batch `work` gets at once.
    """
    bounded_batches(df.sparkSession)
    base = without(df, [f.name for f in added])
    keep = [c for c in base.columns if keep is None or c in keep]
    others = [c for c in needs if c not in keep]
    inner = df.select(*[quoted(c) for c in keep], *[quoted(c).alias(f"__in{i}") for i, c in enumerate(others)])
    schema = StructType([base.schema[c] for c in keep] + [StructField(f.name, f.dataType, True) for f in added])
    n_keep, at = len(keep), [[*keep, *others].index(c) for c in needs]
    from pyspark.sql.pandas.types import to_arrow_type

    kinds, names = [to_arrow_type(f.dataType) for f in added], [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(owner)
        work = make()
        for b in (part for whole in batches for part in pieces(whole, piece_bytes)):
            cols = work(*[b.column(i).to_pylist() for i in at])
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=k) for c, k in zip(cols, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(n_keep)] + arrays, names=names)
            del cols, arrays
        del work
        let_go(owner)

    return inner.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into runs of rows of about `size` bytes, which bounds what Python holds at once."""
    rows = batch.num_rows
    step = max(1, rows // max(1, -(-batch.nbytes // size)))
    for at in range(0, rows, step):
        yield batch.slice(at, step)


class Memo(dict):
    """A dictionary that computes missing values and keeps the first `size` of them; the others are computed each time."""

    def __init__(self, make: Callable, size: int = 400_000):
        super().__init__()
        self.make, self.size = make, size

    def __missing__(self, key):
        value = self.make(key)
        if len(self) < self.size:
            self[key] = value
        return value
