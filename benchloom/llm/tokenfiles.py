"""Token ids as Arrow files of equal-length sequences, readable at random without copying.

A file is an Arrow stream with a footer (the Arrow file format). Its record batches have two columns of fixed-size lists:
`ids` (the narrowest unsigned integers that hold the vocabulary) and `mask` (booleans, false only on the padding behind
the last token of a file). All batches but the last have the same number of sequences, so sequence k of a file is row
k % rows of batch k // rows, and a memory-mapped file gives it as a view. Beside each file lies an index, an Arrow file too,
with the id, first position and number of tokens of each document.

Documents are range-partitioned and sorted by id; a task writes the files of one range. Each attempt of a task picks new
names, and the manifest, a table that Spark commits as a whole, lists only files of attempts that succeeded: a lost executor
leaves at most files that nothing refers to. The manifest has one row per file; running sums over it give the place of each
file in the whole stream.

Defined cases: null and empty texts have only the end id; rows with a null id come first; rows that share an id follow each other in
the order of a hash of their text, and equal rows are told apart by their place, so that many copies spread over tasks; an empty
table makes an empty manifest; columns other than id and text are ignored.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from benchloom.llm.common import pieces, quoted, written
from benchloom.llm.runs import RunEncoder, byte_bpe
from benchloom.session import bounded_batches, fan_out

LENGTH = 2048
END = 2
SEQUENCES = 256  # of a record batch
FILE_TOKENS = 1 << 28

MANIFEST = StructType([
    StructField("part", IntegerType()), StructField("number", IntegerType()), StructField("file", StringType()),
    StructField("n_docs", LongType()), StructField("n_tokens", LongType()), StructField("n_sequences", LongType()),
])


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system that holds a path, by Arrow's own connectors."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def index_of(file: str) -> str:
    return file.removesuffix(".arrow") + ".index.arrow"


class SequenceWriter:
    """Writes the stream of one file: whole batches as they fill, the rest padded at the end."""

    def __init__(self, file: str, kind: pa.DataType, length: int, id_type: pa.DataType):
        self.file, self.kind, self.length, self.id_type = file, kind, length, id_type
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        store, path = open_folder(file)
        self.sink = store.open_output_stream(path)
        self.out = pa.ipc.new_file(self.sink, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_tokens = self.n_sequences = 0
        self.docs: list[pa.Array] = []
        self.sizes: list[np.ndarray] = []

    def add(self, doc_ids: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(doc_ids)
        self.sizes.append(sizes)
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_tokens += len(ids)
        if self.n_held >= SEQUENCES * self.length:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        stream = np.concatenate(self.held) if self.held else np.zeros(0, self.kind.to_pandas_dtype())
        per_batch = SEQUENCES * self.length
        whole = len(stream) if last else len(stream) - len(stream) % per_batch
        for at in range(0, whole, per_batch):
            part = stream[at : min(at + per_batch, whole)]
            rows = -(-len(part) // self.length)
            ids = np.zeros(rows * self.length, part.dtype)
            ids[: len(part)] = part
            mask = np.arange(len(ids)) < len(part)
            self.out.write_batch(pa.RecordBatch.from_arrays([
                pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length), pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
            ], schema=self.schema))
            self.n_sequences += rows
        self.held = [stream[whole:]]
        self.n_held = len(stream) - whole

    def close(self) -> tuple[int, int, int]:
        self._flush(True)
        self.out.close()
        self.sink.close()
        sizes = np.concatenate(self.sizes)
        schema = pa.schema([("doc_id", self.id_type), ("first", pa.int64()), ("n_tokens", pa.int64())])
        first = np.cumsum(sizes) - sizes
        store, path = open_folder(index_of(self.file))
        with store.open_output_stream(path) as sink, pa.ipc.new_file(sink, schema) as out:
            ids = pa.chunked_array(self.docs, self.id_type)
            out.write_table(pa.Table.from_arrays([ids, pa.array(first), pa.array(sizes)], schema=schema), max_chunksize=1 << 16)
        return len(sizes), self.n_tokens, self.n_sequences


def id_type(n_ids: int) -> np.dtype:
    return np.min_scalar_type(max(0, n_ids - 1))


def write_sequences(
    docs: DataFrame, tokenizer: str, folder: str, length: int = LENGTH, end: int = END, doc_id: str = "doc_id", text: str = "text",
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Encode the texts, put `end` behind each and write all ids below `folder` in ascending order of the ids of documents.

    Returns the manifest: part, number (the order of the files), file, n_docs, n_tokens, n_sequences. It is stored in the folder, too.
    """
    bounded_batches(docs.sparkSession)
    with open(tokenizer, encoding="utf-8") as f:  # its size does not depend on the data
        definition = f.read()
    j = json.loads(definition)
    numbers = [*j["model"]["vocab"].values(), *(t["id"] for t in j.get("added_tokens", []))]
    kind = id_type(max(*numbers, end) + 1)
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    own_type = to_arrow_type(docs.schema[doc_id].dataType)
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text")).withColumns(
        {"turn": F.xxhash64("text"), "place": F.monotonically_increasing_id()}
    )
    keys = ["doc_id", "turn", "place"]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")

    def run(batches):
        store, where = open_folder(folder)
        store.create_dir(where, recursive=True)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        encoder = RunEncoder([byte_bpe(shared.value)], led=False)
        found, writer = [], None

        def close():
            found.append((part, len(found), writer.file, *writer.close()))

        for b in (p for whole in batches for p in pieces(whole, min(4 << 20, 4 * file_tokens))):
            ids, sizes = with_end(encoder, b.column(1), end, kind)
            if writer is None:
                name = f"{folder}/part-{part:06d}-{len(found):04d}-{attempt}.arrow"
                writer = SequenceWriter(name, pa.from_numpy_dtype(kind), length, own_type)
            writer.add(b.column(0), sizes, ids)
            if writer.n_tokens >= file_tokens:
                close()
                writer = None
        if writer is not None:
            close()
        columns = list(zip(*found, strict=True)) or [[] for _ in MANIFEST]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, MANIFEST, strict=True)], names=MANIFEST.names
        )

    return written(rows.mapInArrow(run, MANIFEST), f"{folder}/manifest")


def with_end(encoder: RunEncoder, texts: pa.Array, end: int, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch with the end id behind each text, and the number of ids of each text."""
    rows, begin = encoder.rows(texts)
    table = encoder.tables[0]
    total = np.concatenate([[0], np.cumsum(table.sizes(rows))])
    stops = total[begin[1:]]
    return np.insert(table.take(rows).astype(kind), stops, end), np.diff(stops, prepend=0) + 1


class SequenceFile:
    """Random access to the sequences of a file; ids and masks are views of the file's memory."""

    def __init__(self, file: str):
        self.file = file
        store, path = open_folder(file)
        self.source = pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size
        batches = self.reader.num_record_batches
        self.rows = self.reader.get_batch(0).num_rows if batches else 1
        self.size = (batches - 1) * self.rows + self.reader.get_batch(batches - 1).num_rows if batches else 0

    def __len__(self) -> int:
        return self.size

    def batch(self, k: int) -> np.ndarray:
        """The ids of record batch k, one sequence a row."""
        return self.reader.get_batch(k).column(0).values.to_numpy(zero_copy_only=True).reshape(-1, self.length)

    def __getitem__(self, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if not 0 <= k < self.size:
            raise IndexError(k)
        b = self.reader.get_batch(k // self.rows)
        row = k % self.rows
        ids = b.column(0).values.to_numpy(zero_copy_only=True)[row * self.length : (row + 1) * self.length]
        return ids, b.column(1).values.slice(row * self.length, self.length)

    def stream(self, first: int, last: int) -> np.ndarray:
        """The ids from position `first` up to `last` of the file; a view where they lie in one batch."""
        per = self.rows * self.length
        parts = [
            self.batch(k).reshape(-1)[max(first - k * per, 0) : last - k * per] for k in range(first // per, -(-last // per))
        ]
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint16)

    def index(self) -> pa.ipc.RecordBatchFileReader:
        store, path = open_folder(index_of(self.file))
        return pa.ipc.open_file(store.open_input_file(path))


def located(manifest: DataFrame) -> DataFrame:
    """The manifest with `base`: the ids in all files before. One row per file, a running sum over them."""
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_documents(spark: SparkSession, manifest: DataFrame, id_kind, piece_tokens: int = 1 << 19) -> DataFrame:
    """Read the files of a manifest: doc_id, start (ids before it in the whole stream), n_tokens, ids (little-endian
    unsigned 32-bit numbers). `id_kind`: the Spark type of doc_id."""
    schema = StructType([
        StructField("doc_id", id_kind), StructField("start", LongType()), StructField("n_tokens", LongType()), StructField("ids", BinaryType()),
    ])
    files = located(manifest).select("file", "base").repartition(fan_out(spark))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = SequenceFile(file)
                index = own.index()
                for k in range(index.num_record_batches):
                    yield from _documents(own, index.get_batch(k), base, piece_tokens)

    def _documents(own: SequenceFile, docs: pa.RecordBatch, base: int, most: int) -> Iterator[pa.RecordBatch]:
        first, sizes = docs.column(1).to_numpy(), docs.column(2).to_numpy()
        at = 0
        while at < len(first):
            stop = max(at + 1, int(np.searchsorted(first + sizes, first[at] + most, "right")))
            ids = own.stream(int(first[at]), int(first[stop - 1] + sizes[stop - 1])).astype("<u4")
            bounds = np.concatenate([first[at:stop] - first[at], [len(ids)]]) * 4
            load = pa.BinaryArray.from_buffers(pa.binary(), stop - at, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays(
                [docs.column(0).slice(at, stop - at), pa.array(first[at:stop] + base), pa.array(sizes[at:stop]), load], names=schema.names
            )
            at = stop

    return files.mapInArrow(run, schema)
