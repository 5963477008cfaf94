"""Exact removal of repeated passages: suffix sorting over difference covers, dealt out by anchors.

A byte goes when a string of `width` bytes that covers it also starts in a document with a smaller id. Strings are
judged on the input; matches never cross documents.

Sorting the suffixes of the whole corpus in one list would move every suffix many times. Two equal strings of `width`
bytes, however, contain the same smallest hash of a run of GRAM bytes (their anchor), so windows are dealt out by anchor
and all equal ones meet in one bucket:

1. Documents are packed into blocks of some megabytes, stored once in the shared folder, hashed by block into as many
   files as there are shuffle partitions; later joins on the block move only what is joined to it.
2. Each block sends the anchors it has, as 32-bit numbers, one packed row per bucket. A bucket answers which of its
   anchors occur in two blocks. An anchor of a single document needs no more work.
3. Each block sends the stretches of text around the other anchors, each distinct stretch once with its smallest id.
   A bucket sorts the suffixes of its distinct stretches by the difference cover of `diffcover`, compares neighbours over
   `width` bytes and finds the smallest id of every window. A stretch that is the only one with its anchor is all
   windows of its own copies, which have met by then.
4. Each block marks its windows whose smallest id is below the document's own.

Passages that a third of all documents share are one stretch per block, whatever the number of documents. Buckets grow
with the input divided by the number of shuffle partitions, which has to grow with the input as for any shuffle.

Defined cases: a null or empty text has no bytes; ids are whole numbers (null: after all others); rows with equal ids do
not remove from each other; further columns are not returned.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from benchloom.llm.bagminhash import mix
from benchloom.llm.blocks import LAST, blocks_of, each_row, pack, unpack
from benchloom.llm.common import quoted, scratch, written
from benchloom.llm.diffcover import equal_windows

GRAM = 24
U = np.uint64


#: A random number for each byte, and an odd factor for each doubling.
BYTES = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
FACTORS = mix(np.arange(300, 364, dtype=U)) | U(1)


def anchors(data: np.ndarray, gram: int, size: int, piece: int = 1 << 16) -> np.ndarray:
    """From each place on, the smallest of `size` neighbouring hashes of `gram` bytes.

    Hashes and minima are doubled until they are long enough, piece by piece so that all steps stay in the cache.
    """
    total = len(data) - gram - size + 2
    out = np.empty(max(total, 0), dtype=U)
    for at in range(0, total, piece):
        h, done, level = BYTES[data[at : at + piece + gram + size - 2]], 1, 0
        while done < gram:
            step = min(done, gram - done)
            n = len(h) - step
            left = h[:n] * FACTORS[level]
            left += h[step:]
            h, done, level = left, done + step, level + 1
        h = mix(h)
        done = 1
        while done < size:
            step = min(done, size - done)
            h = np.minimum(h[: len(h) - step], h[step:])
            done += step
        out[at : at + len(h)] = h
    return out


class Block:
    """The anchors of a block of documents.

    `start`, `windows`, `anchor`, `doc`: first window, number of windows, anchor hash and document of each run of
    neighbouring windows with one anchor. `bucket`, of `n`: where the anchor is dealt to; `asked`: the distinct anchors,
    as 32-bit numbers below their bucket, sorted, and `mine`: each run's place there.
    """

    def __init__(self, data: bytes, sizes: np.ndarray, width: int, n: int):
        self.data, self.width, self.n = data, width, n
        ends = np.cumsum(sizes)
        first = ends - sizes
        gram = min(GRAM, width)
        low = anchors(np.frombuffer(data, np.uint8), gram, width - gram + 1)
        count = np.maximum(sizes - width + 1, 0)
        new = np.ones(len(low), dtype=bool)
        np.not_equal(low[1:], low[:-1], out=new[1:])
        new[first[count > 0]] = True
        rest = sizes - count  # places at the end of a document where no window starts
        none = np.arange(rest.sum()) - np.repeat(np.cumsum(rest) - rest, rest) + np.repeat(first + count, rest)
        new[none[none < len(low)]] = False
        self.start = np.flatnonzero(new)
        self.doc = np.searchsorted(ends, self.start, "right")
        self.windows = np.minimum(np.append(self.start[1:], len(data)), (first + count)[self.doc]) - self.start
        self.anchor = mix(low[self.start])
        self.bucket = (self.anchor % U(n)).astype(np.int64)
        key = (self.bucket.astype(U) << U(32)) | (self.anchor >> U(32))
        self.order = np.argsort(key)
        key = key[self.order]
        self.head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        self.asked = key[self.head]
        self.mine = np.empty(len(key), dtype=np.int64)
        self.mine[self.order] = np.repeat(np.arange(len(self.head)), np.diff(np.append(self.head, len(key))))

    def numbers(self) -> list[np.ndarray]:
        """The distinct anchor numbers for each bucket, sorted."""
        cut = np.searchsorted(self.asked, np.arange(self.n + 1, dtype=U) << U(32))
        return np.split((self.asked & U(0xFFFFFFFF)).astype(np.uint32), cut[1:-1])

    def wanted(self, answers: dict[int, bytes]) -> np.ndarray:
        """Runs whose anchor may occur in another document: of this block, or by the answers of another one."""
        if not len(self.start):
            return np.zeros(0, dtype=bool)
        doc = self.doc[self.order]
        flag = np.minimum.reduceat(doc, self.head) != np.maximum.reduceat(doc, self.head)
        at = 0
        for b, own in enumerate(self.numbers()):
            if b in answers and len(own):
                flag[at : at + len(own)] |= np.unpackbits(np.frombuffer(answers[b], np.uint8), count=len(own)).astype(bool)
            at += len(own)
        return flag[self.mine]

    def stretches(self, answers: dict[int, bytes], ids: np.ndarray):
        """Distinct stretches by bucket: texts, anchors, smallest ids, first place of each bucket; runs and their stretches."""
        runs = np.flatnonzero(self.wanted(answers))
        runs = runs[np.argsort(self.bucket[runs], kind="stable")]
        begin = self.start[runs]
        known, place = numbered([(self.data, begin, begin + self.windows[runs] + self.width - 1)])
        anchor, bucket = np.empty(len(known), dtype=U), np.empty(len(known), dtype=np.int64)
        anchor[place], bucket[place] = self.anchor[runs], self.bucket[runs]  # equal stretches have one anchor
        low = np.full(len(known), LAST)
        np.minimum.at(low, place, ids[self.doc[runs]])
        return known, anchor, low, np.searchsorted(bucket, np.arange(self.n + 1)), runs, place


def numbered(rows: Iterable[tuple[bytes, np.ndarray, np.ndarray]]) -> tuple[list[bytes], np.ndarray]:
    """The distinct stretches of (data, starts, ends), in order of their first occurrence, and the place there of each."""
    number: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
    places = [np.zeros(0, dtype=np.int64)]
    for data, start, end in rows:
        pieces = map(data.__getitem__, map(slice, start.tolist(), end.tolist()))
        places.append(np.fromiter(map(number.__getitem__, pieces), np.int64, len(start)))
    return list(number), np.concatenate(places)


def smallest_ids(rows: list[bytes], width: int, budget: int = 1 << 18) -> list[bytes]:
    """One bucket: for the stretches of each block, runs of windows with their smallest document id."""
    size, anchors, ids, data = zip(*[unpack(row, np.int32, np.uint64, np.int64, np.uint8) for row in rows], strict=True)
    ends = [np.cumsum(x, dtype=np.int64) for x in size]
    texts, place = numbered((d.tobytes(), e - x, e) for d, e, x in zip(data, ends, size, strict=True))
    anchor, low = np.empty(len(texts), dtype=U), np.full(len(texts), LAST)
    anchor[place] = np.concatenate(anchors)
    np.minimum.at(low, place, np.concatenate(ids))
    held = np.empty(len(texts), dtype=np.int64)
    held[place] = np.concatenate(size)

    order = np.argsort(anchor, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(anchor[order]) != 0, [True]])) if len(order) else np.zeros(1, int)
    several = np.diff(edges) > 1
    alone = order[edges[:-1][~several]]
    own = order[np.repeat(several, np.diff(edges))]
    found = [(alone, np.ones(len(alone), np.int64), held[alone] - width + 1, low[alone])]
    if len(own):  # lots of whole anchors, of about `budget` bytes
        until = np.cumsum(held[own] + 1)
        head = np.cumsum(np.diff(edges)[several]) - np.diff(edges)[several]
        lot = (until[head] - held[own[head]] - 1) // budget
        cut = np.append(head[np.concatenate([[True], lot[1:] != lot[:-1]])], len(own))
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            found.append((own[a:b], *_sort_lot([texts[j] for j in own[a:b].tolist()], low[own[a:b]], width)))

    which, parts, length, value = (np.concatenate(x) for x in zip(*found, strict=True))
    parts_of, first_of = np.empty(len(texts), dtype=np.int64), np.empty(len(texts), dtype=np.int64)
    parts_of[which], first_of[which] = parts, np.cumsum(parts) - parts
    out, at = [], 0
    for x in size:
        mine = place[at : at + len(x)]
        at += len(x)
        k = parts_of[mine]
        segment = np.arange(k.sum()) + np.repeat(first_of[mine] - np.cumsum(k) + k, k)
        out.append(pack(k.astype(np.int32), length[segment].astype(np.int32), value[segment]))
    return out


def _sort_lot(texts: list[bytes], low: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of stretches with their smallest ids: numbers of runs, and the runs' numbers of windows and smallest ids."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    raw = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.uint16) + 1
    ends = np.cumsum(sizes + 1) - 1
    raw[ends] = 0
    count = sizes - width + 1
    which = np.repeat(np.arange(len(texts)), count)
    start = np.arange(len(which)) + np.repeat(ends - sizes - np.cumsum(count) + count, count)
    value = np.zeros(len(raw), dtype=np.int64)
    value[start] = low[which]
    order, new = equal_windows(raw, start, width)
    head = np.flatnonzero(new)
    best = np.minimum.reduceat(value[order], head)
    value[order] = np.repeat(best, np.diff(np.append(head, len(order))))
    value = value[start]
    cut = np.flatnonzero(np.concatenate([[True], (which[1:] != which[:-1]) | (value[1:] != value[:-1])]))
    return np.bincount(which[cut], minlength=len(texts)), np.diff(np.append(cut, len(value))), value[cut]


MAIL = StructType([StructField("bucket", IntegerType()), StructField("block", LongType()), StructField("load", BinaryType())])
FOUND = StructType([
    StructField("doc_id", LongType()), StructField("n_bytes", LongType()),
    StructField("spans", ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))),
    StructField("kept", BinaryType()),
])


def _opened(row: dict, width: int, n: int) -> tuple[Block, np.ndarray]:
    return Block(row["data"], np.frombuffer(row["sizes"], np.int64), width, n), np.frombuffer(row["ids"], np.int64)


def _mail(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())],
        names=MAIL.names,
    )


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 50, block_bytes: int = 6 << 20, workspace: str | None = None,
) -> DataFrame:
    """Per document: doc_id, n_bytes, spans (maximal removed runs of bytes) and kept (the remaining bytes).

    `workspace`: a shared folder for the packed blocks, to be removed by the caller when the result has been used.
    """
    spark = docs.sparkSession
    path = workspace or scratch(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(quoted(doc_id).cast("long").alias("id"), quoted(text).alias("text"), F.lit(0).alias("flag"))
    blocks = blocks_of(rows, f"{path}/blocks", n, block_bytes)

    def ask(batches):
        for row in each_row(batches):
            block, _ = _opened(row, width, n)
            yield _mail([(b, row["block"], own.tobytes()) for b, own in enumerate(block.numbers()) if len(own)])

    def count(key, got):
        own = [np.frombuffer(x, np.uint32) for x in got["load"]]
        values, times = np.unique(np.concatenate(own), return_counts=True)
        often = values[times > 1]
        got["load"] = [np.packbits(np.isin(x, often, assume_unique=True)).tobytes() for x in own]
        return got

    answers = blocks.mapInArrow(ask, MAIL).groupBy("bucket").applyInPandas(count, MAIL)
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "load")).alias("mail"))  # a row per bucket at most
    answers = written(answers, f"{path}/answers")

    def answered(row):
        return {m["bucket"]: m["load"] for m in row["mail"] or []}

    def send(batches):
        for row in each_row(batches):
            block, ids = _opened(row, width, n)
            texts, anchor, low, cut, *_ = block.stretches(answered(row), ids)
            mail = []
            for b in np.flatnonzero(np.diff(cut)).tolist():
                own = slice(cut[b], cut[b + 1])
                sizes = np.array([len(t) for t in texts[own]], np.int32)
                mail.append((b, row["block"], pack(sizes, anchor[own], low[own], np.frombuffer(b"".join(texts[own]), np.uint8))))
            if mail:
                yield _mail(mail)

    def sort(key, got):
        got["load"] = smallest_ids(list(got["load"]), width)
        return got

    both = blocks.join(answers, "block", "left")
    found = both.mapInArrow(send, MAIL).groupBy("bucket").applyInPandas(sort, MAIL)
    found = found.groupBy("block").agg(F.collect_list(F.struct("bucket", "load")).alias("found"))
    found = written(found, f"{path}/found")

    def finish(batches):
        for row in each_row(batches):
            block, ids = _opened(row, width, n)
            removed = np.zeros(len(row["data"]) + 1, dtype=np.int64)
            loads = {m["bucket"]: unpack(m["load"], np.int32, np.int32, np.int64) for m in row["found"] or []}
            if loads:
                *_, first, runs, place = block.stretches(answered(row), ids)
                bucket = block.bucket[runs]
                for b, (parts, length, low) in loads.items():
                    mine = slice(*np.searchsorted(bucket, [b, b + 1]))
                    run, at = runs[mine], place[mine] - first[b]
                    edge = np.cumsum(parts, dtype=np.int64) - parts
                    inner = np.cumsum(length, dtype=np.int64) - length
                    k = parts[at]
                    seg = np.arange(k.sum()) + np.repeat(edge[at] - np.cumsum(k) + k, k)
                    begin = inner[seg] + np.repeat(block.start[run] - inner[edge[at]], k)
                    hit = low[seg] < np.repeat(ids[block.doc[run]], k)
                    np.add.at(removed, begin[hit], 1)
                    np.add.at(removed, begin[hit] + length[seg][hit] + width - 1, -1)
            gone = np.cumsum(removed[:-1]) > 0
            yield _result(row, ids, gone)

    done = blocks.join(answers, "block", "left").join(found, "block", "left")
    return done.mapInArrow(finish, FOUND)


def _result(row: dict, ids: np.ndarray, gone: np.ndarray) -> pa.RecordBatch:
    data = np.frombuffer(row["data"], np.uint8)
    sizes, has = np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["has_id"], np.uint8)
    spans, kept = [], []
    at = 0
    for size in sizes.tolist():
        own = gone[at : at + size]
        if own.any():
            edge = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
            spans.append([{"start": a, "end": b} for a, b in edge.tolist()])
            kept.append(data[at : at + size][~own].tobytes())
        else:
            spans.append([])
            kept.append(row["data"][at : at + size])
        at += size
    numbers = [i if h else None for i, h in zip(ids.tolist(), has.tolist(), strict=True)]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
    cols = [pa.array(c, k) for c, k in zip((numbers, sizes.tolist(), spans, kept), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(cols, names=FOUND.names)
