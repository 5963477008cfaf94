"""Alignment of two tokenizations of the same text, byte for byte.

Each tokenization tiles the bytes of a text. A link joins two tokens that share a byte; a cut lies where both tokenizations
end a token, and what lies between two cuts is a group. `lockstep` merges all texts of a batch at once: one state vector
holds a pointer into the A tokens and one into the B tokens for each lane; a step emits the link of every lane, moves on
whichever token ends first (both at a cut) and drops the lanes that are done. A long text is dealt out to several
lanes at blanks, where both tokenizations end, so that no lane holds up the others.

How often a pair of ids is linked, in documents of the whole corpus, is counted by Spark. A batch becomes one stored block with the
codes of its distinct pairs; their counts are added up by code, joined back to the blocks that hold the code, and collected per
block. Only the highest count of each A id is broadcast, a table with at most one row per entry of the vocabulary.

Defined cases: texts that are null, empty or not spelled by the bytes of either tokenization have no tokens, no links and no
groups; rows that share an id count as documents each; a null id is kept; columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from benchloom.llm.blocks import each_row, pack, table_name, unpack
from benchloom.llm.common import add_columns, kept, pieces, quoted
from benchloom.llm.runs import RunEncoder, byte_bpe, byte_labels, piece_bpe
from benchloom.session import bounded_batches

LANE_RUNS = 256
PIECE_BYTES = 4 << 20


def piece_labels(model: bytes) -> list[bytes]:
    """The bytes of each piece: the mark is a blank, <0xHH> is a byte."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    return [
        bytes([int(library.id_to_piece(i)[3:5], 16)]) if library.is_byte(i) else library.id_to_piece(i).replace("▁", " ").encode()
        for i in range(library.get_piece_size())
    ]


class Labels:
    """Bytes of ids, for whole arrays at once."""

    def __init__(self, labels: list[bytes]):
        self.sizes = np.array([len(b) for b in labels], dtype=np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(labels), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        end = np.cumsum(sizes)
        return self.data[np.repeat(self.begin[ids] - (end - sizes), sizes) + np.arange(end[-1] if len(end) else 0)]


def lockstep(a_end: np.ndarray, b_end: np.ndarray, a_from: np.ndarray, a_to: np.ndarray, b_from: np.ndarray, b_to: np.ndarray):
    """Merge all lanes at once: lane k has the A tokens a_from[k] .. a_to[k] and B tokens b_from[k] .. b_to[k], whose
    ends (byte positions on one scale) are given; both tile the same bytes.

    Returns (a, b, cut): the links in the order of the steps, as positions of tokens, and whether both tokens of the link end there.
    """
    live = (a_from < a_to) & (b_from < b_to)
    a, b, stop = a_from[live], b_from[live], a_to[live]
    found_a, found_b, found_cut = [], [], []
    while len(a):
        ends_a, ends_b = a_end[a], b_end[b]
        found_a.append(a)
        found_b.append(b)
        found_cut.append(ends_a == ends_b)
        a = a + (ends_a <= ends_b)
        b = b + (ends_b <= ends_a)
        running = a < stop
        if not running.all():
            a, b, stop = a[running], b[running], stop[running]
    none = np.zeros(0, np.int64)
    if not found_a:
        return none, none, np.zeros(0, bool)
    return np.concatenate(found_a), np.concatenate(found_b), np.concatenate(found_cut)


class Alignment:
    """All texts of a batch: ids, links and cuts. Texts are numbered as in the batch; a token's place is its index in `a` or `b`."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_begin: np.ndarray, b_begin: np.ndarray, links, n_texts: int):
        self.a, self.b, self.a_begin, self.b_begin, self.n_texts = a, b, a_begin, b_begin, n_texts
        at_a, at_b, cut = links
        order = np.argsort(at_a + at_b, kind="stable")  # each step moves on one pointer at least, so this is the order of the text
        self.link_a, self.link_b, self.cut = at_a[order], at_b[order], cut[order]
        self.a_ends, self.b_ends = np.zeros(len(a), bool), np.zeros(len(b), bool)  # does a group end with this token?
        self.a_ends[self.link_a[self.cut]] = True
        self.b_ends[self.link_b[self.cut]] = True
        self.text = np.searchsorted(a_begin, self.link_a, "right") - 1  # of each link

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """n_a, n_b, n_groups and n_links of each text."""
        n = self.n_texts
        return np.diff(self.a_begin), np.diff(self.b_begin), np.bincount(self.text[self.cut], minlength=n), np.bincount(self.text, minlength=n)


class Aligner:
    def __init__(self, definition: str, model: bytes):
        self.encoder = RunEncoder([byte_bpe(definition, plain_specials=True), piece_bpe(model)], led=True)
        names = byte_labels(definition), piece_labels(model)
        self.labels = [Labels(x) for x in names]
        self.base = len(names[1])
        self.shown = [pa.array([f"{i}{mark}".encode() for i in range(len(x)) for mark in marks], pa.binary()) for x, marks in zip(names, (",|", ",;"), strict=True)]

    def __call__(self, texts: pa.Array) -> Alignment:
        n = len(texts)
        texts = texts.fill_null("")
        rows, begin = self.encoder.rows(texts)
        sizes = [t.sizes(rows) for t in self.encoder.tables]
        ids = [t.take(rows) for t in self.encoder.tables]
        first = [np.concatenate([[0], np.cumsum(s)]) for s in sizes]  # first token of each run
        right = self._spelled(texts, ids, [f[begin] for f in first])
        if not right.all():  # these texts have no tokens
            keep = np.repeat(right, np.diff(begin))
            ids = [i[np.repeat(keep, s)] for i, s in zip(ids, sizes, strict=True)]
            sizes = [s * keep for s in sizes]
            first = [np.concatenate([[0], np.cumsum(s)]) for s in sizes]
        starts = np.concatenate([np.arange(p, q, LANE_RUNS) for p, q in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]) if n else begin[:0]
        stops = np.append(starts[1:], begin[-1])
        ends = [np.cumsum(own.sizes[i]) for own, i in zip(self.labels, ids, strict=True)]
        links = lockstep(ends[0], ends[1], first[0][starts], first[0][stops], first[1][starts], first[1][stops])
        return Alignment(ids[0], ids[1], first[0][begin], first[1][begin], links, n)

    def _spelled(self, texts: pa.Array, ids: list[np.ndarray], begins: list[np.ndarray]) -> np.ndarray:
        """Which texts are not empty and are, behind a blank, what the tokens of both spell."""
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        right = np.diff(offsets) > 0
        want = np.insert(data, offsets[:-1], 32)
        begin = offsets + np.arange(n + 1)
        for own, i, at in zip(self.labels, ids, begins, strict=True):
            size = np.diff(np.concatenate([[0], np.cumsum(own.sizes[i])])[at])
            right &= size == np.diff(begin)
            got = own.spell(i)
            if len(got) == len(want):
                different = np.flatnonzero(got != want)
                right[np.searchsorted(begin, different, "right") - 1] = False
            else:  # some text is not spelled; compare the others one by one
                stop = np.cumsum(size)
                for k in np.flatnonzero(right):
                    right[k] = np.array_equal(got[stop[k] - size[k] : stop[k]], want[begin[k] : begin[k + 1]])
        return right

    def codes(self, found: Alignment) -> np.ndarray:
        """One number for the pair of ids of each link."""
        return found.a[found.link_a].astype(np.int64) * self.base + found.b[found.link_b]

    def groups(self, found: Alignment) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, bounds): the groups of all texts written as a1,a2|b1;a3|b2,b3; text k is bytes[bounds[k] : bounds[k + 1] - 1]
        where it has tokens."""
        before_b = np.concatenate([[0], np.flatnonzero(found.b_ends) + 1])  # B tokens before each group
        before_a = np.concatenate([[0], np.flatnonzero(found.a_ends) + 1])
        group_a, group_b = np.cumsum(found.a_ends) - found.a_ends, np.cumsum(found.b_ends) - found.b_ends
        shown = np.empty(len(found.a) + len(found.b), np.int64)
        shown[np.arange(len(found.a)) + before_b[group_a]] = found.a.astype(np.int64) * 2 + found.a_ends
        shown[np.arange(len(found.b)) + before_a[group_b + 1 if len(found.b) else group_b]] = (
            len(self.shown[0]) + found.b.astype(np.int64) * 2 + found.b_ends
        )
        written = pa.concat_arrays(self.shown).take(pa.array(shown))
        offsets = np.frombuffer(written.buffers()[1], np.int32)[: len(written) + 1]
        return np.frombuffer(written.buffers()[2] or b"", np.uint8), offsets[found.a_begin + found.b_begin]


OWNER = "alignment"


def aligner_of(definition: str, model: bytes) -> Aligner:
    """One aligner each worker, until the worker turns to another operator."""
    return kept(OWNER, hash((definition, model)), lambda: Aligner(definition, model))


def _shared(df: DataFrame, a: str, b: str):
    """The driver reads both vocabularies, whose size does not depend on the data."""
    with open(a, encoding="utf-8") as f, open(b, "rb") as g:
        return df.sparkSession.sparkContext.broadcast((f.read(), g.read()))


def align(docs: DataFrame, a: str, b: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add a_ids and b_ids, links (pairs of positions in them, as one array a0, b0, a1, b1, ... in the order of the text) and groups (as
    a1,a2|b1;a3|b2,b3). `a`: file of a byte-level tokenizer; `b`: file of a sentence-piece model."""
    shared = _shared(docs, a, b)
    numbers = ArrayType(IntegerType())
    added = StructType([StructField(n, t) for n, t in (("a_ids", numbers), ("b_ids", numbers), ("links", numbers), ("groups", StringType()))])

    def make():
        aligner = aligner_of(*shared.value)

        def work(texts):
            found = aligner(pa.array(texts, pa.string()))
            data, bounds = aligner.groups(found)
            link_at = np.concatenate([[0], np.cumsum(found.counts()[3])])
            pairs = np.stack([found.link_a - found.a_begin[found.text], found.link_b - found.b_begin[found.text]], axis=1)

            def lists(values, at):
                return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values.reshape(-1), pa.int32()))

            names = [bytes(data[p : max(p, q - 1)]).decode() for p, q in zip(bounds[:-1], bounds[1:], strict=True)]
            return lists(found.a, found.a_begin), lists(found.b, found.b_begin), lists(pairs, 2 * link_at), names

        return work

    return add_columns(docs, [text], added, make, keep, OWNER)


# ------------------------------------------------------------------ counts over the whole corpus

BLOCKS = StructType([
    StructField("block", LongType()), StructField("codes", ArrayType(LongType())), StructField("holders", ArrayType(IntegerType())),
    StructField("docs", BinaryType()),
])


def _blocks(docs: DataFrame, a: str, b: str, path: str, buckets: int) -> DataFrame:
    """One row for each batch of documents: the codes of its pairs, how many of its documents hold each, and packed for
    each document its numbers, the digest of its groups, and its pairs with how often they occur."""
    bounded_batches(docs.sparkSession)
    shared = _shared(docs, a, b)

    def run(batches) -> Iterator[pa.RecordBatch]:
        aligner, number = aligner_of(*shared.value), TaskContext.get().partitionId() << 32
        for part in (p for whole in batches for p in pieces(whole, PIECE_BYTES)):
            found = aligner(part.column(1))
            data, bounds = aligner.groups(found)
            digests = b"".join(
                hashlib.sha256(data[p : q - 1]).digest() if q > p else bytes(32) for p, q in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
            )
            codes, which = np.unique(aligner.codes(found), return_inverse=True)
            held, times = np.unique(found.text * max(1, len(codes)) + which.reshape(-1), return_counts=True)
            text, pair = np.divmod(held, max(1, len(codes)))
            ids = part.column(0)
            load = pack(
                ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8), np.stack(found.counts()).astype(np.int64),
                np.frombuffer(digests, np.uint8), np.bincount(text, minlength=part.num_rows).astype(np.int64), pair.astype(np.int32), times.astype(np.int32),
            )
            holders = np.bincount(pair, minlength=len(codes)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(codes)], pa.int32()), pa.array(codes, pa.int64())),
                pa.ListArray.from_arrays(pa.array([0, len(codes)], pa.int32()), pa.array(holders, pa.int32())), pa.array([load], pa.binary()),
            ], names=BLOCKS.names)
            number += 1

    rows = docs.select("doc_id", "text").mapInArrow(run, BLOCKS)
    rows.write.bucketBy(buckets, "block").format("parquet").option("compression", "zstd").option("path", path).saveAsTable(table_name(path))
    return docs.sparkSession.table(table_name(path))


ALIGNED = StructType([
    StructField("doc_id", LongType()), StructField("n_a", LongType()), StructField("n_b", LongType()), StructField("n_groups", LongType()),
    StructField("n_links", LongType()), StructField("n_best", LongType()), StructField("count_sum", LongType()), StructField("groups_sha256", StringType()),
])


def pair_counts(blocks: DataFrame, base: int) -> DataFrame:
    """(code, count, best): in how many documents a pair is linked, and whether no pair of its A id is in more."""
    counts = (
        blocks.select(F.explode(F.arrays_zip("codes", "holders")).alias("p")).groupBy(F.col("p.codes").alias("code"))
        .agg(F.sum("p.holders").alias("count"))
    )
    own = F.floor(F.col("code") / base).alias("a")
    top = counts.groupBy(own).agg(F.max("count").alias("top"))  # at most one row per id of A
    return counts.join(F.broadcast(top), own == F.col("a")).select("code", "count", (F.col("count") == F.col("top")).alias("best"))


def link_summary(docs: DataFrame, a: str, b: str, workspace: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: n_a, n_b, n_groups, n_links, n_best (links whose pair of ids is in as many documents as any pair of
    its A id), count_sum (over links, in how many documents their pair of ids is linked) and groups_sha256 ('' without tokens).

    `doc_id` holds whole numbers. Blocks are written below `workspace`.
    """
    spark = docs.sparkSession
    base = len(piece_labels(_shared(docs, a, b).value[1]))
    rows = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).alias("text"))
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = _blocks(rows, a, b, f"{workspace}/blocks", buckets)
    counts = pair_counts(blocks, base)
    asked = blocks.select("block", F.posexplode("codes").alias("at", "code"))
    answers = asked.join(counts, "code").groupBy("block").agg(
        F.collect_list(F.struct("at", (F.col("count") * 2 + F.col("best").cast("long")).alias("value"))).alias("answers")
    )  # as many as a block has distinct pairs

    def run(batches) -> Iterator[pa.RecordBatch]:
        for row in each_row(batches):
            kinds = (np.int64, np.uint8, np.int64, np.uint8, np.int64, np.int32, np.int32)
            ids, has, numbers, digests, sizes, pair, times = unpack(row["docs"], *kinds)
            value = np.zeros(len(row["answers"] or ()), dtype=np.int64)
            for answer in row["answers"] or ():
                value[answer["at"]] = answer["value"]
            count, best = value >> 1, value & 1
            n = len(ids)
            begin = np.concatenate([[0], np.cumsum(sizes)])
            total = [np.concatenate([[0], np.cumsum(x)])[begin] for x in (best[pair] * times, count[pair] * times)]
            numbers = numbers.reshape(4, n)
            names = [digests[32 * k : 32 * k + 32].tobytes().hex() if numbers[0, k] else "" for k in range(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64(), mask=has == 0), *map(pa.array, numbers), *(pa.array(np.diff(t)) for t in total), pa.array(names, pa.string())],
                names=ALIGNED.names,
            )

    return blocks.select("block", "docs").join(answers, "block", "left").select("docs", "answers").mapInArrow(run, ALIGNED)
