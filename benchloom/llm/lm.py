"""Language-model scoring with a log-frequency Bloom filter.

Tokens are the words between white space, A-Z in lower case, and one end token per text. The filter holds the counts of
all pairs of neighbouring tokens of the training texts, quantised to powers of two: a pair with count c is entered for
the levels 1 .. 1 + floor(log2 c). Reading a count means probing level after level until one is missing; the count is
taken as 2 ** (level - 1), never more than the true one but for false positives (about 0.4 %).

A token's probability mixes the pair count with the add-one unigram estimate. The weight of the latter follows the number
of different successors of a word, which grows with a power of its count (as in Witten-Bell smoothing):
(c'(h, w) + t(h) * p(w)) / (c(h) + t(h)), t(h) = mu * c(h) ** power, p(w) = (c(w) + 1) / (N + V + 1).

Texts are packed into blocks. A block sends its distinct words with their training counts, and its distinct pairs as
32-bit numbers with theirs, in one packed row per bucket. Buckets add them up, make their part of the filter, and answer
each block with the total counts of its own words (exact) and what the filter says of its own pairs. Nothing is broadcast or
sent to the driver, and blocks are read twice whatever the size of the filter: a task holds one part of it, and there
are as many buckets as keep the work on a part below `slice_bytes`.

Defined cases: a null or empty text is its end token; a null id counts as training text; without training texts all
counts are 0; words are told apart by 64-bit hashes; rows that repeat an id are scored and counted each.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType
from xxhash import xxh3_64_intdigest

from benchloom.llm.bagminhash import mix
from benchloom.llm.blocks import blocks_of, each_row, pack, unpack
from benchloom.llm.common import quoted, scratch, written
from benchloom.session import bounded_batches

U = np.uint64
K = U(0x9E3779B97F4A7C15)
END, START = xxh3_64_intdigest(b"\n"), xxh3_64_intdigest(b"\n\n")  # no word holds white space
PROBES, BITS_PER_ENTRY = 6, 12
COUNTS = np.array([0.0, *(2.0**k for k in range(62))])  # by level
HELD = 1
ANSWER, TOTAL = 0, 1
#: Words, or pairs, that are worked on at once.
PIECE = 1 << 18
#: What the work on a bucket takes, times the text that it stands for.
WORK = 6

MAIL = StructType([
    StructField("kind", IntegerType()), StructField("bucket", IntegerType()), StructField("block", LongType()),
    StructField("tokens", LongType()), StructField("distinct", LongType()), StructField("load", BinaryType()),
])
MAIL_ARROW = to_arrow_schema(MAIL)
SCORES = StructType([
    StructField("doc_id", LongType()), StructField("held_out", BooleanType()), StructField("n_tokens", LongType()),
    StructField("n_known", LongType()), StructField("base_score", DoubleType()), StructField("score", DoubleType()),
])


class Tokens:
    """All tokens of a block: hashes, the pair that each ends, and the document of each."""

    def __init__(self, row: dict):
        data, sizes = row["data"], np.frombuffer(row["sizes"], np.int64).tolist()
        counts, words, hashes, at = [], [], [np.empty(0, U)], 0
        for size in sizes:
            own = data[at : at + size].lower().split()
            counts.append(len(own) + 1)
            words += own
            at += size
            if len(words) >= PIECE:
                hashes.append(_hashes(words))
                words = []
        hashes.append(_hashes(words))
        self.counts = np.array(counts, dtype=np.int64)
        ends = np.cumsum(self.counts) - 1
        self.token = np.full(int(self.counts.sum()), END, dtype=U)
        inner = np.ones(len(self.token), dtype=bool)
        inner[ends] = False
        self.token[inner] = np.concatenate(hashes)
        before = np.empty_like(self.token)
        before[1:] = self.token[:-1]
        before[ends - self.counts + 1] = START
        self.doc = np.repeat(np.arange(len(sizes)), self.counts)
        self.flags = np.frombuffer(row["flags"], np.uint8)
        self.training = (self.flags[self.doc] & HELD) == 0
        self.pair = mix(before * K + self.token)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), U, len(words))


def _split(key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32-bit number of each pair."""
    return (key % U(n)).astype(np.int64), (key >> U(32)).astype(np.uint32)


def _words(tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, their training counts, and the place of each token among them."""
    words, place = np.unique(tokens.token, return_inverse=True)
    return words, np.bincount(place[tokens.training], minlength=len(words)), place


def _pair_keys(tokens: Tokens, n: int) -> np.ndarray:
    """Bucket and number of each token's pair in one key, which sorts by bucket."""
    bucket, number = _split(tokens.pair, n)
    return (bucket.astype(U) << U(32)) | number


def _pairs(tokens: Tokens, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the distinct pairs and their training counts."""
    marked = np.sort((_pair_keys(tokens, n) << U(1)) | tokens.training.astype(U))
    first = _firsts(marked >> U(1))
    return marked[first] >> U(1), np.add.reduceat(marked & U(1), first)


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Where each distinct value of a sorted array begins."""
    new = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return np.flatnonzero(new)


def _edges(words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Words in the order of their buckets, and where each bucket begins."""
    home = (words % U(n)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    return order, np.searchsorted(home[order], np.arange(n + 1))


def _cuts(pairs: np.ndarray, n: int) -> np.ndarray:
    """Where each bucket begins among the sorted keys of pairs."""
    return np.searchsorted(pairs, np.arange(n + 1, dtype=U) << U(32))


def _positions(number: np.ndarray, level, probe: int, bits) -> np.ndarray:
    key = (number.astype(U) << U(16)) | (np.asarray(level).astype(U) << U(8)) | U(probe)
    return (mix(key * K) % np.asarray(bits).astype(U)).astype(np.int64)


def _levels(count: np.ndarray) -> np.ndarray:
    return (np.floor(np.log2(np.maximum(count, 1))) + 1).astype(np.uint8)


def filter_part(number: np.ndarray, count: np.ndarray) -> tuple[int, bytes]:
    """Bits of one bucket's log-frequency filter."""
    return _part([(number[at : at + PIECE], _levels(count[at : at + PIECE])) for at in range(0, len(number), PIECE)])


def _part(pieces: list[tuple[np.ndarray, np.ndarray]]) -> tuple[int, bytes]:
    """Bits of a filter from distinct numbers and their last levels."""
    bits = max(64, BITS_PER_ENTRY * sum(int(last.sum(dtype=np.int64)) for _, last in pieces))
    table = np.zeros(bits, dtype=bool)
    for number, last in pieces:
        for level in range(1, int(last.max(initial=0)) + 1):
            there = last >= level
            number, last = number[there], last[there]
            for probe in range(PROBES):
                table[_positions(number, level, probe, bits)] = True
    return bits, np.packbits(table).tobytes()


class Filter:
    """Some parts of the filter, side by side."""

    def __init__(self, parts: list[tuple[int, int, bytes]], n: int):
        self.n = n
        self.bits = np.zeros(n, dtype=np.int64)
        self.at = np.zeros(n, dtype=np.int64)
        held, size = [], 0
        for bucket, bits, load in parts:
            self.bits[bucket], self.at[bucket] = bits, size * 8
            held.append(load)
            size += len(load)
        self.data = np.frombuffer(b"".join(held), np.uint8)

    def levels(self, pair: np.ndarray) -> np.ndarray:
        """The last level that is there for each pair, 0 if none or if the pair belongs to another part."""
        return self.last(*_split(pair, self.n))

    def last(self, bucket: np.ndarray, number: np.ndarray, known: np.ndarray | None = None) -> np.ndarray:
        """The last level that is there for each number, of which those up to `known` are known to be there."""
        out = np.zeros(len(number), dtype=np.uint8) if known is None else known.copy()
        live = np.flatnonzero(self.bits[bucket] > 0)
        while len(live):
            for probe in range(PROBES):
                b = bucket[live]
                spot = self.at[b] + _positions(number[live], out[live].astype(np.int64) + 1, probe, self.bits[b])
                live = live[(self.data[spot >> 3] >> (7 - (spot & 7)).astype(np.uint8)) & 1 == 1]
            out[live] += 1
            live = live[out[live] < 62]
        return out


def answers(mail: list) -> tuple[list[bytes], int, int]:
    """What a bucket answers to each block's mail, and how many tokens and distinct words of training texts it has.

    An answer has the total counts of the block's words and the last levels of its pairs, in the order of the mail.
    """
    loads = [unpack(x, U, np.uint32, np.uint32, np.uint32, np.uint32) for x in mail]
    words, place = np.unique(np.concatenate([x[0] for x in loads]), return_inverse=True)
    total = np.bincount(place, np.concatenate([x[1] for x in loads]), len(words)).astype(np.int64)
    times, at = np.ones(sum(len(x[2]) for x in loads), dtype=np.uint32), 0
    for x in loads:
        times[at : at + len(x[2])][x[3]] = x[4]
        at += len(x[2])
    level = _last_levels(np.concatenate([x[2] for x in loads]), times)
    replies, word, pair = [], 0, 0
    for x in loads:
        replies.append(pack(total[place[word : word + len(x[0])]], level[pair : pair + len(x[2])]))
        word, pair = word + len(x[0]), pair + len(x[2])
    return replies, int(total.sum()), int((total > 0).sum())


def _last_levels(number: np.ndarray, times: np.ndarray) -> np.ndarray:
    """What the filter of all these counts says of each number; numbers may repeat, their counts add up."""
    out = np.empty(len(number), dtype=np.uint8)
    packed = number.astype(U) << U(32)
    packed |= np.arange(len(number), dtype=np.uint32)
    packed.sort()
    n = len(number) // PIECE + 1
    cuts = [*np.searchsorted(packed, np.array([(k << 32) // n << 32 for k in range(n)], dtype=U)), len(packed)]
    pieces = [packed[a:b] for a, b in pairwise(cuts) if a < b]  # equal numbers are in one piece
    found = []
    for piece in pieces:
        ordered = piece >> U(32)
        first = _firsts(ordered)
        count = np.add.reduceat(times[piece.astype(np.uint32)], first, dtype=np.int64)
        found.append((ordered[first].astype(np.uint32), np.where(count > 0, _levels(count), np.uint8(0))))
    part = Filter([(0, *_part(found))], 1)
    for piece, (distinct, known) in zip(pieces, found, strict=True):
        last = part.last(np.zeros(len(distinct), dtype=np.int64), distinct, known)
        out[piece.astype(np.uint32)] = np.repeat(last, np.diff(_firsts(piece >> U(32)), append=len(piece)))
    return out


def _mail(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), MAIL_ARROW, strict=True)], schema=MAIL_ARROW)


def score(
    docs: DataFrame, held_out=None, doc_id: str = "doc_id", text: str = "text", mu: float = 3.0, power: float = 0.9,
    block_bytes: int = 6 << 20, slice_bytes: int = 128 << 20, workspace: str | None = None,
) -> DataFrame:
    """Per document: held_out, n_tokens, n_known, train_tokens, base_score and score, both log10 probabilities.

    `held_out`: a condition on the rows of `docs` that are scored but not learnt from. `slice_bytes`: how much memory the work
    on a part of the filter may take. `workspace`: a shared folder that the caller removes when the result has been used.
    """
    spark = docs.sparkSession
    path = workspace or scratch(spark)
    bounded_batches(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    flag = F.lit(0) if held_out is None else F.when(held_out, HELD).otherwise(0)
    rows = docs.select(quoted(doc_id).cast("long").alias("id"), quoted(text).alias("text"), flag.alias("flag"))
    blocks = blocks_of(rows, f"{path}/blocks", n, block_bytes)
    n = max(n, -(-blocks.count() * block_bytes * WORK // slice_bytes))

    def send(batches):
        for row in each_row(batches):
            t = Tokens(row)
            words, counts, _ = _words(t)
            order, edge = _edges(words, n)
            pairs, times = _pairs(t, n)
            cut = _cuts(pairs, n)
            mail = []
            for b in range(n):
                own = order[edge[b] : edge[b + 1]]
                p, c = pairs[cut[b] : cut[b + 1]], times[cut[b] : cut[b + 1]]
                if len(own) or len(p):
                    other = np.flatnonzero(c != 1)
                    load = pack(
                        words[own], counts[own].astype(np.uint32), (p & U(0xFFFFFFFF)).astype(np.uint32),
                        other.astype(np.uint32), c[other].astype(np.uint32),
                    )
                    mail.append((ANSWER, b, row["block"], 0, 0, load))
            yield from _mail(mail).to_batches()

    def add(key, got):
        replies, tokens, distinct = answers([x.as_buffer() for x in got["load"]])
        bucket = key[0].as_py()
        rows = [(ANSWER, bucket, b, 0, 0, r) for b, r in zip(got["block"].to_pylist(), replies, strict=True)]
        return _mail([*rows, (TOTAL, bucket, -1, tokens, distinct, b"")])

    sums = written(blocks.mapInArrow(send, MAIL).groupBy("bucket").applyInArrow(add, MAIL), f"{path}/sums")
    total = sums.where(F.col("kind") == TOTAL).agg(F.sum("tokens").alias("tokens"), F.sum("distinct").alias("distinct")).first()
    replies = (
        sums.where(F.col("kind") == ANSWER).groupBy("block")
        .agg(F.collect_list(F.struct("bucket", "load")).alias("mail"))  # a row per bucket at most
    )
    train_tokens = total.tokens or 0
    found = blocks.join(replies, "block", "left").mapInArrow(_score_step(n, train_tokens, total.distinct or 0, mu, power), SCORES)
    return found.withColumn("train_tokens", F.lit(train_tokens).cast("long"))


def _score_step(n: int, train_tokens: int, distinct: int, mu: float, power: float):
    def run(batches):
        floor = float(train_tokens + distinct + 1)
        for row in each_row(batches):
            t = Tokens(row)
            words, _, place = _words(t)
            order, edge = _edges(words, n)
            pairs, pair = np.unique(_pair_keys(t, n), return_inverse=True)
            cut = _cuts(pairs, n)
            count, last = np.zeros(len(words), dtype=np.int64), np.zeros(len(pairs), dtype=np.uint8)
            for m in row["mail"] or []:
                b = m["bucket"]
                count[order[edge[b] : edge[b + 1]]], last[cut[b] : cut[b + 1]] = unpack(m["load"], np.int64, np.uint8)
            seen = COUNTS[last][pair]
            c = count[place]
            p = (c + 1) / floor
            texts = len(t.counts)
            first = np.cumsum(t.counts) - t.counts
            history = np.empty(len(c), dtype=np.float64)
            history[1:] = c[:-1]
            # every training text begins once
            history[first] = count[np.searchsorted(words, U(END))] if len(words) else 0
            prior = mu * np.maximum(history, 1) ** power
            mixed = (np.minimum(seen, history) + prior * p) / (history + prior)
            cols = [
                [i if h else None for i, h in zip(np.frombuffer(row["ids"], np.int64).tolist(), row["has_id"], strict=True)],
                (t.flags & HELD).astype(bool), t.counts, np.bincount(t.doc[c > 0], minlength=texts),
                np.bincount(t.doc, np.log10(p), texts), np.bincount(t.doc, np.log10(mixed), texts),
            ]
            kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, kinds, strict=True)], names=SCORES.names)

    return run
