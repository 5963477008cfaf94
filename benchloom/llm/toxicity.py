"""Toxicity: class-conditional Kneser-Ney models over the characters of words.

One model of toxic and one of ordinary text give each word a log-likelihood ratio. The highest order has the counts of
each class with absolute discounting; what it holds back goes to one back-off that both classes share, a Kneser-Ney
continuation model of all text. So a rare expression that neither class has seen moves the ratio only by what its
context says, and a word never seen shares its stem with words that were. Words are spelled between marks.

A gram seen in training has one ratio; for any other gram the shared back-off cancels, and the ratio is that of the two
held-back masses of its context. Two tables with `2 ** bits` cells therefore hold all that scoring needs, whatever the
size of the data.

A document is judged by length-normalised ratios: the means over all its words of the ratios and of their positive and
clearly positive parts, and the best mean over stretches of 1, 4, 16 and 64 consecutive words anywhere in the text. A logistic curve fitted on labelled rows that the counts have not seen
turns them into a score from 0 to 1. Labels, language, source and id are never inputs of a score.

Training reads a bounded sample of labelled rows, whole texts: the first `max_rows` of each class in the order of a hash
of the id.

Defined cases: null and empty texts have ratio 0 everywhere; label rows with a null id or label are ignored, an id
labelled twice is toxic if any label says so, repeated documents count each; with one class missing every score is the
share of toxic rows (0 without rows); columns of the input named like an added one are replaced. `drop_toxic` keeps
documents without letters and numbers, whatever the labels are, and changes no column.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from benchloom.llm.common import add_columns, let_go, pieces, quoted, without
from benchloom.session import bounded_batches

ORDER = 6
DISCOUNT = 0.75
STRETCHES = (1, 4, 16, 64)
CLEAR = 2.0
FEATURES = 3 + len(STRETCHES)
WORDS = re.compile(r"[^\W_]+")
K = np.uint64(0x9E3779B97F4A7C15)
START, END = "\x01" * (ORDER - 1), "\x02"


def spell(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words with marks, and the positions that a model predicts (letters and end marks)."""
    chars = np.frombuffer((START + (END + START).join(words) + END).encode("utf-32-le"), np.uint32)
    return chars, np.flatnonzero(chars != 1)


def cells(chars: np.ndarray, at: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The table cells of the grams that end at `at`, and of their contexts."""
    h = np.full(len(at), 7, dtype=np.uint64)
    context = h
    for back in range(ORDER - 1, -1, -1):
        if back == 0:
            context = (h * K) >> np.uint64(64 - bits)
        h = (h ^ chars[at - back]) * K
        h ^= h >> np.uint64(29)
    return ((h * K) >> np.uint64(64 - bits)).astype(np.int64), context.astype(np.int64)


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


class Ratios:
    """What scoring needs: one ratio per gram cell (NaN: not seen) and one per context cell."""

    def __init__(self, grams: np.ndarray, contexts: np.ndarray, bits: int):
        self.grams, self.contexts, self.bits = grams, contexts, bits

    def of_words(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        chars, at = spell(words)
        gram, context = cells(chars, at, self.bits)
        value = self.grams[gram].astype(np.float64)
        value = np.where(np.isnan(value), self.contexts[context], value)
        ends = np.flatnonzero(chars[at] == 2)
        total = np.cumsum(value)[ends]
        return np.diff(total, prepend=0.0)

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Per text: mean ratio of its words, and the best mean over each stretch length."""
        per_text = [words_of(t) for t in texts]
        index = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(per_text)))}
        by_word = self.of_words(list(index))
        counts = np.array([len(w) for w in per_text], dtype=np.int64)
        out = np.zeros((len(texts), FEATURES))
        if not index:
            return out
        seq = by_word[np.fromiter(map(index.__getitem__, chain.from_iterable(per_text)), np.int64, counts.sum())]
        total = np.concatenate([[0.0], np.cumsum(seq)])
        stop = np.cumsum(counts)
        start = stop - counts
        has = counts > 0
        for k, part in enumerate((seq, np.maximum(seq, 0), np.maximum(seq - CLEAR, 0))):
            out[has, k] = np.add.reduceat(part, start[has]) / counts[has]
        last = np.repeat(stop, counts)
        here = np.arange(len(seq))
        for k, size in enumerate(STRETCHES, 3):
            window = (total[np.minimum(here + size, last)] - total[here]) / size
            out[has, k] = np.maximum.reduceat(window, start[has])
        return out


def ranks(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense numbers of the pairs (left, right), and the place where each pair is first met."""
    _, first, number = np.unique(left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64), return_index=True, return_inverse=True)
    return number.reshape(-1), first


def shared_backoff(grams: np.ndarray) -> np.ndarray:
    """Kneser-Ney probability of the last character after the ORDER - 2 before it, for each distinct top gram.

    `grams` has one row of code points per distinct gram of the highest order, either class. Grams are told apart by
    numbers that grow to the left, one character at a time.
    """
    none = np.zeros(len(grams), dtype=np.int64)
    which, first = ranks(none, grams[:, -1])
    context = none
    p = np.full(len(grams), 1.0 / max(1, len(first)))
    for n in range(1, ORDER):
        one = first  # where each gram of this order is first met
        longer, first = ranks(grams[:, ORDER - n - 1], which)  # distinct grams one longer: what continuation counts
        follows = np.bincount(which[first], minlength=which.max() + 1)
        total = np.bincount(context[first], minlength=context.max() + 1)
        kinds = np.bincount(context[one], minlength=context.max() + 1)
        p = (np.maximum(follows[which] - DISCOUNT, 0) + DISCOUNT * kinds[context] * p) / total[context]
        which, context = longer, ranks(grams[:, ORDER - n - 1], context)[0]
    return p


def build(points: np.ndarray, toxic: np.ndarray, plain: np.ndarray, bits: int) -> Ratios:
    """Tables from distinct grams (rows of ORDER code points) with their counts in both classes."""
    backoff = shared_backoff(points) if len(points) else np.zeros(0)
    flat = points.reshape(-1)
    gram, context = cells(flat, np.arange(len(points)) * ORDER + ORDER - 1, bits)
    size = 1 << bits
    probability, held = [], []
    for count in (toxic, plain):
        total = np.bincount(context, count, size)
        kinds = np.bincount(context, count > 0, size)
        back = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
        here = np.maximum(count - DISCOUNT, 0) / np.maximum(total[context], 1)
        probability.append(here + back[context] * backoff)
        held.append(np.log(back))
    table = np.full(size, np.nan, dtype=np.float32)
    table[gram] = np.log(probability[0]) - np.log(probability[1])
    return Ratios(table, (held[0] - held[1]).astype(np.float32), bits)


class Scorer:
    def __init__(self, ratios: Ratios | None, weights: np.ndarray, center: np.ndarray, scale: np.ndarray, share: float):
        self.ratios, self.weights, self.center, self.scale, self.share = ratios, weights, center, scale, share

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if self.ratios is None:
            return np.full(len(texts), self.share)
        x = (self.ratios.features(texts) - self.center) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[1:] + self.weights[0], -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (weight * (y - p)) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
    max_rows: int = 8000, bits: int = 21,
) -> Scorer:
    """Learn from the labelled rows among `docs`; at most `max_rows` of each class are read."""
    spark = docs.sparkSession
    own = (
        labels.where(quoted(doc_id).isNotNull() & quoted(label).isNotNull())
        .groupBy(quoted(doc_id).cast("string").alias("id")).agg(F.max((quoted(label) == 1).cast("int")).alias("y"))
    )
    sizes = {r.y: r.n for r in own.groupBy("y").agg(F.count("*").alias("n")).collect()}
    turn = F.xxhash64("id", F.lit(17))
    chosen: list[tuple[str, int]] = []
    for y in sizes:
        chosen += [(r.id, y) for r in own.where(F.col("y") == y).orderBy(turn, "id").limit(max_rows).collect()]
    total = sum(sizes.values())
    share = sizes.get(1, 0) / total if total else 0.0
    nothing = Scorer(None, np.zeros(0), np.zeros(0), np.zeros(0), share)
    if len(sizes) < 2:
        return nothing
    picked = F.broadcast(spark.createDataFrame(chosen, "id string, y int"))  # at most 2 * max_rows ids
    rows = docs.select(quoted(doc_id).cast("string").alias("id"), quoted(text).alias("text")).join(picked, "id")
    part = F.pmod(F.xxhash64("id", F.lit(23)), F.lit(4))
    counted = _count(rows.where(part != 0), bits)
    got = counted.toArrow().combine_chunks()  # at most 2 ** bits rows
    if not got.num_rows:
        return nothing
    points = np.frombuffer(b"".join(c.buffers()[2][: 4 * ORDER * len(c)] for c in got["gram"].chunks), ">u4").astype(np.uint32)
    ratios = build(points.reshape(-1, ORDER), got["toxic"].to_numpy(), got["plain"].to_numpy(), bits)
    del got, points
    seen = Scorer(ratios, np.zeros(0), np.zeros(0), np.zeros(0), share)
    shared = spark.sparkContext.broadcast(seen)
    fields = StructType([StructField(f"f{k}", DoubleType()) for k in range(FEATURES)])
    measured = add_columns(
        rows.where(part == 0), ["text"], fields, lambda: lambda t: list(shared.value.ratios.features(t).T), ["y"]
    ).toPandas()  # a few numbers for each chosen row
    y = measured.pop("y").to_numpy(np.float64)
    if len(set(y)) < 2:
        return nothing
    x = measured.to_numpy(np.float64)
    center, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    weight = np.where(y == 1, sizes[1] / max(1, (y == 1).sum()), sizes[0] / max(1, (y == 0).sum()))
    weight *= len(y) / weight.sum()
    return Scorer(ratios, _logistic((x - center) / scale, y, weight), center, scale, share)


def _count(rows: DataFrame, bits: int) -> DataFrame:
    """Distinct top grams (code points, four bytes each, in an order that sorts) with their counts in toxic and ordinary
    text, one gram for each table cell."""
    schema = StructType([
        StructField("cell", IntegerType()), StructField("gram", BinaryType()),
        StructField("toxic", LongType()), StructField("plain", LongType()),
    ])

    def run(batches):
        let_go()
        for b in (p for whole in batches for p in pieces(whole, 256 << 10)):
            texts, ys = b.column(0).to_pylist(), b.column(1).to_pylist()
            for y in (0, 1):
                words = [w for t, own in zip(texts, ys, strict=True) if own == y for w in words_of(t)]
                if not words:
                    continue
                chars, at = spell(words)
                cell, _ = cells(chars, at, bits)
                keys, first, counts = np.unique(cell, return_index=True, return_counts=True)
                points = np.stack([chars[at[first] - back] for back in range(ORDER - 1, -1, -1)], axis=1).astype(">u4")
                names = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * ORDER), len(keys), [None, pa.py_buffer(points.tobytes())])
                zero = np.zeros(len(keys), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int32()), names.cast(pa.binary()),
                     pa.array(counts if y else zero, pa.int64()), pa.array(zero if y else counts, pa.int64())],
                    names=schema.names,
                )

    return (
        rows.select("text", "y").mapInArrow(run, schema).groupBy("cell")
        .agg(F.min("gram").alias("gram"), F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"))
    )


def scores(docs: DataFrame, scorer: Scorer, text: str):
    """The score as a column: only the texts go to Python, only numbers come back."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    @F.arrow_udf(DoubleType())
    def measure(texts: pa.Array) -> pa.Array:
        let_go()
        parts = pieces(pa.RecordBatch.from_arrays([texts], names=["text"]), 256 << 10)
        found = [shared.value(p.column(0).to_pylist()) for p in parts]
        return pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())

    return measure(quoted(text))


def score(docs: DataFrame, scorer: Scorer, text: str = "text", threshold: float = 0.7, keep: list[str] | None = None) -> DataFrame:
    """Add score (0 to 1) and predicted (1 from `threshold` on)."""
    kept = [c for c in without(docs, ["score", "predicted"]).columns if keep is None or c in keep]
    scored = docs.select(*[quoted(c) for c in kept], scores(docs, scorer, text).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, scorer: Scorer, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Keep the documents scored below the threshold and those without a word, with the columns they came with."""
    silent = ~F.coalesce(quoted(text), F.lit("")).rlike(r"[\p{L}\p{N}]")
    return docs.where(silent | (scores(docs, scorer, text) < threshold))
