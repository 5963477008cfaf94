"""Benchmark decontamination: test n-grams in a broadcast hash set, scanned over all training windows.

Text is normalised to words: A-Z become lower case, every other ASCII character that is not a letter or digit
separates, all other characters belong to words. A window is `window` consecutive words of a benchmark item; an item
with fewer words, but not none, is one window. Every document word inside an occurrence of a window is hit.

The hash set holds 64-bit hashes of windows; a hit is confirmed word by word. The benchmark is dealt into slices, each
below `slice_bytes` of text (counted first), that are broadcast one after the other, so its size has no limit.

Defined cases: a null or empty text has no words; a null item text has no windows; an item with a null id hits words
but is not listed; repeated items count once, repeated documents are treated row by row; columns of the input named
like an added one are replaced.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from benchloom.llm.common import BROADCAST_BYTES, add_columns, quoted

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
#: Bytes that separate words become spaces, A-Z become a-z.
NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
STEP = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


def _mixed(n: int) -> np.ndarray:
    """One 64-bit number per word id; id 0 stands for words that no item has."""
    x = np.arange(n + 1, dtype=np.uint64) * np.uint64(STEP)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Grams:
    """The windows of one slice of the benchmark, ready for scanning."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.ids: dict[bytes, int] = {}
        by: dict[tuple[int, ...], set[str | None]] = {}
        for item, text in items:
            seq = tuple(self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text))
            size = min(window, len(seq))
            for i in range(len(seq) - size + 1 if size else 0):
                by.setdefault(seq[i : i + size], set()).add(item)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, dict]] = {}
        self.mixed = _mixed(len(self.ids))
        for size in sorted({len(g) for g in by}):
            grams = {g: sorted(x for x in v if x is not None) for g, v in by.items() if len(g) == size}
            hashes = self._hash(np.array(list(grams), dtype=np.int64).reshape(-1), np.arange(len(grams)) * size, size)
            seen = np.zeros(1 << 16, dtype=bool)
            seen[(hashes >> np.uint64(48)).astype(np.int64)] = True
            self.by_length[size] = (np.unique(hashes), seen, grams)

    def _hash(self, seq: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        h = np.zeros(len(at), dtype=np.uint64)
        for j in range(size):
            h = (h * np.uint64(STEP)) ^ self.mixed[seq[at + j]]
            h ^= h >> np.uint64(31)
        return h

    def scan(self, texts: list[str | None]) -> tuple[list[int], dict[int, tuple[np.ndarray, set[str]]]]:
        """Words per text, and for each text with a hit its mask of hit words and its items."""
        counts, parts = [], []
        for t in texts:
            w = words_of(t)
            counts.append(len(w))
            parts.append(np.fromiter(map(self.ids.get, w, repeat(0)), np.int64, len(w)))
            parts.append(np.zeros(1, np.int64))
        found: dict[int, tuple[np.ndarray, set[str]]] = {}
        if not parts or not self.ids:
            return counts, found
        seq = np.concatenate(parts)
        starts = np.concatenate([[0], np.cumsum(np.array(counts) + 1)])
        gap = np.flatnonzero(seq == 0)
        room = gap[np.searchsorted(gap, np.arange(len(seq)))] - np.arange(len(seq))  # known words from here on
        for size, (hashes, seen, grams) in self.by_length.items():
            at = np.flatnonzero(room >= size)
            h = self._hash(seq, at, size)
            near = seen[(h >> np.uint64(48)).astype(np.int64)]
            at, h = at[near], h[near]
            at = at[hashes[np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)] == h]
            for doc, p in zip(np.searchsorted(starts, at, side="right") - 1, at, strict=True):
                items = grams.get(tuple(seq[p : p + size].tolist()))
                if items is None:
                    continue
                doc = int(doc)
                mask, names = found.setdefault(doc, (np.zeros(counts[doc], dtype=bool), set()))
                mask[p - starts[doc] : p - starts[doc] + size] = True
                names.update(items)
        return counts, found




def added(prefix: str) -> StructType:
    kinds = {"n_words": LongType(), "n_hit": LongType(), "items": ArrayType(StringType()), "hit_words": BinaryType()}
    return StructType([StructField(prefix + k, v) for k, v in kinds.items()])


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = 10, slice_bytes: int = BROADCAST_BYTES // 8, keep: list[str] | None = None, prefix: str = "",
    cut: bool = False,
) -> DataFrame:
    """Documents with n_words, n_hit, items (sorted ids found) and hit_words (packed bits, one per word).

    `prefix` goes in front of the added names; `keep` names the input columns to return. With `cut` the text without its hit
    passages takes the place of the text.
    """
    items = benchmark.select(quoted(item_id).cast("string").alias("i"), quoted(item_text).alias("t")).where("t IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("t") + 64)).first()[0] or 0
    slices = -(-total // slice_bytes) or 1
    out = docs
    for s in range(slices):
        part = items.where(F.pmod(F.xxhash64("t", "i"), F.lit(slices)) == s).collect() if total else []
        last = s == slices - 1
        out = _scan_slice(out, [(r.i, r.t) for r in part], text, window, keep if last or keep is None else [*keep, text], prefix, s == 0, cut and last)
    return out


def _scan_slice(docs: DataFrame, part: list, text: str, window: int, keep: list[str] | None, prefix: str, first: bool, cut: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(part)

    def make():
        grams = Grams(shared.value, window)

        def work(texts, items=None, masks=None):
            counts, found = grams.scan(texts)
            n_hit, names, bits = [], [], []
            for k, n in enumerate(counts):
                mask, own = found.get(k, (None, set()))
                if items and items[k]:
                    own = own | set(items[k])
                if masks and masks[k]:
                    before = np.unpackbits(np.frombuffer(masks[k], np.uint8), count=n).astype(bool)
                    mask = before if mask is None else mask | before
                n_hit.append(0 if mask is None else int(mask.sum()))
                names.append(sorted(own))
                bits.append(b"" if mask is None else np.packbits(mask).tobytes())
            clean = ([without_hits(t, b) for t, b in zip(texts, bits, strict=True)],) if cut else ()
            return counts, n_hit, names, bits, *clean

        return work

    needs = [text] if first else [text, f"{prefix}items", f"{prefix}hit_words"]
    # the texts are cut in the same pass: a second one would take a second Python worker for each task
    schema = StructType([*added(prefix), *([StructField(text, StringType())] if cut else [])])
    return add_columns(docs, needs, schema, make, keep)


def remove_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", mode: str = "spans", **options) -> DataFrame:
    """Take hit passages out of the texts (`spans`), or hit documents out of the table (`documents`).

    A passage is a maximal run of hit words with what stands between them; it is replaced by one space. A null text
    stays null. The columns of the input are returned.
    """
    if mode not in ("spans", "documents"):
        raise ValueError(f"mode is spans or documents, not {mode!r}")
    found = find_contamination(docs, benchmark, text, prefix="__dc_", cut=mode == "spans", **options)
    if mode == "documents":
        found = found.where("__dc_n_hit = 0")
    return found.select(*[quoted(c) for c in docs.columns])


def without_hits(t: str | None, bits: bytes | None) -> str | None:
    """The text with one space for each maximal run of hit words."""
    if not t or not bits:
        return t
    spans = [m.span() for m in WORD.finditer(lowered(t))]
    hit = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(spans))
    out, at, k = [], 0, 0
    while k < len(spans):
        if not hit[k]:
            k += 1
            continue
        first = k
        while k < len(spans) and hit[k]:
            k += 1
        out += [t[at : spans[first][0]], " "]
        at = spans[k - 1][1]
    return "".join(out) + t[at:]


_LOWER = {c: c + 32 for c in range(65, 91)}


def lowered(text: str) -> str:
    return text.translate(_LOWER)
