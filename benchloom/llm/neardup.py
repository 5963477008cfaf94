"""Near-duplicate classes by BagMinHash, banding and exact verification.

Two documents are linked when the multisets of their runs of `shingle` words have a weighted Jaccard similarity
(sum of minima over sum of maxima) of at least `threshold`; classes are the connected parts. Words are what white space
separates, A-Z in lower case; a text with fewer words than a run is one run.

1. Texts with equal words collapse first, so groups of exact copies never meet the pair stage.
2. Each distinct text gets a BagMinHash signature (`bagminhash`), cut into `bands` keys of `rows` slots.
3. In a bucket of texts with a common key, all are compared with one pivot, the text that shares most keys with
   others (the centre of a family of variants). Links are verified on the full multisets.
4. Where a bucket's texts still lie in different classes, each text outside the pivot's class is compared with all
   texts of other classes there. What cannot be linked is skipped, that is when the distances to the first pivot differ
   by more than 1 - threshold (Jaccard distance is a metric). A bucket of up to 32 texts is joined with itself. A larger
   one is dealt into cells, some of its loose texts by some of all its texts, of bounded rows and bytes; a cell finds its
   similarities through an inverted index and returns only links that join two of its classes. So no bucket is capped,
   none is written out as pairs, and every two texts with a common key end up in one class if they are linked. A bucket
   with very many loose texts takes work that grows with their number times its size, spread over its cells.

With 40 bands of 6 slots a pair at similarity 0.8 shares no key with probability 5e-6.

Defined cases: null and empty texts have no words and are classes of their own row; a class is named by its smallest
id (ids are compared in their own order; rows with a null id belong to the class of their text, whose name is null if all
ids are); repeated rows are copies; further columns are returned by `near_duplicates` only on request.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructField, StructType
from xxhash import xxh3_64_intdigest

from benchloom.llm.bagminhash import C1, bands as band_keys, mix, signatures
from benchloom.llm.common import BROADCAST_BYTES, add_columns, quoted, remove, scratch, written

SMALL = 32  # texts in a bucket that is joined with itself; larger ones are compared in cells
PIECE_BYTES = 512 << 10  # of texts that are shingled at once: shingles and points take some fifty times as much
CELL_ROWS, CELL_BYTES = 256, 8 << 20  # of each side of a cell, on average
SEED_BITS = 26  # of the fixed-size filter that spares texts without candidates the second reading


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def text_key(words: list[bytes]) -> bytes | None:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None


class Shingler:
    """Shingle multisets of many texts at once."""

    def __init__(self, size: int):
        self.size = size

    def __call__(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, shingle hash, count), sorted, for texts with words."""
        sizes = np.array([len(w) for w in texts], dtype=np.int64)
        seq = np.fromiter(map(xxh3_64_intdigest, chain.from_iterable(texts)), np.uint64, sizes.sum())
        width = np.minimum(sizes, self.size)
        starts = np.cumsum(sizes) - sizes
        number = sizes - width + (sizes > 0)
        doc = np.repeat(np.arange(len(texts)), number)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number) + starts[doc]
        w = width[doc]
        h = w.astype(np.uint64)
        for j in range(self.size):
            step = mix(h * C1 + seq[np.minimum(at + j, len(seq) - 1)])
            h = np.where(j < w, step, h)
        order = np.lexsort((h, doc))
        doc, h = doc[order], h[order]
        first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])])) if len(h) else np.zeros(0, int)
        return doc[first], h[first], np.diff(np.append(first, len(h)))


def sketches(docs: DataFrame, doc_id: str, text: str, shingle: int, bands: int, rows: int) -> DataFrame:
    """id, key of the words and band keys of each row; both null for a text without words."""
    added = StructType([StructField("key", BinaryType()), StructField("bands", ArrayType(LongType()))])

    def make():
        shingler = Shingler(shingle)

        def work(texts):
            words = [words_of(t) for t in texts]
            keys = [text_key(w) for w in words]
            own = {k: w for k, w in zip(keys, words, strict=True) if k is not None}
            found: dict = {None: None}
            if own:
                doc, element, weight = shingler(list(own.values()))
                sig = band_keys(signatures(doc, element, weight, len(own), bands * rows), rows).astype(np.int64)
                found.update(zip(own, sig, strict=True))
            return keys, [found[k] for k in keys]

        return work

    return add_columns(docs.select(quoted(doc_id).alias("id"), quoted(text).alias("text")), ["text"], added, make, ["id"], piece_bytes=PIECE_BYTES)


def _filter_of(keys: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with one bit for each key: what is not in it is not among the keys."""
    start = F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long")
    rows = (
        keys.select((start % (1 << SEED_BITS)).alias("b")).groupBy(F.shiftright("b", 5).alias("w"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(b % 32 AS INT)))").alias("v")).toPandas()
    )
    out = np.zeros(1 << (SEED_BITS - 5), dtype=np.uint32)
    out[rows["w"].to_numpy(np.int64)] = rows["v"].to_numpy(np.int64).astype(np.uint32)
    return out


def _bags(docs: DataFrame, text: str, keys: DataFrame, shingle: int) -> DataFrame:
    """Sorted shingle hashes and counts of the texts with the given keys."""
    may = docs.sparkSession.sparkContext.broadcast(_filter_of(keys))
    schema = StructType([StructField("key", BinaryType()), StructField("bag", BinaryType()), StructField("counts", BinaryType())])

    def make():
        shingler = Shingler(shingle)

        def wanted(key):
            if key is None:
                return False
            bit = int.from_bytes(key[:4], "big") % (1 << SEED_BITS)
            return bool(may.value[bit >> 5] >> (bit & 31) & 1)

        def work(texts):
            words = [words_of(t) for t in texts]
            keys = [k if wanted(k) else None for k in map(text_key, words)]
            own = dict((k, w) for k, w in zip(keys, words, strict=True) if k is not None)
            found: dict = {None: (None, None)}
            if own:
                doc, h, n = shingler(list(own.values()))
                cut = np.searchsorted(doc, np.arange(len(own) + 1))
                for k, a, b in zip(own, cut[:-1], cut[1:], strict=True):
                    found[k] = (h[a:b].tobytes(), n[a:b].astype(np.uint32).tobytes() if n[a:b].max() > 1 else b"")
            return keys, [found[k][0] for k in keys], [found[k][1] for k in keys]

        return work

    bags = add_columns(docs.select(quoted(text).alias("text")), ["text"], schema, make, [], piece_bytes=PIECE_BYTES).where("key IS NOT NULL")
    return bags.join(keys, "key", "left_semi").groupBy("key").agg(F.min(F.struct("bag", "counts")).alias("b")).select("key", "b.*")


def similarity(a: bytes, na: bytes, b: bytes, nb: bytes) -> float:
    """Weighted Jaccard similarity of two bags."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    wx = np.frombuffer(na, np.uint32) if na else np.ones(len(x), np.uint32)
    wy = np.frombuffer(nb, np.uint32) if nb else np.ones(len(y), np.uint32)
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = y[at] == x
    low = int(np.minimum(wx[both], wy[at[both]]).sum())
    return low / (int(wx.sum()) + int(wy.sum()) - low)


def _verified(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """(a, b, sim) for pairs of keys."""
    left = bags.select(F.col("key").alias("a"), F.col("bag").alias("x"), F.col("counts").alias("nx"))
    right = bags.select(F.col("key").alias("b"), F.col("bag").alias("y"), F.col("counts").alias("ny"))
    both = pairs.join(left, "a").join(right, "b")
    return add_columns(
        both, ["x", "nx", "y", "ny"], StructType([StructField("sim", DoubleType())]),
        lambda: lambda *cols: ([similarity(*r) for r in zip(*cols, strict=True)],), ["a", "b"],
    )


def components(links: DataFrame, path: str) -> DataFrame:
    """(key, part): the smallest key reachable over links (a, b).

    Each round takes the smallest name among the neighbours and then the name of that name, so chains shorten fast.
    """
    spark = links.sparkSession
    edges = written(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{path}/edges")
    part = edges.groupBy(F.col("a").alias("key")).agg(F.least(F.col("key"), F.min("b")).alias("part"))
    part = written(part, f"{path}/0")
    step = 0
    while True:
        step += 1
        near = edges.join(part, edges.b == part.key).groupBy("a").agg(F.min("part").alias("p"))
        new = part.join(near, part.key == near.a).select("key", F.col("part").alias("old"), F.least("part", "p").alias("mid"))
        up = part.select(F.col("key").alias("mid"), F.col("part").alias("top"))
        new = new.join(up, "mid").select("key", "old", F.least("mid", "top").alias("part"))
        new = written(new, f"{path}/{step}")
        if not new.where("part != old").head(1):
            return new.select("key", "part")
        part = spark.read.parquet(f"{path}/{step}").select("key", "part")


def links_between_texts(docs: DataFrame, nodes: DataFrame, text: str, threshold: float, shingle: int, path: str) -> DataFrame:
    """Classes (key, part) of the distinct texts that have a link."""
    at = nodes.select("key", F.explode("bands").alias("band"))
    buckets = at.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = written(at.join(buckets, "band"), f"{path}/members")
    keys = written(members.groupBy("key").agg(F.sum("n").alias("pull")), f"{path}/keys")
    bags = _bags(docs, text, keys.select("key"), shingle).withColumn("bytes", F.length("bag") + F.length("counts"))
    bags = written(bags, f"{path}/bags")
    members = members.select("band", "key").join(keys, "key")
    pivot = members.groupBy("band").agg(F.max(F.struct("pull", "key"))["key"].alias("pivot"))
    members = written(members.join(pivot, "band"), f"{path}/pivoted")
    pairs = members.where("key != pivot").select(F.col("key").alias("a"), F.col("pivot").alias("b")).distinct()
    known = written(_verified(pairs, bags), f"{path}/star")
    links = known.where(F.col("sim") >= threshold).select("a", "b")
    part = components(links, f"{path}/parts0")

    far = known.select(F.col("a").alias("key"), F.col("b").alias("pivot"), (1 - F.col("sim")).alias("far"))
    sizes = members.groupBy("band").agg(F.count("*").alias("size")).where("size > 2")
    near = members.join(sizes, "band").join(far, ["key", "pivot"], "left").na.fill(0.0, ["far"])
    near = written(near.select("band", "key", "pivot", "far", "size"), f"{path}/near")
    gap = 1 - threshold + 1e-9  # distances are rounded
    for step, size in (("small", F.col("size") <= SMALL), ("large", F.col("size") > SMALL)):
        named = _named(near.where(size), part)
        if step == "small":
            pairs = written(_pairs(named, gap), f"{path}/pairs")
            new = _verified(pairs, bags).where(F.col("sim") >= threshold).select("a", "b")
        else:
            new = _cell_links(named, bags, gap, threshold)
        new = written(new, f"{path}/links_{step}")
        if new.head(1):
            links = links.union(new)
            part = components(links, f"{path}/parts_{step}")
    return part


def _named(near: DataFrame, part: DataFrame) -> DataFrame:
    """Texts of buckets with their classes p; loose: outside the class of the first pivot."""
    named = near.join(part.withColumnRenamed("part", "p"), "key", "left").withColumn("p", F.coalesce("p", "key"))
    heads = named.where("key = pivot").select("band", F.col("p").alias("head"))
    return named.join(heads, "band").withColumn("loose", F.expr("p != head")).drop("head")


def _pairs(named: DataFrame, gap: float) -> DataFrame:
    """(a, b): each loose text of a bucket with the texts of other classes there that are not ruled out."""
    probes = named.where("loose").select("band", F.col("key").alias("probe"), F.col("p").alias("pp"), F.col("far").alias("pfar"))
    pairs = named.join(probes, "band").where("key != probe AND p != pp AND key != pivot").where(F.abs(F.col("far") - F.col("pfar")) <= gap)
    return pairs.select(F.least("key", "probe").alias("a"), F.greatest("key", "probe").alias("b")).distinct()


def _cell_links(named: DataFrame, bags: DataFrame, gap: float, threshold: float) -> DataFrame:
    """Links (a, b) that join the classes of buckets of any size: all loose texts against all texts, in cells."""
    named = named.join(bags.select("key", "bytes"), "key")
    own = lambda c: F.when(F.col("loose"), c)
    parts = lambda n, size: F.greatest(F.ceil(n / CELL_ROWS), F.ceil(size / CELL_BYTES), F.lit(1)).cast("int")
    stats = named.groupBy("band").agg(
        parts(F.count(own(F.lit(1))), F.sum(own(F.col("bytes")))).alias("across"), parts(F.count("*"), F.sum("bytes")).alias("down"),
        F.min(own(F.col("far"))).alias("low"), F.max(own(F.col("far"))).alias("high"),
    ).where("low IS NOT NULL")
    named = named.join(stats, "band").where((F.col("far") >= F.col("low") - gap) & (F.col("far") <= F.col("high") + gap))
    place = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    probes = named.where("loose").select("band", place("across").alias("i"), every("down").alias("j"), "key", "p", "loose")
    others = named.select("band", every("across").alias("i"), place("down").alias("j"), "key", "p", F.lit(False).alias("loose"))
    cells = probes.union(others).join(bags.select("key", "bag", "counts"), "key")
    return cells.groupBy("band", "i", "j").applyInPandas(lambda pdf: cell_links(pdf, threshold), "a binary, b binary")


def cell_links(cell: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links between the loose and the other rows (key, p, loose, bag, counts) of a cell, one for each two classes that they join."""
    probes, others = cell[cell["loose"]], cell[~cell["loose"]]
    parent: dict = {}

    def root(p):
        while (up := parent.get(p, p)) != p:
            parent[p] = p = parent.get(up, up)
        return p

    def bag(b, n):
        h = np.frombuffer(b, np.uint64)
        return h, np.frombuffer(n, np.uint32).astype(np.int64) if n else np.ones(len(h), np.int64)

    found = []
    if len(probes) and len(others):
        bags = [bag(*x) for x in zip(others["bag"], others["counts"], strict=True)]
        h, w = np.concatenate([x[0] for x in bags]), np.concatenate([x[1] for x in bags])
        doc = np.repeat(np.arange(len(bags)), [len(x[0]) for x in bags])
        total = np.array([x[1].sum() for x in bags])
        order = np.argsort(h, kind="stable")
        h, w, doc = h[order], w[order], doc[order]
        names = list(zip(others["key"], others["p"], strict=True))
        for key, p, b, n in zip(probes["key"], probes["p"], probes["bag"], probes["counts"], strict=True):
            x, wx = bag(b, n)
            start = np.searchsorted(h, x)
            size = np.searchsorted(h, x, "right") - start
            at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
            low = np.bincount(doc[at], np.minimum(np.repeat(wx, size), w[at]), len(bags))
            for k in np.flatnonzero(low / (wx.sum() + total - low) >= threshold):
                other, q = names[k]
                if (one := root(p)) != (two := root(q)):
                    parent[one] = two
                    found.append((key, other))
    return pd.DataFrame(found, columns=["a", "b"])


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8, shingle: int = 5,
    bands: int = 40, rows: int = 6,
) -> DataFrame:
    """One row per document: id, class_id (smallest id of its class) and class_size (rows in the class)."""
    path = scratch(docs.sparkSession)
    drawn = written(sketches(docs, doc_id, text, shingle, bands, rows), f"{path}/sketches")
    # one row per distinct text; the copies meet in the map-side combine of this aggregate
    nodes = drawn.where("key IS NOT NULL").groupBy("key").agg(F.min("bands").alias("bands"))
    part = links_between_texts(docs, nodes, text, threshold, shingle, path)
    keyed = drawn.select("id", "key").join(part, "key", "left").withColumn("part", F.coalesce("part", "key"))
    names = keyed.where("part IS NOT NULL").groupBy("part").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size"))
    out = keyed.join(names, "part", "left").select(
        "id", F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
    )
    out = written(out.withColumnRenamed("id", doc_id), scratch(docs.sparkSession))
    remove(docs.sparkSession, path)
    return out


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with the smallest id of each class, with all their columns.

    Documents without words and documents with a null id are kept; rows that repeat an id are kept or dropped together.
    """
    found = near_duplicates(docs, doc_id, text, **options)
    later = found.where(quoted(doc_id).isNotNull() & (quoted(doc_id) != F.col("class_id"))).select(quoted(doc_id).alias("__later")).distinct()
    # the ids go to the texts, so that no text is shuffled, as long as they are few enough to be broadcast
    size = later.agg(F.sum(F.octet_length(F.col("__later").cast("string")) + 64)).first()[0] or 0
    return docs.join(F.broadcast(later) if size <= BROADCAST_BYTES else later, quoted(doc_id) == F.col("__later"), "left_anti")
