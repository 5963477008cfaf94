"""Links between texts of large buckets, whatever their place among the other texts."""

from __future__ import annotations

import collections

import numpy as np
import pandas as pd

from benchloom.llm import neardup
from benchloom.llm.common import scratch
from conftest_llm import prose
from test_corpus_operators import brute_classes


def key(text):
    return neardup.text_key(neardup.words_of(text))


def variants(seed, n, words=150):
    base = prose(seed, words).split()
    return [" ".join([*base[:k], f"w{seed}x{k}", *base[k + 1 :]]) for k in range(n)]


def classes(spark, placed):
    """Sets of the texts that end up in one class; placed: text -> its bands."""
    docs = spark.createDataFrame([(t,) for t in placed], "text string")
    nodes = spark.createDataFrame([(key(t), b) for t, b in placed.items()], "key binary, bands array<long>")
    part = {bytes(r.key): bytes(r.part) for r in neardup.links_between_texts(docs, nodes, "text", 0.8, 5, scratch(spark)).collect()}
    out = collections.defaultdict(set)
    for t in placed:
        out[part.get(key(t), key(t))].add(t)
    return sorted(map(sorted, out.values()))


def brute(texts):
    return sorted(sorted(texts[k] for k in own) for own in brute_classes(list(enumerate(texts))).values())


def test_large_bucket_without_a_link_elsewhere(spark, monkeypatch):
    """Families of two beside a large one, all in one bucket; no small bucket or second common key helps."""
    texts = [*variants(1, 40), *variants(2, 2), *variants(3, 2), *variants(4, 2), prose(5, 150)]
    want = brute(texts)
    assert sorted(map(len, want)) == [1, 2, 2, 2, 40]
    assert classes(spark, dict.fromkeys(texts, [7])) == want
    for rows, size in ((10, 1 << 20), (256, 9000)):  # many cells
        monkeypatch.setattr(neardup, "CELL_ROWS", rows)
        monkeypatch.setattr(neardup, "CELL_BYTES", size)
        assert classes(spark, dict.fromkeys(texts, [7])) == want


def test_cell_links_are_exact_and_few():
    rng = np.random.default_rng(3)
    shingler = neardup.Shingler(5)
    texts = []
    for k in range(12):
        base = prose(40 + k, 60).split() * (1 + k % 3)
        for _ in range(6):
            own = list(base)
            for _ in range(int(rng.integers(0, 5))):
                own[int(rng.integers(len(own)))] = f"v{rng.integers(10**6)}"
            texts.append(" ".join(own))
    texts = sorted(set(texts))
    doc, h, n = shingler([neardup.words_of(t) for t in texts])
    rows = [(key(t), key(t), h[doc == k].tobytes(), n[doc == k].astype(np.uint32).tobytes() if n[doc == k].max() > 1 else b"") for k, t in enumerate(texts)]
    cell = pd.DataFrame([(*r[:2], loose, *r[2:]) for r in rows for loose in (True, False)], columns=["key", "p", "loose", "bag", "counts"])
    found = neardup.cell_links(cell, 0.8)
    names = {r[0]: r[0] for r in rows}
    for a, b in zip(found["a"], found["b"], strict=True):
        names = {k: names[b] if v == names[a] else v for k, v in names.items()}
    got = collections.defaultdict(list)
    for t in texts:
        got[names[key(t)]].append(t)
    want = brute(texts)
    assert sorted(map(sorted, got.values())) == want
    assert len(found) == len(texts) - len(want)


def test_probe_without_partners_does_not_hold_up_its_bucket(spark):
    """The loose text with the most shared keys is too far from all others; other buckets still find links for a while."""
    one, two = variants(11, 40), variants(12, 40)
    half = " ".join([*one[0].split()[:100], *prose(13, 50).split()])
    pair, other, third = variants(14, 2), variants(15, 2), variants(16, 2)
    centre, lone = prose(17, 150), [prose(18 + k, 150) for k in range(3)]
    placed = {t: [1] for t in [*one, half, *pair]} | {t: [2] for t in [*two, *other]} | {t: [3] for t in [centre, *third]}
    placed[one[1]] = [1, 5, 6]
    placed[half] = [1, 7]
    placed[two[1]] = [2, 8]
    placed[centre] = [3, 8]
    placed |= {lone[0]: [5], lone[1]: [6], lone[2]: [6, 7]}
    want = brute(list(placed))
    assert {tuple(sorted(p)) for p in (pair, other, third)} <= set(map(tuple, want))
    assert classes(spark, placed) == want


def test_dropping_copies_does_not_shuffle_texts(spark, monkeypatch):
    rows = [(k, prose(k // 2, 60)) for k in range(20)] + [(None, prose(3, 60)), (30, None), (31, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans, left = [], []
        for limit in (neardup.BROADCAST_BYTES, 0):
            monkeypatch.setattr(neardup, "BROADCAST_BYTES", limit)
            kept = neardup.keep_one(docs)
            plans.append(kept._jdf.queryExecution().sparkPlan().toString())
            left.append(sorted((r.doc_id if r.doc_id is not None else -1) for r in kept.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" in plans[1]
    assert left[0] == left[1] == [-1, *range(0, 20, 2), 30, 31]
