"""Near-duplicates, repeated passages, language model, quality, toxicity, chat and pipeline against plain Python."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import sys
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from benchloom.llm import bagminhash, chat, diffcover, lm, neardup, quality, repeats, toxicity
from benchloom.llm.blocks import pack, unpack
from conftest_llm import prose


def bag(text):
    w = (text or "").encode().lower().split()
    size = min(5, len(w))
    return collections.Counter(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if w else collections.Counter()


def jaccard(a, b):
    low = sum((a & b).values())
    return low / (sum(a.values()) + sum(b.values()) - low) if a and b else 0.0


def brute_classes(rows):
    names = list(range(len(rows)))

    def top(k):
        while names[k] != k:
            k = names[k]
        return k

    bags = [bag(t) for _, t in rows]
    for a in range(len(rows)):
        for b in range(a):
            if jaccard(bags[a], bags[b]) >= 0.8:
                names[top(a)] = top(b)
    groups = collections.defaultdict(list)
    for k in range(len(rows)):
        groups[top(k)].append(k)
    return groups


def test_bagminhash_is_unbiased():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(30):
        e = rng.integers(0, 2**63, 150).astype(np.uint64)
        a = rng.integers(0, 12, 150)
        b = np.where(rng.random(150) < 0.6, a, rng.integers(0, 12, 150))
        doc = np.concatenate([np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)])
        s = bagminhash.signatures(doc, np.concatenate([e[a > 0], e[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 2, 240)
        errors.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 4 * np.std(errors) / math.sqrt(30) + 1e-3
    assert np.std(errors) < 0.05


def test_near_duplicates(spark, odd_rows, none):
    rng = random.Random(4)
    rows = list(odd_rows)
    for family in range(12):
        words = prose(1000 + family, 120).split()
        for k in range(rng.randint(2, 45 if family == 0 else 6)):
            own = list(words)
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(len(own))] = f"w{rng.randrange(10**6)}"
            rows.append((100 + 50 * family + k, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class_id", F.lit("mine"))
    got = collections.defaultdict(list)
    for r in neardup.near_duplicates(docs).collect():
        got[r.class_id, r.class_size].append(-1 if r.doc_id is None else r.doc_id)
    want = {}
    for own in brute_classes(rows).values():
        ids = [rows[k][0] for k in own]
        want.setdefault((min(i for i in ids if i is not None), len(ids)), []).extend(-1 if i is None else i for i in ids)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert neardup.near_duplicates(none).count() == 0
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    later = {i for (c, _), v in got.items() for i in v if i != c and i != -1}
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - later


def test_suffix_array_and_windows():
    rng = np.random.default_rng(0)
    for _ in range(200):
        x = rng.integers(1, int(rng.integers(2, 5)), int(rng.integers(0, 60)))
        assert diffcover.suffix_array(x).tolist() == sorted(range(len(x)), key=lambda i: x[i:].tolist())


@pytest.mark.parametrize("block_bytes", [6 << 20, 3000])
def test_repeats(spark, odd_rows, none, block_bytes):
    rng = random.Random(2)
    rows = list(odd_rows)
    shared = [prose(500 + k, 20) for k in range(5)]
    for k in range(60):
        rows.append((rng.randrange(20, 70), " ".join([prose(600 + k, rng.randint(0, 25)), rng.choice(shared)[rng.randint(0, 9) :], "z" * rng.randint(0, 120)])))
    width, first = 50, {}
    key = lambda i: 2**63 - 1 if i is None else i
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - width + 1):
            w = b[p : p + width]
            first[w] = min(first.get(w, key(i)), key(i))
    want = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if first[b[p : p + width]] < key(i):
                gone[p : p + width] = b"\1" * width
        runs = [m.span() for m in re.finditer(b"\1+", bytes(gone))]
        want.append((key(i), len(b), runs, bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = repeats.remove_repeats(docs, block_bytes=block_bytes).collect()
    assert sorted((key(r.doc_id), r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in got) == sorted(want)
    assert repeats.remove_repeats(none).collect() == []


@pytest.mark.parametrize("width", [1, 5, 7, 8, 20])
def test_equal_windows(width):
    rng = np.random.default_rng(width)
    for _ in range(30):
        texts = [bytes(rng.choice([0, 97, 255], size=int(rng.integers(width, width + 30))).tolist()) for _ in range(12)]
        data = np.array([c for t in texts for c in [*(x + 1 for x in t), 0]], dtype=np.uint16)
        starts = np.array([p for p in range(len(data) - width) if 0 not in data[p : p + width]])
        order, new = diffcover.equal_windows(data, starts, width)
        windows = [data[p : p + width].tolist() for p in order]
        assert sorted(order) == starts.tolist() and windows == sorted(windows)
        assert new.tolist() == [k == 0 or windows[k] != windows[k - 1] for k in range(len(windows))]


def _mailed(rng, blocks, width=50):
    """Stretches of one bucket as blocks send them: some shared by all, some with one anchor and different ends."""
    core = [bytes(rng.integers(97, 123, size=width, dtype=np.uint8)) for _ in range(300)]
    rows = []
    for _ in range(blocks):
        texts = {core[k] + bytes(rng.integers(97, 99, size=int(rng.integers(0, 4)), dtype=np.uint8)): k for k in rng.permutation(300)}
        ids = rng.integers(0, 1000, size=len(texts))
        rows.append((list(texts), list(texts.values()), ids))
    sizes = lambda texts: np.array([len(t) for t in texts], np.int32)
    return rows, [pack(sizes(t), np.array(a, np.uint64), i, np.frombuffer(b"".join(t), np.uint8)) for t, a, i in rows]


@pytest.mark.parametrize("budget", [1, 3000, 1 << 20])
def test_smallest_ids(budget):
    rows, mail = _mailed(np.random.default_rng(3), 4)
    first = {}
    for texts, _, ids in rows:
        for t, i in zip(texts, ids.tolist(), strict=True):
            for p in range(len(t) - 49):
                first[t[p : p + 50]] = min(i, first.get(t[p : p + 50], i))
    for (texts, _, _), answer in zip(rows, repeats.smallest_ids(mail, 50, budget), strict=True):
        parts, length, low = unpack(answer, np.int32, np.int32, np.int64)
        assert len(parts) == len(texts)
        assert np.repeat(low, length).tolist() == [first[t[p : p + 50]] for t in texts for p in range(len(t) - 49)]


def test_smallest_ids_work_on_arrays():
    """No chain of Python calls for each stretch: that was most of the operator's time."""
    rows, mail = _mailed(np.random.default_rng(4), 8)
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        repeats.smallest_ids(mail, 50)
    finally:
        sys.setprofile(None)
    assert calls < 3 * sum(len(texts) for texts, _, _ in rows)


@pytest.mark.parametrize("slice_bytes", [1 << 27, 500])
def test_language_model(spark, odd_rows, none, slice_bytes):
    docs = spark.createDataFrame(odd_rows, "doc_id long, text string")
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    got = lm.score(docs, held, slice_bytes=slice_bytes, block_bytes=4000).collect()
    tokens = [(i, (t or "").encode().lower().split() + [b"\n"]) for i, t in odd_rows]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = collections.Counter(w for i, ws in tokens if not out(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (i or 0, out(i), len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6)) for i, w in tokens
    )
    assert sorted((r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert sum(r.score for r in got if not r.held_out) > sum(r.base_score for r in got if not r.held_out)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert lm.score(none).collect() == []


def test_filter_levels_are_lower_bounds():
    rng = np.random.default_rng(3)
    pair = np.unique(rng.integers(0, 2**63, 4000).astype(np.uint64))
    count = rng.integers(1, 300, len(pair))
    bucket, number = lm._split(pair, 3)
    parts = [(b, *lm.filter_part(number[bucket == b], count[bucket == b])) for b in range(3)]
    levels = lm.Filter(parts, 3).levels(pair).astype(int)
    exact = np.floor(np.log2(count)).astype(int) + 1
    assert (levels >= exact).all() and (levels == exact).mean() > 0.97
    assert (lm.Filter(parts, 3).levels(rng.integers(0, 2**63, 4000).astype(np.uint64)) > 0).mean() < 0.02


def test_language_model_answers_pairs_where_they_are_counted(spark, odd_rows, monkeypatch):
    """One step of Python reads the blocks at the end, whatever the size of the filter, and nothing is broadcast."""
    docs = spark.createDataFrame(odd_rows, "doc_id long, text string")
    held = F.col("doc_id") % 3 == 0
    sent = []
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(value))
    plans = [lm.score(docs, held, slice_bytes=size, block_bytes=4000)._jdf.queryExecution().executedPlan().toString() for size in (1 << 27, 500)]
    assert [p.count("MapInArrow") for p in plans] == [1, 1] and sent == []


def _pair_mail(rng, blocks, n_pairs):
    """Mail of one bucket: words, their counts, numbers of pairs, and the counts that are not 1."""
    every = np.unique(rng.integers(0, 2**32, n_pairs, dtype=np.uint64)).astype(np.uint32)
    rows, mail = [], []
    for _ in range(blocks):
        number = np.sort(rng.choice(every, len(every) // 2, replace=False))
        count = rng.choice([0, 1, 1, 1, 2, 40], len(number)).astype(np.uint32)
        words = np.unique(rng.integers(0, 50, 40, dtype=np.uint64))
        other = np.flatnonzero(count != 1)
        rows.append((words, rng.integers(0, 9, len(words)).astype(np.uint32), number, count))
        mail.append(pack(*rows[-1][:3], other.astype(np.uint32), count[other]))
    return rows, mail


def test_a_bucket_answers_what_its_filter_part_says():
    rows, mail = _pair_mail(np.random.default_rng(5), 4, 5000)
    words, pairs = collections.Counter(), collections.Counter()
    for w, c, number, count in rows:
        words.update(dict(zip(w.tolist(), c.tolist(), strict=True)))
        pairs.update(dict(zip(number.tolist(), count.tolist(), strict=True)))
    replies, tokens, distinct = lm.answers(mail)
    assert (tokens, distinct) == (sum(words.values()), sum(c > 0 for c in words.values()))
    number, count = (np.array(x) for x in zip(*((k, c) for k, c in pairs.items() if c), strict=True))
    table = lm.Filter([(0, *lm.filter_part(number.astype(np.uint32), count))], 1)
    for (w, _, number, _), reply in zip(rows, replies, strict=True):
        total, last = unpack(reply, np.int64, np.uint8)
        assert total.tolist() == [words[x] for x in w.tolist()]
        assert last.tolist() == table.levels(number.astype(np.uint64) << np.uint64(32)).tolist()


def test_work_on_a_bucket_is_bounded_by_its_pairs():
    _, mail = _pair_mail(np.random.default_rng(6), 8, 400_000)
    tracemalloc.start()
    lm.answers(mail)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 16 * sum(map(len, mail))


def brute_statistics(t):
    t = t or ""
    w = [x for x in re.split("[\x20\x09-\x0d]+", t) if x]
    lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    seen = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    again = {k + j for k in range(len(w) - 4) if seen[tuple(w[k : k + 5])] > 1 for j in range(5)}
    failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again), failed


def test_quality(spark, odd_rows, none):
    rows = [(i, t, "en", None if k % 3 == 0 else "s") for k, (i, t) in enumerate(odd_rows)]
    rows += [(1000 + k, prose(2000 + k, 60 + k), "en", "s") for k in range(80)]
    rows += [(2000 + k, " ".join(w + "###" for w in prose(3000 + k, 80).split()), "en", "s") for k in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("kept", F.lit("x"))
    got = quality.judge(docs).collect()
    base = sorted((r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    assert base == sorted((i or 0, *brute_statistics(t)) for i, t, _, _ in rows)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[1000 + k] for k in range(80)) and not any(kept[2000 + k] for k in range(8))
    assert quality.judge(none.withColumns({"lang": F.lit("en"), "source": F.lit("s")})).collect() == []
    assert quality.judge(docs.limit(3)).count() == 3


def test_toxicity(spark, odd_rows, odd, none):
    rng = random.Random(6)
    rows, labels = [], []
    for k in range(400):
        words = prose(k, rng.randint(20, 200)).split()
        toxic = k % 5 == 0
        if toxic:
            for _ in range(max(3, len(words) // 15)):
                words[rng.randrange(len(words))] = rng.choice(["blargh", "blarghen", "vexnok", "vexnokish"])
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    labels += [(None, 1), (5, None), (99999, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit("own"), "lang": F.lit(None).cast("string")})
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    scorer = toxicity.fit(docs.where(~third), marks.where(~third))
    out = toxicity.score(docs.where(third), scorer).collect()
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in out) / len(out) > 0.95
    assert sorted(toxicity.score(odd, scorer).columns) == ["doc_id", "predicted", "score", "text"]
    assert all(0 <= r.score <= 1 for r in toxicity.score(odd, scorer).collect())
    empty = {r.score for r in toxicity.score(odd, scorer).where("text IS NULL OR trim(text) = ''").collect()}
    assert len(empty) == 1
    assert toxicity.score(none, scorer).collect() == []
    alone = toxicity.fit(docs, marks.where("toxic = 0"))
    assert {r.score for r in toxicity.score(odd, alone).collect()} == {0.0}
    assert {r.score for r in toxicity.score(odd, toxicity.fit(none, marks.limit(0))).collect()} == {0.0}


def test_shared_backoff_is_a_distribution():
    grams = np.array([[ord(c) for c in g] for g in ("aaaaab", "aaaabc", "aabbcd", "xaaaab", "xaaaac", "bbbbbb")], dtype=np.uint32)
    p = toxicity.shared_backoff(grams)
    assert ((p > 0) & (p <= 1)).all()


def test_chat(spark):
    long = [(7, k, "user" if k % 2 == 0 else "assistant", f"t{k}") for k in range(2500)]
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (3, 10, "user", "hi"), (3, 11, "assistant", "yo"), (3, 12, "user", "more"),
        (4, 0, "user", None), (5, 0, "user", ""), (6, 0, "user", "hi"), (6, 1, "assistant", "no"), (None, 0, "system", "x"), (9, 0, "user", "hi"),
        (9, 1, "assistant", "yo"), (9, 2, "user", "more"), (10, None, None, None), (11, 0, "user", "twice"), (11, 0, "user", "twice"), (12, 0, "user", "twice"),
        *long, *[(8, *r[1:]) for r in long[:1700]],
    ]
    logs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit("extra")).repartition(4)
    got = chat.render(logs)
    assert sorted({str(r.conv_id) for r in got.select("conv_id").distinct().collect()}) == ["10", "11", "3", "4", "5", "6", "7", "None"]
    three = [r.piece for r in got.where("conv_id = 3").orderBy("position").collect()]
    assert "".join(three) == "<|user|>\nhi\n<|end|>\n<|assistant|>\nyo\n<|end|>\n<|user|>\nmore\n<|end|>\n"
    seven = got.where("conv_id = 7").orderBy("position").collect()
    assert [r.piece for r in seven] == [f"<|{r[2]}|>\n{r[3]}\n<|end|>\n" for r in long] and seven[0].n_turns == 2500
    assert chat.render(logs.limit(0)).collect() == []


def test_pipeline(spark, tmp_path):
    rng = random.Random(8)
    passage = " ".join(f"bench{k}" for k in range(30))
    rows, labels = [], []
    for k in range(240):
        words = prose(5000 + k, rng.randint(60, 150)).split()
        toxic = k % 6 == 0
        if toxic:
            for _ in range(8):
                words[rng.randrange(len(words))] = rng.choice(["blargh", "blarghen", "vexnok"])
        text = " ".join(words)
        if k == 7:
            text += " " + passage + " tail"
        if k == 8:
            text += " mail joe.doe@mail.example.org now"
        rows.append((k, text, "en", f"s{k % 4}", len(text)))
        labels.append((k, 1, int(toxic)))
    rows += [(300, rows[1][1], "en", "s0", 1), (301, rows[1][1] + " extra", "en", "s1", 1), (302, None, None, None, None), (303, "", "en", "s", 0)]
    folder = str(tmp_path)
    for name, data, schema in (
        ("documents", rows, "doc_id long, text string, lang string, source string, n_chars long"),
        ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", [(1, passage)], "item_id long, text string"),
    ):
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/stage{k}")
        last, docs = docs, spark.read.parquet(f"{folder}/stage{k}")
        if name != "bpe":
            assert docs.columns == last.columns and docs.dtypes == last.dtypes
        seen[name] = {r.doc_id: r for r in docs.collect()}
    toxic = {k for k in range(240) if k % 6 == 0}
    left = set(seen["toxicity"])
    assert len(left & toxic) <= 4 and len({k for k in range(240) if k % 6} - left) <= 2 and {302, 303} <= left
    assert {1, 302, 303} <= set(seen["near_duplicates"]) and not {300, 301} & set(seen["near_duplicates"])
    assert len(seen["near_duplicates"]) == len(left - {300, 301})
    assert "bench" not in seen["decontamination"][7].text and seen["decontamination"][7].text.endswith(" tail")
    assert "<EMAIL>" in seen["pii"][8].text and seen["pii"][8].n_chars == len(seen["pii"][8].text) and seen["pii"][302].text is None
    assert seen["bpe"][302].n_tokens == 0 and hashlib.sha256(seen["bpe"][303].ids).hexdigest() == hashlib.sha256(b"").hexdigest()
    assert corpus_pipeline.run(spark, folder).count() == len(seen["bpe"])
