"""Alignment against a plain comparison of byte ranges."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from conftest_llm import prose
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from test_token_files import odd_texts
from tokenizers import Tokenizer

from benchloom.llm import alignment
from benchloom.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_of(char):
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return ord(char) if ord(char) in plain else [b for b in range(256) if b not in plain][ord(char) - 256]


def tokenized(texts):
    """Per text (A ids, A bytes, B ids, B bytes), without tokens where the bytes differ."""
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    for t in texts:
        own = a.encode(" " + t, add_special_tokens=False).ids if t else []
        spelled_a = [bytes(map(byte_of, a.id_to_token(i))) for i in own]
        other = b.encode(t) if t else []
        spelled_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(other, map(b.id_to_piece, other), strict=True)]
        want = (" " + t).encode() if t else b""
        yield (own, spelled_a, other, spelled_b) if b"".join(spelled_a) == b"".join(spelled_b) == want else ([], [], [], [])


def brute(texts):
    """Per text (n_a, n_b, groups, links as places)."""
    for own, spelled_a, other, spelled_b in tokenized(texts):
        ends_a, ends_b = np.cumsum(list(map(len, spelled_a))).tolist(), np.cumsum(list(map(len, spelled_b))).tolist()
        links = []
        for i, (end, size) in enumerate(zip(ends_a, map(len, spelled_a), strict=True)):
            links += [(i, j) for j in range(len(other)) if min(end, ends_b[j]) > max(end - size, ends_b[j] - len(spelled_b[j]))]
        groups = []
        at_a = at_b = 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = ends_a.index(cut) + 1, ends_b.index(cut) + 1
            groups.append(",".join(map(str, own[at_a:to_a])) + "|" + ",".join(map(str, other[at_b:to_b])))
            at_a, at_b = to_a, to_b
        yield own, other, groups, links


def summary(rows):
    found = list(brute([t for _, t in rows]))
    holders = Counter()
    for own, other, _, links in found:
        holders.update({(own[i], other[j]) for i, j in links})
    top = defaultdict(int)
    for (i, _), n in holders.items():
        top[i] = max(top[i], n)
    out = []
    for (doc, _), (own, other, groups, links) in zip(rows, found, strict=True):
        counts = [(holders[own[i], other[j]], top[own[i]]) for i, j in links]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if own else ""
        out.append((doc, len(own), len(other), len(groups), len(links), sum(n == t for n, t in counts), sum(n for n, _ in counts), digest))
    return sorted(out, key=str)


def test_lockstep_equals_a_merge_of_each_lane():
    rng = random.Random(2)
    a_end, b_end, lanes, want = [], [], [], []
    for _ in range(60):
        size = rng.randrange(0, 40)
        cuts = [sorted({*rng.sample(range(1, size), rng.randrange(0, size - 1)), size}) if size > 1 else [size] * (size > 0) for _ in range(2)]
        base = (a_end or [0])[-1]
        lanes.append((len(a_end), len(a_end) + len(cuts[0]), len(b_end), len(b_end) + len(cuts[1])))
        for i, end in enumerate(cuts[0]):
            for j, other in enumerate(cuts[1]):
                if min(end, other) > max(([0, *cuts[0]])[i], ([0, *cuts[1]])[j]):
                    want.append((len(a_end) + i, len(b_end) + j, end == other))
        a_end += [base + c for c in cuts[0]]
        b_end += [base + c for c in cuts[1]]
    got = alignment.lockstep(np.array(a_end), np.array(b_end), *(np.array(x) for x in zip(*lanes, strict=True)))
    assert sorted(zip(*(x.tolist() for x in got), strict=True)) == sorted(want)
    assert [len(x) for x in alignment.lockstep(*[np.zeros(0, np.int64)] * 6)] == [0, 0, 0]


def test_align_returns_tokens_links_and_groups(spark):
    rows = list(enumerate(odd_texts(400, 9) + [prose(k, 30) for k in range(20)] + ["", None, "x" * 700, "é" * 300 + " a", "<s> </s> <unk> <|endoftext|>"]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("Links", F.lit("own")).repartition(3)
    got = alignment.align(docs, A, B)
    assert got.columns == ["doc_id", "text", "a_ids", "b_ids", "links", "groups"]
    for r, (own, other, groups, links) in zip(sorted(got.collect()), brute([t or "" for _, t in rows]), strict=True):
        assert (r.a_ids, r.b_ids, r.groups) == (own, other, ";".join(groups)), rows[r.doc_id]
        assert list(zip(r.links[::2], r.links[1::2], strict=True)) == links


def test_query_counts_pairs_over_all_documents(spark, odd_rows, tmp_path, monkeypatch):
    monkeypatch.setattr(alignment, "PIECE_BYTES", 20_000)
    rows = odd_rows + [(100 + k, t) for k, t in enumerate(odd_texts(250, 11))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n_a": F.lit("x"), "codes": F.lit(1)})
    docs.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    out = QUERIES["op11_alignment"](spark, str(tmp_path))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert out.dtypes == [(n, "string" if n == names[-1] else "bigint") for n in names]
    assert sorted(map(tuple, out.collect()), key=str) == summary([(i, t or "") for i, t in rows])


def test_nothing_to_align(spark, none, tmp_path):
    none.write.parquet(str(tmp_path / "documents.parquet"))
    assert QUERIES["op11_alignment"](spark, str(tmp_path)).collect() == []
    empty = spark.createDataFrame([(1, None), (None, ""), (3, "▁")], "doc_id long, text string")
    got = alignment.link_summary(empty, A, B, str(tmp_path / "work"))
    assert sorted((r.doc_id or 0, *r[1:]) for r in got.collect()) == [(k, 0, 0, 0, 0, 0, 0, "") for k in (0, 1, 3)]
