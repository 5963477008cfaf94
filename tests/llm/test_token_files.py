"""Runs against the libraries themselves; files of sequences against plain encoding, row by row."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest_llm import prose
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from benchloom.llm import tokenfiles
from benchloom.llm.queries import QUERIES
from benchloom.llm.runs import IdTable, RunEncoder, byte_bpe, piece_bpe, pieces_keep_blanks_first

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["the", " ", "  ", "\n", " \n", " ", "　", "\x1c", "\x85", "don't", "'s", "12", "é", "東京", "▁", "<|endoftext|>", "<s>", "​", "🙂", "é", "\x00", "#$", "﻿", "ﬁ"]


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(14))) for _ in range(n)]


@pytest.fixture(scope="module")
def definition():
    with open(BYTES, encoding="utf-8") as f:
        return f.read()


def per_text(encoder, k, texts):
    rows, begin = encoder.rows(pa.array(texts, pa.string()))
    return [encoder.tables[k].take(rows[a:b]).tolist() for a, b in zip(begin[:-1], begin[1:], strict=True)]


def test_runs_equal_the_byte_library(definition):
    library = Tokenizer.from_str(definition)
    texts = odd_texts(3000) + [prose(k, 40) for k in range(50)] + ["", " ", "a", "a ", " a"]
    encoder = RunEncoder([byte_bpe(definition)], led=False, size=500)
    for at in range(0, len(texts), 400):
        assert per_text(encoder, 0, texts[at : at + 400]) == [library.encode(t, add_special_tokens=False).ids for t in texts[at : at + 400]]
    assert per_text(encoder, 0, [None, "", None]) == [[], [], []]
    assert per_text(encoder, 0, []) == []


def test_runs_with_a_blank_in_front_equal_both_libraries(definition):
    a, b = Tokenizer.from_str(definition), SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    with open(PIECES, "rb") as f:
        encoder = RunEncoder([byte_bpe(definition, True), piece_bpe(f.read())], led=True, size=500)
    texts = [t for t in odd_texts(3000, 2) + [prose(k, 40) for k in range(50)] if t]
    for at in range(0, len(texts), 400):
        part = texts[at : at + 400]
        assert per_text(encoder, 0, part) == [a.encode(" " + t, add_special_tokens=False).ids for t in part]
        assert per_text(encoder, 1, part) == [b.encode(t) for t in part]
    assert not pieces_keep_blanks_first(["▁a", "a▁b"]) and pieces_keep_blanks_first(["▁▁", "▁a", "a"])


def test_id_table_grows_and_forgets():
    t, rng = IdTable(), random.Random(3)
    lists = [[rng.randrange(1 << 32) for _ in range(rng.randrange(9))] for _ in range(40_000)]
    t.add(lists[:30_000])
    t.add(lists[30_000:])
    t.rows = 35_000
    t.add(lists[35_000:])
    rows = np.array([rng.randrange(len(lists)) for _ in range(5000)])
    assert t.take(rows).tolist() == [i for r in rows for i in lists[r]]
    assert t.take(np.zeros(0, np.int64)).tolist() == []


def brute(rows):
    library = Tokenizer.from_file(BYTES)
    library.no_truncation()
    library.no_padding()
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_hold_all_documents_in_order(spark, odd_rows, tmp_path):
    rows = [(i, t) for i, t in odd_rows if i not in (12,)] + [(100 + k, t) for k, t in enumerate(odd_texts(300, 5))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit(1), "turn": F.lit("x"), "Place": F.lit(0)}).repartition(5)
    manifest = tokenfiles.write_sequences(docs, BYTES, f"file:{tmp_path}/out", length=64, file_tokens=600)
    assert manifest.count() > 2
    got = tokenfiles.read_documents(spark, manifest, docs.schema["doc_id"].dataType, piece_tokens=500)
    found = [(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in got.orderBy("start").collect()]
    assert found == brute(rows)
    files = tokenfiles.located(manifest).orderBy("base").collect()
    whole = []
    for f in files:
        own = tokenfiles.SequenceFile(f.file)
        assert len(own) == f.n_sequences
        ids, real = zip(*(own[k] for k in range(len(own))), strict=True)
        assert {len(i) for i in ids} == {64} and ids[0].dtype == np.uint16 and not ids[0].flags.owndata
        flat, mask = np.concatenate(ids), np.concatenate([m.to_numpy(zero_copy_only=False) for m in real])
        assert mask.sum() == f.n_tokens and mask[: f.n_tokens].all() and not flat[f.n_tokens :].any()
        assert own.stream(0, f.n_tokens).tolist() == flat[: f.n_tokens].tolist()
        assert own.stream(50, f.n_tokens - 1).tolist() == flat[50 : f.n_tokens - 1].tolist()
        whole += flat[: f.n_tokens].tolist()
        with pytest.raises(IndexError):
            own[len(own)]
    assert len(whole) == sum(n for _, _, n, _ in found)


def test_rows_that_share_an_id_keep_one_order(spark, tmp_path):
    rows = [(7, prose(k % 5, 6)) for k in range(200)] + [(None, "x"), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = [tokenfiles.read_documents(spark, tokenfiles.write_sequences(d, BYTES, f"{tmp_path}/{k}"), docs.schema["doc_id"].dataType)
           .orderBy("start").select("doc_id", "start", "n_tokens", "ids").collect() for k, d in enumerate((docs, docs.repartition(3)))]
    assert got[0] == got[1] and len(got[0]) == 202 and got[0][0].doc_id is None and got[0][-1].doc_id == 8


def test_empty_tables_and_the_query(spark, none, odd_rows, tmp_path):
    manifest = tokenfiles.write_sequences(none, BYTES, str(tmp_path / "none"))
    assert manifest.count() == 0
    assert tokenfiles.read_documents(spark, manifest, none.schema["doc_id"].dataType).collect() == []
    rows = [r for r in odd_rows if r[0] not in (12,)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = QUERIES["op12_sequences"](spark, str(tmp_path))
    assert dict(out.dtypes) == {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}
    assert sorted(map(tuple, out.collect()), key=lambda r: r[1]) == brute(rows)
