"""What a Python worker holds when it goes from the tasks of one operator to those of another."""

from __future__ import annotations

import array
import weakref

import pyarrow as pa
import pytest
from conftest_llm import prose
from tokenizers import Tokenizer

from benchloom.llm import bpe, common, neardup, toxicity
from benchloom.llm.queries import TOKENIZER


@pytest.fixture
def definition():
    with open(TOKENIZER, encoding="utf-8") as f:
        yield f.read()
    common.let_go()


def steps_of(df, monkeypatch, make):
    """The functions that `make` hands to Python workers."""
    found, real = [], type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, *a, **b: found.append(f) or real(self, f, *a, **b))
    make()
    monkeypatch.setattr(type(df), "mapInArrow", real)
    return found


def test_other_operators_drop_the_codec(spark, odd, monkeypatch, definition):
    texts = [prose(k, 50) for k in range(4)]
    rows = spark.createDataFrame([(t, k % 2) for k, t in enumerate(texts)], "text string, y int")
    steps = {
        "sketches": (lambda: neardup.sketches(odd, "doc_id", "text", 5, 4, 2), [pa.array([1, 2, 3, 4]), pa.array(texts)]),
        "counts": (lambda: toxicity._count(rows, 8), [pa.array(texts), pa.array([0, 1, 0, 1], pa.int32())]),
    }
    for name, (make, columns) in steps.items():
        (step,) = steps_of(odd, monkeypatch, make)
        held = weakref.ref(bpe.codec_of(definition))
        batch = pa.RecordBatch.from_arrays(columns, names=["a", "b"])
        assert sum(b.num_rows for b in step(iter([batch]))) > 0
        assert held() is None, name


def test_encoding_keeps_its_codec_from_task_to_task(odd, monkeypatch, definition):
    (step,) = steps_of(odd, monkeypatch, lambda: bpe.encode(odd, TOKENIZER))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([prose(1, 20), None])], names=["doc_id", "text"])
    codec = bpe.codec_of(definition)
    first, second = (pa.Table.from_batches(list(step(iter([batch])))) for _ in range(2))
    assert first == second and first.num_rows == 2
    assert bpe.codec_of(definition) is codec


def test_transitions_are_bounded(monkeypatch, definition):
    monkeypatch.setattr(bpe, "ARCS", 40)
    codec, library = bpe.Codec(definition), Tokenizer.from_str(definition)
    for k in range(50):
        text = prose(k, 40)
        assert list(array.array("I", codec.encode(text))) == library.encode(text, add_special_tokens=False).ids
        assert len(codec.automaton.table) <= 40


def test_sketches_do_not_depend_on_the_size_of_pieces(odd, monkeypatch):
    drawn = []
    for size in (1 << 30, 500):
        monkeypatch.setattr(neardup, "PIECE_BYTES", size)
        rows = neardup.sketches(odd, "doc_id", "text", 5, 4, 2).collect()
        drawn.append(sorted((r.id or 0, bytes(r.key or b""), tuple(r.bands or ())) for r in rows))
    assert drawn[0] == drawn[1]
