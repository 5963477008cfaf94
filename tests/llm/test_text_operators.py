"""BPE, decontamination, licences and personal data against plain Python."""

from __future__ import annotations

import array
import hashlib
import os
import random
import re

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from benchloom.llm import bpe, decontaminate, licenses, pii
from benchloom.llm.queries import TOKENIZER


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def codec():
    with open(TOKENIZER, encoding="utf-8") as f:
        return bpe.Codec(f.read())


def test_codec_equals_library(codec, library):
    rng = random.Random(5)
    letters = list("aaaabbcdeehillst  '\n\t.,019!?éß€日本\u0085 \x1c\x1f​😀") + ["<|endoftext|>", "'s", "  ", "\n\n "]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += [c * n for c in "aeho -_." for n in (1, 2, 3, 17, 64)] + ["a" * 5000, " " * 500 + "x"]
    for t in texts:
        ids = codec.encode(t)
        expected = library.encode(t, add_special_tokens=False).ids
        assert list(array.array("I", ids)) == expected, t
        assert codec.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_codec_splits_new_letters_like_library(codec, library):
    for c in (0x1C89, 0xA7CB, 0x10D40, 0x10D4A, 0x1E5D0, 0x16D70, 0x13460):
        t = "a" + chr(c) + "1" + chr(c) + " " + chr(c)
        assert list(array.array("I", codec.encode(t))) == library.encode(t, add_special_tokens=False).ids


def test_bpe_digests(odd, none, odd_rows, library):
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(odd, TOKENIZER).collect())
    want = []
    for i, t in odd_rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        want.append((i or 0, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.digests(none, TOKENIZER).collect() == []


def test_bpe_round_trip_and_clashing_names(odd):
    clash = odd.withColumns({"ids": F.lit("mine"), "N_Tokens": F.lit(1.5)})
    out = bpe.decode(bpe.encode(clash, TOKENIZER), TOKENIZER)
    assert sorted(out.columns) == ["decoded", "doc_id", "ids", "n_tokens", "text"]
    assert all(r.decoded == (r.text or "") for r in out.collect())


BENCH = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "short item"), (3, None), (4, "..."),
    (None, "nameless passage here"), (2, "short item"), (5, "Éclair Straße"),
]
TEXTS = [
    (1, "say ALPHA, beta gamma delta epsilon zeta eta theta iota-kappa lambda end"), (2, "a short   item, nameless passage here"),
    (3, "alpha beta gamma delta epsilon zeta eta theta iota"), (4, None), (5, ""), (6, "éclair straße"), (6, "Éclair  Straße!"),
    (7, "short item short item"), (8, "clean " * 5000),
]


def brute_hits(text, items, window=10):
    words = decontaminate.words_of(text)
    hit, found = set(), set()
    for item, t in items:
        own = decontaminate.words_of(t)
        size = min(window, len(own))
        grams = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if size else set()
        for k in range(len(words) - size + 1 if size else 0):
            if tuple(words[k : k + size]) in grams:
                hit |= set(range(k, k + size))
                if item is not None:
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("slice_bytes", [1 << 20, 150])
def test_contamination(spark, slice_bytes):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumn("items", F.lit("own"))
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    got = decontaminate.find_contamination(docs, bench, slice_bytes=slice_bytes, prefix="c_").collect()
    assert sorted((r.doc_id, r.c_n_words, r.c_n_hit, r["c_items"]) for r in got) == sorted((i, *brute_hits(t, BENCH)) for i, t in TEXTS)
    assert {r["items"] for r in got} == {"own"}
    clean = {(r.doc_id, r.text) for r in decontaminate.remove_contamination(docs, bench, slice_bytes=slice_bytes).collect()}
    assert (1, "say   end") in clean and (4, None) in clean and (7, " ") in clean and (3, TEXTS[2][1]) in clean
    kept = decontaminate.remove_contamination(docs, bench, mode="documents", slice_bytes=slice_bytes)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 8]  # É is not lower-cased, é is another word


def test_passages_are_cut_in_the_pass_that_finds_them(spark):
    # two Python steps in a row take two workers for each task, and what later steps load stays in all of them
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    found, clean = decontaminate.find_contamination(docs, bench, cut=True), decontaminate.remove_contamination(docs, bench)
    assert clean._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted(map(str, found.select("doc_id", "text").collect())) == sorted(map(str, clean.collect()))


def test_contamination_empty(spark, none):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    assert all(r.n_hit == 0 and r["items"] == [] for r in decontaminate.find_contamination(docs, bench).collect())
    assert decontaminate.find_contamination(none, bench).collect() == []


def test_licenses(spark, odd, none):
    mit = licenses.KNOWN["MIT"]
    rows = [
        (1, mit), (2, mit.upper().replace("\n", "  \n * ")), (3, "MIT License\n\nCopyright (c) 2020 A. Person\n\n" + licenses.KNOWN["MIT-untitled"]),
        (4, mit + " and more"), (5, None), (6, ""), (7, "Copyright 2001 Nobody"), (8, "LICENCED under the Apache Licence -- Version 2.0"), (8, mit),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("DIGEST", F.lit(1))
    known = licenses.known_licenses(spark)
    got = licenses.scan(docs, known.union(known).union(spark.createDataFrame([(None, "x"), ("n", None)], known.schema)))
    by = sorted(((r.doc_id, r.license_id or "") for r in got.collect()))
    assert by == [(1, "MIT"), (2, "MIT"), (3, "MIT"), (4, ""), (5, ""), (6, ""), (7, ""), (8, ""), (8, "MIT")]
    assert licenses.scan(odd, known).count() == odd.count() and licenses.scan(none, known).count() == 0
    assert licenses.scan(odd, known.limit(0)).where("license_id IS NOT NULL").count() == 0


def plain_canonical(t):
    """The canonical form without Spark."""
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    lines = []
    for line in t.split("\n"):
        bare = line.lstrip(" \t/*#;-")
        drop = bare.startswith(("(c)", "©", "all rights reserved"))
        if bare.startswith("copyright"):
            rest = bare[9:].lstrip(" ")
            drop = rest.startswith(("(c)", "©", "<", "[")) or rest[:1].isdigit()
        lines.append(" " if drop else line)
    t = "\n".join(lines)
    for c in "“”„‘’–—©«»•":
        t = t.replace(c, " ")
    words = re.sub("[^0-9a-z\x80-\U0010ffff]+", " ", t).strip(" ")
    words = re.sub(r"\b(sub)?licen[cs](e|es|ed|ing|ee|or)\b", r"\1licens\2", words, flags=re.A).replace("acknowledgement", "acknowledgment")
    words = re.sub(r"\b(organi|authori|utili|recogni|reali|normali|emphasi|initiali)s(e|es|ed|ing|ation)\b", r"\1z\2", words, flags=re.A)
    words = re.sub(r"\b(fav|hon|behavi|col)our", r"\1or", words, flags=re.A)
    for a, b in (("whilst", "while"), ("per cent", "percent"), ("https", "http")):
        words = re.sub(rf"\b{a}\b", b, words, flags=re.A)
    return words


FULL_TEXTS = {
    "Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0-Perl", "CC0-1.0": "CC0-1.0", "GFDL-1.3": "GFDL-1.3", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0",
    "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0",
}


def test_full_licences_are_found_by_independent_digests(spark):
    folder = "/usr/share/common-licenses"
    texts = {i: open(f"{folder}/{f}", encoding="utf-8").read() for f, i in FULL_TEXTS.items() if os.path.exists(f"{folder}/{f}")}
    texts |= {k.removesuffix("-untitled"): v for k, v in licenses.KNOWN.items()}
    known = set(licenses.KNOWN_DIGESTS)
    assert all((i, hashlib.sha256(plain_canonical(t).encode()).hexdigest()) in known for i, t in texts.items())
    rows = [(i, "/*\n * Copyright 2024 Somebody\n */\n" + t.replace("\n", "\r\n * ").replace(" license ", " LICENCE ")) for i, t in texts.items()]
    rows += [(None, t + " and one word") for t in texts.values()] + [(None, "Read this first: " + t) for t in texts.values()]
    got = licenses.scan(spark.createDataFrame(rows, "expected string, text string"), licenses.known_licenses(spark)).collect()
    assert all(r.license_id == r.expected for r in got)


def test_own_licences_can_be_added(spark):
    own = licenses.digested(spark.createDataFrame([("House-1", "You may look, not touch."), (None, "x"), ("y", None)], "license_id string, text string"))
    docs = spark.createDataFrame([("you MAY look -- not touch",), ("you may touch",)], "text string")
    got = licenses.scan(docs, licenses.known_licenses(spark).unionByName(own)).collect()
    assert [r.license_id for r in got] == ["House-1", None]


def test_redaction_keeps_columns_of_any_name(spark):
    rows = [(1, "write to a.b@c.org or +49 170 1234567", "own", "x", 7), (2, None, "own", None, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, __text string, __clean int")
    out = pii.redact(docs, pii.fit(docs))
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert (got[1].spans, got[1]["__text"], got[1]["__clean"]) == ("own", "x", 7) and "<EMAIL>" in got[1].text and "<PHONE>" in got[1].text
    assert got[2].text is None and got[2].spans == "own"


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if 2 * x > 9 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def passes(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {
        "email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.split(".")),
        "card": lambda: 12 <= len(d) <= 19 and luhn(d), "phone": lambda: 9 <= len(d) <= 15,
    }[kind]()


def brute_spans(text):
    out = []
    for o, (kind, p) in enumerate(PATTERNS.items()):
        out += [(m.start(), o, m.end(), kind) for m in re.finditer(p, text or "") if passes(kind, m[0])]
    return sorted(out)


def test_pii_base_spans(spark, odd, none):
    rng = random.Random(3)
    parts = list("a1b2c@@..--++ ()%_9é5\n4") + ["a@b.c", "1.2.3.4", "4111 1111-1111 1111", "+1 (212) 555-1234", "😀"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(800)]
    texts += [None, "", "a" * 100000, "1" * 50000, "a@b" + ".c" * 5000, "1 " * 5000, "+1" + " " * 20000, "a@b.c-d+e@f.g", "1.2.3.4.5.6.7.8"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans", F.lit(7))
    model = pii.fit(docs)
    found = pii.spans_of(pii.find(docs), model).collect()
    for r in found:
        base = [(x.s, x.o, x.e, x.kind) for x in r["__base"]]
        assert base == brute_spans(texts[r.doc_id]), texts[r.doc_id]
        assert set(base) <= {tuple(x) for x in r["spans"]}
    assert pii.fit(none).prior == {}
    assert pii.redact(none, model).count() == 0
    assert pii.redact(odd, pii.fit(odd)).exceptAll(odd).count() == 0


def test_pii_adds_and_redacts(spark):
    secret = 'token = "0f1e2d3c4b5a69788796a5b4c3d2e1f001234567"'
    rows = [(k, f"mail a{k}@b.org or call +1 (212) 555-12{k:02d} ok {secret} end") for k in range(30)] + [(99, "nothing here"), (100, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(docs)
    out = {r.doc_id: r.text for r in pii.redact(docs, model).collect()}
    assert out[3] == "mail <EMAIL> or call <PHONE> ok <SECRET> end"
    assert out[99] == "nothing here" and out[100] is None


def test_expectation_maximisation_finds_the_bad_labeler():
    rng = random.Random(1)
    counts: dict = {}
    for _ in range(4000):
        y = rng.random() < 0.3
        votes = [int(y if rng.random() < right else not y) for right in (0.95, 0.9, 0.85, 0.5)] + [-1]
        key = ("card", tuple(votes))
        counts[key] = counts.get(key, 0) + 1
    soft, table = pii.expectation_maximisation([(k, v, n) for (k, v), n in counts.items()])
    assert table[0, 1, 1] > 0.9 and table[0, 0, 0] > 0.9
    assert abs(table[3, 1, 1] - table[3, 0, 1]) < 0.1
    assert soft["card", (1, 1, 1, 0, -1)] > 0.9 > 0.1 > soft["card", (0, 0, 0, 1, -1)]
