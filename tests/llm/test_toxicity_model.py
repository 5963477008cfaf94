"""The tables of the toxicity model against a plain Kneser-Ney model, and the odd cases of the filter."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import prose
from pyspark.sql import functions as F

from benchloom.llm import toxicity
from benchloom.llm.queries import QUERIES

ORDER, D = toxicity.ORDER, toxicity.DISCOUNT


def grams_of(words):
    out = []
    for w in words:
        chars = "\x01" * (ORDER - 1) + w + "\x02"
        out += [chars[i - ORDER + 1 : i + 1] for i in range(ORDER - 1, len(chars))]
    return out


def plain_ratio(gram, toxic, plain):
    """log p(last | context, toxic) - log p(last | context, ordinary), written out from the counts of whole grams."""
    types = set(toxic) | set(plain)

    def backoff(text):
        """Continuation probability of the last character of `text` after the others."""
        longer = {g[-len(text) - 1 :] for g in types}
        follows, total, kinds = Counter(x[1:] for x in longer), Counter(x[1:-1] for x in longer), defaultdict(set)
        for x in longer:
            kinds[x[1:-1]].add(x[-1])
        lower = backoff(text[1:]) if len(text) > 1 else 1 / len({g[-1] for g in types})
        return (max(follows[text] - D, 0) + D * len(kinds[text[:-1]]) * lower) / total[text[:-1]]

    def one(counts):
        own = {g: c for g, c in counts.items() if g[:-1] == gram[:-1]}
        total = sum(own.values())
        if not total:
            return backoff(gram[1:])
        return max(counts[gram] - D, 0) / total + D * len(own) / total * backoff(gram[1:])

    return math.log(one(toxic)) - math.log(one(plain))


def test_tables_equal_plain_kneser_ney():
    toxic = Counter(grams_of("damn damned awful awful trash naïve 東京".split()))
    plain = Counter(grams_of("dam damp lawful trust train naïf 東 a a a".split()))
    names = sorted(set(toxic) | set(plain))
    points = np.array([[ord(c) for c in g] for g in names], dtype=np.uint32)
    made = toxicity.build(points, np.array([toxic[g] for g in names]), np.array([plain[g] for g in names]), 20)
    words = ["damned", "lawful", "東京"]
    expected = [sum(plain_ratio(g, toxic, plain) for g in grams_of([w])) for w in words]
    assert made.of_words(words) == pytest.approx(expected, abs=1e-5)


def test_counts_are_those_of_plain_python(spark):
    rows = [(prose(k, 30), k % 2) for k in range(12)] + [(None, 1), ("", 0), ("x" * 3000, 1)]
    got = toxicity._count(spark.createDataFrame(rows, "text string, y int").repartition(4), 20).collect()
    want = Counter((g, y) for t, y in rows for g in grams_of(toxicity.words_of(t)))
    found = Counter()
    for r in got:
        gram = bytes(r.gram).decode("utf-32-be")
        found[gram, 1] += r.toxic
        found[gram, 0] += r.plain
    assert sum(found.values()) == sum(want.values())
    merged = len({g for g, _ in want}) - len(got)  # grams that share a table cell
    assert 0 <= merged <= 2
    assert sum(found[k] != want[k] for k in want) <= 4 * merged


def test_filter_keeps_silent_texts_and_all_columns(spark):
    rows = [(k, prose(k, 20), "a", k) for k in range(20)] + [(100, None, "a", 1), (101, "", "b", 2), (102, " .,; ", "c", 3), (None, "rude words", "d", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, __toxic_score int")
    labels = spark.createDataFrame([(k, 1) for k in range(20)], "doc_id long, toxic int")
    kept = toxicity.drop_toxic(docs, toxicity.fit(docs, labels))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [100, 101, 102]
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    assert sorted(scored.columns) == ["__toxic_score", "doc_id", "predicted", "score", "text"]
    assert {(r.score, r.predicted) for r in scored.collect()} == {(1.0, 1)}


def test_a_row_without_id_is_not_held_out(spark, tmp_path):
    docs = spark.createDataFrame([(1, "good text"), (2, "bad text"), (None, "text")], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = QUERIES["op9_toxicity"](spark, str(tmp_path))
    assert out.where(F.col("held_out").isNull()).count() == 0
    assert dict(out.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
