"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchloom.llm import alignment, bpe, chat, decontaminate, licenses, lm, neardup, pii, quality, repeats, tokenfiles, toxicity, whitening
from benchloom.llm.blocks import forget_blocks
from benchloom.llm.common import remove, scratch, table, written

#: Vocabulary files of public tokenizers, byte-level and sentence pieces; parameters of the operators.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"), workspace=f"{path}/work")
    digest = found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
    out = written(digest, f"{path}/result")
    forget_blocks(spark, f"{path}/work/blocks")
    remove(spark, f"{path}/work")
    return out


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), TOKENIZER)


def op4_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    found = lm.score(table(spark, sf_dir, "documents"), held_out, workspace=f"{path}/work")
    out = written(found, f"{path}/result")
    forget_blocks(spark, f"{path}/work/blocks")
    remove(spark, f"{path}/work")
    return out


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    judged = quality.judge(table(spark, sf_dir, "documents"), workspace=f"{path}/work")
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    out = written(judged.select(*columns), f"{path}/result")
    remove(spark, f"{path}/work")
    return out


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP6_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), grams AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS size, array_to_string(ws[i : i + least(10, len(ws)) - 1], ' ') AS gram
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)
), starts AS (
  SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w
), found AS (
  SELECT s.doc_id, s.i, g.size, g.item_id
  FROM (SELECT DISTINCT size FROM grams) z
  JOIN starts s ON s.i + z.size - 1 <= len(s.ws)
  JOIN grams g ON g.size = z.size AND g.gram = array_to_string(s.ws[s.i : s.i + z.size - 1], ' ')
), hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    # positions and features only: the texts are read once
    found = written(pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "__base", "__wide"), f"{path}/work")
    spans = pii.spans_of(found, pii.fit(found, found=found))
    base = F.col("__base")
    counts = [F.size(F.filter(base, pii.of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.BASE]
    out = written(
        spans.select("doc_id", *counts, F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans")),
        f"{path}/result",
    )
    remove(spark, f"{path}/work")
    return out


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


OP8_SQL = r"""
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role NULLS FIRST, text NULLS FIRST) AS pos
  FROM conversations
), whole AS (
  SELECT conv_id, count(*) AS n, list(struct_pack(r := role, t := text) ORDER BY pos) AS turns FROM t GROUP BY conv_id
), kept AS (
  SELECT a.conv_id, a.n FROM whole a
  WHERE NOT EXISTS (
    SELECT 1 FROM whole b WHERE b.turns[1] = a.turns[1] AND b.turns[1 : a.n] = a.turns
      AND (b.n > a.n OR (b.n = a.n AND b.conv_id < a.conv_id))
  )
)
SELECT t.conv_id, t.pos AS position, kept.n AS n_turns, t.role,
  '<|' || coalesce(t.role, 'unknown') || '|>' || chr(10) || coalesce(t.text, '') || chr(10) || '<|end|>' || chr(10) AS piece
FROM t JOIN kept USING (conv_id)
"""


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    scorer = toxicity.fit(docs.where(~held_out), labels.where(~held_out))
    return toxicity.score(docs.select("doc_id", "text", held_out.alias("held_out")), scorer, keep=["doc_id", "held_out"])


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, licenses.known_licenses(spark)).select("doc_id", "digest", "license_id")


OP10_SQL = f"""
WITH known AS (
  SELECT digest, min(license_id) AS license_id
  FROM (VALUES {", ".join(f"('{k}', '{d}')" for k, d in licenses.KNOWN_DIGESTS)}) v(license_id, digest)
  GROUP BY digest
)
SELECT doc_id, d.digest, license_id FROM (SELECT doc_id, sha256({licenses.canonical_sql('text')}) AS digest FROM documents) d
LEFT JOIN known ON d.digest = known.digest
"""


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    found = alignment.link_summary(table(spark, sf_dir, "documents"), TOKENIZER, PIECES, workspace=f"{path}/work")
    out = written(found, f"{path}/result")
    forget_blocks(spark, f"{path}/work/blocks")
    remove(spark, f"{path}/work")
    return out


def op12_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, docs = scratch(spark), table(spark, sf_dir, "documents")
    manifest = tokenfiles.write_sequences(docs, TOKENIZER, f"{path}/files")
    found = tokenfiles.read_documents(spark, manifest, docs.schema["doc_id"].dataType)
    out = written(found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")), f"{path}/result")
    remove(spark, f"{path}/files")
    return out


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": op1_minhash,
    "op2_suffixes": op2_suffixes,
    "op3_bpe": op3_bpe,
    "op4_scoring": op4_scoring,
    "op5_quality": op5_quality,
    "op6_decontamination": op6_decontamination,
    "op7_pii": op7_pii,
    "op8_chat": op8_chat,
    "op9_toxicity": op9_toxicity,
    "op10_licenses": op10_licenses,
    "op11_alignment": op11_alignment,
    "op12_sequences": op12_sequences,
    "op13_whitening": op13_whitening,
}

SQL: dict[str, str] = {"op6_decontamination": OP6_SQL, "op8_chat": OP8_SQL, "op10_licenses": OP10_SQL}
