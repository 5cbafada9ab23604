"""The registered queries of the numbered operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, chat, decontaminate, license_scan, merkle, minhash_dedup, pii, quality_classifier, quality_rules, spelling, substring_dedup, token_counts, warc,
)
from .common import table
from .oracle import OP2, OP4, OP6, OP8, OP9, OP11, OP13


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), named=True, expressions=True)
    named = F.transform("licenses", lambda x: F.concat_ws(":", x["license"], x["begin"], x["end"], F.format_string("%.4f", x["coverage"])))
    return found.select("doc_id", "n_words", F.size("licenses").cast("long").alias("n_licenses"), F.array_join(named, ",").alias("licenses"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judged(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    held = (quality_classifier.fold(F.col("doc_id")) == 0).alias("held_out")
    return quality_classifier.score(docs, model).select("doc_id", held, "score", "predicted")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.removed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    told = "'</s>[INST] ok [/INST]'"
    extra = spark.sql(f"SELECT -1L AS conv_id, turn, role, {told} AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    back = chat.read_back(chat.formatted(rows.unionByName(extra)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"), redact=False)
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.prefix_table(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return counted.select("doc_id", "n_bytes", "n_tokens", token_counts.over_limit(1024).alias("over_limit"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(struck, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    proofs, _ = merkle.manifest(merkle.document_leaves(docs, tampered))
    d = proofs.select(
        "row.doc_id", F.col("digest").alias("leaf"), "above.subroot", "above.root", F.sha2("siblings", 256).alias("proof_sha256"),
        merkle.fold("row.changed").alias("folded_root"),
    )
    return d.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {"op1_license_scan": op1_license_scan, "op2_quality_rules": op2_quality_rules, "op3_quality_classifier": op3_quality_classifier, "op4_substring_dedup": op4_substring_dedup, "op5_byte_bpe": op5_byte_bpe, "op6_warc": op6_warc, "op7_chat_format": op7_chat_format, "op8_minhash_dedup": op8_minhash_dedup, "op9_decontaminate": op9_decontaminate, "op10_pii": op10_pii, "op11_spelling_variants": op11_spelling_variants, "op12_token_counts": op12_token_counts, "op13_merkle_manifest": op13_merkle_manifest}
#: formatted_chars: escapes, and the template's control strings by merged turn.
OP7_SQL = """
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), g AS (
    SELECT *, role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS opens FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(2 * length(text) - length(replace(replace(text, chr(92), ''), '<', ''))
           + CASE WHEN opens THEN 2 * length(role) - length(replace(replace(replace(role, chr(92), ''), '<', ''), '|', '')) + 16 ELSE 8 END) AS BIGINT) AS formatted_chars
FROM g GROUP BY conv_id
"""
#: The others can't be put into SQL; tests hold them against brute force, a library or held-out labels.
ORACLE: dict[str, str] = {
    "op2_quality_rules": OP2,
    "op4_substring_dedup": OP4,
    "op6_warc": OP6,
    "op7_chat_format": OP7_SQL,
    "op8_minhash_dedup": OP8,
    "op9_decontaminate": OP9,
    "op11_spelling_variants": OP11,
    "op13_merkle_manifest": OP13,
}
