"""The corpus pipeline: documents that are good, distinct, uncontaminated and without personal data, as token ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's docs. Stages work on all that their predecessor kept and, but for the last,
return the columns of documents:

1. quality rules drop the documents they reject;
2. MinHash near-dedup keeps the document of smallest id of each group, linking at NEAR_PERCENT and above;
3. benchmark decontamination drops contaminated documents;
4. personal data is replaced by its kind in brackets, and n_chars counts the new text;
5. byte-level BPE gives each document's ids (little-endian unsigned 32-bit integers); its decoding must equal the text,
   or the stage fails.

Columns beyond those of documents pass through untouched. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuvee.llm import bpe, decontaminate, minhash_dedup, pii, quality_rules
from cuvee.llm.common import discard, table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(docs)


#: Least similarity, in percent, at which the pipeline links documents.
NEAR_PERCENT = 80


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str, percent: int = NEAR_PERCENT) -> DataFrame:
    return minhash_dedup.deduplicated(docs, percent)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = pii.find(docs)
    text = F.when(F.col("text").isNotNull(), F.col("redacted"))
    return found.select([text.alias(c) if c == "text" else F.char_length(text).cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    exact = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    exact = F.when(exact, F.lit(True)).otherwise(F.raise_error("decoded ids differ from the text").cast("boolean"))
    return coded.select("doc_id", "lang", "source", "n_chars", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), exact.alias("round_trip"), "ids")


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: Compression of rules, links, trees and merges into SQL is not possible; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), ()
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        discard(*last)
        last = (docs,)
    return STAGES[-1][1](spark, docs, sf_dir)
