"""A training corpus from ``documents`` in five stages.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and
is written as Parquet in the shared folder before the next one reads it.

1. language: documents without a language (no letters, or no language with at
   least half of the pooled probability) go,
2. exact: of texts equal but for white space the longest stays,
3. near: of documents linked by SimHash (4-word shingles, at most 4 bits) that
   of the smallest id stays,
4. mix: sources are drawn to flattened weights. The budget is all tokens that
   are left; the exponent meets an entropy halfway from that of the sources to
   the largest and repeats no source more than twice, so a tiny source shrinks
   no other, and sources of any kind are reweighted,
5. pack: pieces of at most 2048 tokens, best fit, in training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabreg.llm import exact_dedup, langid, mixing, packing, queries, simhash
from tabreg.llm.common import stored, table

TARGET_ENTROPY = mixing.HALFWAY
#: The mixture's tokens as a multiple of those that are left.
BUDGET_EPOCHS = 1.0
#: The tokeniser's cache beside executors that still hold the earlier stages' heap.
WORKER_CACHE = 250_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted_documents(docs, langid.fit(langid.learning_rows(docs)))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.kept_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(docs, shingle_words=4, max_bits=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, budget_epochs=BUDGET_EPOCHS, target_entropy=TARGET_ENTROPY,
                                  max_repeats=queries.MAX_REPEATS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(docs, queries.tokenizer("byte_bpe_50k.json"), with_ids=False,
                                    cache=WORKER_CACHE)
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32",
                         "sequence_id", "offset")


STAGES = [("language", language), ("exact", exact), ("near", near), ("mix", mix), ("pack", pack)]

#: The first stage is a trained network: SQL can't express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
