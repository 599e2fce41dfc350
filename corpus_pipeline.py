"""Raw documents to token ids in five stages, each on all that the one before kept.

1. language: documents without a letter, or with hardly an n-gram of any learned
   language (score under ``MIN_SCORE``), go; without any labelled document, only
   those without a letter go.
2. near duplicates: one document of each SimHash component stays.
3. decontamination: documents that hold a benchmark item go.
4. personal data: every span is replaced by its kind; n_chars follows the text.
5. tokens: the ids of the whole text as little-endian unsigned 32-bit integers, and a check
   that they decode to the text.

Every stage is written as Parquet into the shared folder and read again, so a
lost executor costs tasks of one stage only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storecast.llm import bpe, decontam, langid, pii, simhash
from storecast.llm.common import fresh, materialize, table

MIN_SCORE = 0.3
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

#: Fingerprints, filters and trained models are beyond SQL; tests hold the stages against plain code.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    filters = langid.learn(docs.where(~langid.held_out()))
    if not filters.languages:  # nothing labelled to learn from: only the texts without a letter go
        return docs.where(F.rlike(F.col("text").cast("string"), F.lit(r"\p{L}")))
    lang, score = fresh(docs, "_lang_pred", "_score")
    found = langid.identify(docs, filters, (lang, score))
    return found.where((F.col(lang) != "und") & (F.col(score) >= MIN_SCORE)).drop(lang, score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs, pii.learn(docs)).withColumn("n_chars", F.length("text").cast("long"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text = F.col("text").cast("string")
    source = docs.select("doc_id", text.alias("text"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("text_sha256"))
    coded = bpe.encode(source, TOKENIZER, keep_text=False)
    return bpe.decode(materialize(coded, "pipeline-ids", "zstd"), TOKENIZER).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        (F.sha2("decoded", 256) == F.col("text_sha256")).alias("decodes"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontaminate),
          ("personal_data", personal_data), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
