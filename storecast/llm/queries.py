"""Registered queries of this package; DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storecast.llm import (audit, bpe, chat, codes, decontam, html, langid, pii, quality, shards, simhash, suffixes,
                           tokenfile)
from storecast.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the decorated builder under its name, with its DuckDB SQL."""
    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn
    return register


@query()
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages, html.learn(pages)).select("page_id", "url", "text", "n_chars")


@query()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", langid.held_out())
    filters = langid.learn(docs.where("not held_out"))
    return langid.identify(docs.drop("lang"), filters).select("doc_id", "held_out", "lang_pred", "score")


@query()
def op4_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


@query(quality.SQL)
def op5_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query(chat.SQL)
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(chat.EXTRA, "conv_id long, turn long, role string, text string")
    return chat.round_trip(rows.unionByName(extra))


@query()
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.digest(pii.annotate(docs, pii.learn(docs)))


@query()
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op3_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query(decontam.SQL)
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.contaminated(docs, table(spark, sf_dir, "benchmark")).drop("row_hash")


@query(suffixes.SQL)
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeats(table(spark, sf_dir, "documents"), min_words=50).drop("other_doc_id")


@query(codes.SQL)
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"),
                                  parts=16, entries=64, rounds=2)
    return coded.select("vec_id", "code", "error", "label_error", F.lit(codes.digest(books)).alias("codebooks_sha256"))


@query(audit.SQL)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(shards.SQL)
def op13_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents"), shards=24)
