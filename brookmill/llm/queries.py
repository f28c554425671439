"""Registered queries of the subpackage, each over its whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from brookmill.llm import curriculum, exact_dedup, infilling, minhash, pieces, quality, quotes, spelling, substring_dedup, suffix_dedup, tiling, token_counts, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = build
        if sql:
            ORACLE_SQL[name] = sql
        return build

    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query("op1_quality")
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@_query("op2_url_filter", url_filter.SQL)
def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.url_verdicts(_table(spark, folder, "pages"), _table(spark, folder, "labels"), url_filter.RULES)


@_query("op3_substring_dedup")
def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = substring_dedup.repeated_words(_table(spark, folder, "documents"), width=50)
    return done.select("doc_id", F.col("n_symbols").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query("op4_quotation_linking", quotes.SQL.replace("l.parent AS parent_turn", "coalesce(l.parent, -1) AS parent_turn"))
def op4_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    done = quotes.reply_order(_table(spark, folder, "conversations"))
    return done.withColumn("parent_turn", F.coalesce("parent_turn", F.lit(-1)))


@_query("op5_sentencepiece")
def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    path = str(public_tokenizers.path("piece_bpe_32k.model"))
    done = pieces.piece_ids(_table(spark, folder, "documents"), path, dropout=0.1, seed=20)
    joined = F.array_join("ids", " ")
    return done.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@_query("op6_token_counts")
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(_table(spark, folder, "documents"), str(path), limit=512)


@_query("op7_exact_dedup", exact_dedup.SQL)
def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.content_sort(_table(spark, folder, "documents"), keep="largest")


@_query("op8_string_tiling")
def op8_string_tiling(spark: SparkSession, folder: str) -> DataFrame:
    done = tiling.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return done.select("doc_id", "contaminated", "items", "best_coverage")


@_query("op9_minhash")
def op9_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents")).select("doc_id", "class_id", "class_size", "kept")


@_query("op10_suffix_dedup")
def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = suffix_dedup.repeated_bytes(_table(spark, folder, "documents"), width=100)
    spans = F.size("spans").cast("long").alias("n_spans")
    return done.select("doc_id", F.col("n_symbols").alias("n_bytes"), "n_removed", spans, F.sha2("kept", 256).alias("kept_sha256"))


@_query("op11_spelling")
def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    done = spelling.spelling_variants(_table(spark, folder, "documents"))
    return done.select("word", "form", "root", "n", "n_near", "form_n")


@_query("op12_infilling", infilling.SQL)
def op12_infilling(spark: SparkSession, folder: str) -> DataFrame:
    done = infilling.fill_in_middle(_table(spark, folder, "documents")).withColumn("output_sha256", F.sha2("output", 256))
    done = infilling.restored(done)
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", F.sha2("restored", 256).alias("restored_sha256"))


@_query("op13_curriculum", curriculum.SQL)
def op13_curriculum(spark: SparkSession, folder: str) -> DataFrame:
    done = curriculum.curriculum(_table(spark, folder, "documents"))
    first = F.get("passes", F.lit(0))["position"]
    return done.select("doc_id", "size", "source_size", "target", "taken", first.alias("position"))


@_query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
