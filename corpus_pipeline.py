"""From raw documents to piece ids: five stages, each over all that the one before has kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmill.llm import exact_dedup, minhash, pieces, quality, tiling
from brookmill.scratch import cut

MODEL = "piece_bpe_32k.model"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.quality_scores(docs, labels, keep_columns=True)


def first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts, the one with the smallest doc_id."""
    return exact_dedup.keep_first_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each class of near-duplicates, the one with the smallest doc_id."""
    return minhash.keep_one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return tiling.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_pieces, and whether the ids decode to the very text."""
    ids = pieces.piece_ids(docs, str(public_tokenizers.path(MODEL)), dropout=0.1, seed=20, compare=True)
    return ids.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "lossless")


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", first_copies),
    ("MinHash near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("SentencePiece encoding", encoded),
]

#: The classifier, weighted sampling and merge-dropout have no SQL form; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return docs
