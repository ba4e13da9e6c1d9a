"""A corpus pipeline: language, exact copies, near copies, benchmark leaks, pieces.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; every stage but the last returns the
columns of the documents. ``run`` writes each stage as Parquet to the shared folder and reads it back for the next.

Defined results: rows without a language (null texts, texts without letters, texts whose likeliest language is less likely
than all others together) go; of equal texts the largest doc_id stays, of near copies the smallest; documents that hold a
benchmark window go; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import decontaminate, exact_dedup, language_id, near_dups, pieces
from ledgerlens.llm.common import ship_package
from ledgerlens.operators.small import settled

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return language_id.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dups.keep_rows(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, piece_ids, round_trip."""
    return pieces.encode_texts(docs, MODEL)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_languages),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("sentencepiece", to_pieces),
]

# A trained network and a piece encoder are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = settled(docs)
    return docs
