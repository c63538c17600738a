"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread as the next one's input.

Every stage works on all rows its predecessor kept and needs them as a table
scan (row ids come from the scan).  All but the last return the columns of
their input, extra ones included; the last gives the piece ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramspark.llm import common, exact_dedup, language, mixing, pieces, queries, simhash

# Least share of a text's words in its predicted language.
MIN_LANGUAGE = 0.4


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: texts without a language, or with none that holds ``MIN_LANGUAGE`` of the words, go."""
    return language.keep_identified(docs, language.fit(docs), MIN_LANGUAGE)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the row with the largest id stays."""
    return exact_dedup.keep_one(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each component the document with the smallest id stays."""
    return simhash.keep_first(docs, shingle=3, max_bits=3)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: as many tokens as came in, dealt over domain, language and source; a row appears once per epoch (two at most)."""
    return mixing.remix(docs, mixing.domain_of(F.col("source")), max_epochs=2)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece encoding: (doc_id, n_tokens, ids, round_trip) of every row."""
    return pieces.encode(docs, queries.PIECES, check=True).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", simhash_stage),
    ("mixing", mixing_stage),
    ("SentencePiece", pieces_stage),
]

# A language model, SimHash and piece vocabularies have no SQL form; tests compare with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
