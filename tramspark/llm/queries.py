"""Registered queries of the operators: whole tables, production parameters, digest columns of the contracts."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramspark.llm import (
    alignment, cotrain, exact_dedup, html_text, language, mixing, outliers, periodic, pieces, sharding, simhash, url_templates, warc,
)
from tramspark.session import shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The public vocabulary; its place is a parameter of the operator.
PIECES = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
BYTE_LEVEL = os.environ.get("BYTE_LEVEL_FILE", "/opt/tokenizers/byte_bpe_50k.json")

# Rules of the url filter (verdict, host, start of the path).
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every whole text, and whether decoding them gives the text back."""
    return pieces.encode(_table(spark, sf_dir, "documents"), PIECES, check=True).withColumnRenamed("id", "doc_id")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 40 equal shards by rendezvous hashing of doc_id; ``grown_shard`` is with 41 shards."""
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), 40)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page: parser events, smoothed text-to-tag ratios, clustering."""
    return html_text.extract(_table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text by the word-level conditional random field; a quarter of the ids is held out."""
    docs = _table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs))
    return found.select(F.col("id").alias("doc_id"), language.held_out("id").alias("held_out"), "lang_pred", "score")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of epochs under budgets over domain, language and source (all tokens, at most 4 epochs)."""
    docs = _table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, mixing.domain_of(F.col("source")), max_epochs=4)
    return mixed.select(F.col("id").alias("doc_id"), "domain", "lang", "source", "n_tokens", "budget", "epochs")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of 3-word shingles, linked at 3 or fewer differing bits by the trie self-join."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def op7_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by co-training of a content and a metadata view on the given labels."""
    found = cotrain.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select(F.col("id").alias("doc_id"), "p_content", "p_meta", "score", (F.col("score") >= 0.5).alias("kept"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives (segmented, chunked, revisits from 1000 bytes) and read back."""
    path = shared_dir(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path, min_revisit=1000)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of equal texts (A-Z lower-cased) by composable fingerprints and chunkwise comparison."""
    found = exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size",
                        (F.col("uid") == F.col("keep_uid")).alias("kept"), F.col("sha").alias("text_sha256"))


def op10_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the minimum-covariance-determinant rule for every whole text (DataFrame operations only)."""
    return outliers.judge(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rules, then by the labelled purity of its path template (DataFrame operations only)."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    found = url_templates.judge(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"), good, URL_RULES)
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "template")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups between common token ends of two vocabularies in every whole text, with corpus-wide link counts."""
    found = alignment.link_scores(_table(spark, sf_dir, "documents"), alignment.Vocabularies(BYTE_LEVEL, PIECES))
    return found.withColumnRenamed("id", "doc_id")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the words of a tenth of the ids made periodic from a place on, as the contract says."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), outliers.SPACES), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def periodic_from(w):
        n = F.size(w)
        a = F.pmod(g, n.cast("long")).cast("int")
        p = (F.floor((n - a) / (F.pmod(g, F.lit(8)) + 3)) + 1).cast("int")
        again = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.when(n > 0, F.array_join(F.slice(F.concat(F.slice(w, 1, a), again), 1, n), " "))

    planted = F.get(F.transform(F.array(words), periodic_from), 0)
    return docs.select("doc_id", F.when(F.pmod(h, F.lit(10)) == 0, planted).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All periodic runs of words of every whole text: the greatest, digests of all, and of the text without repeats."""
    found = periodic.detect(with_planted_periods(_table(spark, sf_dir, "documents")))
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    top = F.col("top")
    return found.withColumn("top", F.array_max(order)).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), (-top["start"]).alias("start"),
        top["length"].alias("length"), (-top["period"]).alias("period"),
        F.floor(1000 * top["length"] / -top["period"]).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_sentencepiece, op2_sharding, op3_html_text, op4_language, op5_mixing, op6_simhash, op7_cotraining, op8_warc, op9_exact_dedup, op10_outliers,
                             op11_url_templates, op12_alignment, op13_periodic_runs)
}
