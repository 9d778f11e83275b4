"""The registered queries of the training-data operators: each applies one
operator, with production parameters, to its whole table and derives the
columns of its contract from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, conversation, html_extract, line_dedup, merkle, mixing, ngram_join, packing, secrets,
               substring_dedup, suffix_dedup, topk, toxicity)
from .common import read_table
from .oracles import SQL


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 1024 ids."""
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), emit_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                         "sequence_length")


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each query's 20 nearest vectors found."""
    return ann.search(read_table(spark, sf_dir, "embeddings"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each query's 20 highest integer scores, exactly."""
    return topk.search(read_table(spark, sf_dir, "embeddings"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: words taken of each."""
    d = mixing.plan(read_table(spark, sf_dir, "documents"))
    return d.select("doc_id", "size", "source_size", "target", "taken", "source", "copies", "part_words")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    d = html_extract.extract_pages(read_table(spark, sf_dir, "pages"))
    return d.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-word windows of earlier documents."""
    d = substring_dedup.dedup(read_table(spark, sf_dir, "documents"), window=50)
    return d.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of templates that recur in earlier documents."""
    d = line_dedup.dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=2, min_tokens=1)
    return d.select("doc_id", F.col("_ld_lines").alias("n_lines"), F.col("_ld_dropped").alias("n_dropped"), "text")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes: distinct 4-word shingles, Jaccard 0.85 or more."""
    return ngram_join.join_components(read_table(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.apply(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"),
                                              "score", "predicted")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document."""
    return secrets.digest(secrets.scan(read_table(spark, sf_dir, "documents"), reach=None))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaf, subroot, root and proof of every document, and the check of a tampered copy."""
    docs = read_table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    d = merkle.manifest(docs, F.when(hit, F.col("n_chars").cast("decimal(20,0)") + 1))
    return d.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 200-byte strings that start anywhere else too."""
    d = suffix_dedup.dedup(read_table(spark, sf_dir, "documents"), length=200)
    return d.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op13_conversation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults and cheapest repair, after damage."""
    return conversation.repair(*conversation.damage(read_table(spark, sf_dir, "conversations")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_ann": op2_ann,
        "op3_topk": op3_topk,
        "op4_mixing": op4_mixing,
        "op5_html": op5_html,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_line_dedup": op7_line_dedup,
        "op8_ngram_join": op8_ngram_join,
        "op9_toxicity": op9_toxicity,
        "op10_secrets": op10_secrets,
        "op11_merkle": op11_merkle,
        "op12_suffix_dedup": op12_suffix_dedup,
        "op13_conversation": op13_conversation,
    }


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
