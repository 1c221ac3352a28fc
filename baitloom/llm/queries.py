"""Queries of the subpackage, as the driver calls them, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cover, decontaminate, html_text, jaccard, manifest, neighbours, pieces, secrets, shard, substring_dedup, toxicity, trie, url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan_secrets(docs).drop("text")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, keep=["page_id"])


def op6_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.shard(table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model, keep=["doc_id"])
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(table(spark, sf_dir, "documents"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verify(table(spark, sf_dir, "documents"))


def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover.near_groups(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_neighbours": op1_neighbours,
    "op2_secrets": op2_secrets,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_decontaminate": op4_decontaminate,
    "op5_url_filter": op5_url_filter,
    "op6_shard": op6_shard,
    "op7_html_text": op7_html_text,
    "op8_toxicity": op8_toxicity,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_pieces": op10_pieces,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_manifest": op12_manifest,
    "op13_near_vectors": op13_near_vectors,
}
ORACLES: dict[str, str] = {
    "op2_secrets": secrets.ORACLE,
    "op4_decontaminate": decontaminate.ORACLE,
    "op11_prefix_trie": trie.ORACLE,
    "op12_manifest": manifest.ORACLE,
    "op13_near_vectors": cover.ORACLE,
}
