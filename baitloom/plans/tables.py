"""Genomes, panels, alignments and links that the shared tables stand for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.depth import alignments_to_depth, filter_alignments
from ..operators.probes import tile
from ..operators.qc import qc_filter

# How letters of a text stand for bases.
LETTERS_FROM = "EeSsLlGgPpNnIiDdBbTtHhUuWwAaOoRrCcFfYyMmVvQqXxZzKkJj"
LETTERS_TO = "AAAAAAAAAACCCCCCCCGGGGGGGGTTTTTTTTTTTTTTTTTTNNNNRRYY"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bases(text: str):
    return F.regexp_replace(F.translate(text, LETTERS_FROM, LETTERS_TO), "[^ACGTNRY]", "")


def genomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(target_id, seq, source, lang, ord): each document as a genome; some without C, some with a tail."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", _bases("text").alias("base"))
    body = F.when(F.col("doc_id") % 101 == 5, F.translate("base", "C", "T")).otherwise(F.col("base"))
    tail = F.when(F.col("doc_id") % 7 == 0, F.repeat(F.lit("A"), (4 + F.col("doc_id") % 9).cast("int"))).otherwise("")
    return docs.select(F.col("doc_id").alias("target_id"), F.concat(body, tail).alias("seq"), "source", "lang", F.col("doc_id").alias("ord"))


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc_filter(genomes(spark, sf_dir))


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(probe_id, seq): tiles of the benchmark's passages."""
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("target_id"), _bases("text").alias("seq"))
    return tile(items, prefix="b")


def alignments(spark: SparkSession, sf_dir: str, a: int = 37, b: int = 91) -> DataFrame:
    """Ten alignments with each kept genome, placed by its id."""
    g, i, n = F.col("target_id"), F.col("i"), F.col("n")
    rows = kept(spark, sf_dir).select("target_id", F.length("seq").cast("long").alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(9).cast("long"))).alias("i"))
    rows = rows.withColumn("start", (g * a + i * b) % (n - 99))
    rows = rows.withColumn("length", F.least(60 + (g * 7 + i * 13) % 61, n - F.col("start")))
    minus = (g + i) % 3 == 0
    low, high = (F.col("start") + 1).cast("int"), (F.col("start") + F.col("length")).cast("int")
    return rows.select(
        F.concat(F.lit("p"), (g % 50).cast("string"), F.lit("_"), i.cast("string")).alias("probe_id"), "target_id", (80 + (g * 3 + i * 11) % 21).cast("double").alias("pident"),
        F.col("length").cast("int").alias("length"), F.when(minus, high).otherwise(low).alias("sstart"), F.when(minus, low).otherwise(high).alias("send"),
    )


def depth(spark: SparkSession, sf_dir: str, a: int = 37, b: int = 91) -> DataFrame:
    return alignments_to_depth(filter_alignments(alignments(spark, sf_dir, a, b)), kept(spark, sf_dir))


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("cluster"))


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    r = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    return lines.withColumn("r", r).withColumn("id", F.concat(F.col("l_orderkey").cast("string"), F.lit("_"), F.col("r").cast("string")))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, seq): an order's lines as blocks."""
    return _nodes(spark, sf_dir).select("id", F.translate(F.col("l_partkey").cast("string"), "0123456789", "ACGTACGTAC").alias("seq"))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(from_id, from_orient, to_id, to_orient): from each line to its order's next, and from some to the next order's first."""
    n = _nodes(spark, sf_dir)
    to = n.select(F.col("l_orderkey").alias("o"), F.col("r").alias("q"), F.col("id").alias("to_id"), F.when(F.col("l_suppkey") % 23 == 0, "-").otherwise("+").alias("to_orient"))
    along = n.join(to, (F.col("l_orderkey") == F.col("o")) & (F.col("r") + 1 == F.col("q")))
    across = n.where("l_partkey % 17 = 0").join(to.where("q = 1"), F.col("l_orderkey") + 1 == F.col("o"))
    return along.unionByName(across).select(F.col("id").alias("from_id"), F.lit("+").alias("from_orient"), "to_id", "to_orient")
