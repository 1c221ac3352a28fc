"""A training corpus from raw documents, in five stages.

Each stage takes what its predecessor kept. All but the last return the columns
of documents, whatever they are: other columns pass through, and one that has the name of
something that a stage makes keeps its own values. Repeated rows are judged each for itself,
texts count whole, and an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baitloom.llm._store import saved
from baitloom.llm.decontaminate import decontaminate
from baitloom.llm.jaccard import keep_one
from baitloom.llm.pieces import digest
from baitloom.llm.queries import table
from baitloom.llm.secrets import scan_secrets
from baitloom.llm.toxicity import fit, score_toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic.

    A null text counts as empty, and without labels of both classes nothing goes.
    """
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).where("predicted = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near copies.

    Documents with a null or wordless text, or a null id, resemble nothing and stay.
    """
    return keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold the benchmark.

    Null and wordless texts hold nothing and stay; without items everything stays.
    """
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).where("NOT contaminated").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind and n_chars brought up to date.

    Null texts stay null; n_chars changes only where a secret was found.
    """
    found = scan_secrets(docs, redact=True)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.when(F.col("n_secrets") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, and how many pieces its text has, their digest, and whether they decode to the text.

    A null or empty text has no pieces; a null id stays null.
    """
    return digest(docs, keep=["doc_id"])


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("pieces", tokenize),
]

#: A trained classifier and SentencePiece are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's are written to the shared folder as Parquet and read again as the next one's."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
