"""Sequences of any length from FASTA files, as pieces.

Lines are read by many tasks, whatever record they belong to. A task numbers the
records that begin in its block of the file; which record a block's first lines
carry on, and where in it they stand, follows from the blocks before.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.sequences import cut_again
from ..store import saved

#: Letters of a row while a block is read; rows of blocks that may be broadcast, each a few hundred bytes.
PART, FEW_BLOCKS = 65_536, 50_000
_PARTS = "file string, block long, record long, at long, header string, part string"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, line) to parts of records; those of record 0 carry on what an earlier block began."""
    rows: list[tuple] = []
    now, record, at, header, held, size = None, 0, 0, None, [], 0

    def close() -> None:
        nonlocal at, header, size
        if now is not None and (held or (header is not None and not at)):
            part = "".join(held)
            rows.append((*now, record, at, header, part))
            at += len(part)
        size = 0
        held.clear()

    def made() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        out = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["file", "block", "record", "at", "header", "part"])
        rows.clear()
        return out

    for batch in batches:
        for file, block, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, block) != now:
                close()
                now, record, at, header = (file, block), 0, 0, None
            if line.startswith(">"):
                close()
                record, at, header = record + 1, 0, line[1:].strip()
            elif letters := "".join(line.split()):
                held.append(letters)
                size += len(letters)
                if size >= PART:
                    close()
        if rows:
            yield made()
    close()
    if rows:
        yield made()


def read_fasta_pieces(spark: SparkSession, path: str | list[str], size: int = 16_384) -> DataFrame:
    """(target_id, at, piece) of a FASTA file or a folder of them: each sequence from every multiple of `size` on. Written.

    No task holds a whole record, so a chromosome is read by as many tasks as its
    file has blocks; only a single line must fit into one. What stands before a
    file's first header is dropped, records without letters have no pieces, and an
    id that stands twice raises, for its pieces could not be told apart.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    parts = saved(lines.mapInArrow(_parts, _PARTS), "fasta-parts")
    names = parts.where("header IS NOT NULL AND at = 0").select(F.split("header", r"\s+")[0].alias("target_id"))
    twice = names.groupBy("target_id").count().where("count > 1").first()
    if twice is not None:
        raise ValueError(f"id stands twice: {twice['target_id']}")
    records = parts.groupBy("file", "block", "record").agg(F.sum(F.length("part")).alias("n"), F.max("header").alias("header"))
    carried = F.coalesce(F.sum(F.when(F.col("record") == 0, F.col("n"))), F.lit(0)).alias("carried")
    blocks = records.groupBy("file", "block").agg(F.max_by(F.struct("record", "n", "header"), "record").alias("last"), carried)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("sum", F.coalesce(F.sum("carried").over(before), F.lit(0)))
    owner = F.when(F.col("last.record") > 0, F.struct(F.col("last.header").alias("header"), (F.col("last.n") - F.col("sum") - F.col("carried")).alias("shift")))
    placed = saved(blocks.withColumn("owner", F.last(owner, ignorenulls=True).over(before)).where("owner IS NOT NULL AND carried > 0").select("file", "block", F.col("owner.header").alias("owner"), (F.col("owner.shift") + F.col("sum")).alias("shift")), "fasta-blocks")
    small = placed.count() <= FEW_BLOCKS
    carries = parts.where("record = 0").join(F.broadcast(placed) if small else placed, ["file", "block"]).select("owner", (F.col("at") + F.col("shift")).alias("at"), "part")
    own = parts.where("record > 0").select(F.col("header").alias("owner"), "at", "part")
    whole = own.unionByName(carries).select(F.split("owner", r"\s+")[0].alias("target_id"), "at", F.col("part").alias("piece"))
    return saved(cut_again(whole, "target_id", size, 0), "fasta-pieces")
