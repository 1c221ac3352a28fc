"""Written tables, which cut lineage, in the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the whole cluster shares: spark.checkpoint.dir, or a temporary folder where Spark runs on one machine."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return f"{context.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that run inside go as soon as each ends."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def saved(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read back: its rows stay, and what it came from can go. Sequences shrink to about two bits a letter."""
    spark = frame.sparkSession
    to = scratch(spark, name)
    with shuffles_removed(spark):
        frame.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", 1).parquet(to)
    return spark.read.schema(frame.schema).parquet(to)


def discard(*frames: DataFrame) -> None:
    """Deletes written tables that nothing reads any more, such as those that a round has replaced. What lies outside the folder of scratch() stays."""
    for frame in frames:
        context = frame.sparkSession.sparkContext
        hadoop, uri = context._jvm.org.apache.hadoop.fs, context._jvm.java.net.URI
        root = context.getCheckpointDir()
        home = root and hadoop.Path(root).toUri().getPath() + "/"
        for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
            path = hadoop.Path(uri(folder))
            if home and path.toUri().getPath().startswith(home):
                path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def free_name(name: str, taken: Iterable[str]) -> str:
    """A column name that is not among those taken, whatever their case."""
    used = {x.lower() for x in taken}
    while name.lower() in used:
        name += "_"
    return name


def numbered(frame: DataFrame, *order: Column, name: str = "place") -> DataFrame:
    """The rows with their place from 0 in this order, written.

    Rows are sorted in ranges; a row's place in its own range and the sizes of the
    ranges before give its place. No task holds more than a range, and the driver
    sees one row for each. Add a column that tells all rows apart as the last of
    the order if many rows may be equal.
    """
    index, part, before = (free_name(x, frame.columns) for x in ("index", "part", "before"))
    ordered = saved(frame.orderBy(*order).withColumn(index, F.monotonically_increasing_id()).withColumn(part, F.shiftright(index, 33)), "ordered")
    first, at = [], 0
    for r in sorted(ordered.groupBy(part).count().collect()):  # a row for each range
        first.append((r[0], at))
        at += r[1]
    starts = F.broadcast(frame.sparkSession.createDataFrame(first, f"`{part}` long, `{before}` long"))
    placed = ordered.join(starts, part).withColumn(name, F.col(index).bitwiseAND((1 << 33) - 1) + F.col(before))
    return placed.drop(index, part, before)
