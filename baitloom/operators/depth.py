"""Depth of coverage as runs, and what is derived from runs.

Depth segments (target_id, start, end, depth) cover each target without gaps.
An alignment is two boundary events, so nothing is ever as long as the bases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import in_pieces, lengths_of
from .letters import cut_out


def filter_alignments(aln: DataFrame, min_id: float = 85.0, min_len: int = 90) -> DataFrame:
    return aln.where((F.col("pident") >= min_id) & (F.col("length") >= min_len))


def depth_from_events(events: DataFrame, lengths: DataFrame) -> DataFrame:
    """Segments of targets (target_id, length) from (target_id, pos, delta); targets without events have depth 0."""
    ends = lengths.where("length > 0").select("target_id", F.explode(F.array(F.lit(0), F.col("length").cast("int"))).alias("pos"), F.lit(0).cast("long").alias("delta"))
    steps = events.select("target_id", F.col("pos").cast("int").alias("pos"), F.col("delta").cast("long").alias("delta")).unionByName(ends)
    steps = steps.groupBy("target_id", "pos").agg(F.sum("delta").alias("delta"))
    order = Window.partitionBy("target_id").orderBy("pos")
    runs = steps.select("target_id", F.col("pos").alias("start"), F.lead("pos").over(order).alias("end"), F.sum("delta").over(order).cast("int").alias("depth"))
    return coalesce_runs(runs.where("end IS NOT NULL"))


def coalesce_runs(segments: DataFrame, key: str | Column = "depth", name: str = "depth") -> DataFrame:
    """Touching segments of equal key as one: (target_id, start, end, name)."""
    key = F.col(key) if isinstance(key, str) else key
    order = Window.partitionBy("target_id").orderBy("start")
    keyed = segments.select("target_id", "start", "end", key.alias("_k"))
    changed = keyed.withColumn("_c", F.when(F.lag("_k").over(order).eqNullSafe(F.col("_k")) & (F.lag("end").over(order) == F.col("start")), 0).otherwise(1))
    islands = changed.withColumn("_i", F.sum("_c").over(order))
    return islands.groupBy("target_id", "_i").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.first("_k").alias(name)).drop("_i")


def alignment_events(aln: DataFrame) -> DataFrame:
    """Boundary events of alignments in 1-based inclusive coordinates, either strand."""
    low, high = F.least("sstart", "send") - 1, F.greatest("sstart", "send")
    pair = F.array(F.struct(low.cast("int").alias("pos"), F.lit(1).alias("delta")), F.struct(high.cast("int").alias("pos"), F.lit(-1).alias("delta")))
    return aln.select("target_id", F.explode(pair).alias("e")).select("target_id", "e.pos", "e.delta")


def alignments_to_depth(aln: DataFrame, targets: DataFrame) -> DataFrame:
    """Depth segments: every alignment counts on all its bases. targets: (target_id, seq), or pieces of them."""
    return depth_from_events(alignment_events(aln), lengths_of(targets))


def segment_events(segments: DataFrame) -> DataFrame:
    pair = F.array(F.struct(F.col("start").alias("pos"), F.col("depth").alias("delta")), F.struct(F.col("end").alias("pos"), (-F.col("depth")).alias("delta")))
    return segments.where("depth != 0").select("target_id", F.explode(pair).alias("e")).select("target_id", "e.pos", "e.delta")


def _digests(targets: DataFrame) -> DataFrame:
    """(target_id, digest) of sequences; of pieces, which must be cut alike on both sides, of their digests in order."""
    if not in_pieces(targets):
        return targets.select("target_id", F.sha2("seq", 256).alias("digest"))
    each = targets.groupBy("target_id").agg(F.sort_array(F.collect_list(F.struct("at", F.sha2("piece", 256).alias("d")))).alias("d"))
    return each.select("target_id", F.sha2(F.to_json("d"), 256).alias("digest"))


def checked_equal(a: DataFrame, b: DataFrame) -> None:
    """Raises if a target of both (target_id, seq), or tables of pieces, has two sequences. Only digests are compared."""
    other = _digests(b).withColumnRenamed("digest", "other")
    wrong = _digests(a).join(other, "target_id").where(~F.col("digest").eqNullSafe(F.col("other"))).select("target_id").first()
    if wrong is not None:
        raise ValueError(f"sequences of a shared target differ: {wrong[0]}")


def merge_capture(a: DataFrame, b: DataFrame, targets: DataFrame | None = None, other_targets: DataFrame | None = None) -> DataFrame:
    """Summed segments of two captures; targets of one only are taken over.

    Shared targets must be equally long and, where both sides' targets are given,
    have the same sequence.
    """
    if targets is not None and other_targets is not None:
        checked_equal(targets, other_targets)
    lengths = lambda x: x.groupBy("target_id").agg(F.max("end").alias("length"))
    both = lengths(a).join(lengths(b).withColumnRenamed("length", "other"), "target_id", "full")
    checked = both.select("target_id", F.when(F.coalesce(F.col("length") != F.col("other"), F.lit(False)), F.raise_error(F.lit("lengths of a shared target differ")).cast("int")).otherwise(F.coalesce("length", "other")).alias("length"))
    return depth_from_events(segment_events(a).unionByName(segment_events(b)), checked)


def merge_dense(a: DataFrame, b: DataFrame) -> DataFrame:
    """The same over (target_id, seq, depth array). Raises if a shared target's sequences or lengths differ."""
    j = a.alias("a").join(b.alias("b"), F.col("a.target_id") == F.col("b.target_id"), "full")
    wrong = (F.col("a.seq") != F.col("b.seq")) | (F.size("a.depth") != F.size("b.depth"))
    summed = F.when(wrong, F.raise_error(F.lit("sequences of a shared target differ")).cast("array<int>")).when(F.col("b.depth").isNull(), F.col("a.depth")).when(F.col("a.depth").isNull(), F.col("b.depth"))
    return j.select(F.coalesce("a.target_id", "b.target_id").alias("target_id"), F.coalesce("a.seq", "b.seq").alias("seq"), summed.otherwise(F.zip_with("a.depth", "b.depth", lambda x, y: x + y)).alias("depth"))


def shared_targets(a: DataFrame, b: DataFrame) -> DataFrame:
    """(target_id, side): both, left or right."""
    ids = lambda x, side: x.select("target_id", F.lit(side).alias("s")).distinct()
    both = ids(a, 1).unionByName(ids(b, 2)).groupBy("target_id").agg(F.sum("s").alias("s"))
    return both.select("target_id", F.when(F.col("s") == 3, "both").when(F.col("s") == 1, "left").otherwise("right").alias("side"))


def smooth_short_zeros(segments: DataFrame, threshold: int = 10) -> DataFrame:
    """Runs of depth 0 shorter than the threshold get depth 1."""
    runs = coalesce_runs(segments)
    changed = runs.withColumn("depth", F.when((F.col("depth") == 0) & (F.col("end") - F.col("start") < threshold), 1).otherwise(F.col("depth")))
    return coalesce_runs(changed)


def low_coverage(segments: DataFrame, targets: DataFrame, k: int = 120, min_depth: int = 0, min_len: int = 40) -> DataFrame:
    """(id, target_id, start, end, seq): runs of low depth longer than min_len, the shorter of them as windows of k around them."""
    low = coalesce_runs(segments, F.col("depth") <= min_depth, "low").where(F.col("low") & (F.col("end") - F.col("start") > min_len))
    j = low.join(lengths_of(targets, "n"), "target_id").where(F.col("n") >= k)
    size = F.col("end") - F.col("start")
    centred = F.col("start") - F.floor((F.lit(k) - size) / 2).cast("int")
    start = F.when(size >= k, F.col("start")).otherwise(F.least(F.greatest(centred, F.lit(0)), F.col("n") - k))
    end = F.when(size >= k, F.col("end")).otherwise(start + k)
    # two short runs may have one window; each has its row
    cut = cut_out(j.select("target_id", start.alias("start"), end.alias("end"), F.col("start").alias("run"), (size < k).alias("short")), targets)
    return cut.select(
        F.concat(F.col("target_id").cast("string"), F.lit("_position_"), (F.col("start") + 1).cast("string"), F.lit("_to_"), F.col("end").cast("string")).alias("id"),
        "target_id", "start", "end", F.when(F.col("short"), F.upper("seq")).otherwise(F.col("seq")).alias("seq"),
    )


def low_coverage_bases(windows: DataFrame, k: int = 120) -> DataFrame:
    """(bases, batch_size) of low-coverage windows: a batch is int(bases / k * 0.3)."""
    total = F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0)).cast("long")
    return windows.agg(total.alias("bases")).withColumn("batch_size", F.floor(F.col("bases") / k * 0.3).cast("long"))


def to_dense(segments: DataFrame, targets: DataFrame) -> DataFrame:
    """(target_id, seq, depth array), for exchange."""
    runs = segments.groupBy("target_id").agg(F.sort_array(F.collect_list(F.struct("start", "end", "depth"))).alias("r"))
    depth = F.flatten(F.transform("r", lambda x: F.array_repeat(x["depth"], x["end"] - x["start"])))
    return targets.select("target_id", "seq").join(runs, "target_id", "left").select("target_id", "seq", F.coalesce(depth, F.array().cast("array<int>")).alias("depth"))


def from_dense(capture: DataFrame) -> DataFrame:
    """Segments of (target_id, depth array): where a depth differs from the one before it a segment starts.

    Only segments become rows, and nothing is shuffled.
    """
    n = F.size("depth")
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | ~F.get("depth", i).eqNullSafe(F.get("depth", i - 1)))
    marked = capture.where(n > 0).select("target_id", "depth", starts.alias("_s"), n.alias("_n"))
    runs = F.transform("_s", lambda s, i: F.struct(s.alias("start"), F.coalesce(F.get("_s", i + 1), F.col("_n")).alias("end"), F.get("depth", s).alias("depth")))
    return marked.select("target_id", F.explode(runs).alias("_r")).select("target_id", "_r.start", "_r.end", "_r.depth")
