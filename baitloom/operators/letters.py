"""Letters of targets by place, without the whole target beside each run.

A target is cut into pieces of PIECE letters, each with the counts of letters before it. How
many letters of a kind stand before a place takes the piece that it lies in; a run's
letters are the difference of two such counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import in_pieces, letter_count, pieces_of

PIECE = 4096
#: Kinds of letters that are counted.
ATGC, N = "ACGTacgt", "N"


def _pieces(targets: DataFrame) -> DataFrame:
    """(target_id, piece_no, piece)"""
    cut = pieces_of(targets, "target_id", PIECE, 0)
    return cut.select("target_id", F.expr(f"at div {PIECE}").alias("piece_no"), "piece")


def _counted(targets: DataFrame) -> DataFrame:
    """Pieces with the letters of a kind that the target has before them."""
    before = Window.partitionBy("target_id").orderBy("piece_no").rowsBetween(Window.unboundedPreceding, -1)
    upto = lambda letters: F.coalesce(F.sum(letter_count(F.col("piece"), letters).cast("long")).over(before), F.lit(0))
    if not in_pieces(targets):
        return _pieces(targets).withColumn("atgc_before", upto(ATGC)).withColumn("n_before", upto(N))
    # a target may be too long for a task that sorts its pieces, but not for one that sorts their counts
    cut = _pieces(targets)
    counts = cut.select("target_id", "piece_no", *[letter_count(F.col("piece"), x).cast("long").alias(c) for c, x in (("atgc_before", ATGC), ("n_before", N))])
    sums = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("atgc_before", "n_before")]
    return cut.join(counts.select("target_id", "piece_no", *sums), ["target_id", "piece_no"])


def run_sums(segments: DataFrame, targets: DataFrame) -> DataFrame:
    """(target_id, depth, n, n_atgc, n_n): what sums to the bases of segments and their letters.

    Two rows for a segment: what the target has up to its end, and, taken away, up to
    its start. Only sums over whole segments mean anything. Segments lie within their
    targets; those of unknown targets give nothing.
    """
    ends = F.array(F.struct(F.col("end").alias("pos"), F.lit(1).alias("sign")), F.struct(F.col("start").alias("pos"), F.lit(-1).alias("sign")))
    places = segments.select("target_id", "depth", F.explode(ends).alias("e")).select("target_id", "depth", "e.pos", "e.sign").where("pos > 0")
    at = places.withColumn("piece_no", F.expr(f"(pos - 1) div {PIECE}")).join(_counted(targets), ["target_id", "piece_no"])
    head = F.substring(F.col("piece"), F.lit(1), (F.col("pos") - F.col("piece_no") * PIECE).cast("int"))
    upto = lambda before, letters: (F.col("sign") * (F.col(before) + letter_count(head, letters))).cast("long")
    return at.select("target_id", "depth", (F.col("sign") * F.col("pos")).cast("long").alias("n"), upto("atgc_before", ATGC).alias("n_atgc"), upto("n_before", N).alias("n_n"))


def cut_out(windows: DataFrame, targets: DataFrame) -> DataFrame:
    """Windows (target_id, start, end) with `seq`, put together from the pieces that they touch. Windows of a target that start and end alike become one."""
    numbers = F.sequence(F.expr(f"start div {PIECE}"), F.expr(f"(end - 1) div {PIECE}"))
    asked = windows.withColumn("piece_no", F.explode(numbers))
    low = F.greatest(F.col("start") - F.col("piece_no") * PIECE, F.lit(0)).cast("int")
    high = F.least(F.col("end") - F.col("piece_no") * PIECE, F.lit(PIECE)).cast("int")
    parts = asked.join(_pieces(targets), ["target_id", "piece_no"]).select(*windows.columns, "piece_no", F.substring(F.col("piece"), low + 1, high - low).alias("part"))
    whole = parts.groupBy(*windows.columns).agg(F.sort_array(F.collect_list(F.struct("piece_no", "part")))["part"].alias("parts"))
    return whole.withColumn("seq", F.array_join("parts", "")).drop("parts")
