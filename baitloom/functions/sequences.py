"""Column functions over sequences. All of them are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The ambiguity codes and the letters that each may stand for, in
# the order that weighted choices go through them. N lists T twice and no G.
AMBIGUITY = {
    "R": ("A", "G"),
    "K": ("G", "T"),
    "S": ("G", "C"),
    "Y": ("C", "T"),
    "M": ("A", "C"),
    "W": ("A", "T"),
    "B": ("C", "G", "T"),
    "H": ("A", "C", "T"),
    "D": ("A", "G", "T"),
    "V": ("A", "C", "G"),
    "N": ("A", "T", "C", "T"),
}
LETTERS = tuple("ACGT") + tuple(AMBIGUITY)


def letter_count(seq: Column, letters: str) -> Column:
    """How many characters of seq are among these letters."""
    return F.length(seq) - F.length(F.translate(seq, letters, ""))


def ambiguous_count(seq: Column) -> Column:
    """Characters other than A, C, G and T in either case."""
    return F.length(F.translate(seq, "ACGTacgt", ""))


def strip_tail(seq: Column) -> Column:
    """Without a run of over five A, N or M at the end, if another letter stands before it."""
    return F.regexp_replace(seq, "([^AaNnMm])[AaNnMm]{6,}$", "$1")


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTRYKMBDHVacgtrykmbdhv", "TGCAYRMKVHDBtgcayrmkvhdb"))


def unit_draw(*parts: Column) -> Column:
    """A number in [0, 1) that only depends on the parts."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def tile_starts(length: Column, size: int, step: int) -> Column:
    """Starts 0, step, ... that fit, and one that ends with the sequence."""
    last = length - size
    return F.when(last >= 0, F.array_union(F.sequence(F.lit(0), last, F.lit(step)), F.array(last))).otherwise(F.array().cast("array<int>"))


def chunks(seqs: DataFrame, id_col: str, size: int, more: int) -> DataFrame:
    """(id, at, piece): each sequence from every multiple of `size` on, with `more` letters beyond; nothing for null or empty ones.

    Pieces are cut from bytes, where any place is reached at once, and before
    rows are made of them, so that no row repeats the whole sequence.
    """
    raw = seqs.where(F.length("seq") > 0).select(id_col, F.encode("seq", "UTF-8").alias("_raw"))
    piece = lambda at: F.struct(at.alias("at"), F.substring(F.col("_raw"), at + 1, F.lit(size + more)).cast("string").alias("piece"))
    cut = raw.select(id_col, F.explode(F.transform(F.sequence(F.lit(0), F.length("_raw") - 1, F.lit(size)), piece)).alias("_c"))
    return cut.select(id_col, F.col("_c.at").alias("at"), F.col("_c.piece").alias("piece"))


def in_pieces(targets: DataFrame) -> bool:
    """Whether targets are a table of pieces (target_id, at, piece) instead of whole sequences (target_id, seq)."""
    return "piece" in targets.columns and "seq" not in targets.columns


def cut_again(parts: DataFrame, id_col: str, size: int, more: int) -> DataFrame:
    """Pieces (id, at, piece), which follow each other without gap or overlap, as `chunks` would cut the whole.

    A part goes to each chunk that it touches, and a chunk is put together by its own
    key, so no task holds more of a target than a chunk.
    """
    n = F.length("piece")
    first = F.greatest(F.floor((F.col("at") - size - more) / size) + 1, F.lit(0))
    asked = parts.where(n > 0).select(id_col, F.col("at").cast("long").alias("_at"), F.col("piece").alias("_p"), F.explode(F.sequence(first, F.floor((F.col("at") + n - 1) / size))).alias("_c"))
    low = F.greatest(F.col("_c") * size - F.col("_at"), F.lit(0)).cast("int")
    high = F.least(F.col("_c") * size + size + more - F.col("_at"), F.length("_p")).cast("int")
    cut = asked.select(id_col, "_c", F.struct(F.col("_at"), F.substring(F.col("_p"), low + 1, high - low).alias("part")).alias("_s"))
    whole = cut.groupBy(id_col, "_c").agg(F.array_join(F.sort_array(F.collect_list("_s"))["part"], "").alias("piece"))
    return whole.select(id_col, (F.col("_c") * size).cast("int").alias("at"), "piece")


def pieces_of(targets: DataFrame, id_col: str, size: int, more: int) -> DataFrame:
    """Chunks of whole sequences or of a table of pieces."""
    return cut_again(targets, id_col, size, more) if in_pieces(targets) else chunks(targets, id_col, size, more)


def lengths_of(targets: DataFrame, name: str = "length") -> DataFrame:
    """(target_id, length) of whole sequences or of a table of pieces."""
    if not in_pieces(targets):
        return targets.select("target_id", F.length("seq").alias(name))
    return targets.groupBy("target_id").agg(F.max(F.col("at") + F.length("piece")).cast("int").alias(name))
