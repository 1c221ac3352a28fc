"""Quality control of input sequences. Repeated rows are judged each by itself; an empty table gives no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import LETTERS, letter_count, strip_tail
from ..store import free_name


def dedup_by_id(seqs: DataFrame, order_col: str = "ord", id_col: str = "target_id") -> DataFrame:
    """The last row of each id; of rows that share id and order, the one with the greatest sequence. Null ids count as one id."""
    n = free_name("n", seqs.columns)
    last = Window.partitionBy(id_col).orderBy(F.col(order_col).desc(), F.col("seq").desc_nulls_last())
    return seqs.withColumn(n, F.row_number().over(last)).where(F.col(n) == 1).drop(n)


def composition_per_seq(seqs: DataFrame, id_col: str = "target_id") -> DataFrame:
    """(id, letter, n, prop) of the upper-cased letters that occur.

    Known letters are counted in place; only what is left is cut into characters.
    """
    upper = F.upper("seq")
    base = seqs.select(id_col, upper.alias("u"), F.length("seq").alias("len"))
    known = F.array(*[F.struct(F.lit(x).alias("letter"), letter_count(F.col("u"), x).cast("long").alias("n")) for x in LETTERS])
    one = base.select(id_col, "len", F.explode(known).alias("x")).select(id_col, "len", "x.letter", "x.n").where("n > 0")
    rest = base.withColumn("rest", F.translate("u", "".join(LETTERS), "")).where("rest != ''")
    other = rest.select(id_col, "len", F.explode(F.split("rest", "")).alias("letter")).where("letter != ''").groupBy(id_col, "len", "letter").agg(F.count("*").alias("n"))
    return one.unionByName(other).select(id_col, "letter", "n", (F.col("n") / F.col("len")).alias("prop"))


def composition_overall(seqs: DataFrame) -> DataFrame:
    """(letter, n, prop) over all sequences; the letters A, C, G, T and N are there even if they never occur."""
    counts = composition_per_seq(seqs).groupBy("letter").agg(F.sum("n").alias("n"))
    always = seqs.sparkSession.createDataFrame([(x,) for x in "ACGTN"], "letter string")
    total = counts.agg(F.sum("n").alias("total"))
    whole = counts.join(F.broadcast(always), "letter", "full").select("letter", F.coalesce("n", F.lit(0)).alias("n"))
    return whole.crossJoin(F.broadcast(total)).select("letter", "n", (F.col("n") / F.col("total")).alias("prop"))


def qc_flag(seqs: DataFrame, max_nonstandard: float = 0.01, max_n: float = 0.05, min_len: int = 100, min_c: float = 0.01, empty: str = "too_short") -> DataFrame:
    """Adds reason (the first that holds, else keep), trimmed_seq and trimmed_bp.

    A null sequence is no_sequence; an empty one, whose shares are none, is what `empty` says. What is measured of a
    sequence is exploded from an array of one: no filter is pushed below that, so
    the sequence is made and read once, however it came to be.
    """
    seq, n = F.col("seq"), F.length("seq")
    share = lambda part: F.try_divide(part, n)
    odd = n - letter_count(seq, "ACGTNacgtn")
    measured = F.struct(n.alias("n"), share(letter_count(seq, "Nn")).alias("n_share"), share(odd).alias("odd_share"), share(letter_count(seq, "Cc")).alias("c_share"), strip_tail(seq).alias("trimmed"))
    q = free_name("qc", seqs.columns)
    known = seqs.select("*", F.explode(F.array(measured)).alias(q))
    left = F.length(f"{q}.trimmed")
    reason = (
        F.when(F.col(f"{q}.n").isNull(), "no_sequence")
        .when(F.col(f"{q}.n") == 0, empty)
        .when(F.col(f"{q}.n_share") > max_n, "excess_n")
        .when(F.col(f"{q}.odd_share") >= max_nonstandard, "nonstandard")
        .when(F.col(f"{q}.n") < min_len, "too_short")
        .when(F.col(f"{q}.c_share") < min_c, "no_c")
        .when(left < min_len, "short_after_trim")
        .otherwise("keep")
    )
    return known.withColumns({"reason": reason, "trimmed_seq": F.col(f"{q}.trimmed"), "trimmed_bp": F.col(f"{q}.n") - left}).drop(q)


def qc_filter(seqs: DataFrame, **limits) -> DataFrame:
    """The kept sequences, trimmed."""
    kept = qc_flag(seqs, **limits).where("reason = 'keep'")
    return kept.withColumn("seq", F.col("trimmed_seq")).drop("reason", "trimmed_seq", "trimmed_bp")


def qc_report(seqs: DataFrame, **limits) -> DataFrame:
    """(reason, n, trimmed): sequences of each reason, and how many of them have a tail to trim."""
    flagged = qc_flag(seqs, **limits)
    return flagged.groupBy("reason").agg(F.count("*").alias("n"), F.count_if(F.col("trimmed_bp") > 0).alias("trimmed"))
