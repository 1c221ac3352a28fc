"""Making, choosing and changing probes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import AMBIGUITY, ambiguous_count, chunks, cut_again, in_pieces, tile_starts, unit_draw
from ..store import numbered, saved

CHUNK, FEW = 4096, 1000


def tile(seqs: DataFrame, probe_len: int = 120, step: int = 120, max_ambig: int = 10, prefix: str = "", id_col: str = "target_id") -> DataFrame:
    """(probe_id, seq): tiles of each sequence, numbered from 1 after dropping ambiguous ones.

    Tiles are numbered inside their array, so nothing is shuffled. Of a table of
    pieces, each chunk cuts its own tiles, and only their counts meet.
    """
    few = lambda p: ambiguous_count(p) <= max_ambig
    if in_pieces(seqs):
        cut = _tiles_of_pieces(seqs, id_col, probe_len, step, few)
    else:
        raw = seqs.select(F.col(id_col).cast("string").alias("_id"), F.encode("seq", "UTF-8").alias("_raw"))
        starts = tile_starts(F.length("_raw"), probe_len, step)
        pieces = F.filter(F.transform(starts, lambda s: F.substring(F.col("_raw"), s + 1, F.lit(probe_len)).cast("string")), few)
        cut = raw.select("_id", F.posexplode(pieces).alias("_n", "seq"))
    return cut.select(F.concat(F.lit(prefix + "_"), "_id", F.lit("_piece_"), (F.col("_n") + 1).cast("string")).alias("probe_id"), "seq")


def _tiles_of_pieces(pieces: DataFrame, id_col: str, probe_len: int, step: int, few) -> DataFrame:
    """(_id, _n, seq). A chunk that is not full ends with its sequence, and so has the tile that does."""
    size = step * max(1, CHUNK // step)
    n = F.length("piece")
    last = n - probe_len
    ends = F.when(n < size + probe_len, F.array(last)).otherwise(F.array().cast("array<int>"))
    starts = F.when(last >= 0, F.array_union(F.sequence(F.lit(0), F.least(last, F.lit(size - 1)), F.lit(step)), ends)).otherwise(F.array().cast("array<int>"))
    made = F.filter(F.transform(starts, lambda s: F.substring(F.col("piece"), s + 1, F.lit(probe_len))), few)
    cut = saved(cut_again(pieces, id_col, size, probe_len).select(F.col(id_col).cast("string").alias("_id"), "at", made.alias("_t")), "tiles")
    before = Window.partitionBy("_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.select("_id", "at", F.coalesce(F.sum(F.size("_t")).over(before), F.lit(0)).alias("_before"))
    return cut.join(counts, ["_id", "at"]).select("_id", "_before", F.posexplode("_t").alias("_i", "seq")).select("_id", (F.col("_before") + F.col("_i")).alias("_n"), "seq")


def pad_short(seqs: DataFrame, min_len: int = 90, probe_len: int = 120, nuc: str = "T", prefix: str = "", id_col: str = "target_id") -> DataFrame:
    """(probe_id, seq): sequences under a probe's length, without N, padded on the left."""
    rest = seqs.where(F.length("seq") < probe_len).withColumn("_s", F.regexp_replace("seq", "[Nn]", "")).where(F.length("_s") >= min_len)
    return rest.select(F.concat(F.lit(prefix + "_"), F.col(id_col).cast("string"), F.lit("_padded_probe")).alias("probe_id"), F.lpad("_s", probe_len, nuc).alias("seq"))


def _chosen(letter: Column, draw: Column, props: dict[str, float], n_choices: str) -> Column:
    out = letter
    for code, letters in (AMBIGUITY | {"N": tuple(n_choices)}).items():
        weights = [props.get(x, 0.0) for x in letters]
        weights = weights if sum(weights) > 0 else [1.0] * len(letters)
        pick, below = F.lit(letters[-1]), []
        for x, w in zip(letters, weights, strict=True):
            below.append((x, (below[-1][1] if below else 0.0) + w))
        for x, upto in reversed(below[:-1]):
            pick = F.when(draw * F.lit(below[-1][1]) < F.lit(upto), F.lit(x)).otherwise(pick)
        out = F.when(letter == code, pick).otherwise(out)
    return out


def substitute_ambiguous(probes: DataFrame, props: DataFrame, seed: int = 1, n_choices: str = "".join(AMBIGUITY["N"])) -> DataFrame:
    """Upper-cases probes and draws a letter for each ambiguity code, weighted by (letter, prop).

    A draw depends on seed, probe and position only. Other characters stay, and so
    does a null sequence. `n_choices` are the letters that N may stand for.
    """
    weights = {r["letter"]: r["prop"] for r in props.select("letter", "prop").where(F.col("letter").isin(*"ACGT")).collect()}
    letters = F.split(F.upper("seq"), "")
    drawn = F.transform(letters, lambda x, i: _chosen(x, unit_draw(F.lit(seed), F.col("probe_id"), i), weights, n_choices))
    return probes.withColumn("seq", F.when(ambiguous_count(F.col("seq")) > 0, F.array_join(drawn, "")).otherwise(F.upper("seq")))


def enum_kmers(seqs: DataFrame, k: int = 120, step: int = 1, max_degen: int = 0, id_col: str = "target_id") -> DataFrame:
    """(id, pos, kmer): upper-cased k-mers at each step with few other letters than A, C, G and T.

    Sequences shorter than k, empty and null ones give none. K-mers are cut out of
    chunks, which begin at a step.
    """
    size = step * max(1, CHUNK // step)
    parts = chunks(seqs, id_col, size, k - 1).where(F.length("piece") >= k).select(id_col, "at", F.lit(0).alias("_s"), F.upper("piece").alias("_u"))
    if max_degen == 0:  # stretches of known letters are cut out first, so no k-mer is looked through
        taken = F.struct(F.lit(0).alias("s"), F.array().cast("array<struct<s: int, u: string>>").alias("found"))
        longer = lambda x, r: F.when(F.length(r) >= k, F.concat(x["found"], F.array(F.struct(x["s"].alias("s"), r.alias("u"))))).otherwise(x["found"])
        known = F.aggregate(F.split("_u", "[^ACGT]"), taken, lambda x, r: F.struct((x["s"] + F.length(r) + 1).alias("s"), longer(x, r).alias("found")))["found"]
        parts = parts.select(id_col, "at", F.explode(known).alias("_r")).select(id_col, "at", F.col("_r.s").alias("_s"), F.col("_r.u").alias("_u"))
    first, last = F.pmod(-F.col("_s"), F.lit(step)), F.least(F.length("_u") - k, F.lit(size - 1) - F.col("_s"))
    made = F.transform(F.sequence(first, last, F.lit(step)), lambda p: F.struct(p.alias("p"), F.substring(F.col("_u"), p + 1, F.lit(k)).alias("kmer")))
    each = parts.where(first <= last).select(id_col, (F.col("at") + F.col("_s")).alias("_s"), F.explode(made).alias("_c"))
    cut = each.select(id_col, (F.col("_s") + F.col("_c.p")).alias("pos"), F.col("_c.kmer").alias("kmer"))
    return cut if max_degen == 0 else cut.where(F.length(F.translate("kmer", "ACGT", "")) <= max_degen)


def kmer_support(kmers: DataFrame) -> DataFrame:
    """(kmer, size): how often each distinct k-mer occurs."""
    return kmers.groupBy("kmer").agg(F.count("*").alias("size"))


def remove_existing(kmers: DataFrame, panel: DataFrame) -> DataFrame:
    """Candidates whose sequence the panel does not have."""
    return kmers.join(panel.select(F.col("seq").alias("kmer")).distinct(), "kmer", "left_anti")


def rank_candidates(centroids: DataFrame) -> DataFrame:
    """By cluster size, largest first; ties by k-mer."""
    return centroids.orderBy(F.desc("size"), F.asc_nulls_last("kmer"))


def take_top(candidates: DataFrame, n: int | None, name: str) -> DataFrame:
    """(probe_id, seq): the first n, or all, numbered from 1. Candidates with a null k-mer come last among their size.

    Up to FEW of them are what each task's best hold. Otherwise ranks come from
    sorted partitions and their sizes, so no task holds all rows. Both give the same.
    """
    if n is not None and n <= FEW:
        ranked = rank_candidates(candidates).limit(n).withColumn("_i", F.row_number().over(Window.orderBy(F.desc("size"), F.asc_nulls_last("kmer"))))
    else:
        ranked = numbered(candidates.select("size", "kmer"), F.desc("size"), F.asc_nulls_last("kmer")).withColumn("_i", F.col("place") + 1)
        ranked = ranked if n is None else ranked.where(F.col("_i") <= n)
    return ranked.select(F.concat(F.lit(name + "_probe_"), F.col("_i").cast("string")).alias("probe_id"), F.col("kmer").alias("seq"))


def append_probes(panel: DataFrame, *more: DataFrame) -> DataFrame:
    """All probes, without removing any."""
    for x in more:
        panel = panel.unionByName(x)
    return panel


def panel_counts(probes: DataFrame, added_marker: str = "_round_") -> DataFrame:
    """(total, added): probes, and those that gap filling added."""
    return probes.agg(F.count("*").alias("total"), F.count_if(F.contains("probe_id", F.lit(added_marker))).alias("added"))
