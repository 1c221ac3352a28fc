"""Reports over depth segments.

Letters matter only as "uncovered N" and "uncovered A, C, G or T"; they come from
counts up to a segment's two ends, so bases are never exploded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import unit_draw
from ..store import numbered
from .letters import run_sums

PERCENTILES = (0, 0.05, 0.1, 0.25, 0.5, 0.75, 1)


def _sum(condition: Column, value: str) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(value))), F.lit(0))


def genome_depth_stats(segments: DataFrame, targets: DataFrame, maxcheck: int = 1) -> DataFrame:
    """(target_id, c0, ..., c_gt, meancov): per cent of bases at each depth, without uncovered N; null if nothing is left."""
    x = run_sums(segments, targets)
    un = _sum(F.col("depth") == 0, "n_n")
    rows = F.sum("n") - un
    share = lambda part: F.when(rows > 0, part / rows * 100)
    at = [share(_sum(F.col("depth") == d, "n") - (un if d == 0 else 0)).alias(f"c{d}") for d in range(maxcheck + 1)]
    mean = (F.sum(F.col("depth") * F.col("n")) / F.sum("n")).alias("meancov")
    return x.groupBy("target_id").agg(*at, share(_sum(F.col("depth") > maxcheck, "n")).alias("c_gt"), mean)


def depth_class_long(stats: DataFrame) -> DataFrame:
    """(target_id, cluster, depth_class, pct), without meancov."""
    ids = [c for c in ("target_id", "cluster") if c in stats.columns]
    return stats.unpivot(ids, [c for c in stats.columns if c not in (*ids, "meancov")], "depth_class", "pct")


def panel_summary(stats: DataFrame, probes: DataFrame, report0: float = 1.0) -> DataFrame:
    """(metric, mean, min, max, median) of each column, total_probes and failed_genomes."""
    values = [c for c in stats.columns if c not in ("target_id", "cluster")]
    long = stats.select(*[F.col(c).cast("double").alias(c) for c in values]).unpivot([], values, "metric", "v")
    out = long.groupBy("metric").agg(F.avg("v").alias("mean"), F.min("v").alias("min"), F.max("v").alias("max"), F.median("v").alias("median"))
    empty = [F.lit(None).cast("double").alias(c) for c in ("min", "max", "median")]
    total = probes.agg(F.count("*").cast("double").alias("mean")).select(F.lit("total_probes").alias("metric"), "mean", *empty)
    failed = stats.agg(F.count_if(F.col("c0") > report0).cast("double").alias("mean")).select(F.lit("failed_genomes").alias("metric"), "mean", *empty)
    return out.unionByName(total).unionByName(failed)


def _coverage(d: int) -> Column:
    covered = _sum(F.col("depth") >= d, "n")
    total = covered + _sum(F.col("depth") < d, "n_atgc")
    return F.when(total > 0, covered * 100 / total).otherwise(F.lit(0.0))


def coverage_at_depth(segments: DataFrame, targets: DataFrame, d: int = 1) -> DataFrame:
    """(target_id, coverage): covered bases, whatever their letter, against these and uncovered A, C, G and T."""
    return run_sums(segments, targets).groupBy("target_id").agg(_coverage(d).alias("coverage"))


def coverage_percentiles(values: DataFrame, ps: Sequence[float] = PERCENTILES) -> DataFrame:
    """(p, value): the value at rank (n - 1) p, or midway between its neighbours; null if there are no values. Null values do not count.

    Values are sorted in ranges and numbered, so none passes through one task with
    all others, however many are equal.
    """
    spark = values.sparkSession
    placed = numbered(values.where("coverage IS NOT NULL").select("coverage", F.monotonically_increasing_id().alias("tie")), F.asc("coverage"), F.asc("tie"), name="rank")
    wanted = spark.createDataFrame([(float(p),) for p in ps], "p double")
    at = wanted.join(F.broadcast(placed.agg(F.count("*").alias("n"))), F.col("n") > 0).withColumn("r", (F.col("n") - 1) * F.col("p"))
    ranks = at.select("p", F.explode(F.array(F.floor("r"), F.ceil("r"))).alias("rank"))
    found = placed.join(F.broadcast(ranks), "rank").groupBy("p").agg(F.avg("coverage").alias("v"))
    return wanted.join(found, "p", "left").select("p", F.round("v", 2).alias("value"))


def panel_depth_distribution(segments: DataFrame) -> DataFrame:
    """One row: per cent of all bases at depth 0 to 4 and 5 or more."""
    n = segments.select("depth", (F.col("end") - F.col("start")).cast("long").alias("n"))
    share = lambda cond: F.round(_sum(cond, "n") * 100 / F.sum("n"), 2)
    return n.agg(*[share(F.col("depth") == d).alias(f"depth_{d}") for d in range(5)], share(F.col("depth") >= 5).alias("depth_5plus"))


def summary_report(segments: DataFrame, targets: DataFrame, name: str) -> DataFrame:
    """One row: targets, coverage percentiles and depth distribution."""
    values = coverage_at_depth(segments, targets)
    names = ["cov_min", "cov_5", "cov_10", "cov_q1", "cov_med", "cov_q3", "cov_max"]
    wide = coverage_percentiles(values).agg(*[F.max(F.when(F.col("p") == float(p), F.col("value"))).alias(c) for p, c in zip(PERCENTILES, names, strict=True)])
    total = segments.agg(F.countDistinct("target_id").alias("total_targets"))
    return total.crossJoin(wide).crossJoin(panel_depth_distribution(segments)).select(F.lit(name).alias("name"), "*")


def long_report(segments: DataFrame, targets: DataFrame, name: str) -> DataFrame:
    """A row for each target: length, letters, bases at each depth, coverage at each depth."""
    x = run_sums(segments, targets)
    n, atgc = F.sum("n"), F.sum("n_atgc")
    bases = [_sum(F.col("depth") == d, "n").alias(f"bases_{d}x") for d in range(5)] + [_sum(F.col("depth") >= 5, "n").alias("bases_5plusx")]
    covs = [F.round(_coverage(d), 1).alias(f"cov_{d}x") for d in range(1, 6)]
    out = x.groupBy("target_id").agg(n.alias("length"), atgc.alias("atgcs"), F.round(atgc * 100 / n, 2).alias("pct_atgcs"), *bases, *covs)
    return out.select(F.lit(name).alias("name"), "*")


def mapped_probe_count(aln: DataFrame) -> DataFrame:
    return aln.agg(F.countDistinct("probe_id").alias("mapped_probes"))


def attach_clusters(stats: DataFrame, clusters: DataFrame) -> DataFrame:
    """Adds each target's cluster, null if it has none, in place of a column `cluster` that is there. clusters: (id, cluster); a target that stands there twice has two rows."""
    return stats.drop("cluster").join(clusters.select(F.col("id").alias("target_id"), "cluster"), "target_id", "left")


def cluster_sizes(stats: DataFrame) -> DataFrame:
    return stats.groupBy("cluster").agg(F.count("*").alias("genomes"))


def boxplot_stats(long: DataFrame, by: Sequence[str] = ("depth_class", "cluster")) -> DataFrame:
    """Quartiles of pct in each group."""
    q = F.percentile("pct", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return long.groupBy(*by).agg(q.alias("q"), F.min("pct").alias("low"), F.max("pct").alias("high"), F.count("*").alias("n")).select(*by, F.col("q")[0].alias("q1"), F.col("q")[1].alias("med"), F.col("q")[2].alias("q3"), "low", "high", "n")


def _median_length(targets: DataFrame) -> DataFrame:
    return targets.agg(F.percentile(F.length("seq"), 0.5).alias("median_len"))


def length_band(targets: DataFrame, tol: float = 0.1) -> DataFrame:
    """Targets whose length is strictly within the median, more or less tol; adds median_len, in place of a column of that name. Null sequences have no length and are left out."""
    j = targets.drop("median_len").crossJoin(F.broadcast(_median_length(targets)))
    n = F.length("seq")
    return j.where((n > F.col("median_len") * (1 - tol)) & (n < F.col("median_len") * (1 + tol)))


def length_normalised_profile(segments: DataFrame, band: DataFrame) -> DataFrame:
    """(target_id, x_start, x_end, depth): segments' 1-based first and last positions as parts of the median length."""
    j = segments.join(band.select("target_id", F.length("seq").alias("n"), "median_len"), "target_id")
    x = lambda pos: pos / F.col("n") * F.col("median_len")
    return j.select("target_id", x(F.col("start") + 1).alias("x_start"), x(F.col("end")).alias("x_end"), "depth")


def sample_targets(targets: DataFrame, over: int = 1000, n: int = 800, seed: int = 1) -> DataFrame:
    """All targets, or n drawn by id and seed if there are more than `over`."""
    if targets.limit(over + 1).count() <= over:
        return targets
    return targets.orderBy(unit_draw(F.lit(seed), F.col("target_id")), "target_id").limit(n)
