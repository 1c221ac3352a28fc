"""URL filters: host and path rules, then a ratio of character language models.

URLs that a rule decides train two variable-order Markov models, one of accepted
and one of rejected URLs. A character's probability is that of the longest
context, smoothed with the next shorter one's down to the uniform. The verdict
of other URLs is that of the log-likelihood difference per character, against
a threshold. A fifth of the decided URLs, by a hash, trains nothing and calibrates
it: it lies where the two classes' error rates are least in sum.

Counts cover every other decided row of the table and are exact: a context or gram of
up to six bytes is its own key. Up to 2^`bits` keys are broadcast. Beyond, they are
joined to the distinct grams of the distinct URLs, which gives the same scores; only
those of no letter or one before, 66,307 at most, are broadcast, for every gram asks for them.

A null URL, and one without "://", has an empty host and path and no rule; it
scores 0, as one does that has neither after "://". One with a path only is scored
by that. Without decided URLs of both classes in both parts every score or the
threshold is 0; where both are, the method's verdict is allow. Rows are judged each
for itself, repeated or not, whole however long. An empty table gives no rows. Other
columns stay as they are, whatever their names; those named like a result are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._flat import flat, slices
from ._store import free_name, saved

# Host, path and verdict of the rules.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
ORDER, BITS, STRENGTH, CELLS, ASIDE = 5, 21, 3.0, 4096, 5
#: Keys of orders 0 and 1 are below; there are at most 257 * 257 + 257 + 1 of them.
SHORT = 2 << 9 * (ORDER + 1)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: str) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lowered."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path(url: str) -> Column:
    """After the host up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def apply_rules(rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits the columns host and path, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, then in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == rule_host) | F.col("host").endswith("." + rule_host)) & F.col("path").startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(then)).otherwise(verdict)
    return name, verdict


def _grams(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Each character with the five before it, nine bits each, the nearest lowest; 0 is before the URL's start."""
    place = np.arange(len(data)) - np.repeat(offs[:-1], np.diff(offs))
    out = (data.astype(np.int64) + 1) << (9 * ORDER)
    for k in range(1, ORDER + 1):
        before = np.zeros(len(data), np.int64)
        before[k:] = data[:-k].astype(np.int64) + 1
        before[place < k] = 0
        out |= before << (9 * (k - 1))
    return out


def _keys(gram):
    """(context, gram) keys of orders 0 to 5 of whole grams: of an array, or of a column's expression."""
    for k in range(ORDER + 1):
        context, char, top = (1 << 9 * k) - 1, 511 << 9 * ORDER, k << 9 * (ORDER + 1)
        if isinstance(gram, Column):
            yield gram.bitwiseAND(F.lit(context)) + F.lit(top), gram.bitwiseAND(F.lit(context | char)) + F.lit(top)
        else:
            yield (gram & context) + top, (gram & (context | char)) + top


class Counts:
    """Counts of both classes by key, for sharing; class 0 rejected, 1 accepted."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[:, order]

    def of(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[:, at], 0)

    def scores(self, column: pa.Array) -> np.ndarray:
        """Log-likelihood difference per character, positive if accepted URLs are likelier."""
        data, offs = flat(column)
        out = np.zeros(len(offs) - 1)
        for a, b in slices(offs):
            own = offs[a : b + 1] - offs[a]
            grams, which = np.unique(_grams(data[offs[a] : offs[b]], own), return_inverse=True)
            p = np.full((2, len(grams)), 1 / 256)
            for context, gram in _keys(grams):
                p = (self.of(gram) + STRENGTH * p) / (self.of(context) + STRENGTH)
            sums = np.concatenate([[0], np.cumsum((np.log(p[1]) - np.log(p[0]))[which])])
            out[a:b] = (sums[own[1:]] - sums[own[:-1]]) / np.maximum(1, np.diff(own))
        return out


def count_keys(decided: DataFrame) -> DataFrame:
    """(key, n0, n1): exact counts of contexts and grams over the rows (target, label), every one of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            data, offs = flat(batch.column(0))
            for a, b in slices(offs):
                own = offs[a : b + 1] - offs[a]
                grams, label = _grams(data[offs[a] : offs[b]], own), np.repeat(labels[a:b], np.diff(own))
                for y in (0, 1):
                    distinct, n = np.unique(grams[label == y], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(np.where(y == 0, n, 0)), pa.array(np.where(y == 1, n, 0))], ["gram", "n0", "n1"])

    add = [F.sum("n0").alias("n0"), F.sum("n1").alias("n1")]
    grams = decided.select("target", "label").mapInArrow(count, "gram long, n0 long, n1 long").groupBy("gram").agg(*add)
    # a context and its gram of one order differ in the highest letter, which no context has
    return grams.select(F.explode(F.array(*[x for pair in _keys(F.col("gram")) for x in pair])).alias("key"), "n0", "n1").groupBy("key").agg(*add)


def _joined_scores(targets: DataFrame, counts: DataFrame) -> DataFrame:
    """(target, score) of distinct targets, by joins of their grams with the counts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = flat(batch.column(0))
            for a, b in slices(offs):
                own = offs[a : b + 1] - offs[a]
                which = np.repeat(np.arange(a, b), np.diff(own))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which)), pa.array(_grams(data[offs[a] : offs[b]], own))], ["target", "gram"])

    parts = saved(targets.mapInArrow(cut, "target string, gram long").groupBy("target", "gram").agg(F.count("*").alias("n")), "url-grams")
    wanted = [F.struct(F.lit(2 * k + j).alias("i"), x.alias("key")) for k, pair in enumerate(_keys(F.col("gram"))) for j, x in enumerate(pair)]
    rows = parts.select("gram").distinct().select("gram", F.explode(F.array(*wanted)).alias("w")).select("gram", "w.i", "w.key")
    n = [F.max(F.when(F.col("i") == i, F.coalesce(f"n{y}", F.lit(0)))).alias(f"c{y}_{i}") for i in range(2 * ORDER + 2) for y in (0, 1)]
    # every gram asks for the empty context, and many for that of one letter: these few counts go to the grams
    short = F.broadcast(counts.where(F.col("key") < SHORT))
    found = rows.where(F.col("key") < SHORT).join(short, "key", "left").unionByName(rows.where(F.col("key") >= SHORT).join(counts.where(F.col("key") >= SHORT), "key", "left"))
    wide = found.groupBy("gram").agg(*n)
    logs = []
    for y in (0, 1):
        p = F.lit(1 / 256)
        for k in range(ORDER + 1):
            p = (F.col(f"c{y}_{2 * k + 1}") + F.lit(STRENGTH) * p) / (F.col(f"c{y}_{2 * k}") + F.lit(STRENGTH))
        logs.append(F.log(p))
    differences = wide.select("gram", (logs[1] - logs[0]).alias("d"))
    return parts.join(differences, "gram").groupBy("target").agg((F.sum(F.col("d") * F.col("n")) / F.sum("n")).alias("score"))


def scored(urls: DataFrame, decided: DataFrame, *, bits: int = BITS) -> tuple[DataFrame, bool]:
    """The rows of urls with the score of their target, under models of the rows (target, label) of decided, and whether there are models."""
    counts = saved(count_keys(decided), "url-counts")
    total = counts.agg(F.count("*").alias("keys"), F.min_by("n0", "key").alias("n0"), F.min_by("n1", "key").alias("n1")).first()  # the empty context has the least key
    if not (total["n0"] and total["n1"]):
        return urls.withColumn("score", F.lit(0.0)), False
    if total["keys"] > 1 << bits:
        found = saved(_joined_scores(urls.select("target").distinct(), counts), "url-scores")
        return urls.join(found, "target", "left").withColumn("score", F.coalesce("score", F.lit(0.0))), True
    got = counts.toArrow()  # at most 2^bits rows
    shared = urls.sparkSession.sparkContext.broadcast(Counts(got["key"].to_numpy(), np.stack([got["n0"].to_numpy(), got["n1"].to_numpy()])))
    keep = [c for c in urls.columns if c != "target"]
    read = urls.select("target", *keep)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.scores(batch.column(0)))], ["target", *keep, "score"])

    return read.mapInArrow(score, T.StructType([*read.schema.fields, T.StructField("score", T.DoubleType())])), True


def best_threshold(scores: DataFrame) -> float:
    """Where the error rates of the classes of (label, score) are least in sum; 0 if a class is missing."""
    cell = F.least(F.greatest(F.floor((F.col("score") + 4) / 8 * CELLS), F.lit(0)), F.lit(CELLS - 1)).cast("int")
    table = np.zeros((2, CELLS))
    for r in scores.groupBy("label", cell.alias("cell")).count().collect():  # at most 2 * CELLS rows
        table[r["label"], r["cell"]] = r["count"]
    if not table.sum(1).all():
        return 0.0
    share = table / table.sum(1, keepdims=True)
    wrong = np.concatenate([[0], np.cumsum(share[1])]) + 1 - np.concatenate([[0], np.cumsum(share[0])])
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return float((best[0] + best[-1]) / 2 / CELLS * 8 - 4)


def filter_urls(pages: DataFrame, *, rules: tuple[tuple[str, str, str], ...] = RULES, keep: list[str] | None = None, bits: int = BITS) -> DataFrame:
    """Adds host, path, rule, verdict and score to each page row; columns with these names are replaced."""
    made = ["host", "path", "rule", "verdict", "score"]
    keep = [c for c in (pages.columns if keep is None else keep) if c not in made]
    name, verdict = apply_rules(rules)
    # the input's other columns travel in one struct, so none can clash with what is made here
    row = F.struct(F.lit(0).alias(free_name("none", keep)), *[F.col(f"`{c}`") for c in keep]).alias("row")
    judged = pages.select(row, F.col("url").alias("url")).withColumns({"host": host("url"), "path": path("url")})
    empty = (F.col("host") == "") & (F.col("path") == "")
    judged = judged.withColumns({"rule": name, "told": verdict, "target": F.when(empty, F.lit("")).otherwise(F.concat("host", "path", F.lit("\n")))}).drop("url")
    label = (F.col("told") == "allow").cast("int").alias("label")
    aside = F.pmod(F.xxhash64("target"), F.lit(ASIDE)) == 0
    decided = judged.where(F.col("told").isNotNull())
    found, ready = scored(judged, decided.where(~aside).select("target", label), bits=bits)
    threshold = best_threshold(found.where(F.col("told").isNotNull() & aside).select(label, "score")) if ready else 0.0
    method = F.when(F.col("score") >= threshold, F.lit("allow")).otherwise(F.lit("block"))
    return found.select(*[F.col("row").getField(c).alias(c) for c in keep], "host", "path", "rule", F.coalesce("told", method).alias("verdict"), "score")
