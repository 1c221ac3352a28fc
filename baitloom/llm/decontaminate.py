"""Benchmark decontamination by winnowing.

Words are runs of bytes outside 00-2F, 3A-60 and 7B-7F after A-Z are lowered.
A window is 13 consecutive item words, or a whole shorter item. The least
5-gram hash of each window is its fingerprint, so equal windows always share
one. Where a document and an item share a fingerprint, the hit is extended to both
sides as far as words agree, letter for letter; if it is a window long, its words
are hit. Items shorter than a window are looked up whole.

The benchmark's index goes to the executors only while it has at most
`broadcast_words` words. Beyond that, fingerprints of documents and items meet
in a Spark join, and only pairs that share one are compared, each document with a bounded
part of its items at a time.

Null, empty and wordless texts give zero counts, an empty item list and
contaminated = false. Repeated rows are judged each for itself, and a null
doc_id stays null. Items with a null id or without words have no window; rows
that repeat an item_id count as one item with the windows of all its rows. An
empty table of documents gives no rows; without items nothing is hit. Texts are
judged whole; memory follows the longest. Other columns stay as they are, whatever
their names; those named like a result are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._flat import Words, byte_values, flat, slices, sliding_min
from ._store import free_name, saved

WINDOW, GRAM = 13, 5
#: Letters of items that are compared with a document at once, where the index is not broadcast.
TOGETHER = 1 << 22
_IS_WORD = np.ones(256, bool)
_IS_WORD[0x00:0x30] = _IS_WORD[0x3A:0x41] = _IS_WORD[0x5B:0x61] = _IS_WORD[0x7B:0x80] = False
_VALUES = byte_values(_IS_WORD)
RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


class Index:
    """Benchmark items by fingerprint: words, their hashes, and where each fingerprint stands; short items by their whole hash."""

    def __init__(self, ids: list[str], texts: list[str], window: int, gram: int):
        self.window, self.gram, self.ids = window, gram, ids
        data, offs = flat(pa.array(texts, pa.string()))
        words = Words(data, offs, _VALUES)
        self.hashes, self.first, self.words = words.hashes, words.first, _spelled(data, words)(0, len(words.starts))
        self.item = np.repeat(np.arange(len(ids)), np.diff(words.first))
        at = selected(words, window, gram)
        prints = words.grams(gram)[at] if len(at) else np.zeros(0, np.uint64)
        by = np.argsort(prints, kind="stable")
        self.places, self.prints = at[by], prints[by]
        self.bits = max(16, int(len(self.prints) * 16).bit_length())
        self.bitmap = np.zeros(1 << self.bits, bool)
        self.bitmap[self.prints >> np.uint64(64 - self.bits)] = True
        self.short: dict[int, dict[int, list[int]]] = {}
        for i, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
            if 0 < b - a < window:
                self.short.setdefault(b - a, {}).setdefault(int(words.span(a, b)), []).append(i)

    def hits(self, data: np.ndarray, words: Words) -> Iterator[tuple[int, int, str]]:
        """Maximal stretches of windows that an item has: first word, word count, item."""
        spelled = _spelled(data, words)
        at = selected(words, self.window, self.gram)
        if len(at) and len(self.prints):
            prints = words.grams(self.gram)[at]
            near = np.flatnonzero(self.bitmap[prints >> np.uint64(64 - self.bits)])
            low, high = np.searchsorted(self.prints, prints[near]), np.searchsorted(self.prints, prints[near], "right")
            done: dict[tuple[int, int], int] = {}  # by item and distance: up to where a stretch was extended
            for p, x, y in zip(at[near].tolist(), low.tolist(), high.tolist(), strict=True):
                for q in self.places[x:y].tolist():
                    line = (int(self.item[q]), p - q)
                    if p >= done.get(line, 0):
                        a, b = self._extended(words, p, q)
                        done[line] = b
                        yield from self._equal(spelled, a, b, q - p, self.ids[line[0]])
        text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
        for n, table in self.short.items():
            grams = words.grams(n)
            keys = np.array(sorted(table), np.uint64)
            found = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
            for p in np.flatnonzero((keys[found] == grams) & (text[: len(grams)] == text[n - 1 :])).tolist():
                for i in table[int(grams[p])]:
                    if spelled(p, p + n) == self.words[int(self.first[i]) : int(self.first[i]) + n]:
                        yield p, n, self.ids[i]

    def _extended(self, words: Words, p: int, q: int) -> tuple[int, int]:
        """The stretch around document word p on which words agree with those around item word q."""
        t = int(np.searchsorted(words.first, p, "right")) - 1
        i = int(self.item[q])
        left = min(p - int(words.first[t]), q - int(self.first[i]))
        right = min(int(words.first[t + 1]) - p, int(self.first[i + 1]) - q)
        before = np.flatnonzero(words.hashes[p - left : p] != self.hashes[q - left : q])
        after = np.flatnonzero(words.hashes[p : p + right] != self.hashes[q : q + right])
        return p - left + (int(before[-1]) + 1 if len(before) else 0), p + (int(after[0]) if len(after) else right)

    def _equal(self, spelled, a: int, b: int, shift: int, name: str) -> Iterator[tuple[int, int, str]]:
        """Parts of a stretch, a window long at least, whose words are letter for letter the item's."""
        if b - a >= self.window:
            same = [x == y for x, y in zip(spelled(a, b), self.words[a + shift : b + shift], strict=True)]
            start = 0
            for i, good in enumerate([*same, False]):
                if not good:
                    if i - start >= self.window:
                        yield a + start, i - start, name
                    start = i + 1


def _spelled(data: np.ndarray, words: Words):
    """The words a to b - 1 with A-Z lowered."""
    whole = data.tobytes().lower()  # bytes: A-Z alone
    starts, ends = words.starts, words.ends
    return lambda a, b: [whole[x:y] for x, y in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)]


def fingerprints(words: Words, window: int, gram: int) -> np.ndarray:
    """The least k-gram hash of the window from each word on."""
    return sliding_min(words.grams(gram), window - gram + 1)


def selected(words: Words, window: int, gram: int) -> np.ndarray:
    """Words from which a k-gram goes on that is the fingerprint of a window inside its text."""
    least, grams = fingerprints(words, window, gram), words.grams(gram)
    if not len(least):
        return np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    # no hash of a window is over that of a k-gram in it, so the greatest of them equals it or none does
    asked = np.where(text[: len(least)] == text[window - 1 :], ~least, ~np.uint64(0))
    edge = np.full(window - gram, ~np.uint64(0))
    return np.flatnonzero(sliding_min(np.concatenate([edge, asked, edge]), window - gram + 1) == ~grams)


def _judge(texts: pa.Array, index: Index, one_in: int) -> list[tuple]:
    data, offs = flat(texts)
    rows = []
    for a, b in slices(offs):
        part = data[offs[a] : offs[b]]
        words = Words(part, offs[a : b + 1] - offs[a], _VALUES)
        hit = np.zeros(len(words.starts) + 1, np.int64)
        items: dict[int, set[str]] = {}
        for at, n, item in index.hits(part, words):
            hit[at] += 1
            hit[at + n] -= 1
            items.setdefault(int(np.searchsorted(words.first, at, "right")) - 1, set()).add(item)
        covered = np.concatenate([[0], np.cumsum(np.cumsum(hit[:-1]) > 0)])
        n_words = np.diff(words.first)
        n_hit = covered[words.first[1:]] - covered[words.first[:-1]]
        for i in range(b - a):
            names = sorted(items.get(i, ()))
            rows.append((int(n_words[i]), int(n_hit[i]), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(n_hit[i] > 0 and one_in * n_hit[i] >= n_words[i])))
    return rows


def _table(columns: list, rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
    made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([*columns, *made], names)


def _words(text: Column) -> Column:
    return F.coalesce(F.length(text), F.lit(0)) / 2 + 1


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = WINDOW,
    gram: int = GRAM,
    one_in: int = 20,
    keep: list[str] | None = None,
    broadcast_words: int = 2_000_000,
) -> DataFrame:
    """Adds n_words, n_hit, n_items, items_sha256 and contaminated to each document row.

    A document is contaminated if a word is hit and at least one word in
    `one_in` is. `keep` names the columns to return beside these (all, if not
    given). Columns of `docs` that have one of the new names are replaced.
    """
    made = [x.split()[0] for x in RESULT.split(", ")]
    docs = docs.drop(*made)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    items = benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(_words(F.col("text")))).first()[0] or 0
    if size > broadcast_words:
        return _by_join(docs, items, window, gram, one_in, made).select(*keep, *made)
    rows = items.collect()
    index = docs.sparkSession.sparkContext.broadcast(Index([r[0] for r in rows], [r[1] for r in rows], window, gram))
    # the text is sent once, whether it is kept or not
    at = keep.index("text") if "text" in keep else len(keep)
    read = docs.select(*keep) if "text" in keep else docs.select(*keep, "text")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _table(batch.columns[: len(keep)], _judge(batch.column(at), index.value, one_in), [*keep, *made])

    return read.mapInArrow(judge, T.StructType([*read.schema.fields[: len(keep)], *_made_fields()]))


def _made_fields() -> list[T.StructField]:
    kinds = {"long": T.LongType(), "string": T.StringType(), "boolean": T.BooleanType()}
    return [T.StructField(name, kinds[kind]) for name, kind in (x.split() for x in RESULT.split(", "))]


def _prints(window: int, gram: int, lengths: list[int] | None):
    """Rows (id, print) of the texts of (id, text): fingerprints of windows, and of shorter whole texts.

    With lengths, of documents: all runs of so many words instead of shorter whole
    texts, for short items occur in them.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = flat(batch.column(1))
            for a, b in slices(offs):
                words = Words(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], _VALUES)
                least, keys, out = fingerprints(words, window, gram), [], []
                by_n = {n: words.grams(n) for n in (range(1, window) if lengths is None else lengths)}
                for i, (x, y) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
                    found = [least[x : y - window + 1]] if y - x >= window else []
                    if lengths is not None:
                        found += [by_n[n][x : y - n + 1] for n in by_n if y - x >= n]
                    elif 0 < y - x < window:
                        found += [by_n[y - x][x : x + 1]]
                    if found:
                        out.append(np.unique(np.concatenate(found)).view(np.int64))
                        keys.append(np.full(len(out[-1]), a + i))
                if out:
                    ids = batch.column(0).take(pa.array(np.concatenate(keys)))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(out))], ["id", "print"])

    return rows


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offs = flat(batch.column(1))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(Words(data, offs, _VALUES).first), pa.int64())], ["id", "n_words"])


def _stretches(window: int, gram: int):
    """Rows (id, text, items) to (id, starts, ends, classes): merged stretches of words that one of the items hits, and the items that do."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, ends, classes = [], [], []
            for i, items in enumerate(batch.column(2).to_pylist()):
                index = Index([x["class"] for x in items], [x["text"] for x in items], window, gram)
                data, offs = flat(batch.column(1).slice(i, 1))
                part = data[offs[0] : offs[1]]
                words = Words(part, offs - offs[0], _VALUES)
                edges, found = np.zeros(len(words.starts) + 2, np.int64), set()
                for at, n, item in index.hits(part, words):
                    edges[at + 1] += 1
                    edges[at + n + 1] -= 1
                    found.add(item)
                turns = np.diff((np.cumsum(edges) > 0).astype(np.int8))
                starts.append(np.flatnonzero(turns == 1))
                ends.append(np.flatnonzero(turns == -1))
                classes.append(sorted(found))
            kinds = (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()))
            made = [pa.array(x, kind) for x, kind in zip((starts, ends, classes), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["id", "starts", "ends", "classes"])

    return rows


def _by_join(docs: DataFrame, items: DataFrame, window: int, gram: int, one_in: int, made: list[str]) -> DataFrame:
    """The same without a broadcast: fingerprints are joined, then texts that share one.

    Equal documents are compared once, and so are equal items. The items that a document
    may hold come to it in parts of about TOGETHER letters; only merged stretches
    and the names of hit items are put together again.
    """
    digest = F.sha2("text", 256)
    names = items.select(digest.alias("class"), "item_id").distinct()
    items = items.groupBy(digest.alias("id")).agg(F.first("text").alias("text"))
    counts = items.mapInArrow(_word_counts, "id string, n_words long").select(F.col("n_words").alias("n"))
    lengths = sorted(r["n"] for r in counts.where((F.col("n") > 0) & (F.col("n") < window)).distinct().collect())  # fewer numbers than a window has words
    item_prints = items.mapInArrow(_prints(window, gram, None), "id string, print long").withColumnRenamed("id", "class")
    key = free_name("key", docs.columns)
    keyed = docs.withColumn(key, F.sha2(F.coalesce("text", F.lit("")), 256))
    texts = keyed.groupBy(F.col(key).alias("id")).agg(F.first(F.coalesce("text", F.lit(""))).alias("text"))
    doc_prints = texts.mapInArrow(_prints(window, gram, lengths), "id string, print long")
    sizes = items.select(F.col("id").alias("class"), F.length("text").cast("long").alias("size"))
    near = saved(doc_prints.join(item_prints, "print").select("id", "class").distinct().join(sizes, "class"), "near-items")
    parts = near.groupBy("id").agg(F.ceil(F.sum("size") / TOGETHER).alias("parts"))
    part = F.pmod(F.xxhash64("class"), F.col("parts")).alias("part")
    dealt = near.join(parts, "id").select("id", "class", part).join(items.withColumnRenamed("id", "class"), "class")
    asked = dealt.groupBy("id", "part").agg(F.collect_list(F.struct("class", "text")).alias("items")).join(texts, "id").select("id", "text", "items")
    met = saved(asked.mapInArrow(_stretches(window, gram), "id string, starts array<long>, ends array<long>, classes array<string>"), "item-hits")
    spans = met.select("id", F.explode(F.arrays_zip("starts", "ends")).alias("s")).select("id", "s.starts", "s.ends")
    before = Window.partitionBy("id").orderBy("starts", "ends").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("ends") - F.greatest("starts", F.coalesce(F.max("ends").over(before), F.lit(0)))
    n_hit = spans.select("id", F.greatest(fresh, F.lit(0)).alias("n")).groupBy("id").agg(F.sum("n").alias("n_hit"))
    hit = met.select("id", F.explode("classes").alias("class")).join(names, "class").groupBy("id").agg(F.sort_array(F.collect_set("item_id")).alias("names"))
    counted = texts.mapInArrow(_word_counts, "id string, n_words long").join(n_hit, "id", "left").join(hit, "id", "left")
    n = F.coalesce("n_hit", F.lit(0)).cast("long")
    judged = counted.select(
        F.col("id").alias(key), "n_words", n.alias("n_hit"), F.coalesce(F.size("names"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("names", ","), F.lit("")), 256).alias("items_sha256"), ((n > 0) & (n * one_in >= F.col("n_words"))).alias("contaminated"),
    )
    return keyed.join(judged, key)


ORACLE = r"""
WITH iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM iw WHERE len(w) > 0)),
d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dg AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT dg.r, dg.i, dg.n, win.item_id FROM dg JOIN win ON dg.n = win.n AND dg.g = win.g),
hw AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
hi AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)
"""
