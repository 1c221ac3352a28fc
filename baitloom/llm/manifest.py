"""Merkle dataset manifest: one digest for a dataset, and a proof for each row.

Rows are leaves; the leaves of each group, in order, are the bottom of a hash
tree of their own, and the groups' tops, in order, that of one more. H is the
lowercase hex SHA-256 of its inputs, concatenated; a node is H of its children.

Every node carries the interval [low, high) of the leaf ranks that it covers.
Levels are taken in bands: a node and its ancestors within a band share a bucket,
the interval of the band's top, so a node meets its ancestors in a join by bucket,
and the one of each level that contains it is its ancestor there. What a parent's
interval has besides the node's own are the node's siblings. A bucket holds
fan ** band nodes of its lowest level at most, however large a group is, and the
number of rounds is the number of bands: 3 for a billion leaves.

Of a row, each column counts as `-` if it is null, or else as the number of its
UTF-8 bytes, a colon and its text. Null group values are one group, the first;
groups go by the bytes of their text. Leaves ascend by the ordering column, null
first; those that agree in it by their digest, so rows that are wholly equal may
change places with each other and nothing else. An empty table has no rows and no
root (None). Texts count whole. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import numbered, saved

FAN, BAND = 2, 10
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree of the groups' tops.
TOP = -1
_PATH = "array<struct<left:string,right:string>>"
_NODES = "tree long, n long, level int, low long, high long, digest string"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(values: Sequence[Column]) -> Column:
    """H of values; each is prefixed by its length, so that no two rows look alike."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


@dataclass
class Manifest:
    """leaves: (tree, low, group, leaf, and the columns that were kept); nodes: (tree, n, level, low, high, digest) above the leaves; tops: (tree, n, group, subroot, rank); root."""

    leaves: DataFrame
    nodes: DataFrame
    tops: DataFrame
    root: str | None
    fan: int
    band: int


def _grown(level: int, band: int, fan: int):
    """A bucket's nodes of one level to all above them within the band, or up to the tree's root."""

    def run(table: pa.Table) -> pa.Table:
        low = table["low"].to_numpy()
        by = np.argsort(low)
        digests = table["digest"].take(pa.array(by)).to_pylist()
        tree, n, start = table["tree"][0].as_py(), table["n"][0].as_py(), int(low.min())
        out: list[list] = [[], [], [], []]
        for up in range(level + 1, level + band + 1):
            if n <= fan ** (up - 1):  # one node is left of this tree
                break
            digests = [h(*digests[i : i + fan]) for i in range(0, len(digests), fan)]
            lows = [start + i * fan**up for i in range(len(digests))]
            for column, made in zip(out, ([up] * len(lows), lows, [min(x + fan**up, n) for x in lows], digests), strict=True):
                column += made
        size = len(out[0])
        arrays = [pa.array([tree] * size, pa.int64()), pa.array([n] * size, pa.int64()), pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())]
        return pa.table(arrays, names=["tree", "n", "level", "low", "high", "digest"])

    return run


def _bucket(width: int) -> Column:
    return F.expr(f"low div {width}L").alias("bucket")


def grow(leaves: DataFrame, most: int, fan: int = FAN, band: int = BAND) -> DataFrame:
    """All nodes above leaves (tree, n, low, digest); `most` is the largest n. A band is a shuffle of its lowest level."""
    empty = leaves.sparkSession.createDataFrame([], _NODES)
    level, bottom, nodes = 0, leaves.select("tree", "n", "low", "digest"), empty
    while fan**level < most:
        open_ = bottom.where(F.col("n") > fan**level).withColumn("bucket", _bucket(fan ** (level + band)))
        made = saved(open_.groupBy("tree", "bucket").applyInArrow(_grown(level, band, fan), _NODES), "manifest-nodes")
        nodes = nodes.unionByName(made)
        level += band
        bottom = made.where(F.col("level") == level).select("tree", "n", "low", "digest")
    return nodes


def build(rows: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "lang", order: str = "doc_id", keep: dict[str, Column] | None = None, fan: int = FAN, band: int = BAND) -> Manifest:
    """The manifest of a table. `keep`: further columns for the leaves, by name. Each row is read once; only digests are sorted."""
    named = {c: F.col(f"`{c}`") for c in columns}
    own = rows.select(named[group].cast("string").alias("group"), named[order].alias("order"), leaf_digest(list(named.values())).alias("leaf"), *[c.alias(k) for k, c in (keep or {}).items()])
    told = saved(own.withColumn("tie", F.monotonically_increasing_id()), "manifest-rows")
    placed = numbered(told, F.asc_nulls_first("group"), F.asc_nulls_first("order"), "leaf", "tie")
    trees = saved(placed.groupBy("group").agg(F.min("place").alias("tree"), F.count("*").alias("n")).withColumnRenamed("group", "g"), "manifest-trees")
    leaves = placed.join(trees, F.col("group").eqNullSafe(F.col("g"))).withColumn("low", F.col("place") - F.col("tree")).drop("g", "tie", "place")
    leaves = saved(leaves, "manifest-leaves")
    most = trees.agg(F.max("n")).first()[0] or 0
    nodes = grow(leaves.withColumnRenamed("leaf", "digest"), most, fan, band)
    # a tree's root covers all of its leaves; of a lone leaf it is the leaf itself
    alone = leaves.where("n = 1").select("tree", F.col("leaf").alias("digest"))
    roots = nodes.where("low = 0 AND high = n").groupBy("tree").agg(F.min_by("digest", "level").alias("digest")).unionByName(alone)
    tops = numbered(trees.join(roots, "tree").select("tree", "n", F.col("g").alias("group"), F.col("digest").alias("subroot")), F.asc("tree"), name="rank")
    tops = saved(tops, "manifest-tops")
    above = tops.agg(F.count("*").alias("n"), F.max_by("subroot", "rank").alias("one")).first()
    upper = grow(_as_leaves(tops, above["n"]), above["n"], fan, band)
    found = upper.where("low = 0 AND high = n").orderBy("level").select("digest").first()
    return Manifest(leaves, nodes.unionByName(upper), tops, found["digest"] if found else above["one"], fan, band)


def _as_leaves(tops: DataFrame, n: int) -> DataFrame:
    return tops.select(F.lit(TOP).cast("long").alias("tree"), F.lit(n).cast("long").alias("n"), F.col("rank").alias("low"), F.col("subroot").alias("digest"), F.col("tree").alias("of"))


def _attached(level: int, keep: list[str], claim: str | None):
    """Entries of one level and a bucket's nodes above them, with what lies above the bucket, to the entries' paths; with a claim, to what paths prove."""

    def run(entries: pa.Table, nodes: pa.Table) -> pa.Table:
        by = np.argsort(entries["low"].to_numpy(), kind="stable")
        entries = entries.take(pa.array(by))
        own = entries.select(keep)
        kinds, above = nodes["level"].to_numpy(), nodes["above"]
        outside = [(x["left"], x["right"]) for x in above[int(np.flatnonzero(kinds < 0)[0])].as_py()]
        lows, highs, digests = entries["low"].to_numpy(), entries["high"].to_numpy(), entries["digest"].to_pylist()
        first = np.arange(len(lows))
        siblings, parents = [], []
        for up in sorted(set(kinds[kinds >= 0].tolist())):
            at = np.flatnonzero(kinds == up)
            at = at[np.argsort(nodes["low"].to_numpy()[at])]
            low, high = nodes["low"].to_numpy()[at], nodes["high"].to_numpy()[at]
            parent = np.searchsorted(low, lows, "right") - 1
            if not ((low[parent] <= lows) & (highs <= high[parent])).all():
                raise ValueError("a node lies in no interval of the level above")
            # within the parent, before and after the node's own interval
            begin, end = np.searchsorted(lows, low[parent]), np.searchsorted(lows, high[parent])
            siblings.append([("".join(digests[b:i]), "".join(digests[i + 1 : e])) for i, (b, e) in enumerate(zip(begin.tolist(), end.tolist(), strict=True))])
            parents.append(parent.tolist())
            lows, highs, digests = low, high, nodes["digest"].take(pa.array(at)).to_pylist()
        paths = [outside] * len(lows)
        for beside, parent in zip(reversed(siblings), reversed(parents), strict=True):
            paths = [[s, *paths[p]] for s, p in zip(beside, parent, strict=True)]
        paths = [paths[i] for i in first]
        if claim is None:
            return own.append_column("path", pa.array([[{"left": a, "right": b} for a, b in p] for p in paths], pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))))
        folded = []
        for digest, path in zip(entries[claim].to_pylist(), paths, strict=True):
            for left, right in path:
                digest = h(left, digest, right)
            folded.append(digest)
        proofs = [h(*[x for pair in p for x in pair]) for p in paths]
        return own.append_column("proof_sha256", pa.array(proofs, pa.string())).append_column("folded_root", pa.array(folded, pa.string()))

    return run


def _joined(entries: DataFrame, nodes: DataFrame, above: DataFrame, level: int, fan: int, band: int, keep: list[str], claim: str | None) -> DataFrame:
    """Entries (tree, low, high, digest) of one level with their ancestors in the band, joined by bucket."""
    bucket = _bucket(fan ** (level + band))
    inside = nodes.where((F.col("level") > level) & (F.col("level") <= level + band)).select("tree", bucket, "level", "low", "high", "digest", F.lit(None).cast(_PATH).alias("above"))
    nothing = [F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("high"), F.lit("").alias("digest")]
    outside = above.select("tree", "bucket", F.lit(-1).alias("level"), *nothing, "above")
    kinds = {f.name: f.dataType.simpleString() for f in entries.schema.fields}
    result = f"path {_PATH}" if claim is None else "proof_sha256 string, folded_root string"
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [result])
    return entries.withColumn("bucket", bucket).groupBy("tree", "bucket").cogroup(inside.unionByName(outside).groupBy("tree", "bucket")).applyInArrow(_attached(level, keep, claim), schema)


def paths(leaves: DataFrame, nodes: DataFrame, above: DataFrame, most: int, fan: int, band: int, keep: list[str], claim: str | None = None) -> DataFrame:
    """Leaves (tree, low, digest and what is to be kept) with all siblings up to the root, from the leaf on; from the top band down.

    above: (tree, n, above), what lies over each tree's own root. With a claim, a
    column of digests, (proof_sha256, folded_root) stand in place of the path.
    """
    level = 0
    while fan ** (level + band) < most:
        level += band
    done = None
    while level:
        entries = nodes.where((F.col("level") == level) & (F.col("n") > fan**level)).select("tree", "low", "high", "digest")
        done = saved(_joined(entries, nodes, _over(above, done, level, fan, band), level, fan, band, ["tree", "low"], None), "manifest-paths")
        level -= band
    return _joined(leaves.withColumn("high", F.col("low") + 1), nodes, _over(above, done, 0, fan, band), 0, fan, band, keep, claim)


def _over(above: DataFrame, done: DataFrame | None, level: int, fan: int, band: int) -> DataFrame:
    """(tree, bucket, above) of each bucket of a band: the path of its top, which the band above has given, or what lies over the tree."""
    ends = above.where((F.col("n") <= fan ** (level + band)) & (F.lit(level == 0) | (F.col("n") > fan**level))).select("tree", F.lit(0).cast("long").alias("bucket"), "above")
    return ends if done is None else ends.unionByName(done.select("tree", _bucket(fan ** (level + band)), F.col("path").alias("above")))


def prove(manifest: Manifest, keep: Sequence[str] = (), claim: Column | None = None) -> DataFrame:
    """The leaves' columns `keep` with `path`, the siblings (left, right) from the leaf up to the root.

    With a claim, an expression for the digest that someone says a leaf has, they come with
    proof_sha256, H of the siblings from left to right and level by level, and
    folded_root, what claim and siblings lead to: the root, if the claim is true.
    """
    m = manifest
    n, most = (m.tops.agg(f).first()[0] or 0 for f in (F.count("*"), F.max("n")))
    nothing = m.tops.sparkSession.createDataFrame([(TOP, n, [])], f"tree long, n long, above {_PATH}")
    tops = paths(_as_leaves(m.tops, n), m.nodes.where(F.col("tree") == TOP), nothing, n, m.fan, m.band, ["of"])
    over = saved(tops.join(m.tops.select(F.col("tree").alias("of"), "n"), "of").select(F.col("of").alias("tree"), "n", F.col("path").alias("above")), "manifest-over")
    leaves = m.leaves.withColumn("digest", F.col("leaf"))
    leaves = leaves if claim is None else leaves.withColumn("claim", claim)
    return paths(leaves, m.nodes.where(F.col("tree") != TOP), over, most, m.fan, m.band, list(keep), None if claim is None else "claim")


def verify(docs: DataFrame) -> DataFrame:
    """The rows of documents as a manifest, each with its proof, and whether a tampered copy still proves.

    Where 7 divides the CRC-32 of the decimal doc_id, the copy has n_chars + 1. A null
    doc_id has no such number and is not tampered with; nor is a null n_chars.
    """
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    changed = leaf_digest([F.col(c).cast("decimal(38,0)") + 1 if c == "n_chars" else F.col(c) for c in COLUMNS])
    m = build(docs.select(*COLUMNS), keep={"doc_id": F.col("doc_id"), "changed": F.when(tampered & F.col("n_chars").isNotNull(), changed)})
    proven = prove(m, ["doc_id", "leaf", "tree"], F.coalesce("changed", "leaf"))
    subroots = m.tops.select("tree", "subroot")
    return proven.join(subroots, "tree").select("doc_id", "leaf", "subroot", F.lit(m.root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == F.lit(m.root)).alias("verified"))


_CRC32 = "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda s, b: xor(xor(s, b) >> 1, 3988292384 * (xor(s, b) & 1))), 4294967295)"


def _sql_leaf(n_chars: str) -> str:
    field = lambda v: f"coalesce(octet_length(encode({v}))::VARCHAR || ':' || {v}, '-')"
    return "sha256(" + " || ".join(field(v) for v in ("doc_id::VARCHAR", "source", "lang", f"{n_chars}::VARCHAR", "text")) + ")"


ORACLE = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, lang, {_sql_leaf('n_chars')} AS leaf, CASE WHEN {_CRC32} % 7 = 0 THEN {_sql_leaf('(n_chars + 1)')} ELSE {_sql_leaf('n_chars')} END AS claim FROM documents),
l AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM d),
t AS (
  SELECT lang, 0 AS level, i, leaf AS x, n FROM l
  UNION ALL SELECT lang, level + 1, i // 2, sha256(string_agg(x, '' ORDER BY i)), (n + 1) // 2 FROM t WHERE n > 1 GROUP BY lang, level, i // 2, n),
s AS MATERIALIZED (SELECT lang, level AS height, x AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (
  SELECT 0 AS level, i, subroot AS x, n FROM s
  UNION ALL SELECT level + 1, i // 2, sha256(string_agg(x, '' ORDER BY i)), (n + 1) // 2 FROM u WHERE n > 1 GROUP BY level, i // 2, n),
p AS MATERIALIZED (
  SELECT l.r, t.level AS k, t.i & 1 AS right_, t.x FROM l JOIN s ON l.lang IS NOT DISTINCT FROM s.lang JOIN t ON t.lang IS NOT DISTINCT FROM l.lang AND t.level < s.height AND t.i = xor(l.i >> t.level, 1)
  UNION ALL SELECT l.r, s.height + u.level, u.i & 1, u.x FROM l JOIN s ON l.lang IS NOT DISTINCT FROM s.lang JOIN u ON u.n > 1 AND u.i = xor(s.i >> u.level, 1)),
-- a node without sibling is hashed alone, so every level counts
a AS MATERIALIZED (SELECT l.r, s.height + (SELECT max(level) FROM u) AS top FROM l JOIN s ON l.lang IS NOT DISTINCT FROM s.lang),
f AS (
  SELECT d.r, 0 AS k, claim AS x FROM d
  UNION ALL SELECT f.r, f.k + 1, sha256(CASE WHEN p.x IS NULL THEN f.x WHEN p.right_ = 1 THEN f.x || p.x ELSE p.x || f.x END) FROM f JOIN a ON a.r = f.r AND f.k < a.top LEFT JOIN p ON p.r = f.r AND p.k = f.k)
SELECT l.doc_id, l.leaf, s.subroot, z.x AS root, sha256(coalesce(q.proof, '')) AS proof_sha256, f.x AS folded_root, f.x = z.x AS verified
FROM l JOIN s ON l.lang IS NOT DISTINCT FROM s.lang JOIN a ON a.r = l.r JOIN f ON f.r = l.r AND f.k = a.top CROSS JOIN (SELECT x FROM u WHERE n = 1) z
LEFT JOIN (SELECT r, string_agg(x, '' ORDER BY k) AS proof FROM p GROUP BY r) q ON q.r = l.r
"""
