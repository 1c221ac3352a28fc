"""Conversation prefix trie, and the tokens that shared prefixes save.

A node is a distinct sequence of first turns (role, text). Its name is a digest of
128 bits: two sums of the turns' SHA-256, each weighed by its depth, so the names of
a conversation's prefixes are running sums over sorted rows, and a conversation that
spans several tasks gets what went before added. Names are verified: all rows of a
name must agree in depth, in the name of the parent and in the whole SHA-256 of the
last turn, or the job stops.

Equal conversations are one of a weight from here on. A node's rows give its members,
its least one, and an upper bound of what lies below it. Where that is more than a
shard should hold, the node belongs to the crown; subtrees below the crown go to
shards as a whole. A shard is flat numpy arrays: a minimal perfect hash gives each
name a slot, checked against the name that the slot keeps; counts are scattered to
slots, and what subtrees sum is added from the deepest nodes up to the slots of
their parents. The crown takes over the shards' sums and adds up by doubling
distances, in as many rounds as its depth has binary digits.

A conversation's turns are in order of `turn`, null first; equal ones in that of their
digest. Null roles and texts are empty. Rows without a conv_id take no part. Repeated
rows are turns of their own. An empty table gives no rows, not even a root. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._flat import mix
from ._store import numbered, saved, sized

#: Nodes below a node of the crown, and about so many in a shard; crown nodes that are broadcast; bytes of a list of conversations that are one row.
SHARD, MOST_BROADCAST, LIST_BYTES = 50_000, 100_000, 1 << 16
BLOCK, HEADS = 100, 6
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
_DEPTH = np.uint64(0xB492B66FBE98F273)


def _power(base: np.uint64, exponent: np.ndarray) -> np.ndarray:
    """Powers modulo 2^64."""
    out, e = np.ones(len(exponent), np.uint64), exponent.astype(np.uint64)
    while e.any():
        out = np.where(e & np.uint64(1) == 1, out * base, out)
        base, e = base * base, e >> np.uint64(1)
    return out


def _terms(digests: pa.Array, depth: np.ndarray) -> list[np.ndarray]:
    lanes = np.frombuffer(b"".join(digests.to_pylist()), np.uint64).reshape(len(digests), 4)
    with np.errstate(over="ignore"):
        return [lanes[:, k] * _power(base, depth) for k, base in enumerate(_BASES)]


def _name(total: np.ndarray, depth: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(total + depth.astype(np.uint64) * _DEPTH).view(np.int64)


ROOT = tuple(int(_name(np.zeros(1, np.uint64), np.zeros(1, np.int64))[0]) for _ in _BASES)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns in order, each with the sums of its conversation's turns so far that this task has seen."""
    part = TaskContext.get().partitionId()
    last, carry = None, [np.uint64(0)] * 2
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, depth = batch.column("conv_id").to_numpy(), batch.column("depth").to_numpy()
        start = np.append(True, ids[1:] != ids[:-1])
        run = np.cumsum(start) - 1
        first = np.flatnonzero(start)
        out = []
        with np.errstate(over="ignore"):
            for k, term in enumerate(_terms(batch.column("turn_digest"), depth)):
                total = np.cumsum(term, dtype=np.uint64)
                before = (total - term)[first]
                if ids[0] == last:
                    before[0] -= carry[k]
                total = total - before[run]
                carry[k] = total[-1]
                out.append(pa.array(total.view(np.int64)))
        last = ids[-1]
        yield pa.RecordBatch.from_arrays([*batch.columns, *out, pa.array(np.full(len(ids), part), pa.int32())], [*batch.schema.names, "s1", "s2", "part"])


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums, and what is to be added to them, to the names of prefixes and of their parents."""
    for batch in batches:
        depth = batch.column("depth").to_numpy()
        names = []
        with np.errstate(over="ignore"):
            for k, term in enumerate(_terms(batch.column("turn_digest"), depth) if batch.num_rows else [np.zeros(0, np.uint64)] * 2):
                total = batch.column(f"s{k + 1}").to_numpy().view(np.uint64) + batch.column(f"c{k + 1}").to_numpy().view(np.uint64)
                names.append((_name(total, depth), _name(total - term, depth - 1)))
        arrays = [batch.column(c) for c in ("conv_id", "depth", "turns", "points", "turn_digest")] + [pa.array(names[k][j]) for j in (0, 1) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "depth", "turns", "points", "turn_digest", "d1", "d2", "p1", "p2"])


def _carried(rows: DataFrame) -> DataFrame:
    """(part, conv_id, c1, c2): what earlier tasks have summed of conversations that go on in a later one. No more rows than tasks."""
    spark = rows.sparkSession
    ends = sorted(rows.groupBy("part").agg(F.min("conv_id"), F.max("conv_id")).collect())  # a row for each task
    wide = sorted({b[1] for a, b in zip(ends, ends[1:], strict=False) if a[2] == b[1]})
    out = []
    if wide:
        own = rows.join(F.broadcast(spark.createDataFrame([(x,) for x in wide], "conv_id long")), "conv_id")
        totals = own.groupBy("conv_id", "part").agg(F.max_by("s1", "depth"), F.max_by("s2", "depth")).collect()
        before, now = None, [0, 0]
        for conv, part, a, b in sorted(totals):
            if conv != before:
                before, now = conv, [0, 0]
            out.append((part, conv, *(x - (1 << 64) if x >= 1 << 63 else x for x in now)))
            now = [(now[0] + a) % (1 << 64), (now[1] + b) % (1 << 64)]
    return spark.createDataFrame(out, "part int, conv_id long, c1 long, c2 long")


def rebuilt_turns(conversations: DataFrame, block: int = BLOCK, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, turns, points, turn_digest) of rebuilt conversations, and (conv_id, turns) of all, those without turns too.

    A conversation begins with the first h turns of that which opens its block of
    ids, in place of its own first h; h is its id's CRC-32 modulo `heads`. Texts are read
    once; what is sorted and joined are digests.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(text("role")).cast("string"), F.lit(":"), text("role"), text("text")), 256))
    read = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("turn_digest"), F.length(text("text")).alias("points"), F.monotonically_increasing_id().alias("tie"))
    placed = numbered(saved(read, "trie-turns"), F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("turn_digest"), F.asc("tie"))
    own = saved(placed.groupBy("conv_id").agg(F.min("place").alias("first"), F.count("*").alias("n")), "trie-own")
    head = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(heads))
    opens = own.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = own.withColumn("h", head).withColumn("base", F.col("conv_id") - F.col("conv_id") % block).join(opens, "base", "left")
    convs = convs.withColumn("b", F.least(F.col("h"), F.coalesce("n_base", F.lit(0)))).withColumn("turns", F.col("b") + F.greatest(F.lit(0), F.col("n") - F.col("h")))
    convs = saved(convs.select("conv_id", "base", "first", "h", "b", "turns"), "trie-conversations")
    columns = ["conv_id", "depth", "turns", "points", "turn_digest"]
    position = F.col("place") - F.col("first") + 1
    kept = placed.join(convs, "conv_id").where(position > F.col("h")).withColumn("depth", position - F.col("h") + F.col("b")).select(*columns)
    early = placed.where(F.col("conv_id") % block == 0).join(own.select("conv_id", "first"), "conv_id").withColumn("depth", position).where(F.col("depth") < heads)
    lent = early.select(F.col("conv_id").alias("base"), "depth", "points", "turn_digest").join(convs.select("conv_id", "base", "b", "turns"), "base").where(F.col("depth") <= F.col("b")).select(*columns)
    return kept.unionByName(lent), convs.select("conv_id", "turns")


def prefixes(turns: DataFrame) -> DataFrame:
    """The turns with the names of their prefixes (d1, d2) and of these without the last turn (p1, p2)."""
    schema = "conv_id long, depth long, turns long, points int, turn_digest binary"
    ordered = saved(turns, "trie-rebuilt").orderBy("conv_id", "depth")
    rows = saved(ordered.mapInArrow(_summed, f"{schema}, s1 long, s2 long, part int"), "trie-sums")
    rows = rows.join(F.broadcast(_carried(rows)), ["part", "conv_id"], "left").fillna(0, ["c1", "c2"])
    return saved(rows.mapInArrow(_named, f"{schema}, d1 long, d2 long, p1 long, p2 long"), "trie-prefixes")


class Slots:
    """A minimal perfect hash: of n different keys each has a slot of its own below n.

    On each level a key claims the bit that its hash points at; a bit that one key alone
    claims is its slot's, the other keys go on to the next level. A slot keeps its key, so a
    stranger is told.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels: list[tuple[np.ndarray, int]] = []
        self.a, self.b = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        left, upto = np.arange(len(a)), 0
        while len(left):
            if len(self.levels) > 64:
                raise ValueError("a name stands twice in a shard")
            size = 2 * len(left)
            at = self._bit(a[left], b[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append((np.append(0, np.cumsum(alone)), upto))
            own = alone[at]
            slots = upto + self.levels[-1][0][at[own]]
            self.a[slots], self.b[slots] = a[left[own]], b[left[own]]
            upto += int(alone.sum())
            left = left[~own]

    @staticmethod
    def _bit(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = mix(a.view(np.uint64) + np.uint64(level) * _BASES[0]) + b.view(np.uint64) * _BASES[1]
        return (mix(h) % np.uint64(size)).astype(np.int64)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slots of keys, -1 of strangers."""
        out, left = np.full(len(a), -1), np.arange(len(a))
        for level, (rank, upto) in enumerate(self.levels):
            at = self._bit(a[left], b[left], level, len(rank) - 1)
            hit = rank[at + 1] > rank[at]
            slot = upto + rank[at[hit]]
            who = left[hit]
            same = (self.a[slot] == a[who]) & (self.b[slot] == b[who])
            out[who[same]] = slot[same]
            left = left[~hit]
        return out


_NODE = "d1 long, d2 long, p1 long, p2 long, depth long, conv_id long, n_convs long"


def _accumulated(table: pa.Table) -> pa.Table:
    """A shard's nodes with what their subtrees sum, and their parents' conv_id, null if the parent is not in the shard."""
    d1, d2, p1, p2, depth, conv, n, points = (table[c].to_numpy() for c in ("d1", "d2", "p1", "p2", "depth", "conv_id", "n_convs", "points"))
    slots = Slots(d1, d2)
    at, parent_of = slots.of(d1, d2), slots.of(p1, p2)
    size = len(at)
    if (at < 0).any():
        raise ValueError("a slot keeps another name")
    scatter = lambda values: _put(np.zeros(size, np.int64), at, values)
    level, parent, saves = scatter(depth), scatter(parent_of), scatter((n - 1) * points.astype(np.int64))
    children = np.bincount(parent[parent >= 0], minlength=size)
    leaves = (children == 0).astype(np.int64)
    by = np.argsort(level, kind="stable")
    for own in reversed(np.split(by, np.flatnonzero(np.diff(level[by])) + 1)):
        own = own[parent[own] >= 0]
        np.add.at(leaves, parent[own], leaves[own])
        np.add.at(saves, parent[own], saves[own])
    convs = scatter(conv)
    above = pa.array(convs[np.maximum(parent_of, 0)], pa.int64(), mask=parent_of < 0)
    made = [pa.array(x[at].astype(np.int64)) for x in (children, leaves, saves)]
    return pa.table([*(table[c] for c in ("d1", "d2", "p1", "p2", "depth", "conv_id", "n_convs")), above, *made], names=["d1", "d2", "p1", "p2", "depth", "conv_id", "n_convs", "parent_conv_id", "n_children", "n_leaves", "saved_tokens"])


def _put(out: np.ndarray, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    out[at] = values
    return out


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (d1, d2, conv_id) in order to (d1, d2, first, ids): runs of decimal ids, joined, of bounded size."""
    names = ["d1", "d2", "first", "ids"]
    held: list[int] = []
    key, size = None, 0

    def packed(rows):
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())], names)

    for batch in batches:
        out = []
        for a, b, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and ((a, b) != key or size > LIST_BYTES):
                out.append((*key, held[0], ",".join(map(str, held))))
                held, size = [], 0
            key = (a, b)
            held.append(conv)
            size += 20
        yield packed(out)
    if held:
        yield packed([(*key, held[0], ",".join(map(str, held)))])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (d1, d2, first, ids) in order to (d1, d2, ends): the digest of all of a name's ids, one list after the other."""
    key, digest, out = None, None, []

    def packed(rows):
        columns = list(zip(*rows, strict=True)) or [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], ["d1", "d2", "ends"])

    for batch in batches:
        out = []
        for a, b, ids in zip(batch.column("d1").to_pylist(), batch.column("d2").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if (a, b) != key:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = (a, b), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield packed(out)
    if key is not None:
        yield packed([(*key, digest.hexdigest())])


def _ends(ends: DataFrame) -> DataFrame:
    """(d1, d2, ends) of (d1, d2, conv_id): the digest of the conversations that end at a node. Lists are made in ranges; a node's own are hashed one after the other."""
    lists = ends.orderBy("d1", "d2", "conv_id").mapInArrow(_lists, "d1 long, d2 long, first long, ids string")
    return lists.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "first").mapInArrow(_hashed, "d1 long, d2 long, ends string")


def _same(column: str) -> Column:
    return F.min(column) == F.max(column)


def _doubled(crown: DataFrame) -> DataFrame:
    """Crown nodes (d1, d2, p1, p2, ..., n_leaves, saved_tokens) with sums over all crown nodes below. In each round a node adds what the nodes `far` below it have, and looks twice as far."""
    columns = crown.columns
    state = crown.withColumn("u1", F.col("p1")).withColumn("u2", F.col("p2"))
    while not (state := saved(state, "trie-crown")).where("u1 IS NOT NULL").isEmpty():
        below = state.where("u1 IS NOT NULL").groupBy(F.col("u1").alias("d1"), F.col("u2").alias("d2")).agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_tokens"))
        further = state.select(F.col("d1").alias("u1"), F.col("d2").alias("u2"), F.col("u1").alias("v1"), F.col("u2").alias("v2"))
        near = state.join(below, ["d1", "d2"], "left").join(further, ["u1", "u2"], "left")
        add = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
        rest = [c for c in columns if c not in ("n_leaves", "saved_tokens")]
        state = near.select(*rest, add("n_leaves", "more_leaves"), add("saved_tokens", "more_tokens"), F.col("v1").alias("u1"), F.col("v2").alias("u2"))
    return state.select(*columns)


def prefix_trie(conversations: DataFrame, shard: int = SHARD, block: int = BLOCK, heads: int = HEADS) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations.

    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (over the subtree, code points that members after the first repeat) and
    ends_sha256 (of the decimal ids of the conversations that end there).
    """
    spark = conversations.sparkSession
    turns, convs = rebuilt_turns(conversations, block, heads)
    rows = prefixes(turns)
    root = convs.agg(F.count("*").alias("n"), F.min("conv_id").alias("least")).first()
    names = [F.lit(x).cast("long").alias(c) for c, x in zip(("d1", "d2"), ROOT, strict=True)]
    ends = rows.where("depth = turns").select("d1", "d2", "conv_id").unionByName(convs.where("turns = 0").select(*names, "conv_id"))
    ends = saved(ends, "trie-ends")
    # equal conversations are one, of the least id
    once = ends.groupBy("d1", "d2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("alike")).drop("d1", "d2")
    own = saved(rows.join(once, "conv_id"), "trie-once")
    firsts = [F.first(c).alias(c) for c in ("p1", "p2", "depth", "points")]
    verified = _same("turn_digest") & _same("p1") & _same("p2") & _same("depth")
    nodes = own.groupBy("d1", "d2").agg(*firsts, F.sum("alike").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum(F.col("turns") - F.col("depth")).alias("below"), verified.alias("verified"))
    points = F.when(F.col("verified"), F.col("points")).otherwise(F.raise_error(F.lit("two prefixes have one name")).cast("int"))
    nodes = saved(nodes.withColumn("points", points).drop("verified"), "trie-nodes")

    heavy = saved(nodes.where(F.col("below") > shard), "trie-heavy")
    n_heavy, n_light = heavy.count(), nodes.count()
    cut = own.select("conv_id", F.lit(0).cast("long").alias("cut")).limit(0)
    if n_heavy:
        cut = own.join(sized(heavy.select("d1", "d2"), n_heavy, MOST_BROADCAST), ["d1", "d2"], "left_semi").groupBy("conv_id").agg(F.max("depth").alias("cut"))
    tops = own.join(cut, "conv_id", "left").where(F.col("depth") == F.coalesce("cut", F.lit(0)) + 1).select("conv_id", F.xxhash64("d1", "d2").alias("top"))
    light = nodes.where(F.col("below") <= shard).join(tops, "conv_id").withColumn("shard", F.pmod("top", F.lit(max(1, -(-n_light // shard)))))
    summed = saved(light.groupBy("shard").applyInArrow(_accumulated, f"{_NODE}, parent_conv_id long, n_children long, n_leaves long, saved_tokens long"), "trie-shards")

    # the crown: heavy nodes and the root; the root has no parent
    none = [F.lit(None).cast("long").alias(c) for c in ("p1", "p2")]
    crown = heavy.select("d1", "d2", "p1", "p2", "depth", "conv_id", "n_convs", "points")
    top = convs.limit(1).select(*names, *none, F.lit(0).cast("long").alias("depth"), F.lit(root["least"]).cast("long").alias("conv_id"), F.lit(root["n"]).cast("long").alias("n_convs"), F.lit(0).alias("points"))
    crown = saved(crown.unionByName(top), "trie-crown")
    up = [F.col("p1").alias("d1"), F.col("p2").alias("d2")]
    inside = heavy.groupBy(*up).agg(F.count("*").alias("inner"))
    outside = summed.where("parent_conv_id IS NULL").groupBy(*up).agg(F.count("*").alias("outer"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("tokens"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    sums = crown.join(inside, ["d1", "d2"], "left").join(outside, ["d1", "d2"], "left").withColumn("n_children", zero("inner") + zero("outer"))
    sums = sums.select("d1", "d2", "p1", "p2", "depth", "conv_id", "n_convs", "n_children", F.when(F.col("n_children") == 0, 1).otherwise(zero("leaves")).alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("points") + zero("tokens")).alias("saved_tokens"))
    sums = _doubled(sums).withColumn("parent_conv_id", F.lit(None).cast("long"))
    parents = sized(crown.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("crown_conv")), n_heavy, MOST_BROADCAST)
    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    whole = summed.unionByName(sums).join(parents, ["p1", "p2"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "crown_conv"))
    nothing = hashlib.sha256(b"").hexdigest()
    return whole.join(_ends(ends), ["d1", "d2"], "left").select(*result, F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"))


_CRC32 = "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda s, b: xor(xor(s, b) >> 1, 3988292384 * (xor(s, b) & 1))), 4294967295)"
ORACLE = f"""
WITH t AS MATERIALIZED (
  SELECT conv_id, x, n, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, x) AS p
  FROM (SELECT conv_id, turn, sha256(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS x, length(coalesce(text, '')) AS n FROM conversations WHERE conv_id IS NOT NULL)),
o AS MATERIALIZED (SELECT conv_id, count(*) AS n, {_CRC32} % 6 AS h FROM t GROUP BY conv_id),
c AS MATERIALIZED (SELECT o.*, least(o.h, coalesce(b.n, 0)) AS b FROM o LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 100),
r AS MATERIALIZED (
  SELECT conv_id, p - h + b AS depth, x, t.n, b + n_ - h AS turns FROM t JOIN (SELECT conv_id, h, b, n AS n_ FROM c) USING (conv_id) WHERE p > h
  UNION ALL SELECT c.conv_id, p, x, t.n, b + greatest(0, c.n - h) FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND p <= b),
w AS MATERIALIZED (SELECT *, string_agg(x, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM r),
m AS (SELECT conv_id, depth, path, n, depth = turns AS ends FROM w UNION ALL SELECT conv_id, 0, '', 0, b + greatest(0, n - h) = 0 FROM c),
nodes AS MATERIALIZED (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS own, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM m GROUP BY path, depth),
k AS MATERIALIZED (SELECT left(path, -64) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
below AS (
  SELECT a.path, sum(b.own) AS saved_tokens, count(*) FILTER (WHERE k.path IS NULL) AS n_leaves
  FROM nodes b JOIN nodes a ON a.path = left(b.path, a.depth * 64) AND a.depth <= b.depth LEFT JOIN k ON k.path = b.path GROUP BY a.path)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, below.n_leaves, CAST(below.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below ON below.path = n.path LEFT JOIN k ON k.path = n.path LEFT JOIN nodes u ON n.depth > 0 AND u.path = left(n.path, -64)
"""
