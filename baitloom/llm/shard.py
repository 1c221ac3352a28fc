"""Sharding by a k-d tree over row metadata.

A node that must hold several shards is split along the dimension in which its
rows spread widest, at the weighted median that gives each side its part of the
bytes. The dimensions are log size, language, source and doc_id. Ties in the
split dimension are ordered by a hash of the row, so a hot source or language is
cut like any other range.

Law: bytes. Equal texts go to one shard together. Groups of copies that hold over
`together` of a shard's bytes are placed first, the largest in the emptiest shard,
and the tree deals the rest into the room that they leave. Only a group that no
shard has room for is cut, like single rows.

Medians are found with histograms that Spark counts: each pass narrows every
node's interval, until few enough units are left in it to be sorted. Slots come
from counts by (shard, bucket), so no shard passes through one task.

Null texts have size 1 and crc 0; null metadata count as empty or 0; repeated
rows get slots of their own. Texts count whole, however long. An empty table gives
no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._store import saved

SHARDS, TOGETHER, CELLS, FEW = 8, 0.04, 2048, 4000
DIMENSIONS = ("d0", "d1", "d2", "d3")


def _place_of(text: str) -> Column:
    """A string as a number that sorts alike, by its first six bytes."""
    padded = F.rpad(F.hex(F.substring(F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8"), 1, 6)), 12, "0")
    return F.conv(padded, 16, 10).cast("double")


@dataclass
class Node:
    path: str
    first: int
    rooms: list[float]  # bytes that its shards are to get
    bytes: int = 0
    dimension: str = ""
    low: float = 0.0
    high: float = 0.0
    before: int = 0
    cut: tuple[float, int] | None = None  # units below (value, tie) go left

    def sides(self) -> list[Node]:
        half = len(self.rooms) // 2
        return [Node(self.path + "0", self.first, self.rooms[:half]), Node(self.path + "1", self.first + half, self.rooms[half:])]

    def target(self) -> float:
        """Bytes that go left."""
        whole = sum(self.rooms)
        half = len(self.rooms) // 2
        return self.bytes * (sum(self.rooms[:half]) / whole if whole else half / len(self.rooms))


def _placed_first(groups: list, shards: int, whole: int) -> tuple[list[int | None], list[float]]:
    """Shards of groups of copies, largest first, null for those that no shard has room for; and the rooms that are left."""
    rooms = [whole / shards] * shards
    out: list[int | None] = []
    for g in groups:
        at = max(range(shards), key=lambda s: (rooms[s], -s))
        out.append(at if g["bytes"] <= rooms[at] else None)
        if out[-1] is not None:
            rooms[at] -= g["bytes"]
    return out, rooms


def _units(rows: DataFrame, limit: float, shards: int, whole: int) -> tuple[DataFrame, DataFrame, list[float]]:
    """Rows with a unit id and, of copies placed first, their shard; units (unit, bytes, tie, dimensions) of the others; and the room left in each shard."""
    text = ["h", "text_crc32", "size"]
    size = rows.groupBy(*text).agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    # at most shards / together groups can be over the limit
    large = sorted(size.where((F.col("bytes") > limit) & (F.col("n") > 1)).collect(), key=lambda g: (-g["bytes"], g["h"], g["text_crc32"]))
    fixed, rooms = _placed_first(large, shards, whole)
    hot = rows.sparkSession.createDataFrame([(g["h"], g["text_crc32"], g["size"], s) for g, s in zip(large, fixed, strict=True)], "h long, text_crc32 long, size long, fixed int").withColumn("hot", F.lit(True))
    rows = rows.join(F.broadcast(hot), text, "left")
    own = F.when(F.col("hot"), F.xxhash64("row", F.lit(1))).otherwise(F.xxhash64(*text))
    rows = rows.withColumn("unit", own).drop("hot")
    units = rows.where("fixed IS NULL").groupBy("unit").agg(F.sum("size").alias("bytes"), F.min(F.struct("doc_id", "row", *DIMENSIONS)).alias("m"))
    return rows, units.select("unit", "bytes", *[F.col(f"m.{d}").alias(d) for d in DIMENSIONS]), rooms


def _inside(node: Node, below: dict[str, Node]) -> Column:
    """Whether a unit is in this node: the cuts of its ancestors."""
    out = F.lit(True)
    for i, side in enumerate(node.path):
        over = below[node.path[:i]]
        left = _left(over)
        out = out & (left if side == "0" else ~left)
    return out


def _left(node: Node) -> Column:
    value, tie = node.cut
    return (F.col(node.dimension) < value) | ((F.col(node.dimension) == value) & (F.col("unit") < tie))


def _which(nodes: list[Node], below: dict[str, Node]) -> Column:
    out = F.lit(None).cast("string")
    for node in nodes:
        out = F.when(_inside(node, below), F.lit(node.path)).otherwise(out)
    return out


def _split(units: DataFrame, nodes: list[Node], below: dict[str, Node], spread: dict[str, float]) -> None:
    """Sets the cut of each node. One pass narrows all of them."""
    placed = units.withColumn("node", _which(nodes, below)).where("node IS NOT NULL")
    ranges = {r["node"]: r for r in placed.groupBy("node").agg(F.sum("bytes").alias("bytes"), *[x for d in DIMENSIONS for x in (F.min(d).alias(f"low_{d}"), F.max(d).alias(f"high_{d}"))]).collect()}
    open_nodes = []
    for node in nodes:
        r = ranges.get(node.path)
        if r is None:
            node.dimension, node.cut = DIMENSIONS[0], (0.0, 0)
            continue
        node.bytes = r["bytes"]
        node.dimension = max(DIMENSIONS, key=lambda d: ((r[f"high_{d}"] - r[f"low_{d}"]) / (spread[d] or 1), -DIMENSIONS.index(d)))
        node.low, node.high = r[f"low_{node.dimension}"], r[f"high_{node.dimension}"]
        open_nodes.append(node)
    ties = {n.path: (-(1 << 63), (1 << 63) - 1) for n in open_nodes}
    while open_nodes:
        cell, value = F.lit(None).cast("int"), F.lit(None).cast("double")
        for n in open_nodes:
            own = (F.col("node") == n.path) & F.col(n.dimension).between(n.low, n.high)
            if n.high > n.low:
                at = F.floor((F.col(n.dimension) - n.low) / (n.high - n.low) * CELLS)
            else:  # one value: the ties are told apart by the unit's hash
                low, high = ties[n.path]
                own = own & F.col("unit").between(low, high)
                at = F.floor((F.col("unit").cast("double") - float(low)) / (float(high) - float(low) + 1) * CELLS)
            cell = F.when(own, F.least(F.greatest(at, F.lit(0)), F.lit(CELLS - 1)).cast("int")).otherwise(cell)
            value = F.when(own, F.col(n.dimension)).otherwise(value)
        counted = placed.withColumns({"cell": cell, "value": value}).where("cell IS NOT NULL").groupBy("node", "cell")
        counts: dict[str, list] = {}
        for r in counted.agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.min("unit").alias("low_tie"), F.max("unit").alias("high_tie")).collect():
            counts.setdefault(r["node"], []).append(r)
        few = []
        for n in list(open_nodes):
            target = n.target()
            chosen = None
            for r in sorted(counts[n.path], key=lambda r: r["cell"]):
                chosen = r
                if n.before + r["bytes"] >= target:
                    break
                n.before += r["bytes"]
            if n.high > n.low:
                n.low, n.high = chosen["low"], chosen["high"]
            else:
                ties[n.path] = (chosen["low_tie"], chosen["high_tie"])
            if chosen["n"] <= FEW:
                open_nodes.remove(n)
                few.append((n, chosen))
        if few:
            near = F.lit(False)
            for n, r in few:
                near = near | ((F.col("node") == n.path) & F.col(n.dimension).between(r["low"], r["high"]) & ((F.lit(r["low"] != r["high"])) | F.col("unit").between(r["low_tie"], r["high_tie"])))
            left = placed.where(near).select("node", "unit", "bytes", *DIMENSIONS).collect()  # at most FEW for each node
            for n, _ in few:
                target, sum_ = n.target(), n.before
                own = sorted((r[n.dimension], r["unit"], r["bytes"]) for r in left if r["node"] == n.path)
                n.cut = (own[-1][0], own[-1][1] + 1 if own[-1][1] < (1 << 63) - 1 else own[-1][1])
                for v, u, size in own:
                    if sum_ + size / 2 > target:
                        n.cut = (v, u)
                        break
                    sum_ += size


def shard(docs: DataFrame, *, shards: int = SHARDS, together: float = TOGETHER, slots_in_task: int = 200_000) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    size = F.octet_length(text).cast("long") + 1
    have = set(docs.columns)
    meta = docs.select(
        "doc_id", size.alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("row"),
        F.log2(size.cast("double")).alias("d0"),
        (_place_of("lang") if "lang" in have else F.lit(0.0)).alias("d1"),
        (_place_of("source") if "source" in have else F.lit(0.0)).alias("d2"),
        F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0)).alias("d3"),
    )
    meta = saved(meta, "shard-rows")
    whole = meta.agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), *[(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]).first()
    rows, units, rooms = _units(meta, (whole["bytes"] or 0) * together / shards, shards, whole["bytes"] or 0)
    units = saved(units, "shard-units")
    below: dict[str, Node] = {}
    level = [Node("", 0, rooms)]
    leaves: list[Node] = []
    while level:
        inner = [n for n in level if len(n.rooms) > 1]
        leaves += [n for n in level if len(n.rooms) == 1]
        if inner:
            below |= {n.path: n for n in inner}
            _split(units, inner, below, {d: whole[d] or 0.0 for d in DIMENSIONS})
        level = [side for n in inner for side in n.sides()]
    which = F.lit(0)
    for n in leaves:
        which = F.when(_inside(n, below), F.lit(n.first)).otherwise(which)
    placed = rows.select("doc_id", "size", "text_crc32", "row", "unit", "fixed").join(units.select("unit", which.cast("int").alias("which")), "unit", "left")
    placed = placed.withColumn("shard", F.coalesce("fixed", "which")).drop("fixed", "which")
    buckets = max(1, -(-(whole["n"] or 0) // (shards * slots_in_task)) * 8)
    placed = saved(placed.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int")), "shard-placed")
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    starts, out = {}, []
    for r in sorted(counts.collect()):  # shards * buckets rows, of slots_in_task / 8 each
        out.append((r["shard"], r["bucket"], starts.get(r["shard"], 0)))
        starts[r["shard"]] = out[-1][2] + r["n"]
    offsets = docs.sparkSession.createDataFrame(out, "shard int, bucket int, start long")
    slot = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "row")) - 1
    return placed.withColumn("own", slot.cast("long")).join(F.broadcast(offsets), ["shard", "bucket"]).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("own") + F.col("start")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
