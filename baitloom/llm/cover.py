"""Embedding near-dedup: exact threshold pairs by dual traversal of cover trees.

Vectors are compared within their label only, by cosine in double precision. On
the unit sphere a cosine of at least t is a distance of at most sqrt(2 - 2t), so the
search is one for pairs within a radius.

The tree's upper levels are made by Spark: while a cell of a label holds more than
`block` vectors, some of its own become centres, chosen so that they are further
apart than the level's radius, and each vector goes to the nearest; radii halve from
level to level. Cells that no level parts (their vectors lie almost at one place)
are dealt by hash into blocks with the same centre. A block's lower levels are a
cover tree in numpy: centres of a node's children are further apart than half
its covering radius, the first is the node's own.

Pairs of cells are met from the top down, level by level, by joins with their children;
pairs of nodes in the same way within a task. A pair is dropped when its centres are
further apart than the search radius and both covering radii together; it is taken
whole, without looking at its members, when that much is within the search
radius; otherwise the wider node gives way to its children. Single vectors are compared
by their cosine. A task gives for each vector that has links their number and one
edge of a spanning forest, so links are counted, never listed.

Equal vectors of a label are one node of a weight, so that many copies cost as much
as one. Vectors that are null, zero or hold null or non-finite components, and rows with a
null label or vec_id, link with nothing; nor do vectors with different numbers of
components. A null vec_id has a null component and is not kept. A repeated
vec_id is one row for each time it stands there; each counts as a vector. An empty
table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import components, saved

#: Vectors of a block, centres of a cell at most, levels of cells at most, vectors of a node that has no children, pairs looked at in one matrix.
BLOCK, CENTRES, LEVELS, LEAF, CELLS = 4096, 64, 6, 8, 1 << 20
#: Bounds must hold by more than rounding can be; cosines closer to the threshold than this are taken again from the given vectors.
SLACK, CLOSE = 1e-7, 1e-9


def _valid(embedding: str) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Equally long lists as the rows of a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows divided by their norm; by their largest component first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.sum(x * x, axis=1, keepdims=True))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def net(x: np.ndarray, radius: float, most: int) -> np.ndarray:
    """Rows further apart than the radius, taken in order, the first always; all others are within it of one of them, unless there are `most`."""
    left, chosen = np.arange(len(x)), []
    while len(left) and len(chosen) < most:
        some, rest = left[:256], left[256:]
        near = distances(x[some], x[some]) <= radius
        out = np.zeros(len(some), bool)
        own = []
        for i in range(len(some)):
            if not out[i]:
                own.append(i)
                out |= near[i]
        chosen += some[own].tolist()
        keep = np.ones(len(rest), bool)
        for lo in range(0, len(rest), 4096):
            keep[lo : lo + 4096] = (distances(x[rest[lo : lo + 4096]], x[some[own]]) > radius).all(axis=1)
        left = rest[keep]
    return np.array(chosen[:most], np.int64)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([np.argmax(x[lo : lo + 4096] @ centres.T, axis=1) for lo in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])


class Tree:
    """A cover tree over unit vectors: each node has a range of `order`, a centre, its covering radius, and children of half of that."""

    def __init__(self, x: np.ndarray):
        self.x, self.order = x, np.arange(len(x))
        self.low, self.high, self.centre, self.radius, self.children = [0], [len(x)], [0], [0.0], [np.zeros(0, np.int64)]
        self._measure(0)
        at = 0
        while at < len(self.low):
            if self.high[at] - self.low[at] > LEAF and self.radius[at] > SLACK:
                self._part(at)
            at += 1
        self.low, self.high, self.centre, self.radius = (np.array(v) for v in (self.low, self.high, self.centre, self.radius))

    def _measure(self, node: int) -> None:
        rows = self.order[self.low[node] : self.high[node]]
        self.radius[node] = float(distances(self.x[rows], self.x[self.centre[node]][None, :]).max(initial=0.0)) if len(rows) > 1 else 0.0

    def _part(self, node: int) -> None:
        low, high = self.low[node], self.high[node]
        rows = self.order[low:high]
        rows = np.concatenate([[self.centre[node]], rows[rows != self.centre[node]]])
        at = net(self.x[rows], self.radius[node] / 2, len(rows))
        centres = rows[at]
        to = nearest(self.x[rows], self.x[centres])
        to[at] = np.arange(len(at))  # a centre is its own, whatever rounding says
        by = np.argsort(to, kind="stable")
        self.order[low:high] = rows[by]
        cuts = np.concatenate([[0], np.cumsum(np.bincount(to, minlength=len(centres)))])
        first = len(self.low)
        for i, c in enumerate(centres):
            self.low.append(low + int(cuts[i]))
            self.high.append(low + int(cuts[i + 1]))
            self.centre.append(int(c))
            self.radius.append(0.0)
            self.children.append(np.zeros(0, np.int64))
            self._measure(first + i)
        self.children[node] = np.arange(first, first + len(centres))

    def members(self, node: int) -> np.ndarray:
        return self.order[self.low[node] : self.high[node]]


class Links:
    """How many others each vector of two blocks is linked with, by weight, and which are connected."""

    def __init__(self, x: np.ndarray, y: np.ndarray | None, weights: np.ndarray, threshold: float):
        self.n, self.threshold, self.weights = len(x), threshold, weights
        self.given = x if y is None else np.vstack([x, y])
        self.count, self.root = np.zeros(len(weights), np.int64), np.arange(len(weights))

    def whole(self, a: np.ndarray, b: np.ndarray | None) -> None:
        """All of a with all of b, or all of a among themselves."""
        if b is None:
            self.count[a] += self.weights[a].sum() - self.weights[a]
            together = a
        else:
            self.count[a] += self.weights[b].sum()
            self.count[b] += self.weights[a].sum()
            together = np.concatenate([a, b])
        self.connect(together, np.full(len(together), together[0]))

    def some(self, a: np.ndarray, b: np.ndarray) -> None:
        np.add.at(self.count, a, self.weights[b])
        np.add.at(self.count, b, self.weights[a])
        self.connect(a, b)

    def connect(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.root[a], self.root[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            if not len(a):
                return
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up

    def reach(self, cosine: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which cosines reach the threshold; close ones are taken again from the given vectors."""
        good = cosine >= self.threshold
        for i in np.flatnonzero(np.abs(cosine - self.threshold) < CLOSE):
            x, y = self.given[a[i]], self.given[b[i]]
            good[i] = float(np.dot(x, y)) / (float(np.linalg.norm(x)) * float(np.linalg.norm(y))) >= self.threshold
        return good


def dual(s: Tree, t: Tree | None, links: Links) -> None:
    """All linked pairs of two trees, or of one tree with itself; rows of the second come after those of the first."""
    within = float(np.sqrt(2 - 2 * links.threshold))
    one, shift = t is None, 0 if t is None else links.n
    t = s if t is None else t
    open_ = [(0, 0)]
    while open_:
        i, j = open_.pop()
        if one and i == j:
            if 2 * s.radius[i] < within - SLACK:
                links.whole(s.members(i), None)
            elif len(s.children[i]):
                kids = s.children[i]
                open_ += [(int(c), int(c)) for c in kids if s.high[c] - s.low[c] > 1]
                open_ += _meet(s, s, kids, kids, True, within, links, 0)
            else:
                own = s.members(i)
                _single(s.x, s.x, own, own, True, links, 0)
            continue
        wide = len(s.children[i]) and (not len(t.children[j]) or s.radius[i] >= t.radius[j])
        if wide:
            open_ += _meet(s, t, s.children[i], np.array([j]), False, within, links, shift)
        elif len(t.children[j]):
            open_ += _meet(s, t, np.array([i]), t.children[j], False, within, links, shift)
        else:
            _single(s.x, t.x, s.members(i), t.members(j), False, links, shift)


def _meet(s: Tree, t: Tree, a: np.ndarray, b: np.ndarray, half: bool, within: float, links: Links, shift: int) -> list[tuple[int, int]]:
    """Pairs of nodes of a and b (of half of them, if both are the same) that must be looked into; those out of reach are dropped, those wholly in reach are taken."""
    out = []
    far = t.x[t.centre[b]]
    rows = max(1, CELLS // len(b))
    for lo in range(0, len(a), rows):
        part = a[lo : lo + rows]
        cosine = s.x[s.centre[part]] @ far.T
        gap = np.sqrt(np.maximum(2 - 2 * cosine, 0))
        reach = s.radius[part][:, None] + t.radius[b][None, :]
        near = gap <= within + reach + SLACK
        if half:
            near &= np.arange(len(b))[None, :] > np.arange(lo, lo + len(part))[:, None]
        x, y = np.nonzero(near)
        p, q = part[x], b[y]
        alone = (s.high[p] - s.low[p] == 1) & (t.high[q] - t.low[q] == 1)
        u, v = s.order[s.low[p[alone]]], t.order[t.low[q[alone]]] + shift
        good = links.reach(cosine[x[alone], y[alone]], u, v)
        links.some(u[good], v[good])
        rest = ~alone
        whole = gap[x[rest], y[rest]] + reach[x[rest], y[rest]] < within - SLACK
        for i, j in zip(p[rest][whole], q[rest][whole], strict=True):
            links.whole(s.members(i), t.members(j) + shift)
        out += list(zip(p[rest][~whole].tolist(), q[rest][~whole].tolist(), strict=True))
    return out


def _single(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, half: bool, links: Links, shift: int) -> None:
    """Vector by vector, for nodes without children."""
    cosine = x[a] @ y[b].T
    near = cosine >= links.threshold - CLOSE
    if half:
        near &= np.triu(np.ones(near.shape, bool), 1)
    i, j = np.nonzero(near)
    u, v = a[i], b[j] + shift
    good = links.reach(cosine[i, j], u, v)
    links.some(u[good], v[good])


_KEY = "tree string, path string"


def _chosen(radius: float):
    """A sample of a cell to its centres, numbered; radii at which it has only one are passed over."""

    def run(table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.argsort(table["tie"].to_numpy(), kind="stable")))
        x, level = unit(matrix(table["embedding"])), radius
        while len(rows := net(x, level, table["most"][0].as_py())) == 1 and level > SLACK:
            level /= 2
        rows = pa.array(rows)
        own = table.select(["tree", "path", "embedding"]).take(rows)
        return own.append_column("number", pa.array(np.arange(len(rows)), pa.int32()))

    return run


def _dealt(points: pa.Table, centres: pa.Table) -> pa.Table:
    """Vectors of a cell to the children that their nearest centres make."""
    own = points.select(["tree", "path", "node", "weight", "embedding"])
    if not len(points) or not len(centres):
        return own
    centres = centres.take(pa.array(np.argsort(centres["number"].to_numpy())))
    to = nearest(unit(matrix(points["embedding"])), unit(matrix(centres["embedding"])))
    return own.set_column(1, "path", pa.array([f"{p}.{i}" for p, i in zip(points["path"].to_pylist(), to.tolist(), strict=True)], pa.string()))


def _packed(table: pa.Table) -> pa.Table:
    """A block as one row, with its centre and covering radius."""
    table = table.take(pa.array(np.argsort(table["node"].to_numpy(), kind="stable")))
    x = matrix(table["embedding"])
    u = unit(x)
    mean = u.mean(axis=0)
    centre = u[int(np.argmax(u @ mean))]
    radius = float(distances(u, centre[None, :]).max())
    kind = np.float32 if np.array_equal(x.astype(np.float32).astype(np.float64), x) else np.float64
    first = lambda c: pa.array([table[c][0].as_py()], pa.string())
    values = [first("tree"), first("path"), first("block"), pa.array([len(x)], pa.int32()), pa.array([centre.tolist()], pa.list_(pa.float64())), pa.array([radius])]
    packs = [np.ascontiguousarray(table[c].to_numpy()).astype(np.int64).tobytes() for c in ("node", "weight")] + [x.astype(kind).tobytes()]
    return pa.table([*values, *(pa.array([p], pa.binary()) for p in packs)], names=["tree", "path", "block", "n", "centre", "radius", "nodes", "weights", "vectors"])


def _linked(threshold: float):
    """The one or two blocks of a pair to (node, n_links, root) of its vectors with links."""

    def run(table: pa.Table) -> pa.Table:
        parts = []
        for row in table.sort_by("block").to_pylist():
            kind = np.float32 if len(row["vectors"]) == row["n"] * len(row["centre"]) * 4 else np.float64
            x = np.frombuffer(row["vectors"], kind).reshape(row["n"], -1).astype(np.float64)
            parts.append((np.frombuffer(row["nodes"], np.int64), np.frombuffer(row["weights"], np.int64), x))
        nodes, weights = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        other = parts[1][2] if len(parts) > 1 else None
        links = Links(parts[0][2], other, weights, threshold)
        dual(Tree(unit(parts[0][2])), None if other is None else Tree(unit(other)), links)
        at = np.flatnonzero(links.count)
        return pa.table([pa.array(nodes[at]), pa.array(links.count[at]), pa.array(nodes[links.root[at]])], names=["node", "n_links", "root"])

    return run


def _cells(points: DataFrame, block: int, centres: int, levels: int) -> DataFrame:
    """(tree, path, node, weight, embedding): cells parted level by level, as long as they hold more than a block."""
    radius = 2.0
    for _ in range(levels):
        radius /= 2
        size = points.groupBy("tree", "path").agg(F.count("*").alias("n")).where(F.col("n") > block)
        size = saved(size.withColumn("most", F.least(F.lit(centres), F.ceil(F.col("n") / block) * 2).cast("int")).withColumn("parts", F.ceil(F.col("n") / block).cast("int")), "cover-cells")
        if size.isEmpty():
            break
        tie = F.xxhash64("node")
        large = points.join(size, ["tree", "path"])
        sample = large.where(F.pmod(tie, F.greatest(F.lit(1), F.floor(F.col("n") / (F.col("most") * 32))).cast("long")) == 0).select("tree", "path", "embedding", "most", tie.alias("tie"))
        found = saved(sample.groupBy("tree", "path").applyInArrow(_chosen(radius), f"{_KEY}, {_type(points)}, number int"), "cover-centres")
        # a cell is dealt by many tasks; each gets its centres
        spread = large.select("tree", "path", "node", "weight", "embedding", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int").alias("salt"))
        copies = found.join(size, ["tree", "path"]).select("tree", "path", "embedding", "number", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"))
        by = ["tree", "path", "salt"]
        parted = spread.groupBy(*by).cogroup(copies.groupBy(*by)).applyInArrow(_dealt, f"{_KEY}, node long, weight long, {_type(points)}")
        points = saved(points.join(size, ["tree", "path"], "left_anti").unionByName(parted), "cover-points")
    return points


def _type(points: DataFrame) -> str:
    return f"embedding {points.schema['embedding'].dataType.simpleString()}"


def _apart(x: str, y: str) -> Column:
    """Distance of two unit vectors."""
    product = F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * product))


def _level(blocks: DataFrame, level: int) -> DataFrame:
    """(tree, cell, up, centre, radius) of a level of cells; a cell that is not parted there stands for itself. A cell has a block's centre, and reaches all its blocks."""
    name = lambda k: F.array_join(F.slice(F.split("path", r"\."), 1, k), ".")
    inside = blocks.select("tree", name(level).alias("cell"), (name(level - 1) if level > 1 else F.lit("")).alias("up"), "centre", "radius", "block")
    by = ["tree", "cell", "up"]
    heads = inside.groupBy(*by).agg(F.min_by("centre", "block").alias("head"))
    return inside.join(heads, by).groupBy(*by).agg(F.first("head").alias("centre"), F.max(_apart("centre", "head") + F.col("radius")).alias("radius"))


def _pairs(blocks: DataFrame, within: float) -> DataFrame:
    """(tree, a, b): pairs of blocks, each with itself too, that no bound keeps apart. Each level's pairs are joined with the children of both."""
    deepest = blocks.agg(F.max(F.size(F.split("path", r"\.")))).first()[0] or 0
    side = lambda cells, x: cells.select("tree", F.col("up").alias(f"up_{x}"), F.col("cell").alias(x), F.col("centre").alias(f"centre_{x}"), F.col("radius").alias(f"radius_{x}"))
    found = blocks.select("tree", F.lit("0").alias("a"), F.lit("0").alias("b")).distinct()
    for level in range(2, deepest + 2):
        cells = _level(blocks, level) if level <= deepest else blocks.select("tree", F.col("block").alias("cell"), F.col("path").alias("up"), "centre", "radius")
        above = found.select("tree", F.col("a").alias("up_a"), F.col("b").alias("up_b"))
        met = above.join(side(cells, "a"), ["tree", "up_a"]).join(side(cells, "b"), ["tree", "up_b"]).where((F.col("up_a") != F.col("up_b")) | (F.col("a") <= F.col("b")))
        near = met.where(_apart("centre_a", "centre_b") <= F.lit(within + SLACK) + F.col("radius_a") + F.col("radius_b"))
        found = saved(near.select("tree", "a", "b"), "cover-pairs")
    return found


def near_groups(vectors: DataFrame, threshold: float = 0.98, block: int = BLOCK, centres: int = CENTRES, levels: int = LEVELS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of (vec_id, embedding, label)."""
    taken = _valid("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = vectors.select("vec_id", "embedding", F.when(taken, F.concat_ws(":", F.size("embedding").cast("string"), F.col("label").cast("string"))).alias("tree"))
    same = rows.where("tree IS NOT NULL").groupBy("tree", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"))
    nodes = saved(same.withColumn("node", F.monotonically_increasing_id()), "cover-nodes")
    cells = _cells(nodes.select("tree", F.lit("0").alias("path"), "node", "weight", "embedding"), block, centres, levels)
    size = cells.groupBy("tree", "path").agg(F.ceil(F.count("*") / block).alias("parts"))
    dealt = cells.join(size, ["tree", "path"]).withColumn("block", F.concat_ws("/", "path", F.pmod(F.xxhash64("node", F.lit(2)), F.col("parts")).cast("string"))).drop("parts")
    packed = "tree string, path string, block string, n int, centre array<double>, radius double, nodes binary, weights binary, vectors binary"
    blocks = saved(dealt.groupBy("tree", "path", "block").applyInArrow(_packed, packed), "cover-blocks")
    pairs = _pairs(blocks.select("tree", "path", "block", "centre", "radius"), float(np.sqrt(2 - 2 * threshold)))
    asked = pairs.select("tree", "a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    met = asked.join(blocks.drop("path", "radius"), ["tree", "block"]).groupBy("tree", "a", "b").applyInArrow(_linked(threshold), "node long, n_links long, root long")
    found = saved(met, "cover-links")
    counts = found.groupBy("node").agg(F.sum("n_links").alias("links"))
    parts = components(found.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")), "cover-parts")
    ids = parts.join(nodes.select("node", "least"), "node")
    low = ids.groupBy("label").agg(F.min("least").alias("component"))
    placed = ids.select("node", "label").join(low, "label").select("node", "component")
    told = nodes.join(counts, "node", "left").join(placed, "node", "left").where("weight > 1 OR links IS NOT NULL")
    told = told.select("tree", "embedding", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "least").alias("component_id"))
    out = rows.join(told, ["tree", "embedding"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


ORACLE = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
e AS MATERIALIZED (
  SELECT a.r AS x, b.r AS y, b.vec_id FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.98),
c AS (SELECT x, y, vec_id FROM e UNION SELECT c.x, e.y, e.vec_id FROM c JOIN e ON e.x = c.y),
n AS (SELECT x, count(*) AS n FROM e GROUP BY x),
m AS (SELECT x, min(vec_id) AS least FROM c GROUP BY x),
t AS (SELECT v.r, v.vec_id, coalesce(n.n, 0) AS n_links, least(v.vec_id, coalesce(m.least, v.vec_id)) AS component_id FROM v LEFT JOIN n ON n.x = v.r LEFT JOIN m ON m.x = v.r)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM t
UNION ALL SELECT vec_id, 0, vec_id, vec_id IS NOT NULL FROM embeddings
WHERE vec_id IS NULL OR label IS NULL OR embedding IS NULL OR len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) > 0 OR len(list_filter(embedding, lambda x: x <> 0)) = 0
"""
