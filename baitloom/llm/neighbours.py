"""Approximate nearest neighbours: NN-descent builds a graph, greedy search reads it.

Equal vectors are one node. First neighbours come from blocks of rows that lie
next to each other in a few orders by random hyperplanes. Then, in rounds, every
node's neighbours and reverse neighbours are joined with their vectors, all
pairs among them of which one is new are scored, and each node keeps its best:
neighbours of neighbours become neighbours. Rounds end when few lists change.

A query starts at its own node. In each round its best nodes that were not yet
expanded, each time up to twice as many, are joined with their neighbour lists, which hold the neighbours'
vectors; the best `pool` of all nodes seen stay, beside the query's vector, until all of them were expanded
or the last round is over. The best are scored again in double precision on the
original vectors, and nodes give way to the rows of their vector.

Nearness is the inner product. Vectors of unequal length (norm) get one more
component in the graph, which makes norms equal and leaves a query's products as
they are.

Vectors that are null, zero, or hold null or non-finite components take no part;
nor do those whose number of components is not the most frequent (of equals, the
larger). Rows with a null vec_id take no part. A repeated vec_id is one row for
each time it stands there; each asks once and can be found by the others. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._store import saved

#: Neighbours and reverse neighbours of a node, rows compared in a first block, orders of first blocks, rounds at most, and what a member learns of one list at most.
NEIGHBOURS, REVERSE, BLOCK, ORDERS, DESCENTS, LEARNT = 24, 24, 512, 4, 4, 6
#: Of a search: nodes kept, nodes expanded in a first round, and nodes scored exactly in the end (twice those asked for, if that is more).
POOL, EXPAND, EXACT = 448, 64, 64
_LISTS = "node long, ids binary, scores binary, fresh binary"
_POOLS = f"{_LISTS}, vec binary"


def _valid(embedding: str) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _nodes(rows: DataFrame, keep: int) -> DataFrame:
    """(node, embedding, members): the distinct vectors, each with its least `keep` vec_ids, repeated ones as often as they stand."""
    by = Window.partitionBy("embedding").orderBy("vec_id")
    first = rows.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= keep)
    return first.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.sort_array(F.collect_list("vec_id")).alias("members"))


def _packed(largest: float, uneven: bool):
    """(node, embedding) to (node, vec): float32 bytes, with the component that evens out norms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.asarray(batch.column(1).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(batch.num_rows, -1)
                if uneven:
                    x = np.hstack([x, np.sqrt(np.maximum(largest**2 - np.sum(x * x, axis=1, keepdims=True), 0))])
                packed = (x / largest).astype(np.float32)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in packed], pa.binary())], ["node", "vec"])

    return run


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """Equally long binaries as the rows of a matrix."""
    n = len(column)
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, kind).reshape(n, -1)


def _coded(planes: np.ndarray):
    """(node, vec) to (node, vec, code): the signs of the products with some hyperplanes, as bits of a number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                product = _matrix(batch.column(1), np.float32) @ planes
                code = ((product > 0).astype(np.int64) << np.arange(planes.shape[1])).sum(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], ["node", "vec", "code"])

    return run


def _blocks(k: int, block: int):
    """Rows in order, cut into blocks, to each one's best k of its block."""

    def lists(ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        scores = x @ x.T
        np.fill_diagonal(scores, -np.inf)
        n = min(k, len(ids) - 1)
        best = np.argpartition(-scores, n - 1, axis=1)[:, :n] if n else np.zeros((len(ids), 0), np.int64)
        own = np.take_along_axis(scores, best, axis=1).astype(np.float32)
        return _as_lists(ids, [ids[b] for b in best], list(own), [np.ones(len(b), bool) for b in best])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vecs = np.zeros(0, np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), np.float32)
            ids = np.concatenate([ids, batch.column(0).to_numpy()])
            vecs = x if vecs is None else np.vstack([vecs, x])
            while len(ids) >= 2 * block:
                yield lists(ids[:block], vecs[:block])
                ids, vecs = ids[block:], vecs[block:]
        if len(ids) > 1:
            yield lists(ids, vecs)

    return run


def _as_lists(nodes: np.ndarray, ids: list, scores: list, fresh: list) -> pa.RecordBatch:
    binary = lambda rows, kind: pa.array([np.ascontiguousarray(r, kind).tobytes() for r in rows], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), binary(ids, np.int64), binary(scores, np.float32), binary(fresh, bool)], ["node", "ids", "scores", "fresh"])


def _flat_lists(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    ids = batch.column(1).to_pylist()
    node = np.repeat(batch.column(0).to_numpy(), [len(x) // 8 for x in ids])
    return node, np.frombuffer(b"".join(ids), np.int64), np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float32), np.frombuffer(b"".join(batch.column(3).to_pylist()), bool)


def _best(node: np.ndarray, ids: np.ndarray, score: np.ndarray, fresh: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Of each node the k best different ids; one that is also there as not fresh is not fresh."""
    by = np.lexsort((fresh, ids, node))
    node, ids, score, fresh = node[by], ids[by], score[by], fresh[by]
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (ids[1:] != ids[:-1])
    new &= ids != node
    node, ids, score, fresh = node[new], ids[new], score[new], fresh[new]
    by = np.lexsort((ids, -score, node))
    node, ids, score, fresh = node[by], ids[by], score[by], fresh[by]
    start = np.flatnonzero(np.diff(node, prepend=node[0] - 1)) if len(node) else np.zeros(0, np.int64)
    rank = np.arange(len(node)) - np.repeat(start, np.diff(np.append(start, len(node))))
    top = rank < k
    return node[top], ids[top], score[top], fresh[top]


def _merged(k: int):
    """Lists in order of node, several to a node, to one list of the k best. What is left of the last node waits for more."""

    def out(node, ids, score, fresh) -> pa.RecordBatch:
        start = np.flatnonzero(np.diff(node, prepend=node[0] - 1))
        return _as_lists(node[start], np.split(ids, start[1:]), np.split(score, start[1:]), np.split(fresh, start[1:]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _flat_lists(batch)
            if waiting is not None:
                rows = tuple(np.concatenate(x) for x in zip(waiting, rows, strict=True))
            rows = _best(*rows, k)
            if not len(rows[0]):
                waiting = None
                continue
            last = rows[0] == rows[0][-1]
            waiting = tuple(x[last] for x in rows)
            if not last.all():
                yield out(*(x[~last] for x in rows))
        if waiting is not None and len(waiting[0]):
            yield out(*waiting)

    return run


def _merge(lists: DataFrame, k: int) -> DataFrame:
    return lists.repartition("node").sortWithinPartitions("node").mapInArrow(_merged(k), _LISTS)


def _pooled(k: int):
    """As _merged, for pools with the vector of their query, which one or more of a node's rows have."""
    merged = _merged(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vecs: dict[int, bytes] = {}

        def lists() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                known = batch.filter(batch.column(4).is_valid())
                vecs.update(zip(known.column(0).to_pylist(), known.column(4).to_pylist(), strict=True))
                yield pa.RecordBatch.from_arrays(batch.columns[:4], ["node", "ids", "scores", "fresh"])

        for batch in merged(lists()):  # in order of node: what is out needs its vector no more
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([vecs.pop(x) for x in batch.column(0).to_pylist()], pa.binary())], [*batch.schema.names, "vec"])

    return run


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists to edges (a, b, score, fresh)."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _flat_lists(batch)], ["a", "b", "score", "fresh"])


def _halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, vec) with vectors in half precision."""
    for batch in batches:
        if batch.num_rows:
            vecs = _matrix(batch.column(1), np.float32).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in vecs], pa.binary())], ["node", "vec"])


def _lists_with_vectors(graph: DataFrame, halves: DataFrame, reverse: int) -> DataFrame:
    """(node, ids, vecs, fresh, least): neighbours and the best `reverse` reverse ones, with their vectors in half precision and the score that a list of theirs ends with."""
    edges = graph.mapInArrow(_edges, "a long, b long, score float, fresh boolean")
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "score", "fresh")
    nearest = Window.partitionBy("a").orderBy(F.desc("score"), "b")
    back = back.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= reverse).drop("rank")
    # an edge that stands both ways comes twice; the packer keeps one
    both = edges.unionByName(back)
    ends = graph.mapInArrow(_ends, "b long, least float")
    known = halves.select(F.col("node").alias("b"), "vec").join(ends, "b", "left")
    return both.join(known, "b").select("a", "b", "fresh", "vec", "least").repartition("a").sortWithinPartitions("a").mapInArrow(_pack, "node long, ids binary, vecs binary, fresh binary, least binary")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        least = [min(np.frombuffer(x, np.float32), default=-np.inf) for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(least, pa.float32())], ["b", "least"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: pa.Table | None = None

    def pack(table: pa.Table) -> pa.RecordBatch:
        a, b = table["a"].to_numpy(), table["b"].to_numpy()
        fresh = table["fresh"].to_numpy(zero_copy_only=False)
        least = np.nan_to_num(table["least"].fill_null(-np.inf).to_numpy(), nan=-np.inf, neginf=-9.0).astype(np.float32)
        vec = _matrix(table["vec"].combine_chunks(), np.float16)
        by = np.lexsort((fresh, b, a))
        new = np.ones(len(by), bool)
        new[1:] = (a[by[1:]] != a[by[:-1]]) | (b[by[1:]] != b[by[:-1]])
        by = by[new]
        start = np.flatnonzero(np.diff(a[by], prepend=a[by[0]] - 1))
        cut = list(zip(start.tolist(), [*start[1:].tolist(), len(by)], strict=True))
        binary = lambda x: pa.array([x[by[i:j]].tobytes() for i, j in cut], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(a[by[start]]), binary(b), binary(vec), binary(fresh), binary(least)], ["node", "ids", "vecs", "fresh", "least"])

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if waiting is None else pa.concat_tables([waiting, table])
        a = table["a"].to_numpy()
        whole = int(np.searchsorted(a, a[-1]))
        if whole:
            yield pack(table.slice(0, whole))
        waiting = table.slice(whole)
    if waiting is not None and waiting.num_rows:
        yield pack(waiting)


def _local_joins(most: int):
    """Lists with vectors to what their members learn of each other: pairs of which one is fresh, better than the member's list ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, ids_out, scores_out = [], [], []
            for ids, vecs, fresh, least in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3, 4)), strict=True):
                ids, fresh, least = np.frombuffer(ids, np.int64), np.frombuffer(fresh, bool), np.frombuffer(least, np.float32)
                x = np.frombuffer(vecs, np.float16).reshape(len(ids), -1).astype(np.float32)
                scores = x @ x.T
                scores[~(fresh[:, None] | fresh[None, :])] = -np.inf
                np.fill_diagonal(scores, -np.inf)
                scores[scores <= least[:, None]] = -np.inf
                n = min(most, len(ids))
                top = np.argpartition(-scores, n - 1, axis=1)[:, :n]
                own = np.take_along_axis(scores, top, axis=1)
                good = own > -np.inf
                rows = np.flatnonzero(good.any(1))
                nodes.append(ids[rows])
                ids_out += [ids[top[r][good[r]]] for r in rows]
                scores_out += [own[r][good[r]] for r in rows]
            if nodes and ids_out:
                yield _as_lists(np.concatenate(nodes), ids_out, scores_out, [np.ones(len(x), bool) for x in ids_out])

    return run


def _aged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fresh = pa.array([bytes(len(x)) for x in batch.column(3).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], fresh], ["node", "ids", "scores", "fresh"])


def _fresh_count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fresh = batch.column(3).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([sum(x) for x in fresh], pa.int64()), pa.array([len(x) for x in fresh], pa.int64())], ["fresh", "all"])


def build_graph(vectors: DataFrame, halves: DataFrame, width: int, *, neighbours: int = NEIGHBOURS, reverse: int = REVERSE, descents: int = DESCENTS, seed: int = 11) -> DataFrame:
    """(node, ids, scores, fresh) by NN-descent over (node, vec): `descents` rounds at most, fewer if 2 % of the lists' entries are new or less."""
    rng = np.random.default_rng(seed)
    first, parts = None, max(1, vectors.count() // BLOCK)  # few rows are one block, in which all pairs are scored
    for _ in range(ORDERS):
        planes = rng.normal(size=(width, 24)).astype(np.float32)
        coded = vectors.mapInArrow(_coded(planes), "node long, vec binary, code long")
        lists = coded.repartitionByRange(parts, "code", "node").sortWithinPartitions("code", "node").mapInArrow(_blocks(neighbours, BLOCK), _LISTS)
        first = lists if first is None else first.unionByName(lists)
    graph = saved(_merge(first, neighbours), "ann-graph")
    # a vector that was alone in its range each time (one a range at most) meets some that are not
    lone = vectors.join(graph.select("node"), "node", "left_anti")
    if not lone.isEmpty():
        met = vectors.join(graph.select("node"), "node", "left_semi").orderBy("node").limit(neighbours)
        more = lone.unionByName(met).select("node", "vec").repartition(1).withColumn("code", F.lit(0).cast("long")).mapInArrow(_blocks(neighbours, max(BLOCK, 4 * neighbours)), _LISTS)
        graph = saved(_merge(graph.unionByName(more), neighbours), "ann-graph")
    for _ in range(descents):
        found = _lists_with_vectors(graph, halves, reverse).mapInArrow(_local_joins(LEARNT), _LISTS)
        graph = saved(_merge(graph.mapInArrow(_aged, _LISTS).unionByName(found), neighbours), "ann-graph")
        fresh = graph.mapInArrow(_fresh_count, "fresh long, all long").agg(F.sum("fresh"), F.sum("all")).first()
        if (fresh[0] or 0) <= 0.02 * (fresh[1] or 0):
            break
    return graph


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node: the query, vec, least, ids, vecs) to scored lists of the query."""
    for batch in batches:
        nodes, ids_out, scores_out = batch.column(0).to_numpy(), [], []
        keep = []
        for i, (vec, least, ids, vecs) in enumerate(zip(*(batch.column(j).to_pylist() for j in (1, 2, 3, 4)), strict=True)):
            ids = np.frombuffer(ids, np.int64)
            scores = np.frombuffer(vecs, np.float16).reshape(len(ids), -1).astype(np.float32) @ np.frombuffer(vec, np.float32)
            good = scores > least
            if good.any():
                keep.append(i)
                ids_out.append(ids[good])
                scores_out.append(scores[good])
        if keep:
            lists = _as_lists(nodes[keep], ids_out, scores_out, [np.ones(len(x), bool) for x in ids_out])
            yield pa.RecordBatch.from_arrays([*lists.columns, pa.nulls(len(keep), pa.binary())], [*lists.schema.names, "vec"])


def _frontier(expand: int, pool: int):
    """Pools (node, ids, scores, fresh, vec) to rows (query, vec, least, b): the nodes to expand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            query, vec_at, least_out, b = [], [], [], []
            for i, (ids, scores, fresh) in enumerate(zip(*(batch.column(j).to_pylist() for j in (1, 2, 3)), strict=True)):
                ids, scores, fresh = np.frombuffer(ids, np.int64), np.frombuffer(scores, np.float32), np.frombuffer(fresh, bool)
                new = np.flatnonzero(fresh)[:expand]  # pools are in order
                b.append(ids[new])
                query.append(np.full(len(new), i))
                least_out.append(np.full(len(new), scores[-1] if len(scores) >= pool else -9.0, np.float32))
            at = pa.array(np.concatenate([*query, np.zeros(0, np.int64)]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(4).take(at), pa.array(np.concatenate([*least_out, np.zeros(0, np.float32)])), pa.array(np.concatenate([*b, np.zeros(0, np.int64)]))], ["query", "vec", "least", "b"])

    return run


def _expanded(expand: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fresh = []
            for x in batch.column(3).to_pylist():
                x = np.frombuffer(x, bool).copy()
                x[np.flatnonzero(x)[:expand]] = False
                fresh.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fresh, pa.binary()), batch.column(4)], ["node", "ids", "scores", "fresh", "vec"])

    return run


def search(queries: DataFrame, graph: DataFrame, halves: DataFrame, *, pool: int = POOL, expand: int = EXPAND, rounds: int | None = None, exact: int = EXACT) -> DataFrame:
    """(query, node): the best nodes found for each query (node, vec: without the component that evens out norms).

    Rounds go on until each pool's nodes have been expanded. A node that a pool has dropped
    cannot come back, so they end. With `rounds` as a limit, a warning says how many
    nodes were left.
    """
    layout = saved(_lists_with_vectors(graph, halves, REVERSE).select("node", "ids", "vecs"), "ann-layout")
    parts = int(halves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    layout = layout.withColumnRenamed("node", "b").repartition(parts, "b").persist()
    # the own node is kept apart: lists never hold their node itself
    start = queries.select(F.col("node").alias("query"), "vec", F.lit(-9.0).cast("float").alias("least"), F.col("node").alias("b"))
    # a query's first pool is empty, and keeps its vector
    empty = queries.select("node", *(F.lit(bytearray()).alias(c) for c in ("ids", "scores", "fresh")), "vec")
    pools, left = None, 1
    try:
        for k in itertools.count() if rounds is None else range(rounds):
            most = min(pool, expand << min(k, 16))  # few rounds, each of which is a shuffle or two, whatever the size
            asked = start if pools is None else pools.mapInArrow(_frontier(most, pool), "query long, vec binary, least float, b long")
            found = asked.join(layout, "b").select("query", "vec", "least", "ids", "vecs").mapInArrow(_expand, _POOLS)
            found = found.unionByName(empty if pools is None else pools.mapInArrow(_expanded(most), _POOLS))
            pools = saved(found.repartition("node").sortWithinPartitions("node").mapInArrow(_pooled(pool), _POOLS), "ann-pools")
            left = pools.mapInArrow(_fresh_count, "fresh long, all long").agg(F.sum("fresh")).first()[0]
            if not left:
                break
    finally:
        layout.unpersist()
    if left:
        warnings.warn(f"the search ended after {rounds} rounds with {left} nodes not expanded", stacklevel=2)
    best = pools.select("node", "ids", "scores", "fresh").mapInArrow(_edges, "a long, b long, score float, fresh boolean")
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("score"), "b"))
    return best.withColumn("rank", rank).where(F.col("rank") <= exact).select(F.col("a").alias("query"), F.col("b").alias("node"))


def nearest(rows: DataFrame, asks: Column, *, k: int = 20, seed: int = 11) -> DataFrame:
    """query_id, rank, vec_id and score: for each row that `asks`, the k nearest others found."""
    rows = rows.where(F.col("vec_id").isNotNull() & _valid("embedding")).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", asks.alias("asks"))
    sizes = rows.groupBy(F.size("embedding").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = sizes["width"] if sizes else 1
    rows = rows.where(F.size("embedding") == width)
    nodes = saved(_nodes(rows.select("vec_id", "embedding"), k + 1), "ann-nodes")
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    norms = nodes.agg(F.sqrt(F.max(square)).alias("high"), F.sqrt(F.min(square)).alias("low"), F.count("*").alias("n")).first()
    high = norms["high"] or 1.0
    uneven = bool(norms["n"]) and norms["low"] < high * (1 - 1e-4)
    vectors = saved(nodes.select("node", "embedding").mapInArrow(_packed(high, uneven), "node long, vec binary"), "ann-vectors")
    asking = rows.where("asks").select("vec_id", "embedding").join(nodes, "embedding").select(F.col("vec_id").alias("query_id"), "node", "embedding")
    asking = saved(asking, "ann-asking")
    flat = asking.select("node", "embedding").dropDuplicates(["node"]).mapInArrow(_packed(high, False), "node long, vec binary")
    if uneven:
        flat = flat.select("node", F.concat("vec", F.lit(bytearray(4))).alias("vec"))
    halves = saved(vectors.mapInArrow(_halved, "node long, vec binary"), "ann-halves")
    graph = build_graph(vectors, halves, width + uneven, seed=seed)
    found = search(saved(flat, "ann-queries"), graph, halves, pool=max(POOL, 4 * k), exact=max(EXACT, 2 * k)).unionByName(asking.select(F.col("node").alias("query"), "node").distinct())
    dot = F.aggregate(F.zip_with("embedding", "other", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    scored = asking.join(found.withColumnRenamed("node", "near"), asking["node"] == found["query"]).join(nodes.select(F.col("node").alias("near"), F.col("embedding").alias("other"), "members"), "near")
    own = F.when(F.col("near") == F.col("node"), F.array_position("members", F.col("query_id"))).otherwise(F.lit(0))
    one = F.posexplode("members").alias("place", "vec_id")
    listed = scored.select("query_id", dot.alias("score"), own.alias("own"), one).where(F.col("place") + 1 != F.col("own"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return listed.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
