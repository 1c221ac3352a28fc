"""Manifest, cover trees and the conversation trie against brute force."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from baitloom.llm import cover, manifest, trie

CLASH = ["tree", "n", "level", "low", "high", "digest", "group", "order", "leaf", "changed", "tie", "place", "path", "node", "weight", "block", "bucket", "part", "index", "above", "claim", "g", "links", "component", "root", "d", "p"]


def with_clashes(frame):
    return frame.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def proofs(items, fan):
    """Root of some digests, and each one's siblings (left, right), level by level."""
    level, at, paths = list(items), list(range(len(items))), [[] for _ in items]
    while len(level) > 1:
        for i, p in enumerate(at):
            start = p - p % fan
            paths[i].append(("".join(level[start:p]), "".join(level[p + 1 : start + fan])))
        level = [sha(*level[i : i + fan]) for i in range(0, len(level), fan)]
        at = [p // fan for p in at]
    return level[0], paths


def manifest_rows(rows, fan=2):
    def leaf(r, add=0):
        n = None if r[3] is None else r[3] + add
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[1], r[2], n, r[4])])

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in order:
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = (own, *proofs([leaf(r) for r in own], fan))
    root, tops = proofs([trees[g][1] for g in order], fan) if order else (None, [])
    out = []
    for g, top in zip(order, tops, strict=True):
        own, subroot, paths = trees[g]
        for r, path in zip(own, paths, strict=True):
            path = path + top
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = leaf(r, 1 if tampered else 0)
            for a, b in path:
                folded = sha(a, folded, b)
            out.append((r[0], leaf(r), subroot, root, sha(*[x for p in path for x in p]), folded, folded == root))
    return sorted(out, key=str)


def random_documents(n, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", None, "ß"]), rng.choice(["en", "en", "en", "de", "日", None, ""]), rng.choice([None, 5, 77]), rng.choice([None, "", "x" * rng.randrange(9), "日本"])) for i in range(n)]
    rows += [(None, "a", "en", 1, "t"), (None, "a", "en", 1, "u"), (3, "a", "en", 1, "t"), (3, "a", "en", 1, "t"), (7, "alone", "fr", 1, "t")]
    return rows


SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def test_manifest(spark):
    rows = random_documents(60, 60)
    got = manifest.verify(with_clashes(spark.createDataFrame(rows, SCHEMA)))
    assert sorted(map(tuple, got.collect()), key=str) == manifest_rows(rows)
    assert manifest.verify(spark.createDataFrame([], SCHEMA)).count() == 0


def test_manifest_of_one_row_and_of_one_group(spark):
    for rows in ([(1, "s", None, None, None)], [(i, "s", "en", 1, "t") for i in range(9)]):
        assert sorted(map(tuple, manifest.verify(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == manifest_rows(rows)


def test_manifest_bands_and_fans(spark):
    """Bands of any height and nodes of any width give the same tree as level by level."""
    rows = random_documents(40, 5)
    frame = spark.createDataFrame(rows, SCHEMA)
    for fan, band in ((2, 1), (2, 3), (3, 2)):
        want = {r[4]: r for r in manifest_rows(rows, fan)}
        m = manifest.build(frame, keep={"doc_id": F.col("doc_id")}, fan=fan, band=band)
        got = manifest.prove(m, ["doc_id", "leaf"], F.col("leaf")).collect()
        assert sorted(r.proof_sha256 for r in got) == sorted(r[4] for r in manifest_rows(rows, fan))
        assert {r.folded_root for r in got} == {m.root} == {next(iter(want.values()))[3]}
        spans = [(r.low, r.high, r.n) for r in m.nodes.collect()]
        assert all(0 <= a < b <= n for a, b, n in spans)
        path = manifest.prove(m, ["leaf"]).first()
        digest = path.leaf
        for x in path.path:
            digest = sha(x.left, digest, x.right)
        assert digest == m.root


def groups(rows, threshold=0.98):
    good = lambda e: e is not None and all(x is not None and np.isfinite(x) for x in e) and any(e)
    n = len(rows)
    link = [[] for _ in range(n)]
    for i in range(n):
        for j in range(i):
            (a, e, k), (b, f, m) = rows[i], rows[j]
            if None in (a, b, k, m) or k != m or not (good(e) and good(f)) or len(e) != len(f):
                continue
            x, y = np.array(e, np.float64), np.array(f, np.float64)
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                link[i].append(j)
                link[j].append(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen]
        least = None if None in ids else min(ids)
        out.append((rows[i][0], len(link[i]), least, rows[i][0] is not None and rows[i][0] == least))
    return sorted(out, key=str)


def vectors(seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(40, 8))
    rows = [(1000 + i, v.tolist(), i % 3) for i, v in enumerate(base)]
    for i in range(160):  # chains and clumps of many widths around a few
        b = base[i % 7]
        rows.append((i, (b + rng.normal(size=8) * rng.choice([0.0, 1e-9, 0.02, 0.08, 0.2, 0.3])).tolist(), int(rng.choice([0, 1]))))
    at = rng.normal(size=8)
    rows += [(2000 + i, (at + rng.normal(size=8) * 0.03).tolist(), 1) for i in range(80)]
    rows += [(3000 + i, (at * (i + 1)).tolist(), 1) for i in range(20)]
    rows += [(4000, None, 1), (4001, [0.0] * 8, 1), (4002, [float("nan")] * 8, 1), (4003, [None] + [1.0] * 7, 1), (4004, [float("inf")] * 8, 1), (None, base[0].tolist(), 0), (4005, base[0].tolist(), None), (4006, [1.0, 2.0], 1), (4007, [1.0, 2.0], 1), (5, base[3].tolist(), 0), (5, base[3].tolist(), 0), (4008, [], 1)]
    return rows


@pytest.mark.parametrize("block", [4096, 7])
def test_near_vectors(spark, block):
    rows = vectors(block)
    frame = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    got = cover.near_groups(frame, block=block, centres=4)
    assert sorted(map(tuple, got.collect()), key=str) == groups(rows)
    assert cover.near_groups(frame.where("false")).count() == 0


def test_the_tree_covers_and_bounds_take_groups_whole(monkeypatch):
    rng = np.random.default_rng(3)
    x = cover.unit(np.vstack([rng.normal(size=(300, 6)), rng.normal(size=6) + rng.normal(size=(2000, 6)) * 1e-3]))
    tree = cover.Tree(x)
    assert sorted(tree.order.tolist()) == list(range(len(x)))
    for i, kids in enumerate(tree.children):
        far = cover.distances(x[tree.members(i)], x[tree.centre[i]][None, :]).max()
        assert far <= tree.radius[i] + 1e-7 and tree.centre[i] in tree.members(i)
        if len(kids):
            apart = cover.distances(x[tree.centre[kids]], x[tree.centre[kids]]) + 9 * np.eye(len(kids))
            assert tree.centre[i] in tree.centre[kids] and apart.min() > tree.radius[i] / 2 - 1e-7 and sum(tree.high[k] - tree.low[k] for k in kids) == tree.high[i] - tree.low[i]
    links = cover.Links(x, None, np.ones(len(x), np.int64), 0.98)
    seen = []
    monkeypatch.setattr(links, "some", lambda a, b, f=links.some: (seen.append(len(a)), f(a, b)))
    cover.dual(tree, None, links)
    cosine = x @ x.T
    assert links.count.tolist() == ((cosine >= 0.98).sum(1) - 1).tolist()
    assert sum(seen) < 20_000  # of two million links among the clump


def trie_rows(rows, block=100, heads=6):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest, (role or "", text or "")))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        rebuilt[c] = tuple(own.get(c - int(math.fmod(c, block)), [])[:h] + turns[h:])
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    kids, leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    ends = {p: sha(",".join(str(c) for c in sorted(c for c in m if rebuilt[c] == p))) for p, m in members.items()}
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], ends[p]) for p, m in members.items()), key=str)


def talks():
    rng = random.Random(21)
    text = lambda: rng.choice([None, "", "é日", "a", "b", "hello " * 5])
    rows = [(c, t, rng.choice(["user", None, "assistant"]), text()) for c in range(180) for t in range(rng.randrange(1, 6))]
    same = [("user", "all the same"), ("assistant", "yes"), ("user", "and on"), (None, "x"), ("user", "y"), ("a", "z"), ("a", "w")]
    rows += [(c, t, *x) for c in [200, *range(211, 260)] for t, x in enumerate(same)]
    rows += [(300, t, "user", f"turn {t}") for t in range(150)] + [(333, t, "user", f"turn {t}" if t < 120 else "other") for t in range(140)]
    rows += [(400, None, "user", "no turn"), (400, None, "user", "no turn"), (400, 3, "user", "t"), (400, 3, "user", "s"), (None, 1, "user", "nobody"), (-5, 0, "user", "below zero"), (777, 0, "user", "alone")]
    rng.shuffle(rows)
    return rows


TALKS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("shard", [50_000, 12])
def test_prefix_trie(spark, shard, monkeypatch):
    monkeypatch.setattr(trie, "LIST_BYTES", 100)
    rows = talks()
    if shard == 12:
        rows = [r for r in rows if r[0] is None or r[0] < 260 or r[1] is None or r[1] < 30]
    got = trie.prefix_trie(with_clashes(spark.createDataFrame(rows, TALKS)).repartition(3), shard=shard)
    assert sorted(map(tuple, got.collect()), key=str) == trie_rows(rows)


def test_prefix_trie_of_nothing(spark):
    assert trie.prefix_trie(spark.createDataFrame([], TALKS)).count() == 0


def test_slots_are_minimal_and_tell_strangers():
    rng = np.random.default_rng(4)
    a, b = rng.integers(-(2**62), 2**62, (2, 20_000))
    a[:100], b[100:200] = 7, 9  # one half of a name may repeat
    slots = trie.Slots(a[:15_000], b[:15_000])
    assert sorted(slots.of(a[:15_000], b[:15_000]).tolist()) == list(range(15_000))
    assert (slots.of(a[15_000:], b[15_000:]) == -1).all()
    with pytest.raises(ValueError):
        trie.Slots(np.array([1, 1]), np.array([2, 2]))
