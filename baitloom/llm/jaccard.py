"""N-gram Jaccard join with several global token orders.

A document's set holds the hashes of its distinct word 5-grams. Documents with
equal sets form a class, and classes stand for them from then on. Two sets whose
similarity reaches the threshold share a token among the first n - ceil(0.8 n) + 1
of each, in any order of all tokens. Orders put tokens by rising frequency
class (those that many documents hold come last) and by a seeded hash within it,
so that common passages rarely stand in a prefix. In the first order prefixes are
three tokens longer, so that pairs must share four.

Prefix postings of the first order meet in Spark, by token. Each token's classes
are paired with the token's leader first, the class with the fewest rare tokens;
links found there join most of a group of near copies without pairing them
all. What still holds different components under one token is paired within bands
of like size. Filters are intersected before any text is fetched: bitmaps of both
sets must allow the overlap, and the prefixes of each further order, joined to the
pairs that are left, must share a token. Then whole sets are compared. The result
is exact: a pair is left out only if its members are known to be connected, differ
too much in size, or share no prefix token under some order.

Null, empty and wordless texts have no shingles and are linked with nothing;
their component is their own doc_id. A null doc_id takes its component from the
others of its class or links, or null. Repeated rows are copies. An empty table
gives no rows. Texts count whole; memory follows the longest. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._flat import Words, byte_values, flat, mix, slices
from ._store import components, saved, sized

SHINGLE, PERCENT, ORDERS, SHARED = 5, 80, 3, 4
HEAVY, MOST_HEAVY, MOST_BROADCAST, IN_BUCKET, IN_TASK = 16, 2_000_000, 1_000_000, 300_000, 256
_IS_WORD = np.ones(256, bool)
_IS_WORD[0x20] = False
_IS_WORD[0x09:0x0E] = False
_VALUES = byte_values(_IS_WORD)


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct k-shingle hashes of each text; fewer words than k are one shingle."""
    data, offs = flat(column)
    for a, b in slices(offs):
        words = Words(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], _VALUES)
        grams = words.grams(k)
        for x, y in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            if y - x >= k:
                yield np.unique(grams[x : y - k + 1])
            elif y > x:
                yield np.array([words.span(x, y)], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def node_of(tokens: np.ndarray) -> int:
    """A class's id: 64 bits of a digest of its set."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def sign(tokens: np.ndarray) -> bytes:
    """A bitmap of the cells that a set's tokens fall in, 4 to 8 cells a token."""
    cells = 1 << max(6, int(4 * len(tokens) - 1).bit_length())
    bits = np.zeros(cells, bool)
    bits[(mix(tokens) & np.uint64(cells - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def most_common(a: bytes, n_a: int, b: bytes, n_b: int) -> int:
    """At most so many tokens are in both sets: shared cells, and what may stand twice in one."""
    size = min(len(a), len(b))
    x, y = (int.from_bytes(np.bitwise_or.reduce(np.frombuffer(s, np.uint8).reshape(-1, size), axis=0).tobytes() if len(s) > size else s, "little") for s in (a, b))
    return (x & y).bit_count() + min(n_a - x.bit_count(), n_b - y.bit_count())


class Orders:
    """Token orders: heavy tokens last, by rising count, then a seeded hash."""

    def __init__(self, heavy: np.ndarray, counts: np.ndarray, percent: int):
        by = np.argsort(heavy)
        self.heavy, self.counts, self.percent = heavy[by], counts[by], percent

    def ranks(self, tokens: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
        """A sort key for each token, and whether it is heavy."""
        hashed = mix(tokens + np.uint64((order * 0xA0761D6478BD642F + 1) % (1 << 64)))
        if not len(self.heavy):
            return hashed >> np.uint64(1), np.zeros(len(tokens), bool)
        at = np.minimum(np.searchsorted(self.heavy, tokens), len(self.heavy) - 1)
        heavy = self.heavy[at] == tokens
        late = np.uint64(1) << np.uint64(63) | (self.counts[at].astype(np.uint64) << np.uint64(31)) | (hashed >> np.uint64(33))
        return np.where(heavy, late, hashed >> np.uint64(1)), heavy

    def prefix(self, tokens: np.ndarray, order: int, more: int = 0) -> tuple[np.ndarray, int]:
        """The first tokens of a set in this order, and how many of the set's are not heavy."""
        ranks, heavy = self.ranks(tokens, order)
        size = prefix_size(len(tokens), self.percent) + more
        first = np.argpartition(ranks, size - 1)[:size] if size < len(tokens) else np.arange(len(tokens))
        return tokens[first], int(len(tokens) - heavy.sum())


def _sets(k: int):
    """(doc_id, text) to (doc_id, n, node, sign, tokens, counts); the last two once a batch: tokens that several of its documents hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, nodes, signs, seen, held, filled = [], [], [], [], [], 0
            for tokens in shingle_sets(batch.column(1), k):
                n.append(len(tokens))
                nodes.append(node_of(tokens) if len(tokens) else None)
                signs.append(sign(tokens) if len(tokens) else None)
                seen.append(tokens)
                filled += len(tokens)
                if filled > 2_000_000:
                    held.append(_often(seen))
                    seen, filled = [], 0
            held.append(_often(seen))
            tokens, counts = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            rest = [None] * (len(n) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int32()), pa.array(nodes, pa.int64()), pa.array(signs, pa.binary()), pa.array(([tokens.tobytes()] + rest)[: len(n)], pa.binary()), pa.array(([counts.tobytes()] + rest)[: len(n)], pa.binary())],
                ["doc_id", "n", "node", "sign", "tokens", "counts"],
            )

    return run


def _often(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that several of these sets hold, and how many do."""
    if not sets:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    tokens, counts = np.unique(np.concatenate(sets), return_counts=True)
    often = counts >= 2
    return tokens[often], counts[often]


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = b"".join(x.as_py() or b"" for x in batch.column(0))
        counts = b"".join(x.as_py() or b"" for x in batch.column(1))
        yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(tokens, np.int64)), pa.array(np.frombuffer(counts, np.int64))], ["token", "count"])


def _heavy(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that come last: held by HEAVY documents, as far as batches saw them more than once. At most MOST_HEAVY, the most frequent."""
    counted = sets.where("tokens IS NOT NULL").select("tokens", "counts").mapInArrow(_spread, "token long, count long").groupBy("token").agg(F.sum("count").alias("count"))
    top = counted.where(F.col("count") >= HEAVY).orderBy(F.desc("count"), "token").limit(MOST_HEAVY).toArrow()
    return top["token"].to_numpy().view(np.uint64), top["count"].to_numpy()


def _postings(k: int, orders, buckets: int):
    """Texts to rows (bucket, nodes, sizes, light, counts, tokens): prefix tokens by bucket, in arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = orders.value
        for batch in batches:
            node, size, light, prefixes, done = [], [], [], [], set()
            for tokens in shingle_sets(batch.column(0), k):
                if len(tokens) and (x := node_of(tokens)) not in done:
                    done.add(x)
                    prefix, rare = own.prefix(tokens, 0, SHARED - 1)
                    node.append(x)
                    size.append(len(tokens))
                    light.append(rare)
                    prefixes.append(prefix)
            if not node:
                continue
            tokens = np.concatenate(prefixes)
            owner = np.repeat(np.arange(len(node)), [len(p) for p in prefixes])
            bucket = (mix(tokens) % np.uint64(buckets)).astype(np.int64)
            by = np.lexsort((owner, bucket))
            tokens, owner, bucket = tokens[by], owner[by], bucket[by]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            node_a, size_a, light_a = np.array(node, np.int64), np.array(size, np.int32), np.array(light, np.int32)
            out: list[list] = [[], [], [], [], [], []]
            for a, b in zip(cuts, [*cuts[1:], len(bucket)], strict=True):
                who, counts = np.unique(owner[a:b], return_counts=True)
                for column, x in zip(out, (int(bucket[a]), node_a[who].tobytes(), size_a[who].tobytes(), light_a[who].tobytes(), counts.astype(np.int32).tobytes(), tokens[a:b].tobytes()), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *(pa.array(x, pa.binary()) for x in out[1:])], ["bucket", "nodes", "sizes", "light", "counts", "tokens"])

    return run


def _met(orders):
    """A bucket's postings of tokens that several classes hold: (token, heavy, node, n, light, leader, leader_n)."""

    def run(table: pa.Table) -> pa.Table:
        join = lambda name, kind: np.frombuffer(b"".join(x.as_py() for x in table[name]), kind)
        counts = join("counts", np.int32)
        token, node = join("tokens", np.int64), np.repeat(join("nodes", np.int64), counts)
        size, light = np.repeat(join("sizes", np.int32), counts), np.repeat(join("light", np.int32), counts)
        by = np.lexsort((node, light, token))
        token, node, size, light = token[by], node[by], size[by], light[by]
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
        token, node, size, light = token[fresh], node[fresh], size[fresh], light[fresh]
        start = np.flatnonzero(np.diff(token, prepend=token[0] - 1 if len(token) else 0))
        length = np.diff(np.append(start, len(token)))
        shared = np.repeat(length > 1, length)
        leader, leader_n = np.repeat(node[start], length), np.repeat(size[start], length)
        heavy = orders.value.ranks(token.view(np.uint64), 0)[1]
        columns = {"token": token, "heavy": heavy, "node": node, "n": size, "light": light, "leader": leader, "leader_n": leader_n}
        return pa.table({k: v[shared] for k, v in columns.items()})

    return run


def _verify(k: int, percent: int):
    """Rows (hub, salt, member, text), the hub's own first, to the links (a, b) among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_set = None, None
        for batch in batches:
            hubs, members = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            found = []
            for h, m, tokens in zip(hubs.tolist(), members.tolist(), shingle_sets(batch.column(2), k), strict=True):
                if h == m:
                    hub, hub_set = h, tokens
                elif h == hub:
                    common = len(np.intersect1d(tokens, hub_set, assume_unique=True))
                    if 100 * common >= percent * (len(tokens) + len(hub_set) - common):
                        found.append((h, m))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], ["a", "b"])

    return run


def _prefixes(k: int, orders):
    """Texts with the class they are asked for to (node, p1, p2, ...): prefixes under the further orders, tokens by 32 of their bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = orders.value
        for batch in batches:
            nodes, made = [], [[] for _ in range(1, ORDERS)]
            for asked, tokens in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), k), strict=True):
                if not len(tokens) or asked not in (None, node := node_of(tokens)):
                    continue
                nodes.append(node)
                for r, out in enumerate(made, 1):
                    out.append((own.prefix(tokens, r)[0] >> np.uint64(32)).astype(np.uint32).view(np.int32))
            lists = []
            for out in made:
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
                lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*out, np.zeros(0, np.int32)]))))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), *lists], ["node", *(f"p{r}" for r in range(1, ORDERS))])

    return run


def _possible(percent: int):
    """Pairs (hub, member, n, sign, hub_n, hub_sign) whose bitmaps allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, n_a, b, n_b in zip(*(batch.column(i).to_pylist() for i in (3, 2, 5, 4)), strict=True):
                common = most_common(a, n_a, b, n_b)
                keep.append(100 * common >= percent * (n_a + n_b - common))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["hub", "member"]).filter(pa.array(keep, pa.bool_()))

    return run


def _texts(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, text) of the classes in these pairs, or null and the text of a row without id. As ids may repeat, the set itself must tell whether a text is the one."""
    nodes = pairs.select(F.col("hub").alias("node")).unionByName(pairs.select(F.col("member").alias("node"))).distinct()
    wanted = saved(classes.join(nodes, "node").select("node", F.col("least").alias("doc_id")), "jaccard-wanted")
    texts = docs.join(sized(wanted.where("doc_id IS NOT NULL"), wanted.count(), MOST_BROADCAST), "doc_id").select("node", "text")
    if not wanted.where("doc_id IS NULL").isEmpty():
        texts = texts.unionByName(docs.where("doc_id IS NULL").select(F.lit(None).cast("long").alias("node"), "text"))
    return texts


def _links(pairs: DataFrame, docs: DataFrame, classes: DataFrame, orders, k: int, percent: int) -> DataFrame:
    """Links among pairs (hub, member), by bitmaps and by prefixes of the further orders first. A hub's members are cut into parts, each of which gets the hub's text."""
    signs = classes.select("node", "n", "sign")
    both = pairs.join(signs.toDF("member", "n", "sign"), "member").join(signs.toDF("hub", "hub_n", "hub_sign"), "hub")
    pairs = saved(both.select("hub", "member", "n", "sign", "hub_n", "hub_sign").mapInArrow(_possible(percent), "hub long, member long"), "jaccard-possible")
    numbers = range(1, ORDERS)
    prefixes = _texts(docs, classes, pairs).mapInArrow(_prefixes(k, orders), "node long, " + ", ".join(f"p{r} array<int>" for r in numbers))
    prefixes = saved(prefixes, "jaccard-prefixes")
    member, hub = (prefixes.select(F.col("node").alias(x), *[F.col(f"p{r}").alias(f"{x}{r}") for r in numbers]) for x in ("member", "hub"))
    shared = F.lit(True)
    for r in numbers:
        shared = shared & F.arrays_overlap(f"member{r}", f"hub{r}")
    pairs = saved(pairs.join(member, "member").join(hub, "hub").where(shared).select("hub", "member").distinct(), "jaccard-candidates")
    texts = _texts(docs, classes, pairs).mapInArrow(_named(k), "node long, text string")
    parts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / IN_TASK).cast("int").alias("parts"))
    salted = pairs.join(parts, "hub").select("hub", "member", F.pmod(F.xxhash64("member"), F.col("parts")).cast("int").alias("salt"))
    hubs = parts.select("hub", F.col("hub").alias("member"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"))
    rows = salted.unionByName(hubs).join(texts.select(F.col("node").alias("member"), "text"), "member")
    near = rows.withColumn("own", F.col("hub") != F.col("member")).repartition("hub", "salt").sortWithinPartitions("hub", "salt", "own")
    return near.select("hub", "member", "text").mapInArrow(_verify(k, percent), "a long, b long")


def jaccard_classes(docs: DataFrame, *, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType
    fields = [T.StructField("doc_id", kind), T.StructField("n", T.IntegerType()), T.StructField("node", T.LongType()), T.StructField("sign", T.BinaryType()), T.StructField("tokens", T.BinaryType()), T.StructField("counts", T.BinaryType())]
    sets = saved(docs.mapInArrow(_sets(k), T.StructType(fields)), "jaccard-sets")
    tokens = sets.agg(F.sum("n")).first()[0] or 0
    orders = spark.sparkContext.broadcast(Orders(*_heavy(sets), percent))

    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(wide, -(-tokens * (100 - percent) // 100 // IN_BUCKET))
    postings = docs.where("text IS NOT NULL").select("text").mapInArrow(_postings(k, orders, buckets), "bucket int, nodes binary, sizes binary, light binary, counts binary, tokens binary")
    met = saved(postings.groupBy("bucket").applyInArrow(_met(orders), "token long, heavy boolean, node long, n int, light int, leader long, leader_n int"), "jaccard-met")

    like = lambda a, b: F.least(a, b) * 100 >= F.greatest(a, b) * percent
    classes = saved(sets.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("sign").alias("sign")), "jaccard-classes")
    # prefixes longer by SHARED - 1 tokens share SHARED at least, if the sets' overlap has as many
    need = lambda a, b: F.least(F.lit(SHARED), F.ceil(F.greatest(a, b) * percent / 100).cast("int"))
    both = [need(F.col("n"), F.col("leader_n")).alias("need")]
    stars = saved(met.where((F.col("node") != F.col("leader")) & like(F.col("n"), F.col("leader_n"))).select(F.col("leader").alias("hub"), F.col("node").alias("member"), *both).groupBy("hub", "member").agg(F.count("*").alias("shared"), F.first("need").alias("need")).where("shared >= need").select("hub", "member"), "jaccard-stars")
    links = saved(_links(stars, docs, classes, orders, k, percent), "jaccard-links")
    labels = components(links)

    # What is still apart under a token: pairs of different components that were not tried.
    # Whoever has a heavy token in its prefix has all its light ones there, so a pair that meets
    # only under heavy tokens shares heavy ones at most.
    labelled = met.select("token", "heavy", "node", "n", "light").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    apart = labelled.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("token")
    # bands are a little wider than the largest difference in size, so likes are in one band or in two neighbouring ones
    band = F.floor(F.log("n") / F.log(F.lit(101 / percent))).cast("int")
    rest = saved(labelled.join(apart, "token").withColumn("band", band), "jaccard-rest")
    a, b = rest.alias("a"), rest.withColumn("below", F.explode(F.array(F.col("band"), F.col("band") - 1))).alias("b")
    enough = F.least(F.col("a.n") - F.col("a.light"), F.col("b.n") - F.col("b.light")) * (100 + percent) >= (F.col("a.n") + F.col("b.n")) * percent
    rises = F.struct("a.n", "a.node") < F.struct("b.n", "b.node")
    pairs = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.band") == F.col("b.below")) & rises & (F.col("a.label") != F.col("b.label")) & like(F.col("a.n"), F.col("b.n")) & (~F.col("a.heavy") | enough))
    # All tokens that a pair shares are counted here, unless it shares heavy ones and is not `enough`.
    whole = lambda x: F.col(f"{x}.light") >= F.least(F.col(f"{x}.n"), F.col(f"{x}.n") - F.ceil(F.col(f"{x}.n") * percent / 100) + SHARED)
    least = F.when(enough | whole("a") | whole("b"), need(F.col("a.n"), F.col("b.n"))).otherwise(1)
    pairs = pairs.select(F.least("a.node", "b.node").alias("hub"), F.greatest("a.node", "b.node").alias("member"), least.alias("need"))
    pairs = pairs.groupBy("hub", "member").agg(F.count("*").alias("shared"), F.first("need").alias("need")).where("shared >= need").select("hub", "member")
    tried = stars.select(F.least("hub", "member").alias("hub"), F.greatest("hub", "member").alias("member"))
    more = saved(_links(saved(pairs.join(tried, ["hub", "member"], "left_anti"), "jaccard-pairs"), docs, classes, orders, k, percent), "jaccard-links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))

    orders.destroy()  # all that was made with it is written
    known = classes.select("node", "least").join(labels, "node", "left").select("node", "least", F.coalesce("label", "node").alias("label"))
    least = known.groupBy("label").agg(F.min("least").alias("component_id"))
    found = known.join(least, "label").select("node", "component_id")
    out = sets.select("doc_id", "n", "node").join(found, "node", "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _named(k: int):
    """Texts with their class's id; those whose row asked for another class are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column(0).to_pylist()
            node = [node_of(t) if len(t) else None for t in shingle_sets(batch.column(1), k)]
            keep = pa.array([x is not None and (y is None or x == y) for x, y in zip(node, asked, strict=True)], pa.bool_())
            made = pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), batch.column(1)], ["node", "text"])
            yield made.filter(keep)

    return run


def keep_one(docs: DataFrame, *, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows whose doc_id is their component's least; rows without shingles or id all stay, and rows of one id stay or go together."""
    gone = saved(jaccard_classes(docs, k=k, percent=percent).where("doc_id != component_id").select("doc_id").distinct(), "jaccard-gone")
    return docs.join(sized(gone, gone.count(), MOST_BROADCAST), "doc_id", "left_anti").select(*docs.columns)
