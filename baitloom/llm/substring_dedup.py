"""Suffix-array dedup: bytes covered by long strings that also start earlier.

A text is its UTF-8 bytes; matches never cross texts. Whether a string starts
earlier is judged on the input: in a row with a smaller doc_id, or in the same
row, further left.

Texts meet where they share a string. Each window of `length` bytes has an
anchor, the place in it whose 32-byte hash is least, so equal windows have equal
anchors at equal offsets. An anchor and the windows that it stands for form a
stretch. Stretches that agree in anchor and bytes, by 64 bits of each, are copies:
all their windows but the first copy's start earlier too. Copies within a batch are
settled there, so that what a common stretch sends on grows with batches, not rows.
First copies that share an anchor and differ otherwise go to a shard together, where
a suffix array and its common prefixes find the windows that they share.

An anchor with more than `hot` different stretches is cut into single windows,
which are grouped by 128-bit names in Spark, so no shard grows with it.

Null texts count as empty. If doc_id is null, repeated or not an integer, rows
are first numbered by doc_id (null first) and then by their place in the input.
An empty table gives no rows. Texts count whole; memory follows the longest. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._flat import Powers, flat, mix, slices, sliding_min
from ._store import saved, sized
from .suffix import common_prefixes, suffix_array

LENGTH, GRAM, HOT = 100, 32, 20_000
IN_BUCKET, IN_SHARD, MOST_BROADCAST = 600_000, 1_500_000, 1_000_000
_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_powers = Powers(np.uint64(0xB492B66FBE98F273))


def _sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up[: len(data)], out=sums[1:])
    return sums, down


def stretches(data: np.ndarray, offs: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Text, anchor hash, hash of the bytes, first window and window count of each stretch; places are within the slice."""
    n = len(data)
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    sums, down = _sums(data)
    gram = min(GRAM, length)
    hashed = mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
    mask = np.uint64((1 << int(n).bit_length()) - 1)
    least = sliding_min((hashed & ~mask) | np.arange(len(hashed), dtype=np.uint64), length - gram + 1)
    anchor = (least & mask).astype(np.int64)
    text = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[: len(anchor)]
    whole = np.arange(len(anchor)) + length <= offs[text + 1]
    first = whole.copy()
    first[1:] &= ~whole[:-1] | (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    low = np.flatnonzero(first)
    last = whole.copy()
    last[:-1] &= ~whole[1:] | first[1:]
    high = np.flatnonzero(last)
    end = high + length
    left = (anchor[low] - low).astype(np.uint64)
    body = mix((sums[end] - sums[low]) * down[low] + (end - low).astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + left)
    return text[low], hashed[anchor[low]], body, low, high - low + 1


def _found(length: int, buckets: int):
    """(key, text) to rows (bucket, keys, counts, anchors, bodies, lows, widths), arrays of a bucket's stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            data, offs = flat(batch.column(1))
            parts = []
            for a, b in slices(offs, 1 << 19):
                text, anchor, body, low, width = stretches(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], length)
                parts.append((text + a, anchor, body, (low - (offs[a + text] - offs[a])).astype(np.int32), width.astype(np.uint8 if length < 256 else np.int32)))
            if not parts:
                continue
            text, anchor, body, low, width = (np.concatenate(x) for x in zip(*parts, strict=True))
            first = _firsts(anchor, body, keys[text], low)
            out: list[list] = [[] for _ in range(7)]
            cut = np.flatnonzero(~first)
            if len(cut):  # copies of what this batch has earlier are settled; they only travel, to a bucket of no anchor
                who, counts = np.unique(text[cut], return_counts=True)
                _add(out, int(mix(keys[:1].astype(np.uint64))[0] % np.uint64(buckets)), keys[who], counts, None, None, low[cut], width[cut])
            at = np.flatnonzero(first)
            bucket = (mix(anchor[at]) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            at, bucket = at[by], bucket[by]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(bucket)], strict=True):
                own = at[a:b]
                who, counts = np.unique(text[own], return_counts=True)
                _add(out, int(bucket[a]), keys[who], counts, anchor[own], body[own], low[own], width[own])
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *(pa.array(x, pa.binary()) for x in out[1:])], ["bucket", "keys", "counts", "anchors", "bodies", "lows", "widths"])

    return run


def _firsts(anchor: np.ndarray, body: np.ndarray, key: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Which stretches are the earliest of those that agree in anchor and bytes."""
    by = np.argsort(body, kind="stable")
    same = body[by[1:]] == body[by[:-1]]
    again = np.append(same, False) | np.append(False, same)
    by = by[again]
    by = by[np.lexsort((low[by], key[by], anchor[by], body[by]))]
    out = np.ones(len(body), bool)
    out[by[1:]] = (body[by[1:]] != body[by[:-1]]) | (anchor[by[1:]] != anchor[by[:-1]])
    return out


def _add(out: list[list], bucket: int, keys: np.ndarray, counts: np.ndarray, anchors, bodies, lows: np.ndarray, widths: np.ndarray) -> None:
    """A row of arrays; stretches of one text stand together."""
    made = (bucket, keys.tobytes(), counts.astype(np.int32).tobytes(), None if anchors is None else anchors.tobytes(), None if bodies is None else bodies.tobytes(), lows.tobytes(), widths.tobytes())
    for column, x in zip(out, made, strict=True):
        column.append(x)


def _copies(length: int, hot: int):
    """A bucket's stretches to rows (key, low, width, kind, anchor): 0 copies, 1 first copies that share an anchor with others, 2 the same of a hot anchor."""

    kind_of = np.uint8 if length < 256 else np.int32

    def run(table: pa.Table) -> pa.Table:
        settled = table.filter(pa.compute.is_null(table["anchors"]))
        table = table.filter(pa.compute.is_valid(table["anchors"]))
        join = lambda t, name, kind: np.frombuffer(b"".join(x.as_py() for x in t[name]), kind)
        key = np.repeat(join(table, "keys", np.int64), join(table, "counts", np.int32))
        anchor, body = join(table, "anchors", np.uint64), join(table, "bodies", np.uint64)
        low, width = join(table, "lows", np.int32), join(table, "widths", kind_of).astype(np.int32)
        travelled = [np.repeat(join(settled, "keys", np.int64), join(settled, "counts", np.int32)), join(settled, "lows", np.int32), join(settled, "widths", kind_of).astype(np.int32)]
        by = np.argsort(anchor, kind="stable")
        again = np.zeros(len(by), bool)
        same = anchor[by[1:]] == anchor[by[:-1]]
        again[1:] |= same
        again[:-1] |= same
        by = by[again]
        by = by[np.lexsort((low[by], key[by], body[by], anchor[by]))]
        key, anchor, body, low, width = key[by], anchor[by], body[by], low[by], width[by]
        new_anchor = np.ones(len(by), bool)
        new_anchor[1:] = anchor[1:] != anchor[:-1]
        new_body = new_anchor.copy()
        new_body[1:] |= body[1:] != body[:-1]
        group = np.cumsum(new_anchor) - 1
        bodies = np.bincount(group, weights=new_body, minlength=1) if len(by) else np.zeros(1)
        kind = np.where(new_body, np.where(bodies[group] > hot, 2, np.where(bodies[group] > 1, 1, -1)), 0) if len(by) else np.zeros(0, np.int64)
        on = kind >= 0
        key, low, width = (np.concatenate([x[on], y]) for x, y in zip((key, low, width), travelled, strict=True))
        none = np.zeros(len(travelled[0]), np.int64)
        return pa.table({"key": key, "low": low, "width": width, "kind": np.concatenate([kind[on], none]).astype(np.int32), "anchor": np.concatenate([anchor[on].view(np.int64), none])})

    return run


def _cut_out(length: int):
    """(text, key, stretches) to rows (key, low, anchor, name, part): a stretch's bytes, or of hot anchors a window's 128-bit name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, low, anchor, name, part = [], [], [], [], []
            for text, k, own in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = (text.as_py() or "").encode()
                for x in own:
                    if x["kind"] == 2:  # single windows, by a hash of their bytes
                        for at in range(x["low"], x["low"] + x["width"]):
                            key.append(k)
                            low.append(at)
                            anchor.append(x["anchor"])
                            name.append(hashlib.blake2b(data[at : at + length], digest_size=16).digest())
                            part.append(None)
                    else:
                        key.append(k)
                        low.append(x["low"])
                        anchor.append(x["anchor"])
                        name.append(None)
                        part.append(data[x["low"] : x["low"] + x["width"] + length - 1])
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(low, pa.int32()), pa.array(anchor, pa.int64()), pa.array(name, pa.binary()), pa.array(part, pa.binary())], ["key", "low", "anchor", "name", "part"])

    return run


def _shared(length: int):
    """A shard's stretches to rows (key, low, width): runs of windows that start earlier in the shard."""

    def run(table: pa.Table) -> pa.Table:
        key, low = table["key"].to_numpy(), table["low"].to_numpy().astype(np.int64)
        data, offs = flat(table["part"])
        size = np.diff(offs)
        start = offs[:-1] + np.arange(len(size))
        s = np.zeros(len(data) + len(size), np.int64)
        s[np.arange(len(data)) + np.repeat(np.arange(len(size)), size)] = data.astype(np.int64) + 1
        sa = suffix_array(s)
        common = common_prefixes(s, sa)[sa]
        group = np.cumsum(common < length)
        owner = np.searchsorted(start, sa, "right") - 1
        offset = sa - start[owner]
        window = offset + length <= size[owner]
        group, owner, offset = group[window], owner[window], offset[window]
        place = low[owner] + offset
        by = np.lexsort((place, key[owner], group))
        again = np.zeros(len(by), bool)
        again[1:] = group[by[1:]] == group[by[:-1]]
        by = by[again]
        owner, offset = owner[by], offset[by]
        by = np.lexsort((offset, owner))
        owner, offset = owner[by], offset[by]
        new = np.ones(len(by), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)
        at = np.flatnonzero(new)
        return pa.table({"key": key[owner[at]], "low": (low[owner[at]] + offset[at]).astype(np.int32), "width": np.diff(np.append(at, len(by))).astype(np.int32)})

    return run


def _remove(length: int, kept: bool):
    """(text, key, doc_id, runs) to the result's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, own in zip(batch.column(0), batch.column(2), strict=True):
                data = (text.as_py() or "").encode()
                if own.is_valid and len(own.values):
                    fields = own.values
                    low, width = fields.field("low").to_numpy(), fields.field("width").to_numpy()
                    edges = np.zeros(len(data) + 1, np.int64)
                    np.add.at(edges, low, 1)
                    np.add.at(edges, low + width + length - 1, -1)
                    gone = np.cumsum(edges[:-1]) > 0
                    n, spans = int(gone.sum()), int(np.sum(gone[1:] & ~gone[:-1]) + gone[:1].sum())
                    rest = np.frombuffer(data, np.uint8)[~gone].tobytes()
                else:
                    n, spans, rest = 0, 0, data
                rows.append((len(data), n, spans, hashlib.sha256(rest).hexdigest(), rest if kept else None))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(1), *made[: 5 if kept else 4]], [*_NAMES[: 6 if kept else 5]])

    return run


_NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, key and text, where keys are integers that rise with doc_id."""
    if isinstance(docs.schema["doc_id"].dataType, (T.LongType, T.IntegerType)):
        ids = docs.agg(F.count("*"), F.count("doc_id"), F.countDistinct("doc_id")).first()
        if ids[0] == ids[1] == ids[2]:
            return docs.select("doc_id", F.col("doc_id").cast("long").alias("key"), "text")
    placed = saved(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("place")), "dedup-placed")
    ordered = placed.orderBy(F.asc_nulls_first("doc_id"), "place")
    return saved(ordered.select("doc_id", F.monotonically_increasing_id().alias("key"), "text"), "dedup-keyed")


def repeated_runs(keyed: DataFrame, *, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(key, low, width): windows low to low + width - 1 of these texts start earlier elsewhere."""
    spark = keyed.sparkSession
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bytes_ = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    density = 2 / (length - min(GRAM, length) + 2)
    buckets = max(wide, int(bytes_ * density / IN_BUCKET))
    read = keyed.where(F.octet_length("text") >= length).select("key", "text")
    found = read.mapInArrow(_found(length, buckets), "bucket int, keys binary, counts binary, anchors binary, bodies binary, lows binary, widths binary")
    met = saved(found.groupBy("bucket").applyInArrow(_copies(length, hot), "key long, low int, width int, kind int, anchor long"), "dedup-met")
    copies = met.where("kind = 0").select("key", "low", "width")
    near = met.where("kind > 0").groupBy("key").agg(F.collect_list(F.struct("low", "width", "kind", "anchor")).alias("own"))
    near = saved(near, "dedup-near")
    size = near.agg(F.count("*"), F.sum(F.size("own"))).first()
    texts = keyed.select("key", "text")
    if size[0] <= MOST_BROADCAST:
        texts = texts.join(F.broadcast(near.select("key")), "key", "left_semi")
    cut = texts.join(near, "key").select("text", "key", "own").mapInArrow(_cut_out(length), "key long, low int, anchor long, name binary, part binary")
    cut = saved(cut, "dedup-cut")
    shards = max(wide, (size[1] or 0) * (length + length // 3) // IN_SHARD)
    parts = cut.where("part IS NOT NULL").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int"))
    shared = parts.groupBy("shard").applyInArrow(_shared(length), "key long, low int, width int")
    windows = cut.where("part IS NULL").select("name", "key", "low")
    first = windows.groupBy("name").agg(F.min(F.struct("key", "low")).alias("first"))
    single = windows.join(first, "name").where(F.struct("key", "low") != F.col("first")).select("key", "low", F.lit(1).alias("width"))
    return copies.unionByName(shared).unionByName(single)


def dedup_substrings(docs: DataFrame, *, length: int = LENGTH, hot: int = HOT, kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row; with `kept`, the remaining bytes too."""
    keyed = _keyed(docs.select("doc_id", "text"))
    runs = repeated_runs(keyed, length=length, hot=hot)
    runs = saved(runs.groupBy("key").agg(F.collect_list(F.struct("low", "width")).alias("runs")), "dedup-runs")
    empty = F.coalesce("text", F.lit(""))
    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(x, T.LongType()) for x in _NAMES[1:4]), T.StructField("kept_sha256", T.StringType())]
    fields += [T.StructField("kept", T.BinaryType())] if kept else []
    schema = T.StructType(fields)
    n = runs.count()
    if n > MOST_BROADCAST:
        return keyed.join(runs, "key", "left").select("text", "doc_id", "runs").mapInArrow(_remove(length, kept), schema)
    keys = F.broadcast(runs.select("key"))
    whole = keyed.join(keys, "key", "left_anti").select(
        "doc_id", F.octet_length(empty).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.sha2(empty, 256).alias("kept_sha256"), *([F.encode(empty, "UTF-8").alias("kept")] if kept else [])
    )
    changed = keyed.join(keys, "key", "left_semi").join(runs, "key").select("text", "doc_id", "runs").mapInArrow(_remove(length, kept), schema)
    return whole.unionByName(changed)
