"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word's embedding is the sum of a row for the hashed word and one for its
hashed first five bytes, so that unseen compounds of known stems are seen.
Filters of several widths run over the words, the largest response of each
filter over the whole text is kept, and a logistic layer scores them. Since a
filter is linear in each word, prediction adds table rows: every bucket's
response to every filter position is computed once.

Every labelled document that is not held out trains, on its whole text. Words become
bucket numbers once, in the tasks, and are written in shards of about SHARD documents, dealt by
a hash. Embeddings start at each bucket's class log-odds in standard errors, counted over all
shards. In a pass each shard starts from the same model and learns in steps of 64 documents
(Adam); what the shards have changed is averaged, by documents for the filters and by uses for
each bucket's row. The fewer documents, the more passes. A fifth of the documents, by a
hash of doc_id, is kept apart from that and sets a threshold for each language, at which false alarms
weigh FALSE_ALARM times as much as misses; logits are counted in steps of 1 / GRID there. With fewer
than LEAST of a class in that fifth, all rows do both. The lang column of the labelled rows names
the languages; which one a text is in is recognised from its own words, so no score
reads a column but text. Any number of languages have a threshold; those with fewer than
twice OWN rows share the one for all. The model has 128 KB for each language. score is
1 / (1 + exp(threshold - logit)), so 0.5 is the language's threshold.

Null, empty and wordless texts score as no filter responding. Null labels do
not train; a document with several label rows is toxic if any of them says so.
Without both classes among the labels every score is 0. Rows are scored each for
itself, repeated or not, whole however long; memory follows the longest text. An
empty table gives no rows. Other columns stay as they are, whatever their names;
only score and predicted are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._flat import Words, byte_values, flat, slices
from ._store import discard, saved, sized

BITS, DIM, WIDTHS, FILTERS = 15, 8, (1, 2, 3), 8
FALSE_ALARM = 6  # a clean document that is called toxic is lost, and there are far more clean ones
OWN = 20  # rows of each class among those set aside that give a language a threshold of its own
LEAST = 5  # rows of each class that a fifth must have to be set aside
#: Documents that learn one after the other, documents of a step, documents in all passes together at least, passes at most and at least, steps of a logit.
SHARD, BATCH, SEEN, MOST, FEWEST, GRID = 8192, 64, 35_000, 7, 2, 256
UNIT = 1 << 24  # changes are summed as whole numbers of so small parts
SENT = 500_000  # labels that are broadcast
_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x41:0x5B] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True
_VALUES = byte_values(_IS_WORD)
PAD = max(WIDTHS) - 1


def buckets(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word and stem buckets of each word, 1 to 2^BITS and beyond; each text ends with PAD words of bucket 0. And the texts' first words."""
    words = Words(data, offs, _VALUES)
    shift = np.uint64(64 - BITS)
    both = np.stack([(words.hashes >> shift).astype(np.int32) + 1, (words.prefix(5) >> shift).astype(np.int32) + 1 + (1 << BITS)], 1)
    return _padded(both, words.first)


def _padded(both: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(first) - 1
    out = np.zeros((len(both) + PAD * n, 2), np.int32)
    out[np.arange(len(both)) + PAD * np.repeat(np.arange(n), np.diff(first))] = both
    return out, first + PAD * np.arange(n + 1)


def _packed(data: np.ndarray, offs: np.ndarray) -> list[bytes]:
    """The buckets of each text's words, two bytes each."""
    ids, first = buckets(data, offs)
    short = (ids - [1, 1 + (1 << BITS)]).astype(np.uint16)
    return [short[x : y - PAD].tobytes() for x, y in zip(first[:-1], first[1:], strict=True)]


def _unpacked(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows from and to, and their buckets as buckets() has them."""
    data, offs = flat(column)
    for a, b in slices(offs, 1 << 19):
        both = data[offs[a] : offs[b]].view(np.uint16).reshape(-1, 2) + np.array([1, 1 + (1 << BITS)], np.int32)
        yield a, b, *_padded(both.astype(np.int32), (offs[a : b + 1] - offs[a]) // 4)


class Model:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        rows = 2 * (1 << BITS) + 1
        self.emb = rng.normal(0, 0.01, (rows, DIM)).astype(np.float32)
        self.conv = {w: rng.normal(0, 0.15, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.out = np.full(FILTERS * len(WIDTHS), 0.3, np.float32)
        self.out_bias = np.zeros(1, np.float32)
        self.tables: dict[tuple[int, int], np.ndarray] = {}
        self.langs: np.ndarray | None = None
        self.thresholds = np.zeros(1, np.float32)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"tables": {}}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.compile()

    def compile(self) -> Model:
        """Every bucket's response at every filter position."""
        self.emb[0] = 0
        self.tables = {(w, j): np.ascontiguousarray(self.emb @ self.conv[w][j]) for w in WIDTHS for j in range(w)}
        return self

    def responses(self, ids: np.ndarray) -> Iterator[np.ndarray]:
        for w in WIDTHS:
            n, out = len(ids), None
            for j in range(w):
                table = self.tables[w, j]
                part = table[ids[j : n - PAD + j, 0]] + table[ids[j : n - PAD + j, 1]]
                out = part if out is None else np.add(out, part, out=out)
            yield out

    def features(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Largest response of each filter in each text, 0 if there is none."""
        n = len(first) - 1
        out = np.zeros((n, FILTERS * len(WIDTHS)), np.float32)
        full = np.flatnonzero(np.diff(first) > PAD)
        if len(full):
            cut = np.stack([first[full], first[full + 1] - PAD], 1).ravel()
            for k, part in enumerate(self.responses(ids)):
                at = np.minimum(cut, len(part))
                at = at[:-1] if at[-1] >= len(part) else at
                most = np.maximum.reduceat(part, at, axis=0)[::2]
                columns = slice(k * FILTERS, (k + 1) * FILTERS)
                out[full, columns] = np.maximum(most + self.bias[columns], 0)
        return out

    def logits(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.features(ids, first) @ self.out + self.out_bias[0]

    def language(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        n = len(first) - 1
        if self.langs is None or self.langs.shape[1] < 2 or not len(ids):
            return np.zeros(n, np.int64)
        words = ids[:, 0]
        sums = np.stack([np.add.reduceat(self.langs[words, k], first[:-1], dtype=float) for k in range(self.langs.shape[1])], 1)
        return np.argmax(sums, axis=1)

    def scores(self, column: pa.Array) -> np.ndarray:
        data, offs = flat(column)
        out = np.zeros(len(offs) - 1)
        for a, b in slices(offs, 1 << 19):
            ids, first = buckets(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
            logit = self.logits(ids, first) - self.thresholds[self.language(ids, first)]
            out[a:b] = 1 / (1 + np.exp(-np.clip(logit.astype(float), -60, 60)))
        return out


class Learner:
    """A model that learns step by step, and what that has changed."""

    def __init__(self, model: Model, weight: np.ndarray):
        self.model, self.weight = Model.__new__(Model), weight
        self.model.__dict__.update(model.__dict__)
        self.model.emb, self.model.conv = model.emb.copy(), {w: c.copy() for w, c in model.conv.items()}
        self.model.bias, self.model.out, self.model.out_bias = model.bias.copy(), model.out.copy(), model.out_bias.copy()
        self.before = model
        self.params = _dense(self.model)
        self.first_moment, self.second_moment = ({k: np.zeros_like(v) for k, v in self.params.items()} for _ in range(2))
        self.squares, self.used = np.zeros_like(model.emb), np.zeros(len(model.emb), np.int64)
        self.steps = self.seen = 0

    def step(self, parts: list[np.ndarray], toxic: np.ndarray) -> None:
        model = self.model
        model.compile() if self.steps % 8 == 0 else None
        self.steps += 1
        self.seen += len(parts)
        toxic = np.asarray(toxic)
        full = [i for i, x in enumerate(parts) if len(x) > PAD]
        grad = {k: np.zeros_like(v) for k, v in self.params.items()}
        touched, moved = [np.zeros(0, np.int32)], [np.zeros((0, DIM), np.float32)]
        if full:
            ids, first = _joined([parts[i] for i in full])
            raw, where = np.zeros((len(full), FILTERS * len(WIDTHS)), np.float32), np.zeros((len(full), FILTERS * len(WIDTHS)), np.int64)
            each = np.arange(FILTERS)
            for k, part in enumerate(model.responses(ids)):
                columns = slice(k * FILTERS, (k + 1) * FILTERS)
                for i, (x, y) in enumerate(zip(first[:-1], first[1:] - PAD, strict=True)):
                    best = np.argmax(part[x:y], axis=0) + x
                    where[i, columns] = best
                    raw[i, columns] = part[best, each]
            raw += model.bias
            feat = np.maximum(raw, 0)
            p = 1 / (1 + np.exp(-np.clip(feat @ model.out + model.out_bias[0], -30, 30)))
            d = ((p - toxic[full]) * self.weight[toxic[full]] / len(parts)).astype(np.float32)
            back = d[:, None] * model.out * (raw > 0)
            grad["out"], grad["out_bias"], grad["bias"] = d @ feat, d.sum(keepdims=True), back.sum(0)
            for k, w in enumerate(WIDTHS):
                own = back[:, k * FILTERS : (k + 1) * FILTERS]
                for j in range(w):
                    rows = ids[where[:, k * FILTERS : (k + 1) * FILTERS] + j]
                    grad[f"conv{w}"][j] = np.einsum("ifd,if->df", model.emb[rows[..., 0]] + model.emb[rows[..., 1]], own)
                    pull = (own[:, :, None] * model.conv[w][j].T).reshape(-1, DIM)
                    touched += [rows[..., 0].ravel(), rows[..., 1].ravel()]
                    moved += [pull, pull]
        for k, g in grad.items():
            g = g + 1e-4 * self.params[k]
            self.first_moment[k] = 0.9 * self.first_moment[k] + 0.1 * g
            self.second_moment[k] = 0.99 * self.second_moment[k] + 0.01 * g * g
            self.params[k] -= (0.01 * (self.first_moment[k] / (1 - 0.9**self.steps)) / (np.sqrt(self.second_moment[k] / (1 - 0.99**self.steps)) + 1e-6)).astype(np.float32)
        # the rows that the step used, by Adagrad
        rows, inverse, times = np.unique(np.concatenate(touched), return_inverse=True, return_counts=True)
        g = np.zeros((len(rows), DIM), np.float32)
        np.add.at(g, inverse, np.concatenate(moved))
        self.squares[rows] += g * g
        model.emb[rows] -= 0.02 * g / (np.sqrt(self.squares[rows]) + 1e-4)
        self.used[rows] += times

    def changes(self) -> np.ndarray:
        """Rows of the model (row, weight, change times weight): those of buckets by their uses, then all others by documents; whole numbers, so that sums do not depend on their order."""
        at = np.flatnonzero(self.used[1:]) + 1
        emb = (self.model.emb[at].astype(float) - self.before.emb[at]) * self.used[at, None]
        others = (_as_rows(_dense(self.model)) - _as_rows(_dense(self.before))) * self.seen
        rows = np.concatenate([at, len(self.used) + np.arange(len(others))])
        weight = np.concatenate([self.used[at], np.full(len(others), self.seen)])
        return np.hstack([rows[:, None], weight[:, None], np.rint(np.vstack([emb, others]) * UNIT).astype(np.int64)])


def _dense(model: Model) -> dict[str, np.ndarray]:
    return {"bias": model.bias, "out": model.out, "out_bias": model.out_bias} | {f"conv{w}": model.conv[w] for w in WIDTHS}


def _as_rows(params: dict[str, np.ndarray]) -> np.ndarray:
    whole = np.concatenate([x.ravel() for x in params.values()]).astype(float)
    return np.pad(whole, (0, -len(whole) % DIM)).reshape(-1, DIM)


def _moved(model: Model, changes: np.ndarray) -> Model:
    """The model with summed changes of its shards, averaged."""
    rows, mean = changes[:, 0], changes[:, 2:] / UNIT / np.maximum(changes[:, 1:2], 1)
    bucket = rows < len(model.emb)
    model.emb[rows[bucket]] += mean[bucket].astype(np.float32)
    others = np.zeros_like(_as_rows(_dense(model)))
    others[rows[~bucket] - len(model.emb)] = mean[~bucket]
    flat_change, at = others.ravel(), 0
    for x in _dense(model).values():
        x += flat_change[at : at + x.size].reshape(x.shape).astype(np.float32)
        at += x.size
    return model


def _counts(ids: np.ndarray, first: np.ndarray, toxic: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Rows (kind, bucket, n): texts with a bucket for kinds 0 and 1, the classes, and words in it for kind 2 + language."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    size = 2 * (1 << BITS) + 1
    once = np.unique(np.stack([text, text], 1) * size + ids)
    kept = lang[text] >= 0
    keys = np.concatenate([toxic[once // size] * size + once % size, (2 + lang[text][kept]) * size + ids[kept, 0]])
    key, n = np.unique(keys, return_counts=True)
    return np.stack([key // size, key % size, n], 1)


def _begun(counts: np.ndarray, n: np.ndarray, languages: int, seed: int) -> Model:
    """A model before its first pass, from summed counts and the texts of each class."""
    model = Model(seed)
    rows = len(model.emb)
    df = np.zeros((2, rows))
    own = counts[:, 0] < 2
    df[counts[own, 0], counts[own, 1]] = counts[own, 2]
    df[:, 0] = n
    n = n[:, None].astype(float)
    share = df.sum(0) / n.sum()
    rate = (df + 2 * share + 0.01) / (n + 2)
    rate = np.minimum(rate, 0.999)
    odds = np.log(rate[1] / (1 - rate[1])) - np.log(rate[0] / (1 - rate[0]))
    error = np.sqrt(1 / (df[1] + 2 * share + 0.3) + 1 / (df[0] + 2 * share + 0.3))
    z = np.where(df.sum(0) >= 2, odds / error, 0)
    model.emb[:, 0] += np.clip(z, -1, 4)
    for w in WIDTHS:
        model.conv[w][:, 0, :] += 0.3
    model.bias -= 0.5
    if languages > 1:
        words = np.zeros(((1 << BITS) + 1, languages))  # a word's own buckets
        words[counts[~own, 1], counts[~own, 0] - 2] = counts[~own, 2]
        words[0] = 0
        whole = words.sum(0, keepdims=True)
        logs = np.log((words + 0.5 * whole / whole.sum()) / (whole + 0.5)) - np.log(whole / whole.sum() / whole)
        logs[words.sum(1) < 5] = 0
        logs[0] = 0
        model.langs = (logs - logs.mean(1, keepdims=True)).astype(np.float32)
    return model.compile()


def _tally(model: Model, ids: np.ndarray, first: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Rows (language as recognised, class, logit in steps, n)."""
    step = np.rint(np.clip(model.logits(ids, first).astype(float), -1000, 1000) * GRID).astype(np.int64)
    key, n = np.unique(np.stack([model.language(ids, first), toxic, step], 1), axis=0, return_counts=True)
    return np.hstack([key, n[:, None]])


def _calibrated(model: Model, tally: np.ndarray, languages: int, rare: bool) -> Model:
    """The model with a threshold for each language, the last of which stands for all that are rare if there are any."""
    model.thresholds = np.full(max(1, languages), _threshold(tally[:, 1:]), np.float32)
    for k in range(languages - rare):
        own = tally[tally[:, 0] == k]
        if all(own[own[:, 1] == y, 3].sum() >= OWN for y in (0, 1)):
            model.thresholds[k] = _threshold(own[:, 1:])
    return model


def _joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    first = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
    return np.concatenate(parts), first


def _threshold(tally: np.ndarray) -> float:
    """Where missed toxic rows and FALSE_ALARM times the false alarms are fewest, each as a share of its class; the middle of the best stretch. Rows are (class, logit in steps, n)."""
    steps, at = np.unique(tally[:, 1], return_inverse=True)
    n = np.zeros((2, len(steps)))
    np.add.at(n, (tally[:, 0], at), tally[:, 2])
    cuts = np.concatenate([[steps[0] - GRID], (steps[1:] + steps[:-1]) / 2, [steps[-1] + GRID]]) / GRID
    below = np.concatenate([np.zeros((2, 1)), np.cumsum(n, axis=1)], axis=1) / np.maximum(1, n.sum(1, keepdims=True))
    wrong = below[1] + FALSE_ALARM * (1 - below[0])
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return float((cuts[best[0]] + cuts[best[-1]]) / 2)


def _languages(count: dict[str, int]) -> list[str]:
    """Languages with rows enough for a threshold of their own, the most frequent first."""
    return sorted((x for x in count if count[x] >= 2 * OWN), key=lambda x: (-count[x], x))


def _placed(langs: list[str | None], names: list[str], rare: bool) -> np.ndarray:
    """Each row's place among the languages, -1 for none."""
    place = {x: i for i, x in enumerate(names)}
    return np.array([place.get(x, len(names) if rare else -1) if x is not None else -1 for x in langs], np.int64)


def train(texts: pa.ChunkedArray, toxic: np.ndarray, langs: list[str | None], *, epochs: int = 7, seed: int = 7) -> Model | None:
    """Fits a model to rows in memory as fit() does to one shard, or None if they do not hold both classes; the first fifth of each class is set aside."""
    toxic = np.asarray(toxic, np.int64)
    if len(set(toxic.tolist())) < 2:
        return None
    data, offs = flat(texts)
    ids, first = buckets(data, offs)
    held = np.zeros(len(toxic), bool)
    for y in (0, 1):
        held[np.flatnonzero(toxic == y)[: np.sum(toxic == y) // 5]] = True
    fit_rows = np.flatnonzero(~held)
    apart = np.flatnonzero(held) if len(set(toxic[held].tolist())) == 2 else fit_rows
    parts = [ids[x:y] for x, y in zip(first[:-1], first[1:], strict=True)]
    count = {x: langs.count(x) for x in set(langs) if x}
    names, rare = _languages(count), any(n < 2 * OWN for n in count.values())
    lang = _placed(langs, names, rare)
    n = np.bincount(toxic[fit_rows], minlength=2)
    model = _begun(_counts(*_joined([parts[i] for i in fit_rows]), toxic[fit_rows], lang[fit_rows]), n, len(names) + rare, seed)
    for _ in range(epochs):
        learner = Learner(model, n.sum() / (2 * n))
        for lo in range(0, len(fit_rows), BATCH):
            learner.step([parts[i] for i in fit_rows[lo : lo + BATCH]], toxic[fit_rows[lo : lo + BATCH]])
        model = _moved(model, learner.changes()).compile()
    return _calibrated(model, _tally(model, *_joined([parts[i] for i in apart]), toxic[apart]), len(names) + rare, rare)


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that end with text to rows that end with its packed buckets."""
    for batch in batches:
        data, offs = flat(batch.column(batch.num_columns - 1))
        packed = [x for a, b in slices(offs, 1 << 18) for x in _packed(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(packed, pa.binary())], [*batch.schema.names[:-1], "ids"])


def _table(rows: np.ndarray, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x), pa.int64()) for x in rows.T], names)


def _summed(frame: DataFrame, by: list[str]) -> np.ndarray:
    """Rows of whole numbers: the keys and the sums of the other columns."""
    others = [c for c in frame.columns if c not in by]
    got = frame.groupBy(*by).agg(*[F.sum(c).alias(c) for c in others]).toArrow()
    return np.stack([got[c].to_numpy() for c in [*by, *others]], 1).astype(np.int64)


def _each(rows: DataFrame, names: list[str], make) -> DataFrame:
    """Rows (toxic, lang, ids) to rows of whole numbers, made from buckets, first words, classes and languages of some of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, langs = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for a, b, ids, first in _unpacked(batch.column(2)):
                yield _table(make(ids, first, toxic[a:b].astype(np.int64), langs[a:b]), names)

    return rows.select("toxic", "lang", "ids").mapInArrow(run, ", ".join(f"{x} long" for x in names))


def _learnt(shared, weight: np.ndarray):
    """Rows (shard, toxic, ids), those of a shard together, to what each shard changes."""
    names = ["row", "weight", *(f"d{i}" for i in range(DIM))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, learner, parts, marks = None, None, [], []

        def end() -> Iterator[pa.RecordBatch]:
            if learner is not None:
                learner.step(parts, marks) if parts else None
                yield _table(learner.changes(), names)

        for batch in batches:
            shard, toxic = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, b, ids, first in _unpacked(batch.column(2)):
                for i in range(a, b):
                    if shard[i] != at:
                        yield from end()
                        at, learner, parts, marks = shard[i], Learner(shared.value, weight), [], []
                    parts.append(ids[first[i - a] : first[i - a + 1]])
                    marks.append(int(toxic[i]))
                    if len(parts) == BATCH:
                        learner.step(parts, marks)
                        parts, marks = [], []
        yield from end()

    return run, names


def fit(docs: DataFrame, labels: DataFrame, *, shard_rows: int = SHARD, seed: int = 7) -> Model | None:
    """A model from all labelled documents that are not held out, on their whole texts.

    lang, if there, names the languages whose words the model learns to
    recognise; a score depends on the text alone. The driver holds the model and
    sums of its size, no row.
    """
    context = docs.sparkSession.sparkContext
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n_known = known.count()
    if not n_known:
        return None
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    texts = docs.where(F.length("text") > 0).select("doc_id", lang.alias("lang"), "text").join(sized(known, n_known, SENT), "doc_id")
    shards = -(-n_known // shard_rows)
    place = F.xxhash64("doc_id", "text")  # in its shard, and which one
    texts = texts.select((F.xxhash64("doc_id", F.lit(seed)) % 5 == 0).alias("apart"), F.pmod(place, F.lit(shards)).cast("int").alias("shard"), F.xxhash64(place).alias("place"), "toxic", F.nullif("lang", F.lit("")).alias("lang"), "text")
    tokens = texts.mapInArrow(_tokens, T.StructType([*texts.schema.fields[:-1], T.StructField("ids", T.BinaryType())]))
    rows = saved(tokens.repartition(shards, "shard").sortWithinPartitions("shard", "place", "toxic", "lang"), "toxic-shards")
    try:
        n = {(r["toxic"], r["apart"]): r["count"] for r in rows.groupBy("toxic", "apart").count().collect()}
        if len({y for y, _ in n}) < 2:
            return None
        apart = all(n.get((y, True), 0) >= LEAST and (y, False) in n for y in (0, 1))
        own, held = (rows.where("NOT apart"), rows.where("apart")) if apart else (rows, rows)
        n = np.array([sum(k for (y, a), k in n.items() if y == z and not (a and apart)) for z in (0, 1)])
        spoken = rows.where("lang IS NOT NULL").groupBy("lang").count()
        names = _languages({r["lang"]: r["count"] for r in spoken.where(F.col("count") >= 2 * OWN).collect()})
        rare = not spoken.where(F.col("count") < 2 * OWN).isEmpty()
        counts = _each(own, ["kind", "bucket", "n"], lambda ids, first, toxic, langs: _counts(ids, first, toxic, _placed(langs, names, rare)))
        model = _begun(_summed(counts, ["kind", "bucket"]), n, len(names) + rare, seed)
        for _ in range(min(MOST, max(FEWEST, -(-SEEN // int(n.sum()))))):
            shared = context.broadcast(model)
            learn, columns = _learnt(shared, n.sum() / (2 * n))
            changes = own.select("shard", "toxic", "ids").mapInArrow(learn, ", ".join(f"{x} long" for x in columns))
            model = _moved(model, _summed(changes, ["row"])).compile()
            shared.destroy()
        shared = context.broadcast(model)
        tally = _each(held, ["lang", "toxic", "step", "n"], lambda ids, first, toxic, langs: _tally(shared.value, ids, first, toxic))
        tally = _summed(tally, ["lang", "toxic", "step"])
        shared.destroy()
        return _calibrated(model, tally, len(names) + rare, rare)
    finally:
        discard(rows)


def score_toxicity(docs: DataFrame, model: Model | None, *, keep: list[str] | None = None) -> DataFrame:
    """Adds score and predicted to each document row; columns with these names are replaced."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # the text is sent once, whether it is kept or not
    at = keep.index("text") if "text" in keep else len(keep)
    read = docs.select(*keep) if "text" in keep else docs.select(*keep, "text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = shared.value.scores(batch.column(at)) if shared.value is not None else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(got), pa.array((got >= 0.5).astype(np.int32))], [*keep, "score", "predicted"])

    return read.mapInArrow(score, T.StructType([*read.schema.fields[: len(keep)], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))
