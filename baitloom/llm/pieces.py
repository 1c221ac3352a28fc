"""SentencePiece encoding and decoding with a weighted finite-state transducer.

Three machines are compiled from a model file. The normaliser writes a dummy
prefix and U+2581 for a space, and copies other characters. The pieces are a trie
whose final arcs write a piece and weigh minus its score; a character that is no
piece has a fallback arc, which writes its bytes. An acceptor weighs each pair of
neighbouring pieces. Normaliser and pieces are composed once. That machine is
composed with each input, which gives a lattice, and the encoding is the lattice's
shortest path in the tropical semiring: weights add along a path, the least wins.

The acceptor takes every pair in a unigram model, where arcs carry the scores. In a
merge (BPE) model a sequence of pieces is the encoding exactly when each pair of
neighbours is: merging the pair's own characters, best piece first and leftmost
among equals, ends in that pair. The acceptor weighs such pairs 0 and others
infinity, and arcs weigh nothing, so the shortest path is the one finite path.

Where no piece of the model goes across, between words and between letters and
other characters, the lattice falls apart; each different part is composed once
per task, in a memo of at most MEMO entries that ends with the task.

Each row is encoded by itself: repeated rows, and rows with a null id, give what
one row does. Null texts count as empty; empty texts have no pieces. An empty table
gives no rows. A very long text is one row of one task, and takes memory in
proportion to its length. Other columns stay as they are, whatever their names.
U+2581 in a text decodes to a space, as the model's own normaliser has it. Models
with a precompiled character map, white-space trimming or suffix marks are refused.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._store import free_name

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
MEMO = 120_000
INFINITE = float("inf")


@dataclass(frozen=True)
class Pieces:
    """What is read from a model file."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]  # of bytes 0 to 255, empty without fallback
    unknown: int
    special: frozenset[int]
    merges: bool
    dummy_prefix: bool

    @staticmethod
    def read(path: str) -> Pieces:
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        norm, trainer = model.normalizer_spec, model.trainer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or trainer.treat_whitespace_as_suffix or not norm.escape_whitespaces:
            raise ValueError("models with a character map, trimming or suffix marks are not supported")
        if trainer.model_type not in (1, 2):
            raise ValueError("unigram and merge models only")
        kinds = [p.type for p in model.pieces]
        by_name = {p.piece: i for i, p in enumerate(model.pieces)}
        return Pieces(
            tuple(p.piece for p in model.pieces),
            tuple(p.score for p in model.pieces),
            tuple(by_name[f"<0x{b:02X}>"] for b in range(256)) if trainer.byte_fallback else (),
            kinds.index(2),
            frozenset(i for i, k in enumerate(kinds) if k != 1),
            trainer.model_type == 2,
            norm.add_dummy_prefix,
        )


@dataclass
class Machine:
    """A weighted transducer. State 0 is its start; an arc reads a character and writes one, or with `writes` a piece at its end."""

    arcs: dict[tuple[int, str], int] = field(default_factory=dict)
    writes: list[int] = field(default_factory=lambda: [-1])  # by state: the piece that may be written there, after which the start follows
    weights: list[float] = field(default_factory=lambda: [INFINITE])

    def add(self, text: str, piece: int, weight: float) -> None:
        at = 0
        for c in text:
            to = self.arcs.get((at, c))
            if to is None:
                to = self.arcs[at, c] = len(self.writes)
                self.writes.append(-1)
                self.weights.append(INFINITE)
            at = to
        self.writes[at], self.weights[at] = piece, weight


def pieces_machine(model: Pieces) -> Machine:
    """The trie of all ordinary pieces; arcs of merge models weigh nothing."""
    out = Machine()
    for i, p in enumerate(model.pieces):
        if i not in model.special:
            out.add(p, i, 0.0 if model.merges else -model.scores[i])
    return out


#: The normaliser's arcs that do not copy: what is read, and what is written.
NORMALISER = {" ": MARK}


def composed(first: dict[str, str], second: Machine) -> list[dict[str, int]]:
    """Arcs, by state, of a one-state transducer followed by a machine: it reads what the first reads and goes where the second goes."""
    out: list[dict[str, int]] = [{} for _ in second.writes]
    for (state, c), to in second.arcs.items():
        if c not in first:
            out[state][c] = to
        for read, written in first.items():
            if written == c:
                out[state][read] = to
    return out


class Transducer:
    """The compiled model."""

    def __init__(self, model: Pieces):
        self.model = model
        machine = pieces_machine(model)
        self.arcs, self.writes, self.weights = composed(NORMALISER, machine), machine.writes, machine.weights
        # a character without a piece costs more than any other path, as unigram models have it
        self.fallback = 0.0 if model.merges else 10.0 - min((s for i, s in enumerate(model.scores) if i not in model.special), default=0.0)
        self.ranks = {p: -model.scores[i] for i, p in enumerate(model.pieces) if i not in model.special}
        self.splits: dict[str, int] = {}
        self.pairs: dict[int, bool] = {}
        self.memo: dict[str, bytes] = {}
        self.words = self._words()
        self.bytes_of = {i: b for b, i in enumerate(model.byte_ids)}
        self.high = np.zeros(len(model.pieces), bool)  # bytes that are not characters by themselves
        self.high[list(model.byte_ids[128:])] = True
        self.surface = [(chr(self.bytes_of[i]) if i in self.bytes_of else " ⁇ " if i == model.unknown else "" if i in model.special else p.replace(MARK, " ")) for i, p in enumerate(model.pieces)]

    def _words(self) -> re.Pattern:
        """Where lattices fall apart: no piece may go across. The finest of three ways that the pieces allow."""
        odd = "".join(sorted({c for p in self.ranks for c in p if re.match(r"[^\W\d_]", c) and not c.isalpha()}))
        mark, letter = f"[ {MARK}]", (f"(?![{re.escape(odd)}])" if odd else "") + r"[^\W\d_]"
        fine = f"{mark}*+(?:[A-Za-z]++|{letter})++|{mark}*+(?:(?!{letter})[^ {MARK}])++|{mark}++"
        for way in (fine, f"{mark}*+[^ {MARK}]++|{mark}++"):
            cut = re.compile(f"(?s){way}")
            if all(cut.fullmatch(p) and len(cut.findall(p)) == 1 for p in self.ranks):
                return cut
        return re.compile("(?s).+")

    def weight(self, left: int, right: int) -> float:
        """The acceptor's weight of two neighbouring pieces."""
        if not self.model.merges:
            return 0.0
        key = left << 32 | right
        good = self.pairs.get(key)
        if good is None:
            if len(self.pairs) >= MEMO:
                self.pairs.clear()
            good = self.pairs[key] = self._stays(self.model.pieces[left], self.model.pieces[right])
        return 0.0 if good else INFINITE

    def _stays(self, a: str, b: str) -> bool:
        """Whether merging the characters of a and b keeps the border between them.

        Undoing the later merge of the two, step by step, gives all pairs that
        ever meet at the border; one of them merges if its piece is better than
        the merge that replaced it, or as good and further left.
        """
        ranks, limit = self.ranks, (INFINITE, 1)
        while True:
            whole = ranks.get(a + b)
            if whole is not None and (whole, 0) < limit:
                return False
            ra, rb = (ranks[x] if len(x) > 1 else -INFINITE for x in (a, b))
            if ra == rb == -INFINITE:
                return True
            if ra > rb:  # a was merged last: until then the border's left neighbour was its right part
                limit, a = (ra, 0), a[self._split(a) :]
            else:  # of equals the left one merges first, so b's is undone first
                limit, b = (rb, 1), b[: self._split(b)]

    def _split(self, piece: str) -> int:
        """Where the last merge of a piece's characters joined it."""
        at = self.splits.get(piece)
        if at is None:
            parts = list(piece)
            while len(parts) > 2:
                best = min(((r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None), default=None)
                if best is None:
                    break
                i = best[1]
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            at = self.splits[piece] = len(parts[0])
        return at

    def path(self, word: str) -> list[int]:
        """The shortest path through the lattice of a word: pieces, and -1 less the code point of characters without one.

        Places are settled by rising cost, the furthest first among equals, so in
        a merge model hardly more of the lattice is composed than the path.
        """
        n, arcs, writes, weights, pairs = len(word), self.arcs, self.writes, self.weights, self.pairs
        last: list[int | None] = [None] * (n + 1)
        back = [0] * (n + 1)
        last[0] = -1
        ahead: list[tuple[float, int, int, int]] = []  # (cost, -end, start, piece) of arcs that are not weighed by the acceptor yet
        at, cost = 0, 0.0
        while at < n:
            state, end, found = 0, at, False
            while end < n and (to := arcs[state].get(word[end])) is not None:
                state = to
                end += 1
                if writes[state] >= 0:
                    found = found or end == at + 1
                    if last[end] is None:
                        heappush(ahead, (cost + weights[state], -end, at, writes[state]))
            if not found and last[at + 1] is None:
                heappush(ahead, (cost + self.fallback, -at - 1, at, -1 - ord(word[at])))
            while True:
                cost, end, start, piece = heappop(ahead)
                if last[-end] is None:
                    before = last[start]
                    good = pairs.get(before << 32 | piece) if before >= 0 <= piece else True
                    if good or (good is None and self.weight(before, piece) == 0):
                        break
            at = -end
            last[at], back[at] = piece, start
        out = []
        while at:
            out.append(last[at])
            at = back[at]
        return out[::-1]

    def encode_word(self, word: str) -> bytes:
        ids: list[int] = []
        unknown = False
        for x in self.path(word):
            if x >= 0:
                ids.append(x)
            elif self.model.byte_ids:
                ids += [self.model.byte_ids[b] for b in chr(-1 - x).encode()]
            elif not unknown:  # neighbouring unknown characters are one piece
                ids.append(self.model.unknown)
            unknown = x < 0
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        if not text:
            return b""
        if self.model.dummy_prefix:  # the normaliser's start
            text = MARK + text
        out, memo = [], self.memo
        for word in self.words.findall(text):
            got = memo.get(word)
            if got is None:
                got = self.encode_word(word)
                if len(word) <= 64 and len(memo) < MEMO:  # frequent words come early
                    memo[word] = got
            out.append(got)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids; byte pieces are joined and read as UTF-8, wrong bytes as U+FFFD each."""
        array = np.frombuffer(ids, "<u4")
        numbers = array.tolist()
        surface = self.surface
        if not self.high[array].any():
            text = "".join([surface[i] for i in numbers])
        else:
            out: list[str] = []
            run: list[int] = []
            bytes_of = self.bytes_of
            for i in numbers:
                b = bytes_of.get(i)
                if b is not None:
                    run.append(b)
                    continue
                if run:
                    out.append(_read_bytes(bytes(run)))
                    run.clear()
                out.append(surface[i])
            if run:
                out.append(_read_bytes(bytes(run)))
            text = "".join(out)
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


def _read_bytes(run: bytes) -> str:
    out, at = [], 0
    while at < len(run):
        for n in (1, 2, 3, 4):
            try:
                out.append(run[at : at + n].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            n = 1
        at += n
    return "".join(out)


def _mapped(docs: DataFrame, source: str, keep: list[str], made: list[T.StructField], model: str, work) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(Pieces.read(model))
    read = docs.select(F.col(source).alias(free_name("text", keep)), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = None  # compiled once per task, so that its memos end with the task
        for batch in batches:
            transducer = transducer or Transducer(shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *work(transducer, batch.column(0))], [*keep, *(f.name for f in made)])

    return read.mapInArrow(run, T.StructType([*read.schema.fields[1:], *made]))


def encode(docs: DataFrame, *, model: str = MODEL, keep: list[str] | None = None) -> DataFrame:
    """Adds `ids`, the pieces of each row's text; a column of that name is replaced."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != "ids"]

    def work(t: Transducer, texts: pa.Array) -> list[pa.Array]:
        got = [np.frombuffer(t.encode(x.as_py() or ""), "<u4").astype(np.int32) for x in texts]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*got, np.zeros(0, np.int32)])))]

    return _mapped(docs, "text", keep, [T.StructField("ids", T.ArrayType(T.IntegerType()))], model, work)


def decode(encoded: DataFrame, *, model: str = MODEL, keep: list[str] | None = None) -> DataFrame:
    """Adds `text`, that of each row's ids (null: empty); a column of that name is replaced."""
    keep = [c for c in (encoded.columns if keep is None else keep) if c != "text"]

    def work(t: Transducer, ids: pa.Array) -> list[pa.Array]:
        return [pa.array([t.decode(np.array(x.as_py() or [], "<u4").tobytes()) for x in ids], pa.string())]

    return _mapped(encoded, "ids", keep, [T.StructField("text", T.StringType())], model, work)


def digest(docs: DataFrame, *, model: str = MODEL, keep: list[str] | None = None) -> DataFrame:
    """Encodes each row's text, decodes it again, and adds what was found.

    n_pieces and n_bytes (byte-fallback pieces), ids_sha256 over the ids as
    little-endian 32-bit numbers, decoded_sha256, and round_trip, whether the
    decoded text is the text.
    """
    made = [T.StructField("n_pieces", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()), T.StructField("round_trip", T.BooleanType())]
    names = [f.name for f in made]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names]

    def work(t: Transducer, texts: pa.Array) -> list[pa.Array]:
        rows = []
        by_byte = np.zeros(len(t.model.pieces), bool)
        by_byte[list(t.model.byte_ids)] = True
        for x in texts:
            text = x.as_py() or ""
            ids = t.encode(text)
            back = t.decode(ids)
            rows.append((len(ids) // 4, int(by_byte[np.frombuffer(ids, "<u4")].sum()), hashlib.sha256(ids).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), back == text))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
        return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]

    return _mapped(docs, "text", keep, made, model, work)
