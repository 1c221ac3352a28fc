"""Matching probes to genomes: seeds, diagonals, extension.

Genomes are cut into overlapping chunks. Probes come in blocks of bounded size; a
block's words of 13 letters, both strands, are an index that is broadcast, and each
chunk is matched against it where it lies, so nothing of a genome is shuffled,
however often its words occur. A word that both have names a diagonal, on which the
best segment is found without gaps, or, with `gapped`, within a band around it.

Every hit that reaches the cut-offs counts, but one that lies inside a better one
of the same probe and strand, on the probe and on the target. No hit is capped.

Null and empty sequences match nothing. Repeated probe or target rows are matched
each for itself. Letters other than A, C, G and T match nothing; case is ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import pieces_of, reverse_complement
from ..store import saved

_CODE = np.full(256, 4, np.uint8)
_CODE[np.frombuffer(b"ACGTacgt", np.uint8)] = [0, 1, 2, 3, 0, 1, 2, 3]
MATCH, MISMATCH = 1, -2
#: Of banded alignments, twice the score: a match, a mismatch and a gap's letter.
DOUBLED, REACH = (2, -4, -5), 16
PROBES_AT_ONCE, CHUNK, HITS_AT_ONCE, ROWS_AT_ONCE, BANDS_AT_ONCE = 20_000, 16_384, 1 << 20, 1 << 15, 2048
ALIGNMENT = "probe_id string, target_id {0}, pident double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int, score int"


def letter_matrix(seqs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of letters, a row for each sequence, 4 where there is no A, C, G or T; and the lengths."""
    lengths = np.array([len(s) for s in seqs], np.int64)
    out = np.full((len(seqs), int(lengths.max(initial=0))), 4, np.uint8)
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = _CODE[np.frombuffer("".join(seqs).encode("ascii", "replace"), np.uint8)]
    return out, lengths


def words_of(codes: np.ndarray, word: int) -> tuple[np.ndarray, np.ndarray]:
    """Along the last axis, each word (of 31 letters at most) as a number, two bits a letter, and whether all its letters are known."""
    n = codes.shape[-1] - word + 1
    if n < 1:
        none = np.zeros((*codes.shape[:-1], 0))
        return none.astype(np.int32), none.astype(bool)
    number, good = np.zeros((*codes.shape[:-1], n), np.int32 if word < 16 else np.int64), np.ones((*codes.shape[:-1], n), bool)
    for i in range(word):
        part = codes[..., i : i + n]
        number = number * 4 + (part & 3)
        good &= part < 4
    return number, good


def dust_mask(codes: np.ndarray, window: int = 64, level: float = 20.0) -> np.ndarray:
    """Which letters are in a stretch of low complexity: triplets that repeat more often than the level allows."""
    out = np.zeros(len(codes), bool)
    if len(codes) < 4:
        return out
    triplet = (codes[:-2] & 3).astype(np.int64) * 16 + (codes[1:-1] & 3) * 4 + (codes[2:] & 3)
    step = window // 2
    for at in range(0, max(1, len(triplet) - step), step):
        part = triplet[at : at + window - 2]
        counts = np.bincount(part, minlength=64)
        score = float(np.sum(counts * (counts - 1)) / 2) / max(1, len(part) - 1) * 10
        if score > level:
            out[at : at + len(part) + 2] = True
    return out


class Index:
    """Sequences by their words."""

    def __init__(self, seqs: list[str], word: int, dust: bool = False):
        self.word = word
        self.codes, self.lengths = letter_matrix(seqs)
        number, self.known = words_of(self.codes, word)
        if dust:
            for i in range(len(seqs)):
                mask = np.concatenate([[0], np.cumsum(dust_mask(self.codes[i, : self.lengths[i]]))])
                n = len(mask) - word
                if n > 0:
                    self.known[i, :n] &= mask[word:] == mask[:n]
        place = np.flatnonzero(self.known.ravel())
        words = number.ravel()[place]
        self.bitmap = np.zeros(-(-(4**word) // 8), np.uint8)  # of fixed size, however many words there are
        np.bitwise_or.at(self.bitmap, words >> 3, (1 << (words & 7)).astype(np.uint8))
        # by word and the letter before it, 4 if no word begins there
        before = np.full(self.known.shape, 4, np.uint8)
        before[:, 1:] = np.where(self.known[:, :-1], self.codes[:, : before.shape[1] - 1], 4)
        keys = words * 5 + before.ravel()[place]
        by = np.argsort(keys, kind="stable")
        self.keys, self.places = keys[by], place[by].astype(np.int32)

    def meetings(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place, row, place in the row) where a common run of letters with a word begins; a bounded number at a time.

        A run begins where the letters before differ, so holders of a word with
        the same letter before it are passed over.
        """
        width = self.known.shape[1]
        number, good = words_of(codes, self.word)
        at = np.flatnonzero(good)
        at = at[(self.bitmap[number[at] >> 3] >> (number[at] & 7).astype(np.uint8)) & 1 == 1]
        letter = np.where(at > 0, codes[np.maximum(at - 1, 0)], 4)
        word = number[at] * 5
        low, high = np.searchsorted(self.keys, word), np.searchsorted(self.keys, word + 5)
        same, after = np.searchsorted(self.keys, word + letter), np.searchsorted(self.keys, word + letter + 1)
        same, after = np.where(letter < 4, same, low), np.where(letter < 4, after, low)
        count = same - low + high - after
        upto = np.cumsum(count)
        start = 0
        while start < len(at):
            done = int(upto[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(upto, done + HITS_AT_ONCE, "right")))
            n = count[start:end]
            part = slice(start, end)
            hit = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            hit += np.repeat(low[part], n) + np.where(hit < np.repeat(same[part] - low[part], n), 0, np.repeat(after[part] - same[part], n))
            row, p = np.divmod(self.places[hit], width)
            yield np.repeat(at[part], n), row, p
            start = end

    def diagonals(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and distances (place less place in the row), each pair once, by row."""
        span = len(codes) + self.codes.shape[1]
        keys = [np.unique(row.astype(np.int64) * span + (t - p) + self.codes.shape[1]) for t, row, p in self.meetings(codes)]
        key = np.unique(np.concatenate([*keys, np.zeros(0, np.int64)]))
        return key // span, key % span - self.codes.shape[1]


def laid_on(codes: np.ndarray, diag: np.ndarray, width: int) -> np.ndarray:
    """Letters of a sequence from each diagonal on, 5 where it has none."""
    padded = np.concatenate([np.full(width, 5, np.uint8), codes, np.full(width, 5, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(padded, width)[np.clip(diag + width, 0, len(codes) + width)]


def best_segments(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Best segment of each row of a laid on that of b: score, first, last, equal letters.

    Of equal scores the one that ends first, then the one that starts first.
    """
    n, width = a.shape
    same = (a == b) & (a < 4)
    step = np.where(same, MATCH, MISMATCH).astype(np.int16)
    total = np.cumsum(step, axis=1, dtype=np.int16)
    before = np.concatenate([np.zeros((n, 1), np.int16), total[:, :-1]], axis=1)
    least = np.minimum.accumulate(before, axis=1)
    gain = total - least
    last = np.argmax(gain, axis=1)
    rows = np.arange(n)
    first = np.argmax((before == least[rows, last][:, None]) & (np.arange(width)[None, :] <= last[:, None]), axis=1)
    counts = np.concatenate([np.zeros((n, 1), np.int32), np.cumsum(same, axis=1)], axis=1)
    return gain[rows, last].astype(np.int32), first, last, counts[rows, last + 1] - counts[rows, first]


def banded(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Best local alignment of each row of a within a band of b, which starts REACH letters before and is 2 REACH wider.

    Score, first and last on a, first and last on b, equal letters, columns,
    gaps. Of equal scores a letter pair goes before a gap.
    """
    match, mismatch, gap = DOUBLED
    n, width = a.shape
    band = 2 * REACH + 1
    # of each cell: score, first of a, first of b, equal letters, columns, gaps, kind of the last step
    row = np.zeros((7, n, band), np.int32)
    best = np.zeros((8, n), np.int32)
    for i in range(width):
        same = (a[:, i : i + 1] == b[:, i : i + band]) & (a[:, i : i + 1] < 4)
        fresh = row[0] <= 0
        new = row.copy()
        new[1] = np.where(fresh, i, row[1])
        new[2] = np.where(fresh, i + np.arange(band)[None, :], row[2])
        new[3:6] = np.where(fresh[None], 0, row[3:6])
        new[0] = np.maximum(row[0], 0) + np.where(same, match, mismatch)
        new[3] += same
        new[4] += 1
        new[6] = 0
        up = row[:, :, 1:].copy()  # a letter of a beside a gap
        up[0] += gap
        up[4] += 1
        up[5] += up[6] != 1
        up[6] = 1
        new[:, :, :-1] = np.where((up[0] > new[0, :, :-1])[None], up, new[:, :, :-1])
        for k in range(1, band):  # a letter of b beside a gap
            left = new[:, :, k - 1].copy()
            left[0] += gap
            better = left[0] > np.maximum(new[0, :, k], 0)
            if better.any():
                left[4] += 1
                left[5] += left[6] != 2
                left[6] = 2
                new[:, :, k] = np.where(better[None], left, new[:, :, k])
        k = np.argmax(new[0], axis=1)
        rows = np.arange(n)
        top = new[:, rows, k]
        better = top[0] > best[0]
        found = np.stack([top[0], top[1], np.full(n, i), top[2], i + k, top[3], top[4], top[5]])
        best = np.where(better[None], found, best)
        row = new
    return tuple(best)


def band_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each row the score that banded finds, and nothing else: gaps along the band are a running maximum, and no cell knows where it came from."""
    match, mismatch, gap = DOUBLED
    n, width = a.shape
    band = 2 * REACH + 1
    probe, on = np.ascontiguousarray(np.where(a < 4, a, 9).T), np.ascontiguousarray(b.T)
    ramp = (np.arange(band, dtype=np.int16) * -gap)[:, None]
    step = np.array([mismatch, match], np.int16)
    row, best = np.zeros((band, n), np.int16), np.zeros(n, np.int16)
    for i in range(width):
        new = row + step[(on[i : i + band] == probe[i]).view(np.uint8)]
        np.maximum(new[:-1], row[1:] + np.int16(gap), out=new[:-1])
        new += ramp
        np.maximum.accumulate(new, axis=0, out=new)
        new -= ramp
        row = np.maximum(new, 0, out=new)
        np.maximum(best, row.max(axis=0), out=best)
    return best


def _bands(row: np.ndarray, diag: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
    """One diagonal for all of a row in the same stretch of REACH, its middle; stretches lie on the target as a whole."""
    made = np.unique(np.stack([row, (diag + at) // REACH]), axis=1)
    return made[0], made[1] * REACH + REACH // 2 - at


def _inside_a_better(row: np.ndarray, score: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """Which hits lie inside another of their row that scores as high; of equal ones all but the first.

    ranges: first and last on the probe and on the target. Hits stand by row and place.
    """
    out = np.zeros(len(row), bool)
    reach = np.flatnonzero(row[1:] == row[:-1])
    shift = 1
    while len(reach):
        i, j = reach, reach + shift
        near = (row[i] == row[j]) & (ranges[2][j] <= ranges[3][i])
        i, j = i[near], j[near]
        for x, y in ((i, j), (j, i)):  # y inside x
            holds = (ranges[0][x] <= ranges[0][y]) & (ranges[1][x] >= ranges[1][y]) & (ranges[2][x] <= ranges[2][y]) & (ranges[3][x] >= ranges[3][y])
            equal = (ranges[:, x] == ranges[:, y]).all(axis=0)
            out[y[holds & (score[x] >= score[y]) & (~equal | (x < y))]] = True
        shift += 1
        reach = i[i + shift < len(row)]
    return out


def _matched(shared, min_id: float, min_len: int, min_score: int, gapped: bool):
    """(target_id, at, piece) to alignments with a block of probes; a chunk has those whose diagonal lies in its own part."""

    match, mismatch, gap = DOUBLED
    # what a hit must reach at least: equal letters, and twice the score of the shortest one
    equal = math.ceil(min_id * min_len / 100 - 1e-6)
    each = (match - gap) * min_id / 100 + gap
    least = max(2, 2 * min_score, math.ceil(each * min_len - 1e-6) if each > 0 else 2)

    def candidates(index: Index, i: int, codes: np.ndarray, at: int) -> Iterator[tuple[np.ndarray, ...]]:
        """Chunk, row, diagonal, the row's letters and the chunk's beside them, of diagonals or bands with a common word; a bounded number at a time."""
        width = index.codes.shape[1]
        row, diag = index.diagonals(codes)
        if gapped:
            row, diag = _bands(row, diag, at)
        for lo in range(0, len(row), ROWS_AT_ONCE):
            r, d = row[lo : lo + ROWS_AT_ONCE], diag[lo : lo + ROWS_AT_ONCE]
            a, b = index.codes[r], laid_on(codes, d - REACH, width + 2 * REACH) if gapped else laid_on(codes, d, width)
            if not gapped:
                able = np.count_nonzero((a == b) & (a < 4), axis=1) >= equal
                r, d, a, b = r[able], d[able], a[able], b[able]
            yield np.full(len(r), i), r, d, a, b

    def measured(parts: list[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
        """Chunk, row, score, first and last on the probe and on the target, equal letters, columns, gaps, diagonal of hits, of the candidates of many chunks at once."""
        i, r, d, a, b = (np.concatenate(x) for x in zip(*parts, strict=True))
        if gapped:
            able = np.concatenate([np.zeros(0, bool), *(band_scores(a[x : x + BANDS_AT_ONCE], b[x : x + BANDS_AT_ONCE]) >= least for x in range(0, len(r), BANDS_AT_ONCE))])
            i, r, d, a, b = i[able], r[able], d[able], a[able], b[able]
        if not len(r):
            return [np.zeros(0, np.int64)] * 11
        if gapped:
            score, first, last, low, high, same, length, gaps = banded(a, b)
            score, low, high = score // 2, d - REACH + low, d - REACH + high
        else:
            score, first, last, same = best_segments(a, b)
            length, gaps, low, high = last - first + 1, np.zeros(len(r), np.int32), d + first, d + last
        good = (same * 100.0 >= min_id * length) & (length >= min_len) & (score >= min_score) & (score > 0)
        return [x[good] for x in (i, r, score, first, last, low, high, same, length, gaps, d)]

    def alignments(batch: pa.RecordBatch, starts: np.ndarray, parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        """Hits of whole chunks, less those inside better ones, as alignments."""
        ids, minus, index = shared.value
        width = index.codes.shape[1]
        found = [np.concatenate(x) for x in zip(*parts, strict=True)]
        if not len(found[0]):
            return
        by = np.lexsort((found[3], found[5], found[1], found[0]))
        found = [x[by] for x in found]
        keep = ~_inside_a_better(found[0] * len(index.codes) + found[1], found[2], np.stack(found[3:7]))
        at = starts[found[0]]
        own = keep & (found[10] < width + CHUNK) & ((found[10] >= width) | (at == 0))
        i, row, score, first, last, low, high, same, length, gaps, _ = (x[own] for x in found)
        if not len(row):
            return
        size, back, at = index.lengths[row], minus[row], at[own]
        low, high = low + at + 1, high + at + 1
        cast = lambda x: pa.array(np.asarray(x), pa.int32())
        made = [
            ids.take(pa.array(row)), batch.column(0).take(pa.array(i)), pa.array(same * 100.0 / length), cast(length), cast(length - same - _gap_letters(first, last, low, high, length)), cast(gaps),
            cast(np.where(back, size - last, first + 1)), cast(np.where(back, size - first, last + 1)), cast(np.where(back, high, low)), cast(np.where(back, low, high)), cast(score),
        ]
        yield pa.RecordBatch.from_arrays(made, ["probe_id", "target_id", "pident", "length", "mismatch", "gapopen", "qstart", "qend", "sstart", "send", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value[2]
        for batch in batches:
            starts, pool, n, found = batch.column(1).to_numpy().astype(np.int64), [], 0, []
            for i, piece in enumerate(batch.column(2).to_pylist()):
                codes = _CODE[np.frombuffer(piece.encode("ascii", "replace"), np.uint8)]
                for part in candidates(index, i, codes, int(starts[i])):
                    pool.append(part)
                    n += len(part[0])
                    if n >= ROWS_AT_ONCE:
                        found.append(measured(pool))
                        pool, n = [], 0
                if found:  # a chunk's hits are judged together
                    yield from alignments(batch, starts, [*found, *map(measured, [pool] if pool else [])])
                    pool, n, found = [], 0, []
            if pool:
                yield from alignments(batch, starts, [measured(pool)])

    return run


def _gap_letters(first, last, low, high, length):
    """Columns of an alignment with a letter on one side only."""
    return 2 * length - (last - first + 1) - (high - low + 1)


def align_probes(probes: DataFrame, targets: DataFrame, word: int = 13, min_id: float = 85.0, min_len: int = 90, dust: bool = True, gapped: bool = False, min_score: int = 0) -> DataFrame:
    """Alignments of probes (probe_id, seq) with targets (target_id, seq), or a table of their pieces, both strands.

    `dust` leaves out words of low complexity as seeds. A panel of more than
    PROBES_AT_ONCE probes goes over the targets once for each block of so many; the
    chunks and each block's hits are then written, and its index is given up before
    the next is made, so memory does not grow with the panel.
    """
    spark = probes.sparkSession
    schema = ALIGNMENT.format(targets.schema["target_id"].dataType.simpleString())
    panel = probes.where(F.length("seq") >= word).select(F.col("probe_id").cast("string").alias("probe_id"), "seq", reverse_complement(F.col("seq")).alias("back"))
    size = panel.agg(F.count("*").alias("n"), F.max(F.length("seq")).alias("width")).first()
    blocks = -(-size["n"] // PROBES_AT_ONCE)
    if not blocks:
        return spark.createDataFrame([], schema)
    pieces = pieces_of(targets, "target_id", CHUNK, 3 * size["width"] + 2 * REACH)
    if blocks > 1:
        block = F.pmod(F.xxhash64("probe_id", "seq"), F.lit(blocks)).alias("block")
        panel, pieces = saved(panel.select("*", block).repartition("block").sortWithinPartitions("block"), "align-panel"), saved(pieces, "align-chunks")
    found = []
    for b in range(blocks):
        part = (panel.where(F.col("block") == b) if blocks > 1 else panel).toArrow()  # about PROBES_AT_ONCE rows
        if not part.num_rows:
            continue
        both = part["seq"].to_pylist() + part["back"].to_pylist()
        minus = np.arange(len(both)) >= part.num_rows
        shared = spark.sparkContext.broadcast((pa.concat_arrays([part["probe_id"].combine_chunks()] * 2), minus, Index(both, word, dust)))
        hits = pieces.mapInArrow(_matched(shared, min_id, min_len, min_score, gapped), schema)
        if blocks == 1:
            return hits
        found.append(saved(hits, "align-hits"))
        shared.destroy()
    return functools.reduce(DataFrame.unionByName, found)
