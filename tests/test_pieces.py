"""Sequences in pieces: read by many tasks, and taken by the operators as whole ones are."""

import random

import numpy as np
import pytest

from baitloom import sources as S
from baitloom.operators import align
from baitloom.operators import depth as D
from baitloom.operators import graph as G
from baitloom.operators import letters as L
from baitloom.operators import probes as P
from baitloom.operators import runs as K
from baitloom.operators import stats
from baitloom.operators.design import capture, evaluate
from baitloom.sources import pieces as pieces_module

from test_design_rounds import blocks


def letters(rng, n, of="ACGT"):
    return "".join(rng.choice(of) for _ in range(n))


def wrapped(seq, width=60):
    return "\n".join(seq[i : i + width] for i in range(0, len(seq), width))


@pytest.fixture
def small_blocks(spark):
    """Files are cut into blocks of a few hundred bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "64"}
    before = {x: spark.conf.get(x, None) for x in names}
    for x, value in names.items():
        spark.conf.set(x, value)
    yield
    for x, value in before.items():
        spark.conf.unset(x) if value is None else spark.conf.set(x, value)


@pytest.mark.parametrize("few, part", [(0, 100), (1000, 65_536)])
def test_records_over_many_blocks(spark, tmp_path, small_blocks, monkeypatch, few, part):
    monkeypatch.setattr(pieces_module, "FEW_BLOCKS", few)
    monkeypatch.setattr(pieces_module, "PART", part)
    rng = random.Random(51)
    want = {"long": letters(rng, 9000, "ACGTN"), "s1": "ACGT", "mid": letters(rng, 1500), "end": letters(rng, 3000)}
    (tmp_path / "a.fa").write_text("junk\n" + "".join(f">{x} more > words\r\n{wrapped(s)}\n\n" for x, s in want.items() if x != "end") + ">none\n")
    (tmp_path / "b.fa").write_text(f">end\n{wrapped(want['end'], 71)}")
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
    got = S.read_fasta_pieces(spark, str(tmp_path), 500).collect()
    assert sorted((r.target_id, r.at, r.piece) for r in got) == sorted((x, i, s[i : i + 500]) for x, s in want.items() for i in range(0, len(s), 500))
    (tmp_path / "c.fa").write_text(">mid\nAC\n")
    with pytest.raises(ValueError, match="stands twice: mid"):
        S.read_fasta_pieces(spark, str(tmp_path))


def test_no_records(spark, tmp_path):
    (tmp_path / "a.fa").write_text("")
    assert S.read_fasta_pieces(spark, str(tmp_path)).isEmpty()


def tables(spark, rows, size):
    """The same sequences whole and in pieces."""
    whole = spark.createDataFrame(rows, "target_id string, seq string")
    cut = [(x, i, s[i : i + size]) for x, s in rows for i in range(0, len(s or ""), size)]
    return whole, spark.createDataFrame(cut, "target_id string, at int, piece string").repartition(5)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def targets():
    rng = random.Random(52)
    base = letters(rng, 1400)
    return [("a", base), ("b", base[:600] + "N" * 30 + base[630:]), ("c", letters(rng, 119)), ("d", letters(rng, 121)), ("e", base[300:420]), ("f", base[200:].lower())]


@pytest.mark.parametrize("step", [1, 50, 120, 500])
def test_tiles(spark, monkeypatch, step):
    monkeypatch.setattr(P, "CHUNK", 240)
    whole, cut = tables(spark, targets() + [("g", None), ("h", "")], 97)
    assert rows_of(P.tile(cut, step=step, prefix="x")) == rows_of(P.tile(whole, step=step, prefix="x"))
    assert P.tile(cut, step=step).count() > 10


def test_capture_and_reports(spark, monkeypatch):
    monkeypatch.setattr(align, "CHUNK", 200)
    monkeypatch.setattr(L, "PIECE", 128)
    whole, cut = tables(spark, targets(), 333)
    panel = P.tile(whole, step=300, prefix="x")
    depth = D.from_dense(D.to_dense(capture(panel, whole), whole))
    assert rows_of(capture(panel, cut)) == rows_of(capture(panel, whole)) == rows_of(depth) and depth.count() > 10
    for work in (stats.genome_depth_stats, stats.coverage_at_depth, lambda d, t: stats.long_report(d, t, "x"), lambda d, t: D.low_coverage(d, t, 120, 0, 20)):
        assert rows_of(work(depth, cut)) == rows_of(work(depth, whole))
    assert rows_of(K.count_kmers(cut, 120)) == rows_of(K.count_kmers(whole, 120))


@pytest.mark.parametrize("bucket, stretch", [(200_000, 1 << 20), (4, 64)])
def test_blocks_over_chunks(spark, monkeypatch, bucket, stretch):
    monkeypatch.setattr(G, "CHUNK", 100)
    monkeypatch.setattr(G, "BUCKET", bucket)
    monkeypatch.setattr(G, "STRETCH", stretch)
    monkeypatch.setattr(L, "PIECE", 128)
    whole, cut = tables(spark, [(x, s.upper()) for x, s in targets() if "N" not in s] + [("p", "AC" * 150), ("q", "A" * 130)], 77)
    want = blocks([r.seq for r in whole.collect()], 21, 40)
    for table in (whole, cut):
        assert sorted((r.seq, r.genomes) for r in G.collapse_shared_sequence(table, k=21, min_len=40).collect()) == want
    assert len(want) > 3


def test_blocks_end_at_unknown_letters(spark, monkeypatch):
    monkeypatch.setattr(G, "CHUNK", 100)
    rng = random.Random(53)
    a, b = letters(rng, 330), letters(rng, 95)
    rows = [("x", a + "N" + b), ("y", a + "N" + b), ("z", "N" * 40), ("null", None), ("empty", ""), ("short", "ACG")]
    got = G.collapse_shared_sequence(spark.createDataFrame(rows, "target_id string, seq string"), k=21, min_len=40).collect()
    assert sorted((r.seq, r.genomes) for r in got) == sorted([(a, 2), (b, 2)])


def test_hashes_that_meet_are_told_apart(monkeypatch):
    seq = np.frombuffer(letters(random.Random(54), 400, "AC").encode(), np.uint8)
    at = np.arange(len(seq) - 6)
    want = len({seq[i : i + 6].tobytes() for i in at})
    for hashes in (G.window_hashes, lambda x, k: np.zeros(len(x) - k + 1, np.uint64)):
        monkeypatch.setattr(G, "window_hashes", hashes)
        by, head = G._groups(seq, at, 6)
        assert head.sum() == want and all((seq[at[by[i]] : at[by[i]] + 6] == seq[at[by[i - 1]] : at[by[i - 1]] + 6]).all() != head[i] for i in range(1, len(by)))
