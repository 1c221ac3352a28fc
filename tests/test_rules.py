"""Rows worked out by hand from the rules."""

import random

import pytest
from pyspark.sql import functions as F

from baitloom.functions.sequences import strip_tail
from baitloom.operators import cluster as C
from baitloom.operators import depth as D
from baitloom.operators import graph as G
from baitloom.operators import probes as P
from baitloom.operators import qc as Q
from baitloom.operators import stats as S
from baitloom.operators.align import align_probes


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def seqs(spark, *rows):
    return frame(spark, list(rows), "target_id string, seq string")


def dense(spark, *rows):
    return frame(spark, list(rows), "target_id string, seq string, depth array<int>")


def test_strip_tail(spark):
    rows = [("GGGTTAAAAAAAA", "GGGTT"), ("AAAAAAAA", "AAAAAAAA"), ("CCAAAAA", "CCAAAAA"), ("CCAAANNNm", "CC")]
    got = frame(spark, rows, "seq string, want string").select(strip_tail(F.col("seq")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)


def test_qc_reasons(spark):
    body = "ACGT" * 24
    rows = [("n6", "N" * 6 + body[:94]), ("n5", "N" * 5 + body[:95]), ("r", "R" + body + "GTC"), ("short", body + "GTC"), ("alln", "N" * 99), ("noc", "AGT" * 67), ("tail", "ACGT" * 23 + "ACG" + "A" * 10)]
    got = {r.target_id: r.reason for r in Q.qc_flag(seqs(spark, *rows)).collect()}
    assert got == {"n6": "excess_n", "n5": "keep", "r": "nonstandard", "short": "too_short", "alln": "excess_n", "noc": "no_c", "tail": "short_after_trim"}


def test_tiles(spark):
    rows = [(str(n), "ACGT" * (n // 4) + "ACGT"[: n % 4]) for n in (119, 120, 240, 250)]
    got = P.tile(seqs(spark, *rows)).groupBy(F.split("probe_id", "_")[1].alias("id")).count().collect()
    assert {r.id: r["count"] for r in got} == {"120": 1, "240": 2, "250": 3}
    mixed = P.tile(seqs(spark, ("x", "N" * 11 + "A" * 229))).collect()
    assert [r.probe_id for r in mixed] == ["_x_piece_1"] and mixed[0].seq == "A" * 120


def test_padding(spark):
    got = P.pad_short(seqs(spark, ("a", "N" * 5 + "C" * 100), ("b", "N" * 25 + "C" * 85), ("c", "C" * 120))).collect()
    assert [(r.probe_id, r.seq) for r in got] == [("_a_padded_probe", "T" * 20 + "C" * 100)]


def test_substitution_never_draws_g_for_n(spark):
    props = frame(spark, [("A", 0.3), ("C", 0.3), ("G", 0.2), ("T", 0.2)], "letter string, prop double")
    got = P.substitute_ambiguous(frame(spark, [("p", "N" * 200)], "probe_id string, seq string"), props).first().seq
    assert set(got) == set("ACT")
    only = P.substitute_ambiguous(frame(spark, [("p", "N" * 200)], "probe_id string, seq string"), props, n_choices="G").first().seq
    assert only == "G" * 200


def test_kmers(spark):
    assert P.enum_kmers(seqs(spark, ("a", "ACGT" * 30 + "AC"), ("b", "A" * 119)), 120).count() == 3


def test_depth_and_merge(spark):
    aln = frame(spark, [("p", "x", 2, 5), ("p", "x", 5, 3)], "probe_id string, target_id string, sstart int, send int")
    targets = seqs(spark, ("x", "A" * 10), ("y", "AC"))
    got = {r.target_id: r.depth for r in D.to_dense(D.alignments_to_depth(aln, targets), targets).collect()}
    assert got == {"x": [0, 1, 2, 2, 2, 0, 0, 0, 0, 0], "y": [0, 0]}
    a, b = dense(spark, ("x", "AC", [1, 0]), ("y", "A", [2])), dense(spark, ("x", "AC", [1, 1]), ("z", "G", [0]))
    assert {r.target_id: r.depth for r in D.merge_dense(a, b).collect()} == {"x": [2, 1], "y": [2], "z": [0]}
    with pytest.raises(Exception, match="differ"):
        D.merge_capture(D.from_dense(a), D.from_dense(dense(spark, ("x", "ACG", [1, 1, 1])))).collect()


def test_smoothing(spark):
    rows = [("a", "A" * 11, [1] + [0] * 9 + [1]), ("b", "A" * 12, [1] + [0] * 10 + [1]), ("c", "AAAA", [0, 0, 0, 2])]
    capture = dense(spark, *rows)
    got = {r.target_id: r.depth for r in D.to_dense(D.smooth_short_zeros(D.from_dense(capture)), capture).collect()}
    assert got == {"a": [1] * 11, "b": rows[1][2], "c": [1, 1, 1, 2]}


@pytest.mark.parametrize(("low", "want"), [((50, 80), "x_position_6_to_125"), ((80, 105), "x_position_34_to_153"), ((0, 30), "x_position_1_to_120"), ((170, 200), "x_position_81_to_200"), ((50, 70), None), ((0, 130), "x_position_1_to_130")])
def test_low_coverage(spark, low, want):
    depth = [0 if low[0] <= i < low[1] else 1 for i in range(200)]
    capture = dense(spark, ("x", "ACGT" * 50, depth))
    got = [r.id for r in D.low_coverage(D.from_dense(capture), capture, 120, 0, 20).collect()]
    assert got == ([want] if want else [])


def test_reports(spark):
    capture = dense(spark, ("a", "ANGT", [1, 0, 0, 1]), ("b", "AnGT", [1, 0, 0, 1]))
    runs = D.from_dense(capture)
    got = {r.target_id: (round(r.c0, 2), round(r.c1, 2), r.meancov) for r in S.genome_depth_stats(runs, capture).collect()}
    assert got == {"a": (33.33, 66.67, 0.5), "b": (50.0, 50.0, 0.5)}
    assert {r.target_id: round(r.coverage, 2) for r in S.coverage_at_depth(runs, capture).collect()} == {"a": 66.67, "b": 66.67}
    values = frame(spark, [(float(x),) for x in (0, 10, 20, 30)], "coverage double")
    assert [r.value for r in S.coverage_percentiles(values).orderBy("p").collect()] == [0, 5, 5, 5, 15, 25, 30]
    assert [r.value for r in S.coverage_percentiles(values.where("false")).collect()] == [None] * 7
    one = dense(spark, ("a", "A" * 8, [0, 0, 1, 2, 5, 7, 3, 4]))
    assert tuple(S.panel_depth_distribution(D.from_dense(one)).first()) == (25.0, 12.5, 12.5, 12.5, 12.5, 25.0)


def test_representatives(spark):
    rows = [(1, "a", 1, "A" * 100), (1, "b", 2, "N" * 3 + "A" * 117), (1, "c", 3, "A" * 90), (2, "b", 1, "N" * 3 + "A" * 117), (2, "d", 2, "N" * 3 + "A" * 127), (2, "e", 3, "N" + "A" * 79), (3, "b", 1, "N" * 3 + "A" * 117), (3, "d", 2, "N" * 3 + "A" * 127)]
    got = C.pick_representatives(frame(spark, rows, "cluster int, id string, ord int, seq string")).collect()
    assert {r.cluster: r.id for r in got} == {1: "a", 2: "e", 3: "d"}


@pytest.mark.parametrize(
    ("links", "drop", "want"),
    [
        ([("A", "+", "B", "+"), ("B", "+", "C", "+")], True, {"A_B_C", "D", "E"}),
        ([("A", "+", "B", "+"), ("B", "+", "C", "+"), ("C", "+", "D", "+"), ("E", "+", "D", "+")], True, {"A_B", "C", "D", "E"}),
        ([("A", "+", "B", "+"), ("B", "+", "C", "+"), ("C", "+", "D", "+"), ("E", "+", "D", "+")], False, {"A_B_C", "D", "E"}),
        ([("A", "+", "B", "+"), ("B", "+", "D", "+"), ("E", "+", "D", "+")], True, {"A", "B", "C", "D", "E"}),
        ([("A", "+", "B", "+"), ("B", "+", "C", "+"), ("C", "+", "A", "+")], True, {"A_B_C", "D", "E"}),
        ([("A", "+", "B", "-")], True, {"A", "B", "C", "D", "E"}),
    ],
)
def test_chains(spark, links, drop, want):
    nodes = frame(spark, [(x, x.lower()) for x in "ABCDE"], "id string, seq string")
    edges = frame(spark, links, "from_id string, from_orient string, to_id string, to_orient string")
    assert {r.id for r in G.merge_linear_chains(nodes, edges, drop).collect()} == want


def test_alignment_finds_both_strands(spark):
    rng = random.Random(3)
    target = "".join(rng.choice("ACGT") for _ in range(500))
    back = target[200:320][::-1].translate(str.maketrans("ACGT", "TGCA"))
    probes = frame(spark, [("f", target[50:170]), ("r", back)], "probe_id string, seq string")
    got = {r.probe_id: (r.sstart, r.send, r.pident, r.length) for r in align_probes(probes, seqs(spark, ("t", target))).collect()}
    assert got == {"f": (51, 170, 100.0, 120), "r": (320, 201, 100.0, 120)}


def test_greedy_equals_one_by_one(spark):
    rng = random.Random(5)
    edges = {tuple(sorted(rng.sample(range(40), 2))) for _ in range(90)}
    near = {i: {b for a, b in edges if a == i} | {a for a, b in edges if b == i} for i in range(40)}
    want = {}
    centroids = []
    for i in range(40):
        best = [c for c in centroids if c in near[i]]
        want[i] = best[0] if best else i
        centroids += [] if best else [i]
    items = frame(spark, [(i, i) for i in range(40)], "id int, rank int")
    got = C.greedy_centroids(items, frame(spark, sorted(edges), "a int, b int")).collect()
    assert {r.id: r.centroid for r in got} == want
