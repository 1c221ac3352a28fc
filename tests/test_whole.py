"""The whole job, where less was done before."""

import itertools
import random
from collections import Counter

from pyspark.sql import functions as F

from baitloom import catalog
from baitloom.operators import align
from baitloom.operators import cluster as C
from baitloom.operators import depth as D
from baitloom.operators import probes as P
from baitloom.operators import qc as Q
from baitloom.operators import runs as K
from baitloom.operators.align import align_probes
from baitloom.operators.design import capture
from baitloom.plans import tables as T


def letters(rng, n, of="ACGT"):
    return "".join(rng.choice(of) for _ in range(n))


def test_gap_rounds_go_on(spark, tmp_path):
    rng = random.Random(11)
    spark.createDataFrame([(1, letters(rng, 420, "enta"), "s", "en")], "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, letters(rng, 120, "enta"))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = T.kept(spark, str(tmp_path))
    panel = catalog.QUERIES["g5_fill_gaps"](spark, str(tmp_path))
    assert kept.count() == 1 and D.low_coverage(capture(panel, kept), kept, 120, 0, 20).isEmpty()


def test_pairs_with_any_common_seed_are_found(spark):
    rng = random.Random(12)
    rows, want = [], set()
    for i in range(150):
        a = letters(rng, 120)
        at = set(rng.sample(range(120), 18))
        b = "".join(rng.choice("ACGT".replace(x, "")) if j in at else x for j, x in enumerate(a))
        rows += [(2 * i, a), (2 * i + 1, b)]
        if "1" * 13 in "".join("0" if j in at else "1" for j in range(120)):
            want.add((2 * i, 2 * i + 1))
    got = {tuple(r) for r in C.similar_pairs(spark.createDataFrame(rows, "id int, seq string"), 0.85).collect()}
    assert got >= want and len(want) > 100


def test_reverse_copies_of_genomes_are_one(spark):
    seq = letters(random.Random(13), 900)
    back = seq[::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert C.dereplicate_genomes(spark.createDataFrame([("a", seq), ("b", back)], "id string, seq string"), trigger=0).count() == 1


def test_tandem_repeats_are_covered(spark):
    unit = letters(random.Random(15), 60)
    probe = spark.createDataFrame([("p", unit * 2)], "probe_id string, seq string")
    target = spark.createDataFrame([("t", unit * 10)], "target_id string, seq string")
    got = capture(probe, target).collect()
    assert min(r.depth for r in got) >= 1 and sum(r.end - r.start for r in got) == 600
    assert align_probes(probe, target).count() == 9


def test_an_indel_splits_only_ungapped_hits(spark):
    rng = random.Random(16)
    target = letters(rng, 900)
    probe = spark.createDataFrame([("gone", target[300:360] + target[363:423]), ("more", target[500:560] + "ACG" + target[560:617])], "probe_id string, seq string")
    targets = spark.createDataFrame([("t", target)], "target_id string, seq string")
    assert align_probes(probe, targets).isEmpty()
    got = {r.probe_id: (r.sstart, r.send, r.gapopen > 0, r.mismatch, r.length) for r in align_probes(probe, targets, gapped=True).collect()}
    assert got == {"gone": (301, 423, True, 0, 123), "more": (501, 617, True, 0, 120)}


def test_chunks_and_blocks_change_nothing(spark, monkeypatch):
    rng = random.Random(17)
    unit = letters(rng, 40)
    rows = [(f"t{i}", letters(rng, 700) + unit * 9 + letters(rng, 300)) for i in range(4)] + [("none", None), ("empty", ""), ("n", "N" * 300)]
    targets = spark.createDataFrame(rows, "target_id string, seq string")
    probes = spark.createDataFrame([(f"p{i}", rows[i % 4][1][at : at + 120]) for i, at in enumerate(range(0, 1200, 90))] + [("u", unit * 3), ("x", None), ("y", "")], "probe_id string, seq string")
    whole = sorted(map(tuple, align_probes(probes, targets, min_len=40).collect()))
    monkeypatch.setattr(align, "CHUNK", 150)
    monkeypatch.setattr(align, "PROBES_AT_ONCE", 5)
    assert sorted(map(tuple, align_probes(probes, targets, min_len=40).collect())) == whole and len(whole) > 40


def test_kmers_cluster_as_one_by_one(spark):
    rng = random.Random(18)
    base = [letters(rng, 200) for _ in range(6)]
    base += ["".join(rng.choice("ACGT") if rng.random() < 0.1 else x for x in b) for b in base]
    count = Counter(b[i : i + 60] for b in base for i in range(0, 141, 7))
    order = sorted(count, key=lambda x: (-count[x], x))

    def alike(x, y):
        for s in range(-59, 60):
            pairs = [(x[i], y[i - s]) for i in range(max(0, s), min(60, 60 + s))]
            run = "".join("1" if a == b else "0" for a, b in pairs)
            if len(pairs) >= 32 and "1" * 13 in run and run.count("1") >= 0.85 * len(pairs):
                return True
        return False

    sizes = {}
    for x in order:
        own = next((c for c in sizes if alike(x, c)), x)
        sizes[own] = sizes.get(own, 0) + count[x]
    support = spark.createDataFrame(sorted(count.items()), "kmer string, size long")
    for batch in (5, 4096):
        assert {r.kmer: r.size for r in C.cluster_kmers(support, 0.85, batch=batch).collect()} == sizes
    assert 10 < len(sizes) < len(order)


def test_odd_rows(spark):
    rows = [("e", "", 1), ("z", None, 2), ("a", "ACGT" * 30, 3), ("a", "ACGT" * 31, 3)]
    seqs = spark.createDataFrame(rows, "target_id string, seq string, ord int").withColumn("qc", F.lit(1))
    assert sorted((r.target_id, r.reason, r.qc) for r in Q.qc_flag(seqs).collect()) == [("a", "keep", 1), ("a", "keep", 1), ("e", "too_short", 1), ("z", "no_sequence", 1)]
    assert {r.target_id: len(r.seq or "") for r in Q.dedup_by_id(seqs).collect()} == {"a": 124, "e": 0, "z": 0}
    empty = seqs.where("false")
    assert [x.count() for x in (Q.qc_filter(empty), P.tile(empty), P.enum_kmers(empty), C.cluster_kmers(P.kmer_support(P.enum_kmers(empty)), 0.9))] == [0, 0, 0, 0]
    assert sorted(r.pos for r in P.enum_kmers(seqs.where("target_id != 'z'"), 120).collect()) == [0, 0, 1, 2, 3, 4]


def test_kmers_of_chunks_are_those_of_the_whole(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 50)
    seq = letters(random.Random(19), 333)
    for step in (1, 7, 60):
        got = sorted((r.pos, r.kmer) for r in P.enum_kmers(spark.createDataFrame([("a", seq)], "target_id string, seq string"), 120, step).collect())
        assert got == [(i, seq[i : i + 120]) for i in range(0, 214, step)]


def test_ranks_over_partitions_are_those_of_a_limit(spark, monkeypatch):
    rows = [("".join(x), n % 4) for n, x in enumerate(itertools.permutations("ACGTN"))]
    frame = spark.createDataFrame(rows, "kmer string, size int").repartition(7)
    small = sorted(map(tuple, P.take_top(frame, 50, "x").collect()))
    monkeypatch.setattr(P, "FEW", 0)
    assert sorted(map(tuple, P.take_top(frame, 50, "x").collect())) == small and P.take_top(frame, None, "x").count() == 120


def test_plans(spark):
    """Texts are turned into bases once, alignment shuffles no genome, and nothing is a cartesian product."""
    d = "/root/testdata/sf0.001"
    plan = lambda name: catalog.QUERIES[name](spark, d)._jdf.queryExecution().executedPlan().toString()
    assert plan("f8_tile").count("regexp_replace([^ACGTNRY]") <= 1
    assert plan("f8_tile").count("regexp_replace") <= 3
    j1 = plan("j1_align_probes")
    assert "Exchange" not in j1 and "CartesianProduct" not in j1 and "Join" not in j1
    assert not any(x in plan(q) for q in ("f6_qc_report", "w3_low_coverage", "a7_long_report", "f11_enum_kmers") for x in ("Python", "InArrow", "CartesianProduct"))


def test_kmers_counted_in_runs(spark, monkeypatch):
    """Runs give what k-mers one by one give: with repeats, letters other than four, chunks, steps, minimizers of many k-mers."""
    rng = random.Random(31)
    unit = letters(rng, 300)
    rows = [(1, unit + "N" + unit[:200]), (2, unit.lower()), (3, "A" * 400), (4, letters(rng, 90) + "RYN" + letters(rng, 90)), (5, None), (6, ""), (7, "ACGT" * 5), (8, "N" * 200), (9, unit[:150] + "A" + unit[151:])]
    seqs = spark.createDataFrame(rows, "target_id int, seq string")
    monkeypatch.setattr(K, "CHUNK", 70)
    for k, step, degen, most in ((60, 1, 0, 200_000), (60, 1, 3, 150), (40, 7, 1, 200_000), (120, 120, 0, 200_000)):
        monkeypatch.setattr(K, "BUCKET", most)
        want = {r.kmer: r["size"] for r in P.kmer_support(P.enum_kmers(seqs, k, step, degen)).collect()}
        got = K.count_kmers(seqs, k, step, degen).collect()
        assert {r.kmer: r["size"] for r in got} == want and len(got) == len(want) > 3


def test_runs_cluster_as_kmers(spark, monkeypatch):
    rng = random.Random(32)
    base = letters(rng, 900)
    rows = [(i, "".join(rng.choice("ACGT") if rng.random() < 0.04 else x for x in base)) for i in range(5)] + [(9, base[300:600] + "N" + base[100:400])]
    seqs = spark.createDataFrame(rows, "target_id int, seq string")
    runs = K.kmer_runs(seqs, 60, 1, 5)
    whole = {r.kmer: r["size"] for r in C.cluster_runs(runs, 60, 0.85, batch=10**6).collect()}
    assert {r.kmer: r["size"] for r in C.cluster_runs(runs, 60, 0.85, batch=10).collect()} == whole and 5 < len(whole) < 400
    assert {r.kmer: r["size"] for r in C.cluster_kmers(P.kmer_support(P.enum_kmers(seqs, 60, 1, 5)), 0.85, batch=10).collect()} == whole


def test_genomes_as_one_by_one(spark):
    """Copies with a mutation, parts, strands, chains of likeness: as taking them one after the other, longest first."""
    rng = random.Random(33)
    base = letters(rng, 1500)
    back = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    change = lambda s, n: (lambda at: "".join(rng.choice("ACGT".replace(x, "")) if i in at else x for i, x in enumerate(s)))(set(rng.sample(range(len(s)), n)))
    seqs = [base, *[change(base, 1) for _ in range(12)], *[back(change(base, 1)) for _ in range(4)], base[200:900], back(base[400:1100]), change(base, 40), letters(rng, 700), letters(rng, 40), "", None]
    rows = list(enumerate(seqs))
    rng.shuffle(rows)

    def alike(a, b):
        short, long = sorted((a or "", b or ""), key=len)
        if len(short) < 32:
            return False
        return any(sum(x == y for x, y in zip(s, long[at:])) >= 0.999 * len(s) for s in (short, back(short)) for at in range(len(long) - len(short) + 1))

    want = {}
    for i, s in sorted(rows, key=lambda r: (-len(r[1] or ""), r[0])):
        own = next((c for c in sorted(set(want.values()), key=lambda c: (-len(seqs[c] or ""), c)) if alike(s, seqs[c])), i)
        want[i] = own
    got = C.cluster_genomes(spark.createDataFrame(rows, "id int, seq string"))
    assert {r.id: r.centroid for r in got.collect()} == want


def test_copies_of_a_genome_meet_their_representative_only(spark, monkeypatch):
    rng = random.Random(34)
    base = letters(rng, 2000)
    counts = []
    monkeypatch.setattr(C, "saved", lambda f, name, s=C.saved: (lambda out: (counts.append(out.count()) if name == "genomes-like" else None, out)[1])(s(f, name)))
    for n in (30, 60):
        rows = [(i, base[:j] + "ACGT"[("ACGT".index(base[j]) + 1) % 4] + base[j + 1 :]) for i, j in enumerate(rng.sample(range(2000), n))]
        before = len(counts)
        assert len({r.centroid for r in C.cluster_genomes(spark.createDataFrame(rows, "id int, seq string"), 0.99).collect()}) == 1
        assert sum(counts[before:]) <= 8 * n
