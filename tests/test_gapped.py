"""Alignments with gaps against whole dynamic programming, and what they change for capture and design."""

import random

from baitloom import catalog
from baitloom.operators import design as X
from baitloom.operators.align import align_probes
from baitloom.plans import tables as T

from test_design_rounds import hits

BACK = str.maketrans("ACGT", "TGCA")


def letters(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def changed(rng, seq, times):
    """With letters changed, left out and put in, away from each other."""
    for at in sorted(rng.sample(range(25, len(seq) - 25, 17), times), reverse=True):
        kind, n = rng.choice("xid"), rng.randint(1, 3)
        put = rng.choice("ACGT".replace(seq[at], "")) if kind == "x" else letters(rng, n) if kind == "i" else ""
        seq = seq[:at] + put + seq[at + (1 if kind == "x" else n if kind == "d" else 0) :]
    return seq


def best(a, b):
    """Score, in halves, of the best local alignment: a pair 2, an unlike pair -4, a letter beside a gap -5."""
    top, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (2 if x == y else -4), row[j + 1] - 5, new[j] - 5))
        top, row = max(top, *new), new
    return top


def test_gapped_scores_are_those_of_dynamic_programming(spark):
    rng = random.Random(61)
    probes, targets, want = [], [], {}
    for i in range(24):
        target = letters(rng, 400)
        at = rng.randint(40, 230)
        probe = changed(rng, target[at : at + 120], rng.randint(1, 4))
        probes.append((str(i), probe if i % 2 else probe[::-1].translate(BACK)))
        targets.append((str(i), target))
        want[str(i)] = best(probe, target)
    of = {x: s for x, s in targets}
    rows = align_probes(spark.createDataFrame(probes, "probe_id string, seq string"), spark.createDataFrame(targets, "target_id string, seq string"), min_id=70.0, min_len=60, gapped=True).where("probe_id = target_id").collect()
    got = {}
    for r in rows:
        got[r.probe_id] = max(got.get(r.probe_id, 0), r.score)
        ends = sorted((r.sstart, r.send))
        gaps = 2 * r.length - (r.qend - r.qstart + 1) - (ends[1] - ends[0] + 1)
        same = round(r.pident * r.length / 100)
        assert same + r.mismatch + gaps == r.length and (r.gapopen > 0) == (gaps > 0) and r.gapopen <= gaps
        assert (2 * same - 4 * r.mismatch - 5 * gaps) // 2 == r.score and 1 <= ends[0] <= ends[1] <= len(of[r.target_id])
    assert got == {x: s // 2 for x, s in want.items()}
    assert sum(r.gapopen > 0 for r in rows) > 10


def test_an_indel_target_counts_as_covered(spark):
    rng = random.Random(62)
    base = letters(rng, 240)
    target = base[:60] + "ACG" + base[60:180] + base[182:]
    probes = spark.createDataFrame([("p1", base[:120]), ("p2", base[120:])], "probe_id string, seq string")
    targets = spark.createDataFrame([("t", target)], "target_id string, seq string")
    assert X.evaluate(probes, targets).genomes.first()["c0"] > 90
    assert X.evaluate(probes, targets, gapped=True).genomes.first()["c0"] == 0
    assert X.capture(probes, targets, gapped=True, min_score=500).where("depth > 0").isEmpty()
    counts = [X.fill_gaps(probes, targets, batch=1, gapped=g, dust=False)[0].count() for g in (False, True)]
    assert counts[0] > 2 and counts[1] == 2


def test_own_panel_and_gapped_queries(spark, tmp_path):
    rng = random.Random(63)
    base = letters(rng, 300)
    other = base[:90] + "".join(rng.choice("ACGT".replace(x, "")) for x in base[90:92]) + base[92:230] + base[233:]
    to_text = str.maketrans("ACGT", "elit")
    rows = [(i, s.translate(to_text), "s", "en") for i, s in enumerate([base, other, letters(rng, 260), base[::-1].translate(BACK)], 1)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, base[40:280].translate(to_text))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {r.target_id: r.seq for r in T.kept(spark, str(tmp_path)).collect()}
    starts = {x: sorted({*range(0, len(s) - 119, 120), len(s) - 120}) for x, s in kept.items()}
    want = sorted((f"x_{x}_piece_{n}", t, a, b) for x, s in kept.items() for n, at in enumerate(starts[x], 1) for t, whole in kept.items() for a, b in hits(s[at : at + 120], whole, 90, 60))
    own = catalog.QUERIES["j1_own_panel"](spark, str(tmp_path))
    got = sorted({(r.probe_id, r.target_id, min(r.sstart, r.send) - 1, max(r.sstart, r.send)) for r in own.collect()})
    assert got == sorted(set(want)) and len(kept) == 4 and len(got) > 15
    gapped = catalog.QUERIES["j1_gapped"](spark, str(tmp_path)).where("target_id = 2").collect()
    panel = [r.seq for r in T.panel(spark, str(tmp_path)).collect()]
    assert max(r.score for r in gapped) == max(best(p, kept[2]) for p in panel) // 2 and any(r.gapopen for r in gapped)
