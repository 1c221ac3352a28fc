"""What round 4 found, each on tables small enough to see why."""

import random

import numpy as np
import pyarrow as pa
import pytest

from baitloom import catalog
from baitloom.operators import align
from baitloom.operators import graph as G
from baitloom.operators import probes as P
from baitloom.operators import runs as K


def against_sql(spark, name, folder, *tables):
    """Rows of a query and of its SQL over the tables (parquet) of a folder."""
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    return sorted(map(tuple, catalog.QUERIES[name](spark, str(folder)).collect())), sorted(con.execute(catalog.ORACLES[name]).fetchall())


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    """Documents, of which two leave no letter."""
    rows = [(i, "tear lace 12 sine " * (3 + i % 9), "src", "en") for i in range(20)] + [(20, "", "src", "en"), (21, "123 456", "src", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(f"{(to := tmp_path_factory.mktemp('odd'))}/documents.parquet")
    return to


def test_f4_of_empty_genomes_is_as_its_sql(spark, documents):
    got, want = against_sql(spark, "f4_qc_flag", documents, "documents")
    assert got == want and {r[1] for r in got if r[0] >= 20 and r[0] % 7} == {"excess_n"}


def test_f6_counts_empty_genomes_as_its_sql(spark, documents):
    got, want = against_sql(spark, "f6_qc_report", documents, "documents")
    assert got == want


def test_f1_kmers_of_known_letters_are_cut_from_stretches(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 50)
    text = "ACGTNACGTRACGGTTACGTAACCGGTTNNACGTTTGACGATTACCAGATTACAGGACCTTAGGACCATTAGGCANTTAGG"
    seqs = spark.createDataFrame([(1, text), (2, text.lower()[3:]), (3, ""), (4, None), (5, "ACGTA")], "target_id long, seq string")
    for k, step, degen in ((7, 1, 0), (7, 3, 1), (20, 2, 2)):
        made = P.enum_kmers(seqs, k, step, degen)
        cut = [(i, p, s[p : p + k]) for i, s in ((1, text), (2, text[3:]), (5, "ACGTA")) for p in range(0, len(s) - k + 1, step)]
        want = [x for x in cut if sum(c not in "ACGT" for c in x[2]) <= degen]
        assert sorted(map(tuple, made.collect())) == want and made.columns == ["target_id", "pos", "kmer"]
        assert degen or "translate" not in made._jdf.queryExecution().executedPlan().toString()


def test_f2_existing_probes_leave_the_runs(spark, monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice("ACGT") for _ in range(400))
    seqs = spark.createDataFrame([(1, text), (2, text[50:300] + "N" + text), (3, "A" * 80)], "target_id long, seq string")
    panel = spark.createDataFrame([("p", text[60:80]), ("q", text[100:120].lower()), ("r", text[200:230]), ("s", "A" * 20), ("t", None)], "probe_id string, seq string")
    for bucket in (200_000, 40):  # counted in tasks of minimizers, and by k-mer
        monkeypatch.setattr(K, "BUCKET", bucket)
        for degen in (0, 1):
            want = P.kmer_support(P.remove_existing(P.enum_kmers(seqs, 20, max_degen=degen), panel))
            assert sorted(K.count_kmers(seqs, 20, max_degen=degen, without=panel).collect()) == sorted(want.collect())


def test_f2_no_row_has_a_whole_kmer_before_the_last_step(spark, monkeypatch, documents):
    """The k-mers less the tiles come from runs; no join or distinct shuffles them."""
    plan = catalog.QUERIES["j5_remove_existing"](spark, str(documents))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_f17_runs_are_shuffled_packed(spark):
    texts = ["ACGT" * n + "GAT"[: n % 4] for n in range(40)] + ["ACGN", "", "acg"]
    made = [K.packed(x, not set(x) - set("ACGT")) for x in texts]
    assert K.unpacked(made) == texts and len(made[39]) == 41
    lengths = spark.createDataFrame([(x,) for x in made], "seq binary").select(K.packed_length("seq")).collect()
    assert [r[0] for r in lengths] == [len(x) for x in texts]


def test_f9_scores_of_bands_are_those_of_whole_alignments():
    """So that only bands that can reach the cut-offs are aligned with all that is told of a hit."""
    rng = np.random.default_rng(5)
    b = rng.integers(0, 5, (300, 92)).astype(np.uint8)
    a = b[:, 16:76].copy()
    for i in range(0, 300, 3):
        a[i] = np.delete(b[i], [20, 40 + i % 9])[14 : 14 + 60]
        a[i + 1] = rng.integers(0, 5, 60)
    assert (align.band_scores(a, b) == align.banded(a, b)[0]).all()


def test_f9_chunks_are_matched_together(spark, monkeypatch):
    """Any number of candidates at a time gives the same hits."""
    rng = random.Random(8)
    base = "".join(rng.choice("ACGT") for _ in range(900))
    rows = [(i, base[i * 40 : i * 40 + 300] + base[i * 40 + 305 : i * 40 + 500]) for i in range(9)]
    targets = spark.createDataFrame(rows, "target_id long, seq string").repartition(1)
    probes = spark.createDataFrame([(f"p{i}", base[i * 60 : i * 60 + 120]) for i in range(13)], "probe_id string, seq string")
    for gapped in (False, True):
        found = []
        for n in (1 << 15, 1, 7):
            run = align._matched(type("Shared", (), {"value": _shared(probes)}), 85.0, 40, 0, gapped)
            monkeypatch.setattr(align, "ROWS_AT_ONCE", n)
            batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([0] * 9, pa.int32()), pa.array([r[1] for r in rows])], ["target_id", "at", "piece"])
            found.append(sorted(tuple(x.values()) for y in run([batch]) for x in y.to_pylist()))
        assert found[0] == found[1] == found[2] and len(found[0]) > 20


def _shared(probes):
    rows = probes.collect()
    seqs = [r.seq for r in rows] + [r.seq[::-1].translate(str.maketrans("ACGT", "TGCA")) for r in rows]
    return pa.array([r.probe_id for r in rows] * 2), np.arange(len(seqs)) >= len(rows), align.Index(seqs, 13)


def test_f15_links_are_made_once(spark, tmp_path):
    made = str(tmp_path / "made")

    def noted(batches):
        for batch in batches:
            with open(made, "a") as f:
                f.write("1" * batch.num_rows)
            yield batch

    rows = [(f"n{i}", "+", f"n{i + 1}", "+") for i in range(5)] + [("n6", "+", "n7", "-")]
    links = spark.createDataFrame(rows, "from_id string, from_orient string, to_id string, to_orient string").coalesce(1)
    found = G.chains(links.mapInArrow(noted, links.schema))
    assert sorted((r.id, r.head, r.rank) for r in found.collect()) == [(f"n{i}", "n0", i) for i in range(6)]
    assert len(open(made).read()) == len(rows)
