import pytest

from baitloom import sources as S


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fa").write_text("junk\n>x first > one\r\nACG\r\nTNn\r\n>y\nAC\n\nGT\n")
    (tmp_path / "b.fa").write_text(">z\nA\n")
    got = {r.id: (r.header, r.seq) for r in S.read_fasta(spark, str(tmp_path)).collect()}
    assert got == {"x": ("x first > one", "ACGTNn"), "y": ("y", "ACGT"), "z": ("z", "A")}


def test_fasta_round_trip(spark, tmp_path):
    rows = [(f"p{i}", "ACGT" * (i + 1)) for i in range(20)]
    S.write_fasta(spark.createDataFrame(rows, "probe_id string, seq string").coalesce(1), str(tmp_path / "out"))
    assert sorted((r.id, r.seq) for r in S.read_fasta(spark, str(tmp_path / "out")).collect()) == sorted(rows)


def test_capture(spark, tmp_path):
    rows = [("t1", "ACGT", [0, 1, 1, 0]), ("t2", "AC", [3, 0])]
    S.write_capture(spark.createDataFrame(rows, "target_id string, seq string, depth array<int>").coalesce(1), str(tmp_path / "out"))
    assert sorted(tuple(r) for r in S.read_capture(spark, str(tmp_path / "out")).collect()) == rows
    assert {r.target_id: r.depth for r in S.read_capture(spark, str(tmp_path / "out"), smooth=10).collect()} == {"t1": [1, 1, 1, 1], "t2": [3, 1]}
    (tmp_path / "bad.pt").write_text(">t\n$ACG\n#0,1\n")
    (tmp_path / "twice.pt").write_text(">t\n$A\n#0\n>t\n$A\n#0\n")
    for name in ("bad.pt", "twice.pt"):
        with pytest.raises(Exception, match="differs|twice"):
            S.read_capture(spark, str(tmp_path / name)).collect()


def test_tables(spark, tmp_path):
    (tmp_path / "aln.tsv").write_text("p1\tt1\t97.5\t120\t3\t0\t1\t120\t240\t121\t1e-50\t200\n")
    row = S.read_alignments(spark, str(tmp_path / "aln.tsv")).first()
    assert (row.probe_id, row.sstart, row.send, row.evalue) == ("p1", 240, 121, 1e-50)
    (tmp_path / "c.tsv").write_text("a\t1\nb\t2")
    assert sorted(tuple(r) for r in S.read_clusters(spark, str(tmp_path / "c.tsv")).collect()) == [("a", "1"), ("b", "2")]
    (tmp_path / "c.clstr").write_text(">Cluster 7\n0\t150nt, >seqA... *\n1\t140nt, >seqB... at +/99.95%\n>Cluster 8\n0\t90nt, >seqC... *\n")
    assert sorted((r.id, r.cluster) for r in S.read_clusters(spark, str(tmp_path / "c.clstr"), "cdhit").collect()) == [("seqA", "7"), ("seqB", "7"), ("seqC", "8")]
    (tmp_path / "g.gfa").write_text("H\tVN\nS\ta\tA\nL\ta\t+\tb\t-\t0M\nP\tx\n")
    assert [tuple(r)[:4] for r in S.read_gfa_links(spark, str(tmp_path / "g.gfa")).collect()] == [("a", "+", "b", "-")]
    stats = spark.createDataFrame([("a", 1.23456)], "target_id string, c0 double")
    S.write_stats_csv(stats, str(tmp_path / "s.csv"))
    assert tuple(spark.read.csv(str(tmp_path / "s.csv"), header=True).first()) == ("a", "1.235")
    S.write_report_tsv(stats, str(tmp_path / "r.tsv"))
    assert spark.read.csv(str(tmp_path / "r.tsv"), sep="\t", header=True).columns == ["target_id", "c0"]


def test_replaced_tables_are_deleted(spark, tmp_path):
    """Tables of the shared folder go, all others stay."""
    from pathlib import Path
    from urllib.parse import unquote, urlparse

    from baitloom.store import discard, saved

    written = saved(spark.range(5).toDF("id"), "a table")
    spark.range(3).write.parquet(own := str(tmp_path / "own table"))
    folder = {f.rsplit("/", 1)[0] for f in written.inputFiles()}
    assert len(folder) == 1
    discard(written, spark.read.parquet(own))
    assert not Path(unquote(urlparse(folder.pop()).path)).exists()
    assert spark.read.parquet(own).count() == 3
