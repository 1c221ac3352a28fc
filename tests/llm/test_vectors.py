import numpy as np
import pytest

from baitloom.llm import neighbours


def test_recall_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[300:500] = x[7]  # one very common vector
    x[500:] *= rng.uniform(0.5, 1.5, (1000, 1)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9000, None), (9020, [0.0] * 16), (9040, [float("nan")] * 16), (9060, [None] + [1.0] * 15), (None, [1.0] * 16), (9080, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.nearest(table, table.vec_id % 20 == 0).collect()
    assert {r.query_id for r in got} == set(range(0, 1500, 20)) and all(r.query_id != r.vec_id for r in got)
    d = x.astype(np.float64)
    hits = 0
    for q in range(0, 1500, 20):
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 21))
        scores = d @ d[q]
        scores[q] = -np.inf
        best = set(np.lexsort((np.arange(1500), -scores))[:20].tolist())
        hits += len(best & {m[1] for m in mine})
        assert all(abs(scores[m[1]] - m[2]) < 1e-9 for m in mine)
    assert hits >= 0.95 * 20 * 75


def test_few_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(empty, empty.vec_id % 20 == 0).collect() == []
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.0])], "vec_id long, embedding array<float>")
    assert [(r.rank, r.vec_id, r.score) for r in neighbours.nearest(two, two.vec_id == 0).collect()] == [(1, 1, 1.0), (2, 2, 0.5)]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_few_vectors_over_many_partitions(spark, adaptive):
    """However rows lie, a few vectors find all others, nearest first."""
    before = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        rng = np.random.default_rng(5)
        for n in (1, 3, 30):
            x = rng.normal(size=(n, 6))
            table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(8)
            got = neighbours.nearest(table, table.vec_id % 1 == 0).collect()
            for q in range(n):
                scores = x @ x[q]
                want = [i for i in sorted(range(n), key=lambda i: (-scores[i], i)) if i != q][:20]
                assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == want
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before[0])
        spark.conf.set("spark.sql.shuffle.partitions", before[1])


def test_a_vector_that_is_alone_in_its_ranges_is_found(spark, monkeypatch):
    """Blocks of a vector each give no list; those left over meet others."""
    monkeypatch.setattr(neighbours, "BLOCK", 1)
    x = np.random.default_rng(6).normal(size=(40, 6))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = neighbours.nearest(table, table.vec_id % 20 == 0, k=5).collect()
    assert sorted({r.query_id for r in got}) == [0, 20] and len(got) == 10
