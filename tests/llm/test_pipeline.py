"""The pipeline's stages against plain Python, each on its own input."""

import re

import corpus_pipeline

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {name: None for name, _ in corpus_pipeline.STAGES}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, docs, SF).cache()
        rows = docs.collect()
        kept[name] = {r.doc_id for r in rows}
        assert kept[name] <= set(before) and len(rows) == len(kept[name])
        if name != "pieces":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "near_copies":
            sets = {i: shingles(t) for i, t in before.items()}
            same = lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
            group = {i: i for i in sets}
            for i in sorted(sets):
                for j in sorted(sets):
                    if j < i and same(i, j):
                        low, high = sorted((group[i], group[j]))
                        group = {k: low if v == high else v for k, v in group.items()}
            assert kept[name] == {i for i in sets if group[i] == i}
        if name == "secrets":
            assert kept[name] == set(before) and not any(re.search(r"AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}", r.text) for r in rows)
        if name == "pieces":
            assert all(r.round_trip for r in rows)
