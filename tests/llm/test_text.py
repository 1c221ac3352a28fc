"""Operators on texts against brute force, with the odd rows that tables hold."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from baitloom.llm import decontaminate, html_text, jaccard, pieces, secrets, shard, substring_dedup, suffix, toxicity, url_filter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [(None, "null id"), (1, None), (2, ""), (3, "  \n"), (4, "ß é 日本 words"), (4, "ß é 日本 words"), (5, "x" * 50_000)]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 7) for i, t in rows], "doc_id long, text string, lang string, source string, n_words long")


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, 5000, n))


def copies():
    base = prose(1, 300)
    out = [(100, base), (101, base), (102, base.replace(" ", "  "))]
    for i in range(40):
        words = base.split()
        for j in np.random.default_rng(i).integers(0, 300, i % 12):
            words[j] = f"edit{i}_{j}"
        out.append((110 + i, " ".join(words)))
    out += [(200 + i, prose(1, 60) + " " + prose(50 + i, 100)) for i in range(20)]
    return out + [(300, "one two"), (301, "ONE two"), (302, "one two three four five six"), (303, "one")]


def brute_classes(rows, k=5):
    sets = []
    for i, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER))
        sets.append((i, {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                parent[find(a)] = find(b)
    ids = {}
    for a, (i, _) in enumerate(sets):
        if i is not None:
            ids[find(a)] = min(i, ids.get(find(a), i))
    return sorted(((i, len(s), ids.get(find(a))) for a, (i, s) in enumerate(sets)), key=str)


@pytest.mark.parametrize("heavy", [16, 3])
def test_jaccard(spark, monkeypatch, heavy):
    monkeypatch.setattr(jaccard, "HEAVY", heavy)
    rows = ODD + copies()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_classes(docs(spark, rows)).collect()), key=str)
    assert got == brute_classes(rows)


def test_jaccard_empty(spark):
    assert jaccard.jaccard_classes(docs(spark, [])).collect() == []


def test_prefixes_share_tokens():
    rng = np.random.default_rng(2)
    orders = jaccard.Orders(rng.integers(0, 1 << 62, 5).astype(np.uint64), np.arange(5), 80)
    for n in range(1, 60):
        a = np.unique(rng.integers(0, 1 << 62, n)).astype(np.uint64)
        b = np.union1d(a[: int(0.9 * len(a)) + 1], rng.integers(0, 1 << 62, max(0, n // 12)).astype(np.uint64))
        common = len(np.intersect1d(a, b))
        assert jaccard.most_common(jaccard.sign(a), len(a), jaccard.sign(b), len(b)) >= common
        if 100 * common >= 80 * len(np.union1d(a, b)):
            shared = np.intersect1d(orders.prefix(a, 0, jaccard.SHARED - 1)[0], orders.prefix(b, 0, jaccard.SHARED - 1)[0])
            assert len(shared) >= min(jaccard.SHARED, common)


def brute_contamination(rows, items):
    words = lambda t: re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER).encode())
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for j in range(len(w) - n + 1) if w and i is not None else ():
            windows.setdefault(tuple(w[j : j + n]), set()).add(str(i))
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit |= set(range(j, j + n))
                    found |= windows[tuple(w[j : j + n])]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit, together", [(2_000_000, 0), (0, 1 << 22), (0, 50)])
def test_contamination(spark, monkeypatch, limit, together):
    """By a broadcast, and by joins with all items of a document at once or in many parts."""
    monkeypatch.setattr(decontaminate, "TOGETHER", together)
    items = [(1, prose(9, 40)), (10, prose(9, 40)), (2, "Short item"), (3, None), (4, "..."), (None, prose(8, 20)), (5, prose(7, 13)), (6, prose(9, 40) + " " + prose(6, 20)), (7, prose(9, 60)), (7, "short")]
    rows = [*ODD, (50, prose(3, 30) + " " + prose(9, 40).upper() + " tail"), (50, prose(3, 30) + " " + prose(9, 40).upper() + " tail"), (55, prose(9, 55) + " Short " + prose(6, 20)), (51, "a short ITEM here"), (52, prose(7, 13)), (53, prose(7, 12)), (54, prose(3, 2000) + " " + prose(7, 13))]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminate(docs(spark, rows), table, broadcast_words=limit)
    assert sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in got.collect()), key=str) == brute_contamination(rows, items)
    assert got.where("doc_id IS NULL").first().source == "s"


def test_secrets(spark):
    key = "AKIA" + "B" * 16
    rows = [*ODD, (60, f"é {key} Password = 'abcdef' and token=ab secret=token:abcdefg " + "0f" * 12), (61, "-----BEGIN RSA PRIVATE KEY----- api_key: abc123 APIKEY=abc12")]
    got = {r.doc_id: r for r in secrets.scan_secrets(docs(spark, rows), redact=True).collect() if r.doc_id}
    text, start = rows[-2][1], rows[-2][1].index("0f0f")
    want = f"access:2:22,assign:{text.index('Password')}:{text.index('abcdef') + 6},hex:{start}:{start + 24}"
    assert got[60].spans == want and (got[60].n_assign, got[60].n_access, got[60].n_hex) == (1, 1, 1)
    assert got[60].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert got[60].text == "é [access] [assign]' and token=ab secret=token:abcdefg [hex]"
    assert [s.split(":")[0] for s in got[61].spans.split(",")] == ["pem", "assign"]
    assert (got[1].spans, got[1].text, got[1].base_sha256) == ("", None, hashlib.sha256(b"").hexdigest())
    assert secrets.trigram_query(secrets.BASE[2].regex) == [] and secrets.trigram_query(secrets.BASE[1].regex) == [[frozenset({"aki", "kia"})]]


def brute_removed(rows, n):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (t or "").encode()
        gone = np.zeros(len(data) + 1, int)
        for p in range(len(data) - n + 1):
            if data[p : p + n] in seen:
                gone[p] += 1
                gone[p + n] -= 1
            seen.add(data[p : p + n])
        gone = np.cumsum(gone[:-1]) > 0
        out.append((i, len(data), int(gone.sum()), int(np.sum(gone[1:] & ~gone[:-1]) + gone[:1].sum()), hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [20_000, 1])
def test_substrings(spark, hot):
    rows = [*ODD[:-1], (5, "x" * 700), *copies()[:25], (400, "ab" * 300), (401, "é" * 120)]
    got = substring_dedup.dedup_substrings(docs(spark, rows), hot=hot)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_removed(rows, 100)


def test_suffix_array():
    rng = np.random.default_rng(4)
    for _ in range(60):
        s = np.concatenate([np.append(rng.integers(1, 4, rng.integers(1, 40)), 0) for _ in range(4)])
        end = [int(np.flatnonzero(s[i:] == 0)[0]) + i for i in range(len(s))]
        got = [tuple(s[i : end[i]]) for i in suffix.suffix_array(s)]
        assert got == sorted(got)


def test_shards(spark):
    rng = np.random.default_rng(6)
    rows = ODD + [(i, "é" * int(n)) for i, n in enumerate(rng.integers(1, 900, 3000), 10)] + [(9000 + i, "same text") for i in range(1500)]
    got = shard.shard(docs(spark, rows)).collect()
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    sizes = [sum(r.size for r in got if r.shard == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 0.1 * sum(sizes) / 8 + 50_001
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert shard.shard(docs(spark, [])).count() == 0


def test_copies_stay_together(spark):
    """Groups of over 4 % of a shard, too; only the one that is larger than a shard is cut."""
    rng = np.random.default_rng(8)
    groups = [3000, 700, 650, 300, 120, 60]  # of 10 bytes each
    rows = [(i, "x" * int(n)) for i, n in enumerate(rng.integers(1, 60, 1500))]
    rows += [(10_000 * (g + 1) + j, f"group {g:03}"[:9]) for g, n in enumerate(groups) for j in range(n)]
    got = shard.shard(docs(spark, rows)).collect()
    of = {}
    for r in got:
        of.setdefault((r.doc_id // 10_000, r.text_crc32), set()).add(r.shard)
    assert all(len(s) == 1 for (g, _), s in of.items() if g != 1)
    sizes = [sum(r.size for r in got if r.shard == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 0.1 * sum(sizes) / 8


def test_pages():
    page = "<html><head><title>t</title></head><body><nav><a href=x>menu</a></nav><div class='ad'>buy</div><article><h1>Head &amp; line</h1><p>One,\n two <b>three</b><br>four<p>Five&nbsp;six, seven.<aside>side</aside><script>var p='</p>'</script></article><div class=comments><p>nice, really, very nice comment</div><footer>end</footer>"
    assert html_text.main_text(page) == "Head & line One, two three four Five six, seven."
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p></p>") == ""
    assert html_text.main_text("plain text") == "plain text" and html_text.main_text("<div><p>cut off</p><p cla") == "cut off"


def test_urls(spark):
    rows = [(1, "https://A.Example.NET/en/x?y"), (2, "http://a.net/"), (3, "http://a.net"), (4, "http://x.org/fr/1#a"), (5, None), (6, "nothing"), (7, "http://b.example.com/de/1"), (8, "http://notexample.com/de/1"), (8, "http://notexample.com/de/1")]
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), bits=12).collect())
    assert got[0] == (1, "a.example.net", "/en/x", "example.net/en/", "allow") and got[1] == (2, "a.net", "/", "net/", "block")
    assert got[2][1:4] == ("a.net", "", None) and got[3][3:] == ("org/fr/", "allow") and got[4][1:4] == ("", "", None) and got[6][3:] == ("example.com/de/", "block") and got[7][3] is None
    assert len(got) == 9 and {g[4] for g in got} <= {"allow", "block"}


def test_toxicity(spark):
    rows = [(i, prose(i, 60) + (" you idiot moron" if i % 3 == 0 else "")) for i in range(600)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs(spark, rows), labels)
    got = toxicity.score_toxicity(docs(spark, rows + ODD), model).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()
    held = [r for r in got if r.held and (r.doc_id or 0) >= 6 and r.n_words == 7]
    assert np.mean([(r.predicted == 1) == (r.doc_id % 3 == 0) for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got) and len(got) == len(rows) + len(ODD)
    none = toxicity.fit(docs(spark, rows), labels.where("toxic = 0"))
    assert none is None and toxicity.score_toxicity(docs(spark, ODD), none).agg(F.max("score")).first()[0] == 0


def test_pieces_equal_the_library(spark):
    lib = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=pieces.MODEL)
    rows = [*ODD, (70, "Hello,  world!\n\n  it's 12.5² ▁ Ａ\x00 👩‍👩‍👧 " + prose(2, 30)), (71, "    "), (72, "a" * 300)]
    encoded = pieces.encode(docs(spark, rows))
    for r in encoded.collect():
        assert r.ids == lib.encode(r.text or "")
    for r in pieces.decode(encoded.withColumnRenamed("text", "old")).collect():
        assert r.text == lib.decode(r.ids)
    assert all(r.round_trip for r in pieces.digest(docs(spark, ODD)).collect())
