"""Main text and URL scores on hand-made rows."""

import html
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from baitloom.llm import html_text, url_filter


def test_short_sections_and_headings_stay():
    long = "".join(f"<p>{'Word, and more words, ' * 20}{i}.</p>" for i in range(6))
    short = "<h2>Two</h2><p>Short one.</p><ul><li>Point.</li></ul><table><tr><td>Cell.</td></tr></table>"
    links = "<ul><li><a href='/a'>Link away</a></li></ul>"
    for a, z in (("<article>", "</article>"), ("<main>", "</main>"), ("<div>", "</div>")):
        page = f"<html><body><nav>Menu</nav>{a}<h1>Title</h1><div class='body'><div class='sec'>{long}</div><div class='sec'>{short}</div>{links}</div><div class='comments'><p>Reply</p></div>{z}<footer>End</footer></body></html>"
        got = html_text.main_text(page)
        assert got.startswith("Title Word,") and got.endswith("Two Short one. Point. Cell.")
        assert not any(x in got for x in ("Menu", "Link away", "Reply", "End"))


PAGES = [
    ("<body><div id=content><h1>Head</h1><div class=sec>{long}</div><div class=sec><p>Short.</p></div></div></body>", "Head {text} Short."),
    ("<body><div><h2>Head</h2><div class=text>{long}</div><ul><li>Point.</li></ul></div></body>", "Head {text} Point."),
    ("<body><article>{long}<div class='related-work'><p>Other work.</p></div><div class=meta>By me</div></article></body>", "{text} Other work. By me"),
    ("<body><article>{long}<p class='comment'>Reply</p><div id='reader-comments'><p>Reply, too</p></div></article></body>", "{text}"),
    ("<body><div class='site-footer'>F</div><div class=siteNav>N</div><div class='top-banner'>B</div><div class='cookie-bar'>C</div><main>{long}</main><form><p>Name, please</p></form></body>", "{text}"),
]


@pytest.mark.parametrize(("page", "want"), PAGES)
def test_whole_articles(page, want):
    text = [f"{'Word, and more words, ' * 12}{i}." for i in range(5)]
    assert html_text.main_text(page.format(long="".join(f"<p>{x}</p>" for x in text))) == want.format(text=" ".join(text))


def test_deep_pages_take_time_in_proportion():
    page = "<div>" * 60_000 + "<p>Deep, and down.</p>" + "</i></div>" * 60_000
    began = time.time()
    assert html_text.main_text(page) == "Deep, and down."
    assert time.time() - began < 10


def test_pages_of_the_table(spark):
    """Every page's article and nothing else, by plain cutting: these pages mark it."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in html_text.extract_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = re.sub(r"</?(?:h1|p|br)[^>]*>", " ", article)
        assert got[r.page_id] == " ".join(html.unescape(re.sub(r"<[^>]*>", "", blocks)).split())


@pytest.mark.parametrize("bits", [21, 8])
def test_url_scores_are_of_exact_counts(spark, bits):
    rng = random.Random(14)
    hosts = ("a.net", "www.example.net", "example.com", "x.org", "other.info", "é.dev")
    rows = [(i, f"http://{rng.choice(hosts)}/{rng.choice(('en', 'de', 'fr'))}/{rng.randrange(10**6)}") for i in range(80)] + [(80, None), (81, "nothing"), (82, "file:///en/a"), (83, "x://")]
    got = url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), bits=bits).collect()
    text = lambda r: list(f"{r.host}{r.path}\n".encode()) if r.host or r.path else []
    aside = {r.page_id for r in spark.createDataFrame([(r.page_id, bytes(text(r)).decode()) for r in got], "page_id long, t string").where("pmod(xxhash64(t), 5) = 0").collect()}
    counts = {"allow": Counter(), "block": Counter()}
    grams = lambda u: [[(tuple(([-1] * 5 + u)[i + 5 - k : i + 5]), u[i]) for k in range(6)] for i in range(len(u))]
    for r in got:
        for char in grams(text(r)) if r.rule and r.page_id not in aside else ():
            for context, letter in char:
                counts[r.verdict].update([(context,), (context, letter)])
    for r in got:
        want = 0.0
        for char in grams(text(r)):
            p = {"allow": 1 / 256, "block": 1 / 256}
            for context, letter in char:
                p = {y: (counts[y][context, letter] + 3 * p[y]) / (counts[y][context,] + 3) for y in p}
            want += math.log(p["allow"] / p["block"]) / len(text(r))
        assert abs(r.score - want) < 1e-6 and (r.score != 0) == (r.page_id not in (80, 81, 83))
    assert len(got) == len(rows)


def test_any_number_of_languages_has_a_threshold():
    """Thirty languages: none is left out, and those too rare for a threshold of their own have the one for all."""
    from baitloom.llm import toxicity

    rng = np.random.default_rng(8)
    names = [a + b for a in "abcdef" for b in "vwxyz"]
    langs = [names[i % 30] for i in range(6600)] + ["rare"] * 10
    toxic = rng.integers(0, 2, len(langs))
    texts = pa.chunked_array([pa.array([f"{lang}word {lang}other " + ("vile" if t else "mild") for lang, t in zip(langs, toxic, strict=True)])])
    model = toxicity.train(texts, toxic, langs, epochs=1)
    assert model.langs.shape[1] == 31 and len(model.thresholds) == 31
    data, offs = toxicity.flat(pa.array([f"{n}word {n}other" for n in names]))
    assert len(set(model.language(*toxicity.buckets(data, offs)).tolist())) == 30


LONG = "".join(f"<p>{'Word, and more words, ' * 12}{i}.</p>" for i in range(5))
TEXT = " ".join(f"{'Word, and more words, ' * 12}{i}." for i in range(5))
#: Class names as pages have them: what stands in the article (L), and what must come out (T).
REAL = [
    ("<div class='content no-sidebar'>L</div><div><p>Copyright..</p></div>", "T Copyright.."),  # nothing tells this line from the text
    ("<article><div class='has-sidebar'>L</div><p>End.</p></article>", "T End."),
    ("<div class='elementor-widget elementor-widget-text-editor'>L</div>", "T"),
    ("<article><p>First of all, this.</p><section class='social-history'>L</section></article>", "First of all, this. T"),
    ("<body><div><a>Home</a> <a>About</a></div>L</body>", "T"),
    ("<div><ul><li><a href='/'>Home</a><li><a href='/a'>About</a></ul>L</div>", "T"),
    ("<div>L<ul><li><a href='/'>Terms</a><li><a href='/a'>Imprint</a></ul></div>", "T"),
    *[(f"<article>L<div class='{name}'><p>Buy this, sign up, or read on.</p></div><p>End, at last.</p></article>", "T End, at last.") for name in ("newsletter-signup", "ad-slot", "google-ad", "cookie-notice", "subscribe-box", "related-stories", "user-comment-text", "adsbygoogle", "site-notice", "post-share-buttons")],
    ("<article>L</article><div class='post-comments'>L</div>", "T"),
    ("<main><article><h1>One</h1>L</article><article><h1>Two</h1>L</article></main>", "One T Two T"),
    ("<div class='post'><h1>Title</h1>L<div class='comment-thread'><p>Nice, really.</p></div></div>", "Title T"),
    ("<div class='sidebar-left-layout'><div id='main-column'>L</div></div>", "T"),
]


@pytest.mark.parametrize("page, want", REAL)
def test_names_do_not_outweigh_points(page, want):
    assert html_text.main_text(page.replace("L", LONG)) == want.replace("T", TEXT).replace(TEXT + "wo", "Two").replace(TEXT + "itle", "Title")


def test_pages_of_the_table_without_article_tags(spark):
    """The article is found by its points alone."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    bare = pages.withColumn("html", F.regexp_replace("html", "</?article[^>]*>", ""))
    text = lambda p: sorted((r.page_id, r.text) for r in html_text.extract_text(p).collect())
    assert text(bare) == text(pages)


def test_every_labelled_document_trains(spark):
    """4,800 toxic rows of which each fourth shares a rare word: all of these words are learned, however the rows lie and are sharded; nothing is drawn."""
    from baitloom.llm import toxicity

    spelled = lambda n: "".join("qwertyuiop"[int(x)] for x in f"{n:04}")
    made = [(i, f"some words {spelled(i // 4) if i < 6000 else 'plain' + spelled(i % 9)} here", "en", int(i < 6000)) for i in range(6600)]
    rows = spark.createDataFrame(made, "doc_id long, text string, lang string, toxic int")
    docs, labels = rows.drop("toxic"), rows.select("doc_id", "toxic")
    model = toxicity.fit(docs.repartition(7), labels, shard_rows=1000)
    learns = rows.where(~toxicity.held_out(F.col("doc_id"))).where("toxic = 1 AND xxhash64(doc_id, 7) % 5 <> 0")
    words = [r[0] for r in learns.groupBy(F.split("text", " ")[2].alias("word")).count().where("count > 1").collect()]
    data, offs = toxicity.flat(pa.array(words))
    ids, first = toxicity.buckets(data, offs)
    own = ids[first[:-1], 0]
    own = own[~np.isin(own, toxicity.buckets(*toxicity.flat(pa.array([made[i][1] for i in range(6000, 6009)])))[0][:, 0])]  # not by chance a bucket of clean texts
    assert len(own) > 1000 and (model.emb[own, 0] > 0.2).all()
    again = toxicity.fit(docs.coalesce(1), labels, shard_rows=1000)
    assert np.array_equal(model.emb, again.emb) and np.array_equal(model.thresholds, again.thresholds)


def test_toxicity_threshold_against_all_cuts():
    """The threshold from counts against every cut of the rows."""
    from baitloom.llm import toxicity

    rng = np.random.default_rng(4)
    for n in (2, 30, 300):
        toxic = np.arange(n) % 3 == 0
        step = rng.integers(-40, 40, n) + 25 * toxic
        step, toxic = np.append(step, [3, 3]), np.append(toxic, [True, False])
        cut = toxicity._threshold(np.stack([toxic, step, np.ones(len(step))], 1).astype(np.int64)) * toxicity.GRID
        wrong = lambda c: np.mean(step[toxic] < c) + toxicity.FALSE_ALARM * np.mean(step[~toxic] > c)  # noqa: E731, B023
        assert abs(wrong(cut) - min(wrong(c + 0.5) for c in range(-42, 68))) < 1e-9


def test_search_takes_few_rounds(spark, monkeypatch):
    """A pool of 448 is expanded to its end in fewer rounds than 448 / 64, and its queries find nearly all of their nearest."""
    from baitloom.llm import neighbours

    rounds = []
    monkeypatch.setattr(neighbours, "saved", lambda frame, name, f=neighbours.saved: (rounds.append(name), f(frame, name))[1])
    x = np.random.default_rng(3).normal(size=(1500, 16))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id) for r in neighbours.nearest(rows, F.col("vec_id") % 100 == 0).collect()}
    want = {(q, int(i)) for q in range(0, 1500, 100) for i in [i for i in np.argsort(-(x @ x[q])) if i != q][:20]}
    assert len(got) == 300 and len(got & want) >= 285 and rounds.count("ann-pools") <= 7
