import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fedlake.llm import html_text, multi_index, quality

from .fixtures import documents

SMALL = "/root/testdata/sf0.01"


def test_held_out_quality(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    scored = quality.score(docs, *quality.train(docs, labels)).withColumn("held", quality.held_out())
    assert scored.columns == [*docs.columns, "score", "held"]
    rows = scored.join(labels.select("doc_id", "quality"), "doc_id").select("doc_id", "score", "quality", "held").collect()
    for r in rows:
        assert r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in rows if r.held]
    assert np.mean([(r.score >= quality.THRESHOLD) == r.quality for r in held]) > 0.93
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.98


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(r.doc_id, i % 2) for i, r in enumerate(docs.collect())], "doc_id long, quality int")
    other = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(quality.score(docs, *quality.train(docs, x)).select("doc_id", "score").collect(), key=str)
            for x in (labels, other))
    assert a == b


@pytest.mark.parametrize("rows", [[], [(1, 1)], [(1, None), (None, 1), (2, 7)]])
def test_few_labels(spark, rows):
    docs = documents(spark)
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    got = quality.score(docs, *quality.train(docs, labels)).select("score").collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    none = docs.limit(0)
    assert quality.score(none, *quality.train(none, labels)).count() == 0


def test_texts_without_blanks_count_whole():
    terms = quality.Terms()
    cjk = "漢字仮名交じり文" * 40
    table = np.random.default_rng(2).normal(size=(quality.SLOTS, quality.DIM)).astype(np.float32)
    slots, shapes = terms.of(["a", cjk + "x1", "b"])
    assert len(slots) == len(shapes) == 2 + -(-(len(cjk) + 2) // 64)
    a, b = quality.pooled(terms, [cjk + "!!9 end", cjk + "tail end"], table), quality.pooled(terms, [cjk + "!!9 end"], table)
    assert np.array_equal(a[0], b[0]) and not np.array_equal(a[0, quality.DIM:-1], a[1, quality.DIM:-1])
    # what stands after the first piece has its shapes
    one, other = quality.pooled(terms, ["a" * 64 + "7" * 64, "a" * 64 + "b" * 64], table)
    assert not np.array_equal(one[quality.DIM:-1], other[quality.DIM:-1])
    # shorter words as before, also after a long one
    assert np.array_equal(terms.of(["a", "b" * 64])[0], quality.Terms().of(["a", "b" * 64])[0]) and len(terms.of(["b" * 64])[0]) == 1


def test_temperature_and_network():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = (x[:, 0] + 0.7 * rng.normal(size=3000) > 0).astype(float)
    net = quality.fit(x, y)
    p = net.scores(x)
    for lo in (0.1, 0.4, 0.7):  # calibrated: shares follow scores
        near = (p >= lo) & (p < lo + 0.2)
        assert abs(y[near].mean() - p[near].mean()) < 0.12


ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li></ul></nav><header><h1>Site</h1></header><!-- <p>no</p> -->
<div class="ad">Buy <b>now</b>!</div><article><h1>Head&amp;line</h1><p>One <b>bo</b>ld&nbsp;&#233;
 two.</p><div class="cookie-notice">We use cookies</div><p>Thr<i>ee</i><br>four &lt;p&gt;.</p><p>ok</p>
<form><input><button>Send</button></form><section class="comments"><p>Nice article, says a reader at length.</p></section></article>
<aside>Related</aside><footer>&copy; 2020</footer></body></html>"""

PLAIN = "<html><body><div><a href=x>One</a><a href=y>Two</a></div>" + "<ul>" + "<li><a href=z>Link</a></li>" * 9 + "</ul>" + "".join(
    f"<p>Paragraph {i} has a good many words in it, so that it weighs something.</p>" for i in range(4)) + \
    "<br>" * 5 + "<div>tiny</div></body></html>"


def test_main_text():
    assert html_text.main_text(ARTICLE) == "Head&line One bold é two. Three four <p>. ok"
    assert html_text.main_text("") == "" and html_text.main_text("<html><nav>x</nav></html>") == ""
    assert html_text.main_text("<article>a") == "a" and html_text.main_text("just text") == "just text"
    got = html_text.main_text(PLAIN)
    assert got.startswith("Paragraph 0") and "Paragraph 3" in got and "Link" not in got
    assert html_text.main_text("<article><p>a</p>" + "<div class=ad>x</div>" * 9 + "<p>b</p></article>") == "a b"
    assert html_text.main_text("<article><p title='a > b'>c <p") == "c"
    assert html_text.main_text("<div class='page with-sidebar'><p>" + "word " * 40 + "</p></div>").startswith("word")
    long = "<article>" + "<p>some words &amp; more</p>" * 50_000 + "</article>"
    assert len(html_text.main_text(long)) == 50_000 * len("some words & more ") - 1


@pytest.mark.parametrize("part", [
    '<p title="the hidden cost">T</p>', '<div data-id="ad-12">T</div>', '<blockquote cite="https://x.org/?id=share">T</blockquote>',
    "<p data-class='ad' alt=class=ad>T</p>", '<h2 class="section-header">T</h2>', '<div class="article-header">T</div>',
    '<p class="widget-text">T</p>', '<h3 class="header">T</h3>', '<h2 id="related-work">T</h2>', '<p class="social">T</p>',
    '<header><h1>T</h1><nav>no</nav></header>'])
def test_article_text_stays(part):
    assert html_text.main_text(f"<article><p>a</p>{part}<p>b</p></article>") == "a T b"


@pytest.mark.parametrize("part", [
    "<div title='x' class='ad'>T</div>", "<div CLASS=share>T</div>", "<p hidden>T</p>", "<p title=x hidden=''>T</p>", "<p class='ad-1'>T</p>",
    "<div class='search-box'>T</div>", "<div id='comments'>T</div>", "<p aria-hidden='true'>T</p>", "<footer>T</footer>"])
def test_furniture_of_an_article_goes(part):
    assert html_text.main_text(f"<article><p>a</p>{part}<p>b</p></article>") == "a b"


def test_page_without_article():
    body = "<p>" + "a long paragraph " * 9 + "</p>"
    ad = '<div class="ad">x</div>'

    def text(html):
        got = html_text.main_text(f"<div>{html}</div>")
        assert "x" not in got and got.startswith("a long paragraph")
        return got.rpartition("paragraph ")[2]

    assert text(body + ad + "<p>A short last one.</p>") == "A short last one."
    assert text(body + ad + "<p>Yes?</p><p>No.</p>" + ad + "<ul><li>one<li>two</ul>" + ad * 5 + "<p>end</p>") == "Yes? No. one two end"
    half = "<p>See the <a href=u>whole long statement of it</a> too.</p>"
    assert text(body + half) == text(body + ad + half) == "See the whole long statement of it too."
    # a link alone between lines of text stays; a list of links and what links end the page do not
    link = "<p><a href=u>link</a></p>"
    assert text(body + link + "<p>end</p>" + link) == "link end"
    assert text(body + link * 9 + "<p>end</p>") == "end"
    assert text(link * 2 + body + "end") == "end"
    assert html_text.main_text("<p>First.</p>" + ad + "<p>Then a second.</p>") == "First. Then a second."
    first = "<p>" + "word " * 20 + "<a href=u>" + "word " * 20 + "</a></p>"
    assert html_text.main_text(first + body) == ("word " * 40 + "a long paragraph " * 9).strip()


LONG = "a long paragraph " * 9 + "end"


@pytest.mark.parametrize("html", [
    # comments and teasers beside and in an article
    f"<article><p>{LONG}</p><section class=comments><article class=comment>no</article></section></article>",
    f"<article><p>{LONG}</p><article id=comment-12 class='comment even'>no</article></article>",
    f"<article><p>{LONG}</p></article><aside class=related><article>no</article><article>no</article></aside>",
    f"<aside><div><article><p>no</article></aside><main><p>{LONG}</p></main><nav><article>no</article></nav>",
    # and as the only articles
    f"<body><p>{LONG}</p><section class=comments><article class=comment>no</article></section></body>",
    f"<p>{LONG}</p><article class='teaser-card'>no</article><div class=sidebar><article>no</article></div>",
    # furniture that was never closed
    f"<nav><ul><li>no<article><p>{LONG}</p></article><nav>no</nav>",
    f"<div><div class=ad>no<article><p>{LONG}</p></article>",
    f"<section><div class=ad>no</section><article><p>{LONG}</p></article><div>no</div>",
    f"<p class=ad>no<p>{LONG}</p>",
    f"<ul><li class=ad>no<li>{LONG}</ul>",
    # articles that furniture's names do not concern, and wrappers of a page
    f"<article class='post category-social comments-open'><p>{LONG}</p></article><p>no</p>",
    f"<form id=page><nav>no</nav><article><p>{LONG}</p></article></form>",
    f"<div class=header-fixed><main><p>{LONG}</p></main></div><article class=teaser>no</article>",
    f"<div class=layout-sidebar><article><p>{LONG}</p></article></div><p>no</p>"])
def test_articles_that_are_not_the_page_s(html):
    assert html_text.main_text(html) == LONG


def test_ends():
    def ends(html):
        tags = [((m["name"] or "").lower(), bool(m["close"])) for m in html_text._TAG.finditer(html)]
        return [e for e, (_, closing) in zip(html_text._ends(tags), tags) if not closing]

    assert ends("<div><p>a<p>b<br></div><p>") == [(4, True), (2, False), (4, False), (6, False), (6, False)]
    assert ends("<b><i></b></i></b>") == [(2, True), (3, True)]
    assert ends("<table><tr><td><p>a<td>b<tr><td></table>") == [
        (7, True), (5, False), (4, False), (4, False), (5, False), (7, False), (7, False)]
    assert ends("<head><body><p><span></body></span>") == [(1, False), (4, True), (4, False), (4, False)]


def test_extract(spark):
    rows = [(1, "u", ARTICLE, "x"), (1, "u", ARTICLE, "x"), (2, None, None, "x"), (None, "v", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, 44), (1, 44), (2, 0)]
    assert html_text.extract(pages.limit(0)).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "?") for i, v in rows], "vec_id long, embedding array<float>, label int, id string")


def test_multi_index_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = table.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    got = {}
    for r in multi_index.search(table, F.col("id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = []
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        mine = sorted(got[ids[q]])
        assert [m[0] for m in mine] == list(range(1, 21)) and all(a[2] >= b[2] for a, b in zip(mine, mine[1:]))
        for _, i, score in mine:
            assert score == pytest.approx(s[np.flatnonzero(ids == i)[0]], abs=1e-12)
        hits.append(len({m[1] for m in mine} & set(ids[np.argsort(-s)[:20]].tolist())) / 20)
    assert np.mean(hits) >= 0.9


@pytest.mark.parametrize("kind,most", [("clustered", 0.1), ("uniform", 0.6)])
def test_multi_index_recall_on_many_vectors(spark, kind, most):
    rng = np.random.default_rng(3)
    n, d = 50_000, 24
    x = rng.normal(size=(n, d))
    if kind == "clustered":
        x = rng.normal(size=(400, d))[rng.integers(0, 400, n)] + 0.25 * x
    x = x / np.linalg.norm(x, axis=1)[:, None]
    table = vectors(spark, [(i, v) for i, v in enumerate(x.tolist())])
    x = np.array(x, np.float32).astype(np.float64)
    assert multi_index.fitted(multi_index.valid(table, "vec_id", "embedding"), n, 20).share < most
    got = {}
    for r in multi_index.search(table, F.col("id") % 250 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for q in range(0, n, 250):
        s = x @ x[q]
        s[q] = -np.inf
        assert len(got[q]) == 20
        hits.append(len(got[q] & set(np.argpartition(-s, 20)[:20].tolist())) / 20)
    assert np.mean(hits) >= 0.9


def test_centroids_grow_with_the_vectors():
    assert [multi_index.centroids(n) for n in (500, 50_000, 10**6, 10**7, 10**10)] == [128, 128, 252, 631, 1024]


def test_multi_index_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0, 2.0]), (1, None), (2, [0.0, 0.0, 0.0]), (3, [nan, 1.0, 1.0]), (4, [1.0, None, 1.0]), (5, [inf, 1.0, 1.0]),
            (6, [1.0, 0.0, 2.0]), (7, [1.0, 0.0, 2.0]), (8, [-1.0, 0.5, 0.0]), (None, [1.0, 1.0, 1.0]), (9, [1.0, 1.0]), (8, [-1.0, 0.5, 0.0])]
    got = multi_index.search(vectors(spark, rows), F.col("id") % 20 == 0, k=20).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(0, 1, 6), (0, 2, 7), (0, 3, 8), (0, 4, 8)]
    assert got[0].score == 5.0 and got[2].score == -1.0
    assert multi_index.search(vectors(spark, rows).limit(0), F.col("id") % 20 == 0).count() == 0


def test_one_vector_a_third_of_all(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "PART_ENTRIES", 200)
    rng = np.random.default_rng(9)
    rows = [(i, [1.0, 0.0, 0.0, 0.0] if i % 3 == 0 else rng.normal(size=4).tolist()) for i in range(1500)]
    got = multi_index.search(vectors(spark, rows), F.col("id") == 0, k=20).orderBy("rank").collect()
    x = np.array([r[1] for r in rows], np.float32).astype(np.float64)
    s = x @ x[0]
    want = [i for i in np.lexsort((np.arange(1500), -s)) if i][:20]
    assert [r.vec_id for r in got] == want


def test_traverse_is_in_order_of_sums():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=9), rng.normal(size=7)
    counts = rng.integers(0, 3, 63)
    got = multi_index.traverse(a, b, counts, 40)
    order = [c for c in np.argsort(-(a[:, None] + b[None, :]).ravel()) if counts[c]]
    assert got == order[:len(got)] and counts[got].sum() >= 40 > counts[got[:-1]].sum()
