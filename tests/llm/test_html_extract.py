import html
import re

import numpy as np
import pytest

from shelfcast.llm import boosting
from shelfcast.llm import html_extract as h

WORDS = "the committee met on tuesday to discuss plans for a new library near the old harbour, which many residents support. "
SITE = """<!DOCTYPE html><html><head><title>T</title><style>p{{a:b}}</style><script>if (a < b) document.write("<p>no</p>")</script></head>
<body><header class="site-header"><div class="logo">Daily Post</div><nav class="main-nav"><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav></header>
<div class="cookie-notice"><p>We use cookies to make this site better for you.</p><button>OK</button></div>
<div class="container"><{tag}{name}><h1>New library</h1>{body}<div class="ad">Buy cheap shoes now at our shop</div><ul><li>First point of many</li><li>Second point</ul></{tag}>
<aside class="sidebar"><h3>Popular</h3><ul><li><a href="/x">Ten tricks for your garden</a></li><li><a href="/y">Rain again</a></li></ul></aside></div>
<section id="comments"><h3>2 comments</h3><div class="comment"><b>Ann</b><p>I disagree with all of this, the harbour needs ships.</p></div>
<div class="comment"><b>Bob</b><p>Great idea, well written!</p></div><form><textarea>say</textarea></form></section>
<footer><p>&copy; 2020 Daily Post. All rights reserved.</p></footer></body></html>"""


def paragraphs(k):
    return [f"{WORDS * 2}It is plan {i} &amp; more &#8211; caf&eacute;.&nbsp; " for i in range(k)]


@pytest.fixture(scope="module")
def trees():
    return h.fit_extractor([f"<article>{''.join(f'<p>{p}</p>' for p in paragraphs(9))}</article>"] * 5)


def text_of(trees, source):
    page = h.parse(source)
    x = h.node_features(page)
    return h.main_text(page, h.decode(page, trees[0].margin(x), trees[1].margin(x)))


def clean(x):
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split())


@pytest.mark.parametrize("tag, name", [("article", ""), ("div", ' class="post-content"'), ("main", ""), ("div", ' id="content"')])
def test_site_without_its_frame(trees, tag, name):
    body = "".join(f"<p>{p}" for p in paragraphs(6))
    expected = ["New library", *map(clean, paragraphs(6)), "First point of many", "Second point"]
    assert text_of(trees, SITE.format(tag=tag, name=name, body=body)).split("\n") == expected


def test_parser():
    page = h.parse("a<div>b <b>c<p>d\n e<br>f<!-- x --><i>g</div>h &lt;i&gt; &amp &am<script>x</p>")
    assert [(page.tags[b], t) for b, t, *_ in page.texts] == [("html", "a"), ("div", "b c"), ("p", "d e fg"), ("html", "h <i> & &am")]
    assert h.parse("").texts == [] and h.parse("<p").texts == [] and h.parse("<div a='>x</div>").texts in ([], [(1, "x", 0, 0)])
    assert [t for _, t, *_ in h.parse("<table><tr><td>1<td>2<tr><td>3</table>").texts] == ["1", "2", "3"]
    deep = h.parse("<div>" * 5000 + "x")
    assert deep.texts == [(5000, "x", 0, 0)]


def test_decoding_agrees_with_search():
    # All labellings of small trees, by brute force.
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(2, 8))
        page = h.Page(tags=["div"] * n, parents=[-1] + [int(rng.integers(0, i)) for i in range(1, n)])
        page.tokens, page.images, page.inputs = [()] * n, [0] * n, [0] * n
        enter, stay = rng.normal(size=n) * 3, rng.normal(size=n) * 3
        got = h.decode(page, enter, stay)
        best, answer = -np.inf, None
        for bits in range(1 << n):
            main = [bool(bits >> i & 1) for i in range(n)]
            clutter, fits, score = [False] * n, True, 0.0
            for i in range(n):
                p = page.parents[i]
                over_main, over_clutter = p >= 0 and main[p], p >= 0 and clutter[p]
                if over_clutter:
                    fits &= not main[i]
                    clutter[i] = True
                else:
                    x = stay[i] if over_main else enter[i]
                    score -= np.logaddexp(0, -x if main[i] else x)
                    clutter[i] = over_main and not main[i]
            if fits and score > best:
                best, answer = score, main
        for i, p in enumerate(page.parents):
            assert not got[i] or p < 0 or got[p] or not any(got[a] for a in ancestors(page, i))
        assert got == answer or not any(answer)


def ancestors(page, i):
    while page.parents[i] >= 0:
        i = page.parents[i]
        yield i


def test_held_out_layouts(trees):
    words = [clean(p) for p in paragraphs(40)]
    right = []
    for source in h.layouts(words, 200, 77):
        page = h.parse(source, truth=True)
        x = h.node_features(page)
        chosen = h.decode(page, trees[0].margin(x), trees[1].margin(x))
        got = sum(len(t) for b, t, *_ in page.texts if chosen[b])
        true = sum(len(t) for b, t, *_ in page.texts if page.marks[b] == "1")
        both = sum(len(t) for b, t, *_ in page.texts if chosen[b] and page.marks[b] == "1")
        right.append(2 * both / max(1, got + true))
    assert np.mean(right) > 0.9 and np.median(right) == 1


def test_tables_own_articles(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    out = {r.page_id: r for r in h.extract_main_text(pages).collect()}
    assert len(out) == pages.count()
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1].replace("<br>", " ")
        expected = "\n".join(x for x in map(clean, re.split(r"</?(?:p|h1)>", inner)) if x)
        assert out[r.page_id].text == expected and out[r.page_id].n_chars == len(expected)


def test_odd_pages(spark):
    long = "<article>" + f"<p>{WORDS * 20}</p>" * 300 + "</article>"
    data = [(1, "u", None, "x"), (1, "u", "", "x"), (None, None, "<script>only</script>", "x"), (4, "u", long, "x"), (4, "u", long, "x")]
    docs = spark.createDataFrame(data, "page_id long, url string, html string, text string")
    out = h.extract_main_text(docs).collect()
    assert sorted(r.n_chars for r in out)[:3] == [0, 0, 0]
    assert [r.text.count("\n") for r in out if r.page_id == 4] == [299, 299]
    assert h.extract_main_text(docs.limit(0)).count() == 0


def test_boosting_learns():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 6)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(int)
    model = boosting.fit_trees(x[:2000], y[:2000], column_share=1.0)
    assert np.mean((model.margin(x[2000:]) > 0) == y[2000:]) > 0.97
    assert boosting.fit_trees(x[:50], np.ones(50, int)).margin(x[:5]).min() > 3
