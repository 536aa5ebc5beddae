import html
import itertools
import re

import numpy as np
import pytest

from notewright.llm import pages
from notewright.llm.queries import QUERIES
from tests.llm.page_kinds import KINDS


def by_hand(source):
    """The text of the article of a test page, by its known outline."""
    inner = re.search(r"<article>(.*)</article>", source or "", re.S)
    if not inner:
        return ""
    blocks = re.split(r"</?(?:p|h1)>", inner[1])
    texts = [" ".join(html.unescape(re.sub(r"<br>", " ", b).replace("<b>", "").replace("</b>", "")).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


@pytest.fixture(scope="module")
def trees(spark, small_sf):
    return pages.fit(spark.read.parquet(f"{small_sf}/pages.parquet"))


def test_query_on_table(spark, small_sf):
    source = {r.page_id: r for r in spark.read.parquet(f"{small_sf}/pages.parquet").collect()}
    rows = QUERIES["op5_html"](spark, small_sf).collect()
    assert len(rows) == len(source)
    right = [r.text == by_hand(source[r.page_id].html) for r in rows]
    assert all(r.n_chars == len(r.text) and r.url == source[r.page_id].url for r in rows)
    assert sum(right) / len(right) > 0.98


def test_surroundings_inside_and_outside(trees):
    body = "".join(f"<p>Sentence number {k}, with a few more words in it, to be read.</p>" for k in range(6))
    page = f"""<html><body><header><h1>Site name</h1></header><div class="sidebar"><p>Popular things, here.</p></div>
        <div class="cookie-notice">We use cookies, accept.</div>
        <main><h1>Title &amp; more</h1>{body}<form><label>Your mail</label><input></form>
        <div class="comments"><p>Reader says this is a long comment, with words.</p></div></main>
        <footer>Copyright</footer></body></html>"""
    want = "Title & more\n" + "\n".join(f"Sentence number {k}, with a few more words in it, to be read." for k in range(6))
    assert pages.main_texts([page, page], trees) == [want, want]


@pytest.fixture(scope="module")
def more_trees(spark, small_sf):
    return pages.fit(spark.read.parquet(f"{small_sf.replace('sf0.001', 'sf0.01')}/pages.parquet"))


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_articles_of_other_kinds(more_trees, kind):
    source, want = KINDS[kind]
    assert pages.main_texts([source], more_trees) == [want]


def test_pages_that_name_no_article(spark):
    lines = [f"Line {k} of some text that people read, with words in it." for k in range(60)]
    rows = [(k, f"<body><div>{''.join(f'<p>{x}</p>' for x in lines[k : k + 5])}</div></body>") for k in range(40)]
    trees = pages.fit(spark.createDataFrame(rows, "page_id long, html string"))
    source, want = KINDS["notices and adverts between paragraphs"]
    assert pages.main_texts([source], trees) == [want]


def test_deep_pages_in_the_sample(spark):
    deep = "<article>" + "<div>" * 1500 + "<p>Some text, here.</p>"
    rows = [(k, f"{deep}{k}") for k in range(5)]
    frame = spark.createDataFrame(rows, "page_id long, html string")
    assert pages.fit(frame) is not None
    assert pages.fit(frame.limit(0)) is None


def test_decoding_is_the_best_consistent_choice():
    rng = np.random.default_rng(1)
    for _ in range(30):
        parent = np.array([-1, *[rng.integers(0, k) for k in range(1, 8)]])
        odds = rng.normal(size=8)
        best = -np.inf
        for keep in itertools.product((False, True), repeat=7):
            keep = (True, *keep)
            if all(keep[parent[k]] or not keep[k] for k in range(1, 8)):
                best = max(best, sum(odds[k] for k in range(1, 8) if keep[k]))
        kept = pages.decode(odds, parent)
        assert all(kept[parent[k]] or not kept[k] for k in range(1, 8))
        assert sum(odds[1:][kept[1:]]) == pytest.approx(best)


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 5)).astype(np.float32)
    y = ((x[:, 1] > 0) & (x[:, 3] > 0.5)).astype(float)
    fitted = pages.fit_trees(x[:3000], y[:3000])
    assert ((fitted.log_odds(x[3000:]) > 0) == y[3000:]).mean() > 0.97


def test_odd_pages(spark, sf_of):
    long = "<article>" + "<p>A line, of words.</p>" * 5000 + "</article>"
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    odd = [None, "", "plain", "<", "<p", "<!-- x", "<script>a</p>", "</p></div>", "a<br>b&nbsp;c &lt;&#233;", long, deep, "plain"]
    rows = spark.createDataFrame(
        [(i, "u" if i else None, t, "x") for i, t in enumerate(odd)], "page_id long, url string, html string, text string"
    )
    got = {r.page_id: r for r in QUERIES["op5_html"](spark, sf_of(pages=rows)).collect()}
    assert len(got) == len(odd) and got[0].text == got[1].text == ""
    assert all(r.text is not None and r.n_chars == len(r.text) for r in got.values())
    assert got[9].text.count("\n") == 4999
    assert QUERIES["op5_html"](spark, sf_of(pages=rows.limit(0))).count() == 0
    assert pages.main_texts(["a<br>b&nbsp;c &lt;&#233;"], None) == ["a b c <é"]


def test_head_without_an_end_tag():
    for source in (
        "<html><head><title>x</title><body><article><p>text</article></html>",
        "<html><head><title>x</title><meta charset=a><article><p>text</article></html>",
        "<head><noscript><img src=a></noscript><style>p {}</style><title>x<body><p>text",
        "<head><title>x</title><noscript><div>y</div></noscript></head><body><p>text</body>",
    ):
        assert pages.main_texts([source], None) == ["text"], source


@pytest.mark.parametrize("name", ["button", "select", "noscript", "iframe", "object", "svg", "canvas", "template"])
def test_skipped_element_without_an_end_tag(name):
    assert pages.main_texts([f"<body><div><{name}>a<b>b</b></div><p>text</p></body>"], None) == ["text"]
    assert pages.main_texts([f"<body><div><{name}>a</div><p>text</p><{name}>b</{name}><p>more</p></body>"], None) == ["text\nmore"]
    assert pages.main_texts([f"<body><{name}>a<p>text</p><p>more"], None) == ["text\nmore"]
    assert pages.main_texts([f"<body><div><{name}>a<div>b</div><p>c</div></{name}>"], None) == [""]
    assert pages.main_texts([f"<div><{name}>a<div>b</div><i/>c</{name}>text</div>"], None) == ["text"]
