"""Main-text extraction: the given pages, layouts of its own, broken markup, and the decoding."""

import html as H
import random
import re
import time

import numpy as np
import pyarrow.parquet as pq
import pytest

from pricenet.llm import boosting, html_extract, page_samples, queries
from pricenet.llm.dom import Page
from tests.conftest import SF_CHECK


@pytest.fixture(scope="module")
def trees():
    return html_extract.model()


def article_of(html):
    """The text of the given pages' only article; they have no other markup in it than p, h1, b and br."""
    inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    inner = re.sub(r"</?(?:p|h1|br)[^>]*>", " ", inner)
    return " ".join(H.unescape(re.sub(r"<[^>]*>", "", inner)).split())


def test_whole_table(spark):
    got = {r.page_id: r for r in queries.op7_main_text(spark, SF_CHECK).collect()}
    rows = pq.read_table(f"{SF_CHECK}/pages.parquet").to_pylist()
    assert len(got) == len(rows)
    for row in rows:
        r = got[row["page_id"]]
        assert (r.url, r.text, r.n_chars) == (row["url"], article_of(row["html"]), len(article_of(row["html"])))


def test_unseen_layouts(trees):
    rng = random.Random(77)
    shares = []
    for _ in range(120):
        html = page_samples.Writer(rng).page()
        page = Page(html)
        marks = [0] * len(page.elements)
        for e in page.elements[1:]:
            mark = e.named().get("data-main")
            marks[e.index] = marks[e.parent] if mark is None else int(mark)
        want = html_extract.kept_text(page, [bool(m) for m in marks]).split()
        got = html_extract.extract([re.sub(r' data-main="\d"', "", html)], trees)[0].split()
        shared = len(set(want) & set(got))
        shares.append(2 * shared / max(1, len(set(want)) + len(set(got))))
    assert np.mean(shares) > 0.98 and np.quantile(shares, 0.1) > 0.95


TEXT = "A sentence of the story, long enough to be read as prose by everyone. " * 4


@pytest.mark.parametrize("part", [
    '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>',
    '<div class="cookie-banner"><p>We use cookies to improve this site for all of its visitors.</p><button>OK</button></div>',
    '<aside class="sidebar"><h3>Other things</h3><p>Something else that is happening elsewhere today.</p></aside>',
    '<div id="comments"><h3>2 comments</h3><div class="comment"><p>I do not agree with this at all, sorry.</p></div></div>',
    '<form class="newsletter"><label>Your address</label><input><button>Subscribe</button></form>',
    '<div class="ad">Buy this now and save very much.</div>', "<script>var x = '<p>no text</p>';</script>",
    "<style>p { color: red }</style>", "<footer>&copy; 2020 all of us <a href='/x'>imprint</a></footer>",
    "<header><a href='/'>The site</a></header>", "<!-- <p>hidden</p> -->",
])
@pytest.mark.parametrize("before", [True, False])
def test_one_part_beside_the_article(trees, part, before):
    article = f"<article><h1>The title</h1><p>{TEXT}</p><p>{TEXT}</p></article>"
    body = part + article if before else article + part
    page = f"<html><head><title>t</title></head><body>{body}</body></html>"
    assert html_extract.extract([page], trees)[0] == f"The title {TEXT}{TEXT}".strip()


def test_references_space_and_inline_elements(trees):
    page = "<article><p>Fish &amp; chips&nbsp;&eacute;&#33; a<b>b</b>c <i>d</i>\n\n e<br>f</p><p>" + TEXT + "</p></article>"
    assert html_extract.extract([page], trees)[0] == ("Fish & chips é! abc d e f " + TEXT).strip()


def test_reader_closes_what_browsers_close():
    page = Page("<UL><li>a<li>b</UL><p>c<b>d<p>e</div><div>f<script>if (a<b) '</p>'</script>g<table><tr><td>h<td>i<tr><td>j</table>k")
    tags = [(e.tag, page.elements[e.parent].tag) for e in page.elements[1:]]
    assert tags == [("ul", "#root"), ("li", "ul"), ("li", "ul"), ("p", "#root"), ("b", "p"), ("p", "#root"), ("div", "#root"),
                    ("script", "div"), ("table", "div"), ("tr", "table"), ("td", "tr"), ("td", "tr"), ("tr", "table"), ("td", "tr")]
    assert html_extract.kept_text(page, [True] * len(page.elements)) == "a b cd e f g h i j k"


@pytest.mark.parametrize("html, text", [
    ("", ""), ("plain text only", "plain text only"), ("a < b & c", "a < b & c"), ("<", "<"), ("<p", ""), ("<!--", ""),
    ("<script>never closed", ""), ("</p></div>", ""), ("x" * 50, "x" * 50), ("<title>t</title>", ""),
])
def test_odd_pages(trees, html, text):
    assert html_extract.extract([html], trees) == [text]


def test_very_long_and_deep_pages(trees):
    deep = "<div>" * 3000 + f"<p>{TEXT}</p>" + "</div>" * 3000
    long = f"<article><h1>t</h1>{f'<p>{TEXT}</p>' * 3000}</article>"
    texts = html_extract.extract([deep, long], trees)
    assert texts[1] == "t " + (TEXT * 3000).strip() and len(texts[0]) in (0, len(TEXT.strip()))


def words(n, stem="word"):
    return " ".join(f"{stem}{k}" for k in range(n))


@pytest.mark.parametrize("n", [1, 3, 7, 12, 30])
def test_links_in_prose_stay(trees, n):
    page = f"<article><h1>The title</h1><p>{TEXT}</p><p>{words(40)} <a href='/x'>{words(n, 'link')}</a> {words(35, 'rest')}</p></article>"
    assert html_extract.extract([page], trees)[0] == f"The title {TEXT.strip()} {words(40)} {words(n, 'link')} {words(35, 'rest')}"


NAV = '<nav><a href="/">Home</a> <a href="/n">News</a></nav>'
FOOT = '<footer><p>&copy; 2020 the site</p><a href="/i">Imprint</a></footer>'


@pytest.mark.parametrize("before, inner, after", [
    (NAV, f"<article><h1>T one</h1><p>{TEXT}</p><h2>Sources</h2><ul>" + "".join(
        f'<li><a href="/{k}">{words(4, f"s{k}x")}</a></li>' for k in range(5)) + "</ul></article>", FOOT),
    (NAV, f"<main><h1>T</h1><p>{TEXT}</p><ol><li>{words(9)}</li><li><a href='/a'>{words(6, 'l')}</a></li></ol><p>{TEXT}</p></main>", FOOT),
    ("<header><h2>Daily</h2></header>", f"<div class='post'><h1>T</h1><p><em>{words(12, 'lead')}</em></p><p>{TEXT}</p></div>", FOOT),
    ("", f"<div id='content'><h1>T</h1><p>{TEXT}</p><blockquote><p>{words(20, 'q')}</p></blockquote><p>{TEXT}</p></div>", FOOT),
    (NAV, f"<article><h1>T</h1><p><a href='/only'>{words(10, 'l')}</a></p><p>{TEXT}</p></article>", ""),
    (NAV, f"<article><h1>T</h1><p>{TEXT}</p><table><tr><th>{words(2)}</th><td>{words(3, 'c')}</td></tr><tr><td>x</td><td>y</td></tr></table></article>", FOOT),
    (NAV, f"<article><h1><a href='/self'>A linked title</a></h1><p>{TEXT}</p><p>{words(3, 'short')}</p></article>", FOOT),
    ("<div class='ad'>Buy this now please</div>", f"<article><p>{TEXT}<br>{words(15)}</p><pre>{words(10, 'code')}</pre></article>", FOOT),
    (NAV, f"<article><h1>T</h1><p>{TEXT}</p><figure><img src='a.png'><figcaption>{words(8, 'cap')}</figcaption></figure><p>{TEXT}</p></article>", FOOT),
    (NAV, f"<section class='story-body'><h1>T</h1><p>{TEXT}</p><p>{words(30)} <a href='/1'>{words(4, 'k')}</a>, "
          f"<a href='/2'>{words(5, 'm')}</a> <a href='/3'>{words(6, 'n')}</a>.</p></section>", FOOT),
])
def test_hand_written_layouts_come_out_whole(trees, before, inner, after):
    page = f"<!DOCTYPE html><html><head><title>t</title></head><body>{before}{inner}{after}</body></html>"
    blocks = re.sub(r"</?(?!a\b|em\b)[a-z0-9]+[^>]*>", " ", inner)
    want = " ".join(H.unescape(re.sub(r"<[^>]*>", "", blocks)).split())
    assert html_extract.extract([page], trees)[0] == want


@pytest.mark.parametrize("html", [
    "<b>" * 25_000 + "</i>" * 25_000, "<b>" * 25_000 + "<hr>" * 25_000, "<div>" * 20_000 + "</p>" * 20_000,
    "<p>" + "<b>" * 25_000 + "<li>" * 25_000, "<table>" + "<tr><td>" * 20_000, "<i><p>" * 20_000 + "</i>" * 20_000,
])
def test_reader_is_linear(html):
    began = time.process_time()
    Page(html)
    assert time.process_time() - began < 1.5


def test_decoding_is_consistent():
    page = Page("<div><section><p>a</p><p>b</p></section><nav><a>c</a></nav></div>")
    by = {e.tag: e.index for e in page.elements}
    scores = {"div": -1.0, "section": -0.5, "p": 2.0, "nav": -3.0, "a": 2.0}
    indices = [e.index for e in page.elements[1:]]
    keep = html_extract.decode(page, indices, np.array([scores[page.elements[i].tag] for i in indices]))
    assert keep[by["div"]] and keep[by["section"]] and keep[by["p"]]
    assert not keep[by["nav"]] and not keep[by["a"]]
    assert all(keep[e.parent] or not keep[e.index] for e in page.elements[1:])


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    trees = boosting.train(x, y, np.ones(2000))
    assert (((trees.raw(x) > 0) == (y > 0)).mean()) > 0.95
    again = boosting.train(x, y, np.ones(2000))
    assert (again.raw(x) == trees.raw(x)).all() and len(trees.raw(x[:0])) == 0


def test_awkward_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (3, "u", "<article><p>" + TEXT), (3, "u", "<article><p>" + TEXT)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as n_chars")
    out = html_extract.extract_text(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = out.collect()
    assert len(got) == 5 and [r.text for r in got if r.page_id in (1, 2)] == ["", ""]
    assert [r.text for r in got if r.page_id == 3] == [TEXT.strip()] * 2
    assert html_extract.extract_text(df.limit(0)).count() == 0
