"""Marks of the HTML extractor: what they hide, what they must not, and their votes per host."""

import random
import time
from html.parser import HTMLParser

import pytest

from cohortlens.llm import html_text

LONG = " ".join(["This is the running text of the article with enough words."] * 12)


def text(body, ignored=frozenset()):
    return html_text.Page(f"<html><body>{body}</body></html>", ignored).text(None)


@pytest.mark.parametrize("inner", ["<p data-id='ad'>kept</p>", "<div data-role='sidebar'>kept</div>", "<p title='see class=ad here'>kept</p>",
                                   "<p ID=x data-class=ad>kept</p>", "<p class='social-contract'>kept</p>", "<p aria-label=\"id='menu'\">kept</p>"])
def test_other_attributes_hide_nothing(inner):
    assert text(f"<article><p>{LONG}</p>{inner}</article>") == f"{LONG}\n\nkept"


@pytest.mark.parametrize("name", ["comment-list", "user-comments", "comments-section", "site-header", "site-footer", "left-sidebar",
                                  "cookie-notice-bar", "main-menu", "ad_3", "Cookie-Banner"])
@pytest.mark.parametrize("attribute", ["class", "id", "CLASS"])
def test_longer_names_hide(name, attribute):
    junk = f"<div {attribute}='x {name}'>junk</div>" if attribute != "id" else f"<div id='{name}'>junk</div>"
    for body in (f"<article><p>{LONG}</p></article>{junk}", f"<div class=post><p>{LONG}</p></div>{junk}",
                 f"<article>{junk}<p>{LONG}</p>{junk}</article>", f"{junk}<p>{LONG}</p>"):
        assert text(body) == LONG


@pytest.mark.parametrize("name", ["layout with-sidebar", "content no-comments", "elementor-widget elementor-widget-theme-post-content",
                                  "page-social", "post-with-comments", "has-menu"])
def test_names_around_the_article_hide_nothing(name):
    for inner in (f"<article><p>{LONG}</p></article>", f"<p>{LONG}</p>", f"<main><p>{LONG}</p></main>"):
        assert text(f"<div class='{name}'>{inner}</div>") == LONG


@pytest.mark.parametrize("one", ["<p>a reader has much to say here</p>", "<article class=comment><p>a reader has much to say here</p></article>"])
def test_comments_longer_than_the_post(one):
    assert text(f"<div class=post><p>{LONG}</p></div><div class=comments>{one * 80}</div>") == LONG


def test_nested_items_take_linear_time():
    t = time.perf_counter()
    assert html_text.Page("<div>" * 8000 + "<li></li>" * 8000 + "<li>x").text(None) == "x"
    html_text.Page("<table>" + "<tr><td><p>" * 8000)
    assert time.perf_counter() - t < 4


def test_ends_that_starts_imply():
    assert text("<ul><li>a<li>b<ul><li>c<li>d</ul>e<li>f</ul><dl><dt>g<dd>h<dt>i</dl><p>j<p>k<table><tr><td>l<td>m<tr><td>n</table>") == \
        "\n\n".join("abcdefghijklmn")


def test_hosts_decide_what_a_mark_is(spark):
    """On host a the widgets hold the article, so a short one on a page is no junk; on host b they are junk."""
    body = f"<div class='el-widget'><p>{LONG}</p></div>"
    short = "<div class=post><div class='el-widget'><h1>A headline</h1></div><p>{}</p></div>".format(LONG)
    pages = [(i, "https://a.example/x", body) for i in range(3)] + [(10, "https://a.example/y", short)]
    pages += [(20 + i, "https://b.example/x", f"<div class=post><p>{LONG}</p></div><div class='el-widget'>junk of the host</div>") for i in range(3)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    out = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert out[10] == f"A headline\n\n{LONG}" and out[0] == LONG and out[20] == LONG


def test_tied_votes_take_the_deeper_then_the_later_path(spark):
    pages = [(1, "https://t.example/1", f"<div class=b><p>{LONG}</p></div>"), (2, "https://t.example/2", f"<div class=a><p>{LONG}</p></div>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    for d in (df, df.orderBy("page_id", ascending=False)):
        out = html_text.extract(d).collect()
        assert {r.path for r in out} == {"page>div.b"} and {r.text for r in out} == {LONG}
    deeper = df.limit(0).union(spark.createDataFrame([(3, "https://t.example/3", f"<div class=a><div class=a><p>{LONG}</p></div></div>")], df.schema))
    assert {r.path for r in html_text.extract(df.where("page_id = 1").union(deeper)).collect()} == {"page>div.a>div.a"}


class Plain(HTMLParser):
    """All text in article but for elements that carry data-junk, block by block."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.blocks, self.part = [], [], ""

    def flush(self):
        t = " ".join(self.part.split())
        if t:
            self.blocks.append(t)
        self.part = ""

    def handle_starttag(self, tag, attrs):
        if tag not in ("a", "b", "i", "em", "span", "br"):
            self.flush()
        if tag == "br":
            self.part += " "
        else:
            self.stack.append((tag, "data-junk" in dict(attrs)))

    def handle_endtag(self, tag):
        if tag not in ("a", "b", "i", "em", "span"):
            self.flush()
        self.stack.pop()

    def handle_data(self, data):
        if any(t == "article" for t, _ in self.stack) and not any(j for _, j in self.stack):
            self.part += data


def generated(seed):
    rng = random.Random(seed)
    junk = ["comment-list", "user-comments", "share", "related", "left-sidebar", "newsletter-box", "ad", "cookie-notice", "main-menu", "social"]

    def words(n):
        return " ".join(rng.choice(["alpha", "beta", "gamma", "caf&eacute;", "x &amp; y", "delta", "&#8212;", "1 &lt; 2"]) for _ in range(n))

    def noise():
        return f"<div data-junk=1 class='{rng.choice(['', 'box '])}{rng.choice(junk)}'><p>{words(rng.randrange(1, 9))}</p></div>"

    def block(depth=0):
        k = rng.randrange(6 if depth < 3 else 3)
        if k == 0:
            return f"<p>{words(12)} <b>{words(2)}</b>, <a href='/x'>{words(1)}</a><br>{words(9)}</p>"
        if k == 1:
            return f"<h2 data-id='menu'>{words(3)}</h2>"
        if k == 2:
            return f"<ul>{''.join(f'<li>{words(4)}</li>' for _ in range(rng.randrange(1, 5)))}</ul>"
        if k == 3:
            return noise()
        return f"<div class='{rng.choice(['body', 'part-3', 'text with-sidebar', ''])}'>{''.join(block(depth + 1) for _ in range(rng.randrange(1, 4)))}</div>"
    article = "".join(block() for _ in range(8)) + f"<p>{words(60)}</p>"
    outside = [f"<nav><a href='/'>{words(3)}</a></nav>", f"<header>{words(4)}</header>", noise(), noise()]
    return f"<html><body>{''.join(outside)}<article>{article}</article>{noise()}<footer>{words(5)}</footer></body></html>"


def test_generated_pages_against_a_plain_extractor(spark):
    pages = [generated(i) for i in range(150)]
    expected = []
    for p in pages:
        plain = Plain()
        plain.feed(p)
        plain.flush()
        expected.append("\n\n".join(plain.blocks))
    assert [html_text.Page(p).text(None) for p in pages] == expected
    df = spark.createDataFrame([(i, f"https://h{i % 7}.example/{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_text.extract(df).collect()} == dict(enumerate(expected))
