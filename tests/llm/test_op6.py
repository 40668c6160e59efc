"""Main text: given pages against their article, layouts, and odd pages."""

import html as html_lib
import re

import pytest
from pyspark.sql import functions as F

from freshet.llm import op6_html as op


def article(html):
    """The given pages' one article, by patterns."""
    inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    inner = re.sub(r"</?(?:p|h1)[^>]*>", "\0", re.sub(r"<br>", " ", inner))
    parts = re.sub(r"<[a-zA-Z/][^>]*>", "", inner).split("\0")
    return "\n".join(t for t in (" ".join(html_lib.unescape(p).split()) for p in parts) if t)


def test_given_pages(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op.op6_html(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == article(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


@pytest.mark.parametrize("html, want", [
    (None, ""), ("", ""), ("just text", "just text"), ("a < b &amp; c &lt d &#x41;&nbsp;x", "a < b & c < d A x"),
    ("<p>one<p>two<b> bold\n\n text<br>next<p>three", "one\ntwo bold text next\nthree"),
    ("<body><header>Site</header><nav>menu</nav><main><header><h1>T</h1></header><p>x</p><aside>side</aside></main><footer>f</footer>", "T\nx"),
    ("<article><p>a</p><div class='post ad-box ad'>buy</div><section id=comments><p>first!</p></section><form>q<input></form><p>b</article>", "a\nb"),
    ("<script>var a='</p><p>x';</script><style>p{}</style><ul><li>1<li>2<ul><li>3</ul></ul><!-- <p>no --><p title='a>b'>y</p>", "1\n2\n3\ny"),
    ("<table><tr><td>a<td>b<tr><td>c</table><script>never closed <p>x", "a\nb\nc"),
    ("<?xml version='1'?><!DOCTYPE html><P>Up</P></b></div>after</><div", "Up\nafter"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>end", "deep\nend"),
    ("<p>x</p>" + "<a " * 200_000, "x"), ("<p>x</p>" + "<a b=\"" * 2_000 + ">y", "x\ny"), ("a<!-- never closed <p>b", "a"),
    ("<article>" + "<p>w</p>" * 30_000 + "</article>", "\n".join(["w"] * 30_000)),
])
def test_odd_pages(html, want):
    assert op.main_text(html, None, None) == want


def test_layout_numbers_agree_with_the_tree_read_back():
    root = op.parse("<body><div class='x y'><p>1</p><ul><li>a<li><p>b</ul><p>2</p></div><div class='x y'><p>3</div>")
    text = op.layout(root)
    tree, seen = op.Layout(text), {}

    def walk(n):
        if n.place >= 0:
            seen.setdefault(n.place, set()).add(n.label)
        for k in n.kids:
            if not isinstance(k, str):
                walk(k)

    walk(root)
    assert seen == {i: {label} for i, label in enumerate(tree.label)}


def slow_match(a, b, i=0, j=0):
    if a.label[i] != b.label[j]:
        return 0

    def rows(x, y):
        if not x or not y:
            return 0
        return max(rows(x[1:], y), rows(x, y[1:]), slow_match(a, b, x[0], y[0]) + rows(x[1:], y[1:]))

    return 1 + rows(a.kids[i], b.kids[j])


def test_tree_matching_is_the_largest():
    texts = ["r(a(b,c),d(e,e(f)),g)", "r(d(e(f)),a(c),h,g)", "r(a(c,b),a(b,c))", "x(a)", "r"]
    for s in texts:
        for t in texts:
            a, b = op.Layout(s), op.Layout(t)
            pairs = op.match_trees(a, b)
            assert len(pairs) == slow_match(a, b)
            assert all(a.label[i] == b.label[j] for i, j in pairs.items())


def page(i, extra=""):
    return f"<html><body><div class=top>Brand</div><div class=c><h2>Title {i}</h2><p>Text {i} of the page.</p><p>Sign up now!</p>{extra}</div></body></html>"


def wrapped(i):
    return page(i).replace("<p>Sign up now!</p>", "<div class=tail>Sign up now!</div>")


def test_template_nodes_go_and_slots_stay(spark):
    rows = [(i, f"http://H.net/{i}", wrapped(i)) for i in range(30)] + [(100, "http://h.net/x", wrapped(100).replace("<h2>", "<h3>").replace("</h2>", "</h3>"))]
    rows += [(200 + i, "http://copies.net/", wrapped(7)) for i in range(25)]  # copies of one page: all is content
    rows += [(300, "http://few.net/", wrapped(1)), (301, "http://few.net/", wrapped(2)), (400, None, "<p>no url</p>"), (401, "http://h.net/", None), (401, "http://h.net/", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("region", F.lit("clash"))
    got = {r["page_id"]: r["text"] for r in op.extract(df).collect()}
    assert all(got[i] == f"Title {i}\nText {i} of the page." for i in range(30))
    assert got[100] == "Title 100\nText 100 of the page."
    assert all("Text 7 of the page." in got[200 + i] and "Title 7" in got[200 + i] for i in range(25))
    assert got[300].startswith("Title 1\nText 1") and got[400] == "no url" and got[401] == ""
    assert op.extract(df).count() == len(rows) and op.extract(df.limit(0)).count() == 0


def test_copies_of_a_page_are_no_evidence_for_template(spark):
    copy = wrapped(7).replace("</h2>", "</h2><ul><li>Only here</li></ul>")  # the most frequent layout
    rows = [(i, "http://h.net/", wrapped(i)) for i in range(30)] + [(100 + i, "http://h.net/", copy) for i in range(40)]
    article = lambda html, i: html.replace("<div class=c>", "<article>").replace("</div></body>", f"</article><p>Page {i}</p></body>")
    rows += [(1000 + i, "http://a.net/", article(html, i)) for i, _, html in rows]  # copies of what is read only
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in op.extract(df).collect()}
    for at in (0, 1000):
        assert all(got[at + i] == f"Title {i}\nText {i} of the page." for i in range(30))
        assert all(got[at + 100 + i] == "Title 7\nOnly here\nText 7 of the page." for i in range(40))


def test_constant_blocks_beside_varying_siblings_go(spark):
    rows = [(i, "http://h.net/", page(i)) for i in range(30)]
    rows += [(100 + i, "http://h.net/", page(100 + i).replace("Sign up now!", f"Last words of {i}.")) for i in range(20)]
    rows += [(200 + i, "http://rare.net/", page(i).replace("Sign up now!", "See also:" if i < 20 else f"Then {i}.")) for i in range(200)]
    rows += [(500 + i, "http://copies.net/", page(7)) for i in range(25)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in op.extract(df).collect()}
    assert all(got[i] == f"Title {i}\nText {i} of the page." for i in range(30))
    assert all(got[100 + i] == f"Title {100 + i}\nText {100 + i} of the page.\nLast words of {i}." for i in range(20))
    assert all(got[200 + i].endswith(f"Text {i} of the page.\nSee also:") for i in range(20))  # few pages: text
    assert all("Title 7" in got[500 + i] and "Sign up now!" in got[500 + i] for i in range(25))


def _post(i, body_class="", article_class=""):
    return (f"<html><body class='{body_class}'><div class='site-header'><p>Site</p></div><div id=content class='layout'><article class='{article_class}'>"
            f"<h1>Title {i}</h1><p>Text {i} one.</p><p>Text {i} two.</p></article></div><div class='footer-widgets'><p>Foot</p></div></body></html>")


@pytest.mark.parametrize("make", [
    lambda i: _post(i, "post has-sidebar"), lambda i: _post(i, "no-comments right-sidebar"), lambda i: _post(i, "search-results"), lambda i: _post(i, "", "post ad-free"),
    lambda i: _post(i).replace("class='layout'", "class='layout with-sidebar'"), lambda i: _post(i).replace("class='layout'", "class='right-sidebar'"),
    lambda i: _post(i, "page comments"), lambda i: _post(i, "", "comment"),
    lambda i: _post(i).replace("</article>", "</article><div class='comments'><article class='comment'><p>First!</p></article></div>"),
])
def test_class_names_do_not_empty_pages(spark, make):
    df = spark.createDataFrame([(i, "http://h.net/", make(i)) for i in range(6)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in op.extract(df).collect()}
    assert got == {i: f"Title {i}\nText {i} one.\nText {i} two." for i in range(6)}


def test_names_of_chrome():
    assert all(op._is_chrome(t) for t in ("sidebar", "main-sidebar", "footer-widgets", "sidebar-left", "ad_slot_3", "cookie-banner", "menu-item"))
    assert not any(op._is_chrome(t) for t in ("has-sidebar", "with-sidebar", "no-comments", "ad-free", "alert-level", "search-results", "", "-", "post", "header"))


@pytest.mark.parametrize("n", [2, 3, 19, 20, 21])
def test_hosts_of_all_sizes_are_judged_alike(spark, n):
    """A fixed line goes from three pages on; a line two pages share stays."""
    def make(i):
        extra = "<p>Shared by two.</p>" if i < 2 else ""
        return _post(i).replace("</article>", f"{extra}<p>Read more on our site.</p></article>")
    df = spark.createDataFrame([(i, "http://h.net/", make(i)) for i in range(n)], "page_id long, url string, html string")
    for r in op.extract(df).collect():
        lines = r["text"].split("\n")
        assert ("Read more on our site." in lines) == (n < op.LEAST_PAGES)
        assert ("Shared by two." in lines) == (r["page_id"] < 2) and f"Text {r['page_id']} two." in lines


def test_near_copies_are_no_evidence(spark):
    near = lambda i: _post(7).replace("</article>", "".join(f"<p>Paragraph {k}.</p>" for k in range(10)) + f"<p>Seen {i} times.</p></article>")
    df = spark.createDataFrame([(i, "http://h.net/", near(i)) for i in range(30)] + [(100 + i, "http://h.net/", _post(i)) for i in range(5)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in op.extract(df).collect()}
    assert all("Text 7 two.\nParagraph 0." in got[i] and f"Seen {i} times." in got[i] for i in range(30))


def test_very_many_classes_stay_small():
    letters = lambda i: "".join("abcdefghij"[int(c)] for c in str(i))
    html = "<article>" + "".join(f"<div class='{letters(i)} post-{i}'><p>w{i}<ul><li>x</ul></div>" for i in range(20_000)) + "</article>"
    root = op.parse(html)
    text = op.layout(root)
    assert len(text) < 100 and len(op.match_trees(op.Layout(text), op.Layout(text))) == 3
    assert op.main_text(html, None, None) == "\n".join(f"w{i}\nx" for i in range(20_000))
    numbered = op.parse("".join(f"<div class='item item-{i}'><p>w</div>" for i in range(100)))
    assert op.layout(numbered) == "#root(div.item.item(p))"
