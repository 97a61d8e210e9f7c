"""Elements by class and attribute, on nested, unclosed and broken markup."""

import html as stdlib
import re

import pytest
from pyspark.sql import functions as F

from pressroom.operators import markup as M

LISTING = """<div class="list">
  <div class="card vertical light"><div class="font-bold">First <b>story</b></div>
     <a class="more" href="/n/1?a=1&amp;b=2">more</a><time datetime="2024-06-05T10:00:00">5 June</time></div>
  <div class='light x card vertical'><div class="font-bold">Second</div>
     <a class="more" href=/n/2>more</a></div>
  <div class="card">not a match</div><div class="cards vertical light">nor this</div>
</div>"""


def one(spark, html, column):
    return spark.createDataFrame([(html,)], "html string").select(column(M.page(F.col("html")))).first()[0]


def test_cards_by_rule(spark):
    pages = spark.createDataFrame([(1, "x", LISTING), (2, "none", LISTING), (3, "x", None), (4, "x", "")],
                                  "page_id long, layout string, html string")
    rules = spark.createDataFrame([("x", "div.card.vertical.light", "div.font-bold", "a@href", "time@datetime")],
                                  "layout string, card string, title string, link string, date string")
    got = [tuple(r) for r in M.extract_cards(pages, rules, "layout").orderBy("pos").collect()]
    assert got == [(1, "x", 0, "First story", "/n/1?a=1&b=2", "2024-06-05T10:00:00"), (1, "x", 1, "Second", "/n/2", None)]


CASES = [
    ("div.a.b", '<div class="b c a">x<div>y</div>z</div><div class="a">n</div>', ["x<div>y</div>z"]),
    ("p", "<article><p>one<br><p>two</article><p>three", ["one<br>", "two", "three"]),
    ("article p", "<p>out<article><p>in</article><p>out", ["in"]),
    ("article", "<p>open<article>body</article>", ["body"]),
    ("[itemprop]", '<span itemprop>a</span><div itemprop="x">b</div><i>c</i>', ["a", "b"]),
    ("article[itemprop=articleBody]", '<article>n</article><article itemprop="articleBody">y</article>', ["y"]),
    ("li", "<ul><li>a<li>b</ul><ol><li>c</li></ol>", ["a", "b", "c"]),
    ("div", "<div>" * 3 + "x" + "</div>" * 2, ["<div><div>x</div>"]),
    ("b", "<b>" * 3000, ["<b>" * 2999]),
    ("span.x", '<!-- <span class="x">n</span> --><script>"<span class=x>n</span>"</script><SPAN CLASS="x">y</SPAN>', ["y"]),
    ("div.ad", '<div class="ad">1 < 2</div>', ["1 < 2"]),
    ("", "<p>x</p>", []),
    ("p.q", "<p>x</p>", []),
]


@pytest.mark.parametrize("selector,html,inner", CASES)
def test_elements(spark, selector, html, inner):
    got = one(spark, html, lambda p: M.elements(p, selector))
    assert [re.sub(r"^<[^>]*>|</[a-zA-Z]+>$", "", e) for e in got] == inner


def test_container_without_subtrees(spark):
    html = ("<body><nav><a>menu</a></nav><article><p><b>one.<br><p>two &amp; more</p>"
            "<div class='ad big'>buy<div>x</div></div><p>three</article><footer>f</footer>")
    pages = spark.createDataFrame([(k, html) for k in ("all", "body", "joined", "lead", "gone", "other")], "source string, html string")
    rules = spark.createDataFrame([("all", "body", "", None), ("body", "body", "nav, div.ad, footer", "text"),
                                   ("joined", "article", "div.ad", "paragraphs"), ("lead", "article", None, "first"),
                                   ("gone", "section", "", "text")],
                                  "source string, container string, drop string, take string")
    got = {r["source"]: r["text"] for r in M.extract_container(pages, rules, "source").collect()}
    assert got == {"all": "menuone.two & morebuyxthreef", "body": "one.two & morethree",
                   "joined": "one.\ntwo & more\nthree\n", "lead": "one.", "gone": "", "other": ""}


TECH = """<body><div class="entry-content"><p>Lead &amp; more.</p>
<section><div><h2>Support TechNode</h2></div><p>Give</p></section>
<p>Body<br>text</p>

<div class="x jp-relatedposts"><p>Related</p></div><div><h2>Support TechNode now</h2></div><p>End</p></div><footer>f</footer></body>"""


def test_boilerplate_by_ancestor_and_text(spark):
    pages = spark.createDataFrame([("tech", TECH), ("none", TECH), ("one", "<article><i>x</i><b><i>x</i></b><i>y</i></article>"),
                                   ("high", "<article><p><i>x</i>z</article>")], "source string, html string")
    rules = spark.createDataFrame([("tech", "div.entry-content", "h2:text(Support TechNode):first:up(2), .jp-relatedposts"),
                                   ("one", "article", "i:text(x):first"), ("high", "article", "i:up(9), i:text(y, z)")],
                                  "source string, container string, drop string")
    got = {r["source"]: re.sub(r"\n+", "\n", r["text"]) for r in M.extract_container(pages, rules, "source").collect()}
    assert got == {"tech": "Lead & more.\nBodytext\nSupport TechNode nowEnd", "none": "", "one": "xy", "high": "xz"}


def test_open_elements_end_with_what_holds_them(spark):
    ends = "<b><div class=t>x</b>y</div><ul><li>a<ul><li>in</li></ul>b<li>c</ul><td>d<td>e</nothing>"
    assert one(spark, ends, lambda p: M.elements(p, "div.t")) == ["<div class=t>x"]
    assert one(spark, ends, lambda p: M.elements(p, "li")) == ["<li>a<ul><li>in</li></ul>b", "<li>c"]
    assert one(spark, ends, lambda p: M.elements(p, "li:text(in):up(2)")) == ["<li>a<ul><li>in</li></ul>b"]
    assert one(spark, ends, lambda p: M.elements(p, "td")) == ["<td>d", "<td>e</nothing>"]


def test_a_rule_takes_one_walk(spark):
    pages = spark.createDataFrame([("x", LISTING)], "layout string, html string")
    rules = spark.createDataFrame([("x", "div.card.vertical.light", "div.font-bold", "a@href", "time@datetime")],
                                  "layout string, card string, title string, link string, date string")
    plan = M.extract_cards(pages, rules, "layout")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(concat(<page>") == 1


def test_entities_match_the_standard_library(spark):
    texts = ["&mdash;&#8217;&laquo;x&raquo;", "&amp;lt;", "&nope; & &; &#x1F600;&#128512;", "&eacute;&Eacute;&hellip;",
             "a&b;c", "&#xD800;&#1114112;", "&NotEqualTilde;", "plain", "&quot;&#39;&nbsp;&copy;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", M.unescape(F.col("t")).alias("u")).collect():
        if "xD800" not in r["t"]:
            assert r["u"] == stdlib.unescape(r["t"]), r["t"]


def test_meta_fields(spark):
    html = '<head><meta charset="utf-8"><meta content="T &amp; t" name="title"><meta itemprop=datePublished content="2024-06-05"></head>'
    assert one(spark, html, lambda p: M.meta_content(p, "title")) == "T & t"
    assert one(spark, html, lambda p: M.meta_content(p, "datePublished")) == "2024-06-05"
    assert one(spark, html, lambda p: M.meta_content(p, "author")) is None
