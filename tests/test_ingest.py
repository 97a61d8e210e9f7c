"""The ingest job on hand-written payloads of every kind."""

import datetime as dt
import json

from pyspark.sql import functions as F

from pressroom.operators import relate as R
from pressroom.operators.ingest import RULES, ingest_job, ingest_run, parse_payloads, payload_report

DAY = dt.date(2024, 6, 6)   # a Thursday: the week starts on June 3

CARD = """<div class="card big"><h2> {title} </h2><a class="more" href="{url}">x</a><time datetime="{day}T08:00:00.000Z">d</time></div>"""


def rule(source, kind, **values):
    names = [c.strip().split(" ")[0] for c in RULES.split(", ")]
    return tuple({"source": source, "kind": kind, **values}.get(n) for n in names)


def test_every_kind_of_source(spark):
    cards = dict(card="div.card", title="h2", link="a.more@href", date="time@datetime", date_rule="iso_prefix")
    rules = spark.createDataFrame([
        rule("feed", "rss", container="div.body", drop="div.ad", take="paragraphs", allow=["tech", "science"]),
        rule("hits", "json", lang="en", label="Hits", stop="page"),
        rule("cards", "html", lang="en", base="https://c.example", stop="row", container="article", **cards),
        rule("shape", "html", lang="de", container="article", **cards),
        rule("empty", "rss"), rule("broken", "json", stop="page"), rule("old", "rss"), rule("late", "rss"),
    ], RULES)
    item = lambda t, u, d, *c: (f"<item><title>{t}</title><link>{u}</link><pubDate>{d}</pubDate>"
                                + "".join(f"<category>{x}</category>" for x in c) + "</item>")
    rss = lambda *items: "<rss><channel>" + "".join(items) + "</channel></rss>"
    feeds = spark.createDataFrame([
        ("feed", rss(item("A", "https://f/1", "Tue, 4 Jun 2024 10:00:00 +0300", "art", "tech"),
                     item("B", "https://f/2", "Tue, 4 Jun 2024 10:00:00 +0000", "art"),
                     item("C", "https://f/3", "Sun, 2 Jun 2024 23:59:59 +0000", "tech"))),
        ("old", rss(item("O", "https://o/1", "Mon, 27 May 2024 10:00:00 +0000"))),
        ("late", rss(item("L", "https://l/1", "Tue, 4 Jun 2024 10:00:00 +0000"),
                     item("M", "https://l/2", "Wed, 5 Jun 2024 10:00:00 +0000"))),
        ("empty", "<rss"), ("nobody", rss(item("N", "https://n/1", "Tue, 4 Jun 2024 10:00:00 +0000")))],
        "source string, xml string")
    epoch = lambda d: int(dt.datetime(2024, 6, d, tzinfo=dt.timezone.utc).timestamp())
    hit = lambda t, d: {"fields": {"post_title": t, "post_content": f"text {t}", "post_url": f"/{t}",
                                   "post_date_gmt": epoch(d)}}
    page = lambda *hits: json.dumps({"hits": {"hit": list(hits)}})
    card = lambda t, d: CARD.format(title=t, url=f"/{t}", day=f"2024-06-{d:02}")
    listings = spark.createDataFrame([
        ("hits", 0, page(hit("h1", 5), hit("h2", 4))), ("hits", 1, page(hit("h3", 1), hit("h4", 3))),
        ("hits", 2, page(hit("h5", 4))), ("broken", 0, "{"),
        ("cards", 0, json.dumps({"items": [{"html": card("c1", 5)}, {"html": card("c2", 4)}]})),
        ("cards", 1, json.dumps({"html": card("c3", 1) + card("c4", 4)})),
        ("shape", 0, json.dumps({"rendered": card("s1", 1) + card("s2", 3)}))], "source string, page int, json string")
    pages = spark.createDataFrame([
        ("https://f/1", "<div class='body x'><p>one<p>two &mdash; x<div class=ad><p>ad</div></div><p>out"),
        ("https://c.example/c1", "<article>c &amp; one</article>"), ("/s2", "<b>no article</b>")], "url string, html string")
    log = spark.createDataFrame([("ingest", "parse_and_save_late", "SUCCESS", dt.datetime(2024, 6, 4, 7)),
                                 ("ingest", "parse_and_save_late", "FAILED", dt.datetime(2024, 6, 6)),
                                 ("other", "parse_and_save_feed", "SUCCESS", dt.datetime(2024, 6, 5))],
                                "dag_id string, task_id string, state string, end_date timestamp_ntz")
    stored = spark.createDataFrame([(7, "old", "", "u", "en", "s", dt.datetime(2024, 1, 1))],
                                   "id long, title string, content string, url string, lang string, source string, published_at timestamp_ntz")
    articles, quarantine = ingest_job(feeds, listings, pages, stored, log, rules, DAY)
    got = {r["title"]: r for r in articles.collect()}
    assert sorted(got) == ["A", "M", "c1", "c2", "h1", "h2", "h4", "old", "s2"]
    assert got["A"]["content"] == "one\ntwo \u2014 x\n" and got["A"]["lang"] == "art"
    assert got["A"]["published_at"] == dt.datetime(2024, 6, 4, 7)
    assert (got["h1"]["source"], got["h1"]["content"], got["h1"]["lang"]) == ("Hits", "text h1", "en")
    assert (got["c1"]["url"], got["c1"]["content"]) == ("https://c.example/c1", "c & one")
    assert got["c2"]["content"] == "" and got["s2"]["content"] == "" and got["s2"]["lang"] == "de"
    assert sorted(r["id"] for r in got.values()) == list(range(7, 16)) and got["old"]["id"] == 7
    assert {r["source"]: r["reason"] for r in quarantine.collect()} == {
        "empty": "no items", "broken": "no items", "old": "no items in the window"}
    none, _ = ingest_job(feeds.limit(0), listings.limit(0), pages.limit(0), stored.limit(0), log.limit(0), rules, DAY)
    assert none.count() == 0


LOG = "dag_id string, task_id string, state string, end_date timestamp_ntz"
STORED = "id long, title string, content string, url string, lang string, source string, published_at timestamp_ntz"


def hits_page(*days, url="/{n}", prefix="h"):
    epoch = lambda d: int(dt.datetime(*d, tzinfo=dt.timezone.utc).timestamp())
    return json.dumps({"hits": {"hit": [{"fields": {
        "post_title": f"{prefix}{n}", "post_content": None, "post_url": url.format(n=f"{prefix}{n}"), "post_date_gmt": epoch(d)}}
        for n, d in enumerate(days)]}})


def run(spark, rules, feeds=(), listings=(), pages=(), day=dt.date(2024, 10, 4), log=()):
    return ingest_run(spark.createDataFrame(list(feeds), "source string, xml string"),
                      spark.createDataFrame(list(listings), "source string, page int, json string"),
                      spark.createDataFrame(list(pages), "url string, html string"),
                      spark.createDataFrame([], STORED), spark.createDataFrame(list(log), LOG),
                      spark.createDataFrame(rules, RULES), day)


def test_row_stop_on_hits_and_items(spark):
    # an old hit between new ones: what comes after it is not read, what came before is
    days = [(2024, 10, 3), (2024, 10, 2), (2024, 1, 1), (2024, 10, 1)]
    item = lambda n, d: (f"<item><title>f{n}</title><link>/f{n}</link><pubDate>"  # noqa: E731
                         f"{dt.datetime(*d):%a, %d %b %Y} 00:00:00 +0000</pubDate></item>")
    feed = "<rss><channel>" + "".join(item(n, d) for n, d in enumerate(days)) + "</channel></rss>"
    out = run(spark, [rule("j", "json", stop="row"), rule("r", "rss", stop="row"), rule("all", "json")],
              feeds=[("r", feed)], listings=[("j", 0, hits_page(*days)), ("all", 0, hits_page(*days, prefix="a"))])
    assert sorted(r.title for r in out.articles.collect()) == ["a0", "a1", "a3", "f0", "f1", "h0", "h1"]
    assert out.quarantine.collect() == []


def test_positions_run_on_over_pages_and_fragments(spark):
    card = lambda t, d: CARD.format(title=t, url=f"/{t}", day=f"2024-10-{d:02}")
    cards = dict(card="div.card", title="h2", link="a.more@href", date="time@datetime", date_rule="iso_prefix", stop="row")
    out = run(spark, [rule("c", "html", **cards)], listings=[
        ("c", 0, json.dumps({"items": [{"html": card("a", 3)}, {"html": card("b", 2) + card("old", 1).replace("2024-10", "2024-01")},
                                       {"html": card("after", 3)}]})), ("c", 1, json.dumps({"html": card("later", 3)}))])
    assert sorted(r.title for r in out.articles.collect()) == ["a", "b"]


def test_page_fetched_twice_is_one_page(spark):
    pages = [("/h0", "<article>first</article>"), ("/h0", "<article>second</article>"), ("/h0", None)]
    out = run(spark, [rule("j", "json", container="article")], listings=[("j", 0, hits_page((2024, 10, 3)))], pages=pages)
    assert [(r.id, r.content) for r in out.articles.collect()] == [(1, "second")]
    listing = spark.createDataFrame([("u",), ("v",), (None,)], "url string")
    fetched = spark.createDataFrame([("u", "a"), ("u", "b"), ("w", "c"), (None, "d")], "url string, content string")
    got = R.attach_content(listing, fetched, flag_col="there").collect()
    assert sorted((r.url or "", r.content, r.there) for r in got) == [("", "", False), ("u", "b", True), ("v", "", False)]


def test_two_updates_of_a_key_are_one(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id long, x string, y int")
    updates = spark.createDataFrame([(1, "p", None, 1), (1, "o", 7, 2), (1, None, None, 3), (3, "n", 1, 1)],
                                    "id long, x string, y int, at int")
    assert sorted(map(tuple, R.masked_update(base, updates, order="at").collect())) == [(1, "o", 7), (2, "b", 2)]
    assert sorted(map(tuple, R.masked_update(base, updates.drop("at")).collect())) == [(1, "p", 7), (2, "b", 2)]
    once = updates.where("at = 2")
    assert sorted(map(tuple, R.masked_update(base, once, unique=True).collect())) == [(1, "o", 7), (2, "b", 2)]


def test_broken_payloads_are_reported(spark):
    good = hits_page((2024, 10, 3))
    feed = "<rss><channel><item><title>t</title><link>/t</link><pubDate>Thu, 03 Oct 2024 00:00:00 +0000</pubDate></item></channel></rss>"
    cards = dict(card="div.card", title="h2", link="a.more@href", date="time@datetime", date_rule="iso_prefix")
    html = json.dumps({"html": CARD.format(title="c", url="/c", day="2024-10-03")})
    feeds = [("r", feed), ("cut", feed[:-3]), ("other", "<html><p>x</p></html>"), ("blank", " "), ("null", None), ("bare", "<rss><channel/></rss>")]
    listings = [("j", 0, good), ("j", 1, good[:-2]), ("j", 2, "{}"), ("j", 3, '{"hits": {"hit": []}}'), ("j", 4, "[1]"), ("j", 5, None),
                ("h", 0, html), ("h", 1, "<html>"), ("h", 2, '{"x": 1}'), ("h", 3, '{"items": []}')]
    rules = [rule(s, "rss") for s, _ in feeds] + [rule("j", "json"), rule("h", "html", **cards)]
    out = run(spark, rules, feeds=feeds, listings=listings)
    assert {(r.source, r.page): (r.reason, r.payload) for r in out.broken.collect()} == {
        ("cut", 0): ("malformed", feed[:-3]), ("other", 0): ("no channel", "<html><p>x</p></html>"), ("blank", 0): ("empty", " "),
        ("null", 0): ("empty", None), ("j", 1): ("malformed", good[:-2]), ("j", 2): ("no hits", "{}"), ("j", 4): ("malformed", "[1]"),
        ("j", 5): ("empty", None), ("h", 1): ("malformed", "<html>"), ("h", 2): ("no markup", '{"x": 1}')}
    assert sorted(r.title for r in out.articles.collect()) == ["c", "h0", "t"]
    assert {r.source for r in out.quarantine.collect()} == {"cut", "other", "blank", "null", "bare"}
    told = payload_report(parse_payloads(spark.createDataFrame(feeds, "source string, xml string"), spark.createDataFrame(
        listings, "source string, page int, json string"), spark.createDataFrame(rules, RULES), DAY)).collect()
    assert {(r.source, r.page): r.n_items for r in told if r.n_items} == {("r", 0): 1, ("j", 0): 1, ("h", 0): 1}
    assert len(told) >= len(feeds) + len(listings) - 1
