"""Extraction queries over payload tables (RSS feeds, JSON listings, HTML
pages), paging early stop, and the ingest job."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from pressroom.functions.dates import ntz
from pressroom.operators import extract as X
from pressroom.operators import relate as R
from pressroom.operators import select as C
from pressroom.operators.ingest import ingest_job, parse_payloads, payload_report
from pressroom.plans import bindings as B
from pressroom.plans import duck as D
from pressroom.plans.duck import with_
from pressroom.plans.registry import query
from pressroom.sources.tables import read_table

col = F.col
LO, HI = "TIMESTAMP '2024-06-20 00:00:00'", "TIMESTAMP '2024-08-31 23:59:59'"
FEED_ID = "CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) * 1000000 + page"


def _pages(spark, sf_dir):
    return read_table(spark, sf_dir, "pages")


# --- RSS and JSON payloads ----------------------------------------------------------


@query("rss_items", "A9 B1 B12 I10(rfc822) H2", with_(["listing"], f"""
SELECT {FEED_ID} AS feed_id, source, 'Doc ' || CAST(id AS VARCHAR) AS title, url, published_at, lang AS category
FROM listing"""))
def rss_items(spark, sf_dir):
    items = X.rss_items(B.feeds(spark, sf_dir))
    return items.select("feed_id", "source", "title", "url", "published_at", "category")


@query("rss_category_filter", "B2 D7j", with_(["news"], """
SELECT source, url, lang AS category FROM news WHERE lang IN ('en', 'de')"""))
def rss_category_filter(spark, sf_dir):
    items = X.rss_items(B.feeds(spark, sf_dir))
    kept = X.category_gate(items, B.category_allowlist(spark, sf_dir))
    return kept.select("source", "url", "category")


@query("json_listing", "A10 B3 D22", with_(["listing"], """
SELECT source, page, title, content, url, published_at FROM listing"""))
def json_listing(spark, sf_dir):
    hits = X.json_hits(B.listings_json(spark, sf_dir))
    return hits.select("source", "page", "title", "content", "url", "published_at")


@query("canonical_articles", "C1 B13 B12", with_(["news"], """
SELECT 'Doc ' || CAST(id AS VARCHAR) AS title, '' AS content, url, lang, source, published_at FROM news"""))
def canonical_articles(spark, sf_dir):
    items = X.rss_items(B.feeds(spark, sf_dir))
    records = items.select("title", F.lit(None).cast("string").alias("content"), "url",
                           col("category").alias("language"), "source",
                           col("published_at").alias("date"))
    return C.canonical_articles(records)


# --- paging ------------------------------------------------------------------------------


@query("early_stop_page", "C4 F1 D18", with_(["listing"], f"""
SELECT id, source, page FROM (
  SELECT *, coalesce(max(CASE WHEN published_at < {LO} THEN 1 ELSE 0 END) OVER (
    PARTITION BY source ORDER BY page RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped
  FROM listing)
WHERE stopped = 0 AND published_at BETWEEN {LO} AND {HI}"""))
def early_stop_page(spark, sf_dir):
    kept = X.early_stop_page(B.listing(spark, sf_dir), B.WINDOW_MIN, B.WINDOW_MAX)
    return kept.select("id", "source", "page")


@query("early_stop_row", "C5 F1 D18", with_(["listing"], f"""
SELECT id, source, pos FROM (
  SELECT *, max(CASE WHEN published_at < {LO} THEN 1 ELSE 0 END) OVER (
    PARTITION BY source ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stopped
  FROM listing)
WHERE stopped = 0 AND published_at <= {HI}"""))
def early_stop_row(spark, sf_dir):
    kept = X.early_stop_row(B.listing(spark, sf_dir), B.WINDOW_MIN, B.WINDOW_MAX)
    return kept.select("id", "source", "pos")


@query("page_frontier", "A14 B10", with_(["listing"], """
SELECT source, mode, page_no,
  'https://' || source || '.example.com/news?' || CASE WHEN mode = 'offset' THEN 'start=' ELSE 'page=' END
    || CAST(page_no AS VARCHAR) AS url
FROM (
  SELECT source, mode, unnest(CASE mode WHEN 'one_based' THEN range(1, n + 1) WHEN 'zero_based' THEN range(0, n)
                              WHEN 'offset' THEN range(0, n * 20, 20) ELSE range(2, n + 1) END) AS page_no
  FROM (SELECT source, max(page) + 1 AS n, ['one_based', 'zero_based', 'offset', 'from_two'][
          CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4 + 1] AS mode FROM listing GROUP BY source))"""))
def page_frontier(spark, sf_dir):
    from pressroom.operators.frontier import frontier
    return frontier(B.page_counts(spark, sf_dir), "https://{source}.example.com/news?", B.PAGE_SIZE)


# --- HTML pages -------------------------------------------------------------------------------


@query("scan_pages", "A11", "SELECT page_id, url, CAST(length(html) AS BIGINT) AS n_chars FROM pages")
def scan_pages(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", "url", F.length("html").cast("long").alias("n_chars"))


_NAV = """SELECT page_id, url, h, t, unnest(range(1, len(h) + 1)) AS k FROM (
    SELECT page_id, url, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS h,
           regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS t FROM pages)"""


@query("listing_cards", "B4 H2", f"""
SELECT page_id, url, k - 1 AS pos, h[k] AS href, {D.unescape('t[k]')} AS text FROM ({_NAV})""")
def listing_cards(spark, sf_dir):
    cards = X.nav_cards(_pages(spark, sf_dir))
    return cards.select("page_id", "url", col("pos").cast("long").alias("pos"), "href", "text")


@query("absolute_links", "B11", f"""
SELECT page_id, k - 1 AS pos,
  CASE WHEN starts_with(h[k], '/') THEN regexp_extract(url, '^(https?://[^/]+)', 1) || h[k] ELSE h[k] END AS link
FROM ({_NAV})""")
def absolute_links(spark, sf_dir):
    cards = X.nav_cards(_pages(spark, sf_dir))
    return cards.select("page_id", col("pos").cast("long").alias("pos"),
                        X.absolute(col("url"), col("href")).alias("link"))


@query("article_text", "B5", f"""
SELECT page_id, {D.strip_tags(D.container('html'))} AS text FROM pages""")
def article_text(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", X.strip_tags(X.container(col("html"))).alias("text"))


@query("first_paragraph", "B6 D21 D24", f"""
SELECT page_id, coalesce({D.paragraphs(D.container('html'))}[1], '') AS first FROM pages""")
def first_paragraph(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", X.first_paragraph(col("html")).alias("first"))


@query("paragraphs_joined", "B7 D24", f"""
SELECT page_id, array_to_string(list_transform({D.paragraphs(D.container('html'))}, lambda p: p || chr(10)), '')
  AS text FROM pages""")
def paragraphs_joined(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", X.paragraphs_joined(col("html")).alias("text"))


def _boilerplate_sql() -> str:
    body = r"regexp_replace(regexp_extract(html, '(?s)<body\b[^>]*>(.*)', 1), '(?s)</body>.*$', '')"
    for pat in X.BOILERPLATE:
        body = f"regexp_replace({body}, '{pat}', '', 'g')"
    return rf"regexp_replace({D.strip_tags(body)}, '\n+', chr(10), 'g')"


@query("article_minus_boilerplate", "B8", f"SELECT page_id, {_boilerplate_sql()} AS text FROM pages")
def article_minus_boilerplate(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", X.text_without_boilerplate(col("html")).alias("text"))


@query("page_meta", "B9 B10", rf"""
SELECT page_id, {D.unescape("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} AS title,
  regexp_extract(html, '<html\b[^>]*\blang="([^"]*)"', 1) AS lang,
  coalesce(TRY_CAST(nullif(regexp_extract(html, 'class="(?:[^"]*[ _-])?total(?: [^"]*)?"[^>]*>\s*([0-9]+)\s*<', 1), '')
    AS INTEGER), 1) AS max_page
FROM pages""")
def page_meta(spark, sf_dir):
    p = _pages(spark, sf_dir)
    return p.select("page_id", X.page_title(col("html")).alias("title"), X.page_lang(col("html")).alias("lang"),
                    X.pager_size(col("html")).alias("max_page"))


@query("attach_content", "D1j B14", with_(["news"], f"""
SELECT n.id, p.page_id IS NOT NULL AS fetched,
  CAST(length(coalesce({D.strip_tags(D.container('p.html'))}, '')) AS BIGINT) AS n_chars
FROM news n LEFT JOIN pages p ON n.id = p.page_id"""))
def attach_content(spark, sf_dir):
    n = B.news(spark, sf_dir).select("id")
    fetched = _pages(spark, sf_dir).select(col("page_id").alias("id"),
                                           X.strip_tags(X.container(col("html"))).alias("content"))
    j = R.attach_content(n, fetched, on="id", flag_col="fetched")
    return j.select("id", "fetched", F.length("content").cast("long").alias("n_chars"))


# --- the ingest job -----------------------------------------------------------------------------


INGEST_DAY = _dt.date(2024, 9, 1)   # "today" of the ingest run
RUN_LO = """greatest(TIMESTAMP '2024-08-26', CASE WHEN rank % 5 = 0 THEN TIMESTAMP '0001-01-01'
  ELSE CAST(DATE '2024-08-20' + CAST(rank % 10 AS INTEGER) + 1 AS TIMESTAMP) END)"""

RULES_SQL = f"SELECT name AS source, CASE WHEN rank % 2 = 0 THEN 'json' ELSE 'rss' END AS kind, {RUN_LO} AS lo FROM authority"


def ingest(spark, sf_dir):
    """K1 on the fixture's payloads: odd-ranked sources publish an RSS feed and
    article pages, even-ranked ones a JSON listing with texts that is read page by
    page. What was stored before the summer stays, the run's articles follow."""
    stored = B.news(spark, sf_dir).where(col("published_at") < ntz(B.WINDOW_MIN)).select(
        "id", "title", "content", "url", "lang", "source", "published_at")
    listing = B.listing(spark, sf_dir)   # numbered and written once
    articles, _ = ingest_job(B.feeds(spark, sf_dir, listing), B.listings_json(spark, sf_dir, listing),
                             B.article_pages(spark, sf_dir), stored, B.source_runs(spark, sf_dir),
                             B.source_rules(spark, sf_dir), INGEST_DAY)
    return articles


@query("job_ingest", "K1 C3 C4 C1 D1j H1 C2 A5 I11 I12 I13 C19 B5", with_(["news", "listing", "authority"], f"""
SELECT id, title, url, lang, source, published_at, CAST(length(content) AS BIGINT) AS n_chars FROM (
  SELECT id, title, content, url, lang, source, published_at FROM news WHERE published_at < {LO}
  UNION ALL
  SELECT (SELECT max(id) FROM news WHERE published_at < {LO}) + row_number() OVER (ORDER BY source, url),
         title, content, url, lang, source, published_at FROM (
    SELECT 'Doc ' || CAST(n.id AS VARCHAR) AS title, n.content, n.url, n.lang, n.source, n.published_at
    FROM news n JOIN rules r ON n.source = r.source AND r.kind = 'rss'
    WHERE n.published_at BETWEEN r.lo AND {HI}
    UNION ALL
    SELECT l.title, l.content, l.url, 'en', l.source, l.published_at FROM (
      SELECT n.*, r.lo, coalesce(max(CASE WHEN published_at < r.lo THEN 1 ELSE 0 END) OVER (
        PARTITION BY n.source ORDER BY page RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped
      FROM listing n JOIN rules r ON n.source = r.source AND r.kind = 'json') l
    WHERE l.stopped = 0 AND l.published_at BETWEEN l.lo AND {HI}))""", [("rules", RULES_SQL)]))
def job_ingest(spark, sf_dir):
    out = ingest(spark, sf_dir)
    return out.select("id", "title", "url", "lang", "source", "published_at",
                      F.length("content").cast("long").alias("n_chars"))


@query("broken_payloads", "A9 A10 B14 C19", with_(["listing", "authority"], f"""
SELECT source, page, reason, CASE WHEN reason IS NULL THEN n ELSE 0 END AS n_items FROM (
  SELECT l.source, l.page, count(*) AS n, CASE l.page % 5 WHEN 0 THEN 'malformed' WHEN 2 THEN 'empty'
         WHEN 1 THEN CASE WHEN r.kind = 'json' THEN 'no hits' ELSE 'no channel' END END AS reason
  FROM listing l JOIN rules r ON l.source = r.source GROUP BY l.source, l.page, r.kind)""", [("rules", RULES_SQL)]))
def broken_payloads(spark, sf_dir):
    """Feeds and listing pages of which some are broken: what each gave, and why
    it gave nothing."""
    listing = B.listing(spark, sf_dir)
    feeds = B.damaged(B.feeds(spark, sf_dir, listing), "xml", col("page"), "<html><body>Not found</body></html>")
    pages = B.damaged(B.listings_json(spark, sf_dir, listing), "json", col("page"), '{"error": "limit"}')
    return payload_report(parse_payloads(feeds, pages, B.source_rules(spark, sf_dir), INGEST_DAY))


# --- rules-driven extraction ------------------------------------------------------------


def _layout_rules(spark):
    """Extraction rules keyed by page layout (one layout in the driver pages)."""
    return spark.createDataFrame(
        [("fixture", "nav li", "a", "a@href", "", "article", "")],
        "layout string, card string, title string, link string, date string, container string, drop string")


def _pages_with_layout(spark, sf_dir):
    return _pages(spark, sf_dir).withColumn("layout", F.lit("fixture"))


@query("listing_cards_rules", "B4 B12 (rules table)", f"""
SELECT page_id, url, k - 1 AS pos, h[k] AS href, {D.unescape('t[k]')} AS text FROM ({_NAV})""")
def listing_cards_rules(spark, sf_dir):
    from pressroom.operators.markup import extract_cards
    rules = _layout_rules(spark).select("layout", "card", "title", "link", "date")
    cards = extract_cards(_pages_with_layout(spark, sf_dir), rules, "layout")
    return cards.select("page_id", "url", "pos", col("link").alias("href"), col("title").alias("text"))


@query("article_text_rules", "B5 (rules table)", f"""
SELECT page_id, {D.strip_tags(D.container('html'))} AS text FROM pages""")
def article_text_rules(spark, sf_dir):
    from pressroom.operators.markup import extract_container
    rules = _layout_rules(spark).select("layout", "container", "drop")
    return extract_container(_pages_with_layout(spark, sf_dir), rules, "layout").select("page_id", "text")


@query("boilerplate_rules", "B8 (rules table, drop list)", f"""
SELECT page_id, {_boilerplate_sql()} AS text FROM pages""")
def boilerplate_rules(spark, sf_dir):
    from pressroom.operators.markup import extract_container
    rules = spark.createDataFrame([("fixture", "body", "nav, div.ad, footer, script, style")],
                                  "layout string, container string, drop string")
    out = extract_container(_pages_with_layout(spark, sf_dir), rules, "layout")
    return out.select("page_id", F.regexp_replace("text", r"\n+", "\n").alias("text"))
