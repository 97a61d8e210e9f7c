"""Extraction of article rows from payload tables.

RSS and JSON payloads are parsed with ``from_xml`` / ``from_json`` against
declared schemas and exploded; HTML pages go through regular-expression
column functions (the page markup in scope is regular), all JVM-side.
Per-source behaviour (payload kind, date rule, category allowlist, paging
stop) is data in small rules tables, joined by plain equi-joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pressroom.functions.dates import epoch_seconds_ntz, ntz, parse_date
from pressroom.operators.markup import unescape
from pressroom.schemas import HITS_DOC, HTML_DOC, RSS_DOC

col = F.col

# --- RSS / JSON -------------------------------------------------------------------


#: Where the parsers put a payload that is none.
_BROKEN = "_corrupt_record"


def _broken_too(doc: T.StructType) -> T.StructType:
    return T.StructType([*doc.fields, T.StructField(_BROKEN, T.StringType())])


def _fault(payload: Column, parsed: Column, there: Column, missing: str) -> Column:
    """What is wrong with a payload, null if nothing is: ``empty``, ``malformed``,
    or ``missing`` if it can be read but isn't of the expected kind (a list
    without entries is)."""
    return (F.when(F.coalesce(F.trim(payload), F.lit("")) == "", F.lit("empty"))
            .when(parsed[_BROKEN].isNotNull(), F.lit("malformed")).when(~there, F.lit(missing)))


def _exploded(payloads: DataFrame, payload: str, parsed: Column, entries, there, missing: str) -> DataFrame:
    """Rows ``pos, _it`` of each payload's entries, parsed once. A payload
    without entries has one row of nulls with its ``fault`` (null if it is just empty of
    entries)."""
    own = [c for c in payloads.columns if c not in ("pos", "fault")]
    docs = payloads.select(*own, parsed.alias("_doc"))
    fault = _fault(col(payload), col("_doc"), there(col("_doc")), missing)
    docs = docs.select(*own, fault.alias("fault"), entries(col("_doc")).alias("_list"))
    return docs.select(*own, "fault", F.posexplode_outer(F.when(col("fault").isNull(), col("_list"))).alias("pos", "_it"))


def rss_payloads(feeds: DataFrame, xml_col: str = "xml") -> DataFrame:
    """One row per ``channel/item`` of each feed with its place ``pos`` in it, and
    one row per feed that has none, with its ``fault``. ``pubDate`` is RFC 822
    and is parsed to UTC; ``category`` is the first of the item's ``categories``."""
    items = _exploded(feeds, xml_col, F.from_xml(col(xml_col), _broken_too(RSS_DOC)), lambda d: d["channel"]["item"],
                      lambda d: d["channel"].isNotNull(), "no channel")
    return (items.select("*", col("_it.title").alias("title"), col("_it.link").alias("url"),
                         parse_date(col("_it.pubDate"), "rfc822").alias("published_at"),
                         col("_it.category").alias("categories"),
                         F.try_element_at(col("_it.category"), F.lit(1)).alias("category"))
            .drop("_it"))


def rss_items(feeds: DataFrame, xml_col: str = "xml") -> DataFrame:
    """One row per item of each feed; ``rss_payloads`` tells of feeds without."""
    return rss_payloads(feeds, xml_col).where(col("pos").isNotNull()).drop(xml_col, "fault")


def category_gate(items: DataFrame, allowlist: DataFrame) -> DataFrame:
    """Keep items of which any category is allowed for their source; items
    without a category are dropped. The allowlist is a rules table: its
    categories per source are few and travel as one array."""
    allow = allowlist.groupBy("source").agg(F.collect_set("category").alias("_allowed"))
    kept = items.join(allow, "source").where(F.arrays_overlap("categories", "_allowed"))
    return kept.select(*items.columns)


def json_payloads(listings: DataFrame, json_col: str = "json") -> DataFrame:
    """One row per ``hits.hit[].fields`` of each listing page with its place ``pos``
    in it, and one row per page that has none, with its ``fault``; the epoch
    date is read as UTC."""
    hits = _exploded(listings, json_col, F.from_json(col(json_col), _broken_too(HITS_DOC)), lambda d: d["hits"]["hit"],
                     lambda d: d["hits"]["hit"].isNotNull(), "no hits")
    return (hits.select("*", col("_it.fields.post_title").alias("title"),
                        col("_it.fields.post_content").alias("content"),
                        col("_it.fields.post_url").alias("url"),
                        epoch_seconds_ntz(col("_it.fields.post_date_gmt")).alias("published_at"))
            .drop("_it"))


def json_hits(listings: DataFrame, json_col: str = "json") -> DataFrame:
    """One row per hit of each listing page; ``json_payloads`` tells of pages without."""
    return json_payloads(listings, json_col).where(col("pos").isNotNull()).drop(json_col, "fault")


def fragment_payloads(listings: DataFrame, json_col: str = "json") -> DataFrame:
    """One row per HTML fragment (``html``) of each JSON answer, in any of the
    shapes ``items[].html``, ``rendered`` and ``html``, with its place ``part`` in it,
    and one row per answer that has none, with its ``fault``."""
    parts = lambda d: F.filter(F.concat(
        F.coalesce(F.transform(d["items"], lambda i: i["html"]), F.array().cast("array<string>")),
        F.array(d["rendered"], d["html"])), lambda p: p.isNotNull())
    there = lambda d: d["items"].isNotNull() | d["rendered"].isNotNull() | d["html"].isNotNull()
    return (_exploded(listings, json_col, F.from_json(col(json_col), _broken_too(HTML_DOC)), parts, there, "no markup")
            .withColumnsRenamed({"pos": "part", "_it": "html"}))


def json_fragments(listings: DataFrame, json_col: str = "json") -> DataFrame:
    """One row per HTML fragment; ``fragment_payloads`` tells of answers without."""
    return fragment_payloads(listings, json_col).where(col("part").isNotNull()).drop(json_col, "part", "fault")


# --- early stop --------------------------------------------------------------------


def _bound(value) -> Column:
    return value if isinstance(value, Column) else ntz(value)


def early_stop_page(listing: DataFrame, lo, hi, key: str = "source") -> DataFrame:
    """Paged crawl that stops after the first page holding an item older than
    ``lo``: in-window rows of the pages up to and including that page. The bounds
    are times, or columns of the listing (a window per source).

    The stop page per source is a grouped min (partial aggregation, so a hot
    source is still spread over all tasks) joined back to the listing."""
    old = col("published_at") < _bound(lo)
    stop = listing.groupBy(key).agg(F.min(F.when(old, col("page"))).alias("_stop"))
    j = listing.join(stop, key, "left")
    keep = ((col("_stop").isNull() | (col("page") <= col("_stop")))
            & col("published_at").between(_bound(lo), _bound(hi)))
    return j.where(keep).drop("_stop")


def early_stop_row(listing: DataFrame, lo, hi, key: str = "source") -> DataFrame:
    """Row-by-row crawl that stops at the first item older than ``lo`` (in
    listing order ``pos``); the later bound ``hi`` is applied afterwards."""
    old = col("published_at") < _bound(lo)
    stop = listing.groupBy(key).agg(F.min(F.when(old, col("pos"))).alias("_stop"))
    j = listing.join(stop, key, "left")
    keep = ((col("_stop").isNull() | (col("pos") < col("_stop")))
            & (col("published_at") <= _bound(hi)))
    return j.where(keep).drop("_stop")


# --- HTML ---------------------------------------------------------------------------

# Elements dropped before taking the text of a whole page body.
BOILERPLATE = (r"(?s)<script\b[^>]*>.*?</script>", r"(?s)<style\b[^>]*>.*?</style>",
               r"(?s)<!--.*?-->", r"(?s)<nav\b[^>]*>.*?</nav>",
               r'(?s)<div class="ad">.*?</div>', r"(?s)<footer\b[^>]*>.*?</footer>")


def strip_tags(c: Column) -> Column:
    """Text content of an HTML fragment: tags removed, entities decoded."""
    return unescape(F.regexp_replace(c, r"<[^>]*>", ""))


def container(html: Column, tag: str = "article") -> Column:
    """Inner HTML of the first ``<tag>`` element ('' when missing)."""
    return F.regexp_extract(html, rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>", 1)


def paragraphs(fragment: Column) -> Column:
    """Texts of the ``<p>`` elements of a fragment. A ``<p>`` start tag closes
    an open paragraph, so unclosed paragraphs do not swallow later ones."""
    pieces = F.slice(F.split(fragment, r"<p\b[^>]*>"), 2, 1 << 30)
    return F.transform(pieces, lambda piece: strip_tags(F.split(piece, "</p>")[0]))


def first_paragraph(html: Column, tag: str = "article") -> Column:
    return F.coalesce(F.try_element_at(paragraphs(container(html, tag)), F.lit(1)), F.lit(""))


def paragraphs_joined(html: Column, tag: str = "article") -> Column:
    """Every paragraph text followed by a newline, concatenated."""
    return F.array_join(F.transform(paragraphs(container(html, tag)),
                                    lambda p: F.concat(p, F.lit("\n"))), "")


def text_without_boilerplate(html: Column) -> Column:
    # Body to </body>, or to the end of the page when the end tag is missing.
    body = F.regexp_replace(F.regexp_extract(html, r"(?s)<body\b[^>]*>(.*)", 1), r"(?s)</body>.*$", "")
    for pat in BOILERPLATE:
        body = F.regexp_replace(body, pat, "")
    return F.regexp_replace(strip_tags(body), r"\n+", "\n")


def page_title(html: Column) -> Column:
    return unescape(F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1))


# A class whose last part is "total", alone or after "_" or "-" (page-pagination__item_total).
PAGER_TOTAL = r'<[^>]*class="(?:[^"]*[\s_-])?total(?:\s[^"]*)?"[^>]*>\s*([0-9]+)\s*<'


def pager_size(html: Column) -> Column:
    """Page count from the pager's "total" button, 1 when there is none."""
    n = F.regexp_extract(html, PAGER_TOTAL, 1)
    return F.coalesce(F.nullif(n, F.lit("")).try_cast("int"), F.lit(1))


def page_lang(html: Column) -> Column:
    return F.regexp_extract(html, r'<html\b[^>]*\blang="([^"]*)"', 1)


NAV_LINK = r'<li><a href="([^"]*)">([^<]*)</a></li>'


def nav_cards(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per listing card (navigation link): position, href, text."""
    links = pages.select(id_col, "url",
                         F.arrays_zip(F.regexp_extract_all(col(html_col), F.lit(NAV_LINK), 1).alias("href"),
                                      F.regexp_extract_all(col(html_col), F.lit(NAV_LINK), 2).alias("text"))
                         .alias("_l"))
    return (links.select(id_col, "url", F.posexplode("_l").alias("pos", "_c"))
            .select(id_col, "url", "pos", col("_c.href").alias("href"),
                    unescape(col("_c.text")).alias("text")))


def absolute(url: Column, href: Column) -> Column:
    """Prefix a site-relative href with the scheme and host of ``url``."""
    host = F.regexp_extract(url, r"^(https?://[^/]+)", 1)
    return F.when(href.startswith("/"), F.concat(host, href)).otherwise(href)
