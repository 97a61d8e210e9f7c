"""Serving and workflow-queue queries: feeds, digests, facets, search,
prompts, and the per-step selections of the enrichment jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pressroom.functions.dates import format_ntz, ntz

from pressroom.functions.text import digest_label, news_label
from pressroom.operators import relate as R
from pressroom.operators import select as C
from pressroom.operators.sequence import number_within
from pressroom.operators.serve import mark_in_use, save_prompt
from pressroom.plans import bindings as B
from pressroom.plans.duck import with_
from pressroom.plans.registry import query
from pressroom.schemas import NEWS
from pressroom.sources.staging import staging_path

col = F.col
WIN = "TIMESTAMP '2024-06-20 00:00:00' AND TIMESTAMP '2024-08-31 23:59:59'"

# --- scans and projections ---------------------------------------------------


@query("scan_news", "A1 1.2", with_(["news"], "SELECT * FROM news"))
def scan_news(spark, sf_dir):
    return B.news(spark, sf_dir).select(*NEWS.fieldNames())


@query("public_news", "C14 G1 C18", with_(["news"], """
SELECT id, title, published_at, source, lang, is_public FROM news WHERE is_public
ORDER BY published_at DESC, id"""))
def public_news(spark, sf_dir):
    return (B.news(spark, sf_dir).where(col("is_public"))
            .select("id", "title", "published_at", "source", "lang", "is_public")
            .orderBy(col("published_at").desc(), col("id")))


@query("feed_cards", "C18 (card)", with_(["news"], """
SELECT id, title, summary FROM news WHERE is_public"""))
def feed_cards(spark, sf_dir):
    return B.news(spark, sf_dir).where(col("is_public")).select("id", "title", "summary")


@query("news_by_id", "C15 C18 (detail)", with_(["news"], """
SELECT title, source, published_at, summary, url FROM news WHERE id = 42"""))
def news_by_id(spark, sf_dir):
    return (B.news(spark, sf_dir).where(col("id") == 42)
            .select("title", "source", "published_at", "summary", "url"))


@query("facet_filter", "C16", with_(["news"], """
SELECT id, title, published_at, source, lang, is_public FROM news
WHERE source = 'src3' AND lang = 'en' AND is_public
  AND date_trunc('month', published_at) = TIMESTAMP '2024-07-01'"""))
def facet_filter(spark, sf_dir):
    n = B.news(spark, sf_dir)
    return (n.where((col("source") == "src3") & (col("lang") == "en") & col("is_public")
                    & (col("published_at") >= ntz(dt.datetime(2024, 7, 1)))
                    & (col("published_at") < ntz(dt.datetime(2024, 8, 1))))
            .select("id", "title", "published_at", "source", "lang", "is_public"))


@query("text_search", "C17", with_(["news"], """
SELECT id, title, source FROM news
WHERE (instr(lower(title), 'the') > 0 OR instr(lower(content), 'the') > 0 OR instr(lower(source), 'the') > 0)
  AND (instr(lower(title), 'and') > 0 OR instr(lower(content), 'and') > 0 OR instr(lower(source), 'and') > 0)"""))
def text_search(spark, sf_dir):
    return C.text_search(B.news(spark, sf_dir), "The AND").select("id", "title", "source")


@query("text_search_index", "C17 (trigram index)", with_(["news"], """
SELECT id, title, source FROM news
WHERE (instr(lower(title), 'token') > 0 OR instr(lower(content), 'token') > 0 OR instr(lower(source), 'token') > 0)
  AND (instr(lower(title), 'src1') > 0 OR instr(lower(content), 'src1') > 0 OR instr(lower(source), 'src1') > 0)"""))
def text_search_index(spark, sf_dir):
    """An index of all articles, and a search by it."""
    from pressroom.operators.search import search_index, write_index

    fields = ("title", "content", "source")
    root = write_index(B.news(spark, sf_dir).select("id", *fields), staging_path(spark, "search"), "id", fields, buckets=16)
    return search_index(spark, root, "id", "TOKEN src1", fields, buckets=16).select("id", "title", "source")


@query("layout_lookup", "C15 C16 (Z-ordered layout, Bloom filter)", with_(["news"], """
SELECT 'facet' AS lookup, id, title, source, published_at FROM news
WHERE source = 'src3' AND published_at >= TIMESTAMP '2024-07-01' AND published_at < TIMESTAMP '2024-08-01'
UNION ALL SELECT 'id', id, title, source, published_at FROM news WHERE id = 42"""))
def layout_lookup(spark, sf_dir):
    """Articles stored along a Z-curve through source and date, read by facet and by id."""
    from pressroom.sources.layout import time_between, write_zordered

    columns = ["id", "title", "source", "published_at"]
    path = write_zordered(B.news(spark, sf_dir).select(*columns), staging_path(spark, "zordered"), ["source", "published_at"],
                          files=8, bloom=["id"])
    stored = spark.read.parquet(path)
    july = time_between("published_at", dt.datetime(2024, 7, 1), dt.datetime(2024, 7, 31, 23, 59, 59, 999999))
    return (stored.where((col("source") == "src3") & july).select(F.lit("facet").alias("lookup"), *columns)
            .unionByName(stored.where(col("id") == 42).select(F.lit("id").alias("lookup"), *columns)))


@query("feed_page", "G5 (one page)", with_(["news"], """
SELECT id, title, published_at, pos, page FROM (
  SELECT *, CAST(floor(pos / 20) AS BIGINT) AS page FROM (
    SELECT id, title, published_at, row_number() OVER (ORDER BY published_at DESC, id DESC) - 1 AS pos FROM news WHERE is_public))
WHERE page = 3"""))
def feed_page(spark, sf_dir):
    """The public feed stored by pages, and one page of it."""
    from pressroom.sources import layout as L

    n = B.news(spark, sf_dir).where(col("is_public")).select("id", "title", "published_at")
    root = L.write_feed(n, staging_path(spark, "feed"), [col("published_at").desc(), col("id").desc()], B.PAGE_SIZE, pages_per_file=2)
    return L.feed_page(spark, root, n.schema, 3, pages_per_file=2)


@query("date_window", "C3", with_(["news"], f"""
SELECT id, source, published_at FROM news WHERE published_at BETWEEN {WIN}"""))
def date_window(spark, sf_dir):
    return (C.date_window(B.news(spark, sf_dir), B.WINDOW_MIN, B.WINDOW_MAX)
            .select("id", "source", "published_at"))


@query("allowlist_projection", "C2 (drops id and the transient rate)", with_(["news"], """
SELECT title, content, summary, published_at, source, url, vectorized_content, lang, is_vectorized,
  is_translated, is_public, is_requested_for_summarization, is_summarized, summarization_request_id,
  is_requested_for_scoring, score, score_request_id, is_scored FROM news"""))
def allowlist_projection(spark, sf_dir):
    n = B.news(spark, sf_dir).withColumn("rate", F.lit(""))
    return C.allowlist_projection(n)


@query("labels_text", "I19 (article label)", with_(["news"], """
SELECT id, printf('%s (%s)', title, strftime(published_at, '%Y-%m-%d %H:%M:%S')) AS label FROM news"""))
def labels_text(spark, sf_dir):
    return B.news(spark, sf_dir).select("id", news_label("title", "published_at").alias("label"))


@query("paged_feed", "G5 F2", with_(["news"], """
SELECT id, pos, CAST(floor(pos / 20) AS INTEGER) AS page FROM (
  SELECT id, row_number() OVER (ORDER BY published_at DESC, id DESC) - 1 AS pos FROM news WHERE is_public)"""))
def paged_feed(spark, sf_dir):
    n = B.news(spark, sf_dir).where(col("is_public")).select("id", "published_at")
    numbered = number_within(n, [], [col("published_at").desc(), col("id").desc()], "pos")
    return numbered.select("id", "pos", F.floor(col("pos") / B.PAGE_SIZE).cast("int").alias("page"))


# --- workflow queues -----------------------------------------------------------


@query("queue_translate", "C7", with_(["news"], """
SELECT id, lang, is_translated, is_requested_for_summarization FROM news
WHERE (NOT is_translated AND lang <> 'en') OR NOT is_requested_for_summarization"""))
def queue_translate(spark, sf_dir):
    return (B.news(spark, sf_dir).where(C.queue_translate(B.TARGET_LANG))
            .select("id", "lang", "is_translated", "is_requested_for_summarization"))


@query("queue_results", "C8", with_(["news"], """
SELECT id, is_summarized, is_requested_for_summarization, is_requested_for_scoring, is_scored FROM news
WHERE (NOT is_summarized AND is_requested_for_summarization) OR (is_requested_for_scoring AND NOT is_scored)"""))
def queue_results(spark, sf_dir):
    return (B.news(spark, sf_dir).where(C.queue_results())
            .select("id", "is_summarized", "is_requested_for_summarization",
                    "is_requested_for_scoring", "is_scored"))


@query("derive_flags", "C20 I20 D3", with_(["news"], """
SELECT id, coalesce(content, '') = '' AS content_empty, is_translated OR lang = 'en' AS is_translated,
  is_requested_for_summarization OR coalesce(summarization_request_id, '') <> '' AS is_requested_for_summarization,
  coalesce(is_vectorized, false) AS is_vectorized
FROM news WHERE (NOT is_translated AND lang <> 'en') OR NOT is_requested_for_summarization"""))
def derive_flags(spark, sf_dir):
    n = C.derive_flags(B.news(spark, sf_dir).where(C.queue_translate(B.TARGET_LANG)), B.TARGET_LANG)
    return n.select("id", (col("content") == "").alias("content_empty"), "is_translated",
                    "is_requested_for_summarization", "is_vectorized")


@query("to_translate", "C9 F4 G4 D28", with_(["news"], """
SELECT id, lang, length(content) AS n_chars FROM (
  SELECT id, lang, content, is_translated OR lang = 'en' AS tr FROM news
  WHERE (NOT is_translated AND lang <> 'en') OR NOT is_requested_for_summarization)
WHERE NOT tr AND length(content) > 0 ORDER BY id LIMIT 200"""))
def to_translate(spark, sf_dir):
    work = C.derive_flags(B.news(spark, sf_dir).where(C.queue_translate(B.TARGET_LANG)))
    return (C.first_n(work, C.to_translate_pred(), 200)
            .select("id", "lang", F.length("content").cast("long").alias("n_chars")))


@query("to_summarize", "C10", with_(["news"], """
SELECT id FROM news WHERE ((NOT is_translated AND lang <> 'en') OR NOT is_requested_for_summarization)
  AND (is_translated OR lang = 'en')"""))
def to_summarize(spark, sf_dir):
    work = C.derive_flags(B.news(spark, sf_dir).where(C.queue_translate(B.TARGET_LANG)))
    return work.where(C.to_summarize()).select("id")


@query("to_embed", "C11", with_(["news"], """
SELECT id FROM news WHERE NOT is_vectorized AND (is_translated OR lang = 'en')"""))
def to_embed(spark, sf_dir):
    return B.news(spark, sf_dir).where(C.to_embed(B.TARGET_LANG)).select("id")


@query("to_classify", "C12 D13", with_(["news"], """
SELECT id FROM news WHERE is_translated AND NOT is_scored"""))
def to_classify(spark, sf_dir):
    return B.news(spark, sf_dir).where(C.to_classify()).select("id")


@query("to_collect_rate", "C13", with_(["news"], """
SELECT id, score_request_id FROM news WHERE is_requested_for_scoring AND NOT is_scored"""))
def to_collect_rate(spark, sf_dir):
    return B.news(spark, sf_dir).where(C.to_collect_rate()).select("id", "score_request_id")


# --- digests -------------------------------------------------------------------


@query("public_digests", "C14 G2 I19 (digest label)", with_(["digest"], """
SELECT id, start_date, end_date, concat_ws('-', CAST(id AS VARCHAR), CAST(start_date AS VARCHAR),
  CAST(end_date AS VARCHAR)) AS label FROM digest WHERE is_public ORDER BY start_date DESC"""))
def public_digests(spark, sf_dir):
    d = B.digest(spark, sf_dir)
    return (d.where(col("is_public"))
            .select("id", "start_date", "end_date",
                    digest_label("id", "start_date", "end_date").alias("label"))
            .orderBy(col("start_date").desc()))


@query("digest_news", "D4j K5 D12", with_(["news", "digest"], """
SELECT d.id AS digest_id, n.id, n.title, n.published_at FROM digest d JOIN news n
  ON n.published_at BETWEEN CAST(d.start_date AS TIMESTAMP) AND CAST(d.end_date AS TIMESTAMP)
WHERE n.is_public"""))
def digest_news(spark, sf_dir):
    pairs = R.digest_news(B.digest(spark, sf_dir), B.news(spark, sf_dir))
    return pairs.select("digest_id", "id", "title", "published_at")


@query("digest_news_whole_day", "D4j D12 (inclusive_end_day option)", with_(["news", "digest"], """
SELECT d.id AS digest_id, n.id FROM digest d JOIN news n
  ON n.published_at >= CAST(d.start_date AS TIMESTAMP)
 AND n.published_at < CAST(d.end_date + 1 AS TIMESTAMP)
WHERE n.is_public"""))
def digest_news_whole_day(spark, sf_dir):
    pairs = R.digest_news(B.digest(spark, sf_dir), B.news(spark, sf_dir), inclusive_end_day=True)
    return pairs.select("digest_id", "id")


@query("digest_counts", "E3 K5", with_(["news", "digest"], """
SELECT d.id, d.start_date, d.end_date, d.is_public, count(n.id) AS news_count
FROM digest d LEFT JOIN news n
  ON n.published_at BETWEEN CAST(d.start_date AS TIMESTAMP) AND CAST(d.end_date AS TIMESTAMP) AND n.is_public
GROUP BY d.id, d.start_date, d.end_date, d.is_public"""))
def digest_counts(spark, sf_dir):
    return R.digest_counts(B.digest(spark, sf_dir), B.news(spark, sf_dir))


# --- facets and stats ------------------------------------------------------------


@query("facet_counts", "E6", with_(["news"], """
SELECT facet, value, count(*) AS n FROM (
  SELECT 'source' AS facet, source AS value FROM news
  UNION ALL SELECT 'lang', lang FROM news
  UNION ALL SELECT 'is_public', CASE WHEN is_public THEN 'true' ELSE 'false' END FROM news
  UNION ALL SELECT 'month', strftime(published_at, '%Y-%m') FROM news)
GROUP BY facet, value"""))
def facet_counts(spark, sf_dir):
    n = B.news(spark, sf_dir)
    facets = [("source", col("source")), ("lang", col("lang")),
              ("is_public", col("is_public").cast("string")),
              ("month", format_ntz("published_at", "yyyy-MM"))]
    long = n.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("facet"), value.alias("value")) for name, value in facets
    ])).alias("f")).select("f.facet", "f.value")
    return long.groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


@query("ingest_stats", "E7 C19 D30", with_(["news"], f"""
SELECT source, count(*) AS n, count(*) FILTER (WHERE published_at BETWEEN {WIN}) AS n_in_window,
  count(*) FILTER (WHERE content = '') AS n_empty,
  count(*) FILTER (WHERE published_at BETWEEN {WIN}) > 0 AS ok
FROM news GROUP BY source"""))
def ingest_stats(spark, sf_dir):
    n = B.news(spark, sf_dir)
    in_win = col("published_at").between(ntz(B.WINDOW_MIN), ntz(B.WINDOW_MAX))
    return (n.groupBy("source")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(in_win).alias("n_in_window"),
                 F.count_if(col("content") == "").alias("n_empty"))
            .withColumn("ok", col("n_in_window") > 0))


# --- prompts and emails ----------------------------------------------------------


@query("email_dupes", "E5", with_(["emails"], """
SELECT email, count(*) AS n FROM emails GROUP BY email HAVING count(*) > 1"""))
def email_dupes(spark, sf_dir):
    return (B.emails(spark, sf_dir).groupBy("email").agg(F.count(F.lit(1)).alias("n"))
            .where(col("n") > 1))


@query("prompt_mark_in_use", "D5j H3 E4 K6 D37", with_(["prompts"], """
SELECT p.id, s.id IS NOT NULL AS in_use,
  (SELECT count(*) FROM prompts p2 WHERE length(p2.prompt) < 40 AND p2.in_use) AS selection_active
FROM prompts p LEFT JOIN (SELECT id FROM prompts WHERE length(prompt) < 40) s ON p.id = s.id"""))
def prompt_mark_in_use(spark, sf_dir):
    p = B.prompts(spark, sf_dir)
    selected = p.where(F.length("prompt") < 40)
    return mark_in_use(p, selected).select("id", "in_use", "selection_active")


@query("prompt_save", "K6 (save with in_use)", with_(["prompts"], """
SELECT id, id = (SELECT max(id) FROM prompts) AS in_use FROM prompts"""))
def prompt_save(spark, sf_dir):
    p = B.prompts(spark, sf_dir)
    latest = p.where(col("id") == p.agg(F.max("id")).scalar()).withColumn("in_use", F.lit(True))
    return save_prompt(p, latest).select("id", "in_use")


# --- admin lists: search and ordering ---------------------------------------------


@query("prompt_search", "C17 (prompts) G3", with_(["prompts"], """
SELECT id, prompt, in_use FROM prompts WHERE instr(lower(prompt), 'ment') > 0 ORDER BY id"""))
def prompt_search(spark, sf_dir):
    found = C.text_search(B.prompts(spark, sf_dir), "ment", fields=("prompt",))
    return found.select("id", "prompt", "in_use").orderBy("id")


@query("email_search", "C17 (emails) G3", with_(["emails"], """
SELECT id, email FROM emails WHERE instr(lower(email), 'mail2.example') > 0 ORDER BY id"""))
def email_search(spark, sf_dir):
    found = C.text_search(B.emails(spark, sf_dir), "mail2.example", fields=("email",))
    return found.select("id", "email").orderBy("id")


@query("digest_search", "C17 (digests: id and dates as text)", with_(["digest"], """
SELECT id, start_date, end_date FROM digest
WHERE instr(CAST(id AS VARCHAR), '2024-07') > 0 OR instr(CAST(start_date AS VARCHAR), '2024-07') > 0
   OR instr(CAST(end_date AS VARCHAR), '2024-07') > 0"""))
def digest_search(spark, sf_dir):
    d = B.digest(spark, sf_dir).select("id", "start_date", "end_date")
    as_text = d.select("*", col("id").cast("string").alias("_i"), col("start_date").cast("string").alias("_s"),
                       col("end_date").cast("string").alias("_e"))
    return C.text_search(as_text, "2024-07", fields=("_i", "_s", "_e")).select("id", "start_date", "end_date")


@query("digest_facets", "E6 C16 (digest filters and start-date drill-down)", with_(["digest"], """
SELECT facet, value, count(*) AS n FROM (
  SELECT 'start_year' AS facet, CAST(year(start_date) AS VARCHAR) AS value FROM digest
  UNION ALL SELECT 'start_month', strftime(start_date, '%Y-%m') FROM digest
  UNION ALL SELECT 'end_month', strftime(end_date, '%Y-%m') FROM digest
  UNION ALL SELECT 'is_public', CASE WHEN is_public THEN 'true' ELSE 'false' END FROM digest)
GROUP BY facet, value"""))
def digest_facets(spark, sf_dir):
    d = B.digest(spark, sf_dir)
    facets = [("start_year", F.year("start_date").cast("string")),
              ("start_month", format_ntz("start_date", "yyyy-MM")),
              ("end_month", format_ntz("end_date", "yyyy-MM")),
              ("is_public", col("is_public").cast("string"))]
    long = d.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("facet"), value.alias("value")) for name, value in facets
    ])).alias("f")).select("f.facet", "f.value")
    return long.groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


@query("prompt_facets", "E6 C16 (prompt in_use filter)", with_(["prompts"], """
SELECT CASE WHEN in_use THEN 'true' ELSE 'false' END AS in_use, count(*) AS n FROM prompts GROUP BY 1"""))
def prompt_facets(spark, sf_dir):
    return (B.prompts(spark, sf_dir).groupBy(col("in_use").cast("string").alias("in_use"))
            .agg(F.count(F.lit(1)).alias("n")))
