"""Views of the article data model derived from the driver's tables.

Every binding is a narrow projection or a small aggregate of a driver table,
so its size grows with the input; nothing here is a made-up fixed table.
The flag columns are derived from ``doc_id`` arithmetic (a stand-in for the
workflow state a real article table carries); no rows are filtered out.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pressroom.functions.dates import format_ntz
from pressroom.sources.tables import read_table

# Fixed values of the fixture data model.
EPOCH_START = _dt.datetime(2024, 6, 1)          # first published_at
HOURS_SPAN = 2160                               # published_at = start + (id % span) hours
DIGEST_START = _dt.date(2024, 6, 1)
AS_OF = _dt.date(2024, 9, 30)                   # "today" of every checked query
WINDOW_MIN = _dt.datetime(2024, 6, 20)          # ingest window lower bound
WINDOW_MAX = _dt.datetime(2024, 8, 31, 23, 59, 59)
PAGE_SIZE = 20                                  # listing page size
TARGET_LANG = "en"


def published_at(id_col: Column) -> Column:
    hours = (id_col % HOURS_SPAN).cast("int")
    from pressroom.functions.dates import ntz
    return ntz(EPOCH_START) + F.make_dt_interval(F.lit(0), hours)


def rate_reply(id_col: Column) -> Column:
    """Simulated classifier reply text for article ``id``."""
    return (F.when(id_col % 7 == 0, F.lit("none"))
            .otherwise(F.concat(F.lit("theme "), (id_col % 12).cast("string"), F.lit(" of 12"))))


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return news_from(read_table(spark, sf_dir, "documents"))


def news_from(d: DataFrame) -> DataFrame:
    """The article table as a projection of ``documents`` (batch or stream)."""
    i = F.col("doc_id")
    req_sum = (i % 4).isin(1, 2)
    req_score = (i % 5).isin(1, 2)
    return d.select(
        i.alias("id"),
        F.split("text", "\n")[0].alias("title"),   # the first line, whole
        F.col("text").alias("content"),
        F.lit("").alias("summary"),
        published_at(i).alias("published_at"),
        F.col("source"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/"),
                 i.cast("string")).alias("url"),
        F.lit(None).cast(T.ArrayType(T.DoubleType())).alias("vectorized_content"),
        F.col("lang"),
        (i % 6 == 0).alias("is_vectorized"),
        ((F.col("lang") != TARGET_LANG) & (i % 3 == 0)).alias("is_translated"),
        (i % 10 != 0).alias("is_public"),
        req_sum.alias("is_requested_for_summarization"),
        (i % 4 == 2).alias("is_summarized"),
        F.when(req_sum, F.concat(F.lit("s"), i.cast("string"))).otherwise(F.lit(""))
         .alias("summarization_request_id"),
        (i % 5 == 2).alias("is_scored"),
        req_score.alias("is_requested_for_scoring"),
        F.when(req_score, F.concat(F.lit("r"), i.cast("string"))).otherwise(F.lit(""))
         .alias("score_request_id"),
        F.lit(0.0).alias("score"),
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model replies keyed by request id: ``r<id>`` carry the classification
    code, ``s<id>`` a summary. Pending requests have ``done = false``."""
    d = read_table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    score = d.select(F.concat(F.lit("r"), i.cast("string")).alias("request_id"),
                     (i % 3 != 0).alias("done"), rate_reply(i).alias("text"))
    summary = d.select(F.concat(F.lit("s"), i.cast("string")).alias("request_id"),
                       (i % 3 != 1).alias("done"),
                       F.concat(F.lit("summary: "), F.col("text")).alias("text"))
    return score.unionByName(summary)


def authority(spark: SparkSession, sf_dir: str, listed: int | None = None) -> DataFrame:
    """Ranked source list: rank = numeric suffix of ``srcN`` + 1, i.e. the list
    order. ``listed`` keeps only the first ``listed`` names (unlisted case)."""
    src = read_table(spark, sf_dir, "documents").select("source").distinct()
    ranked = src.select(
        (F.regexp_extract("source", r"([0-9]+)$", 1).cast("long") + 1).alias("rank"),
        F.col("source").alias("name"))
    if listed is not None:
        ranked = ranked.where(F.col("rank") <= listed)
    return ranked


def digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One digest per week from DIGEST_START up to two weeks past the last
    article (the trailing weeks are empty digests)."""
    n = news(spark, sf_dir)
    last_week = n.agg(F.max(F.floor(F.datediff(F.to_date("published_at"),
                                               F.lit(DIGEST_START)) / 7)).alias("w"))
    k = F.col("k")
    return (last_week
            .select(F.explode(F.sequence(F.lit(0).cast("long"),
                                         F.col("w").cast("long") + 2)).alias("k"))
            .select(k.alias("id"),
                    F.date_add(F.lit(DIGEST_START), (k * 7).cast("int")).alias("start_date"),
                    F.date_add(F.lit(DIGEST_START), (k * 7 + 6).cast("int")).alias("end_date"),
                    (k % 4 != 0).alias("is_public")))


def page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages per source, and its paging mode (sources take turns)."""
    from pressroom.operators.frontier import MODES

    turn = F.regexp_extract("source", r"([0-9]+)$", 1).cast("int") % len(MODES)
    return (read_table(spark, sf_dir, "documents").groupBy("source")
            .agg(F.ceil(F.count(F.lit(1)) / PAGE_SIZE).alias("n"))
            .withColumn("mode", F.element_at(F.array(*map(F.lit, MODES)), turn + 1)))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles as a newest-first listing per source with pinned old posts on
    top (id % 97 = 0), ``pos`` 0-based and ``page`` = pos // PAGE_SIZE. Narrow:
    what is numbered is also written once, so texts stay out of it."""
    from pressroom.operators.sequence import number_within

    n = (news(spark, sf_dir).select("id", "source", "url", "lang", "published_at")
         .withColumn("pin", F.when(F.col("id") % 97 == 0, 0).otherwise(1)))
    numbered = number_within(n, ["source"], [F.col("pin").asc(), F.col("id").desc()], "pos")
    return (numbered.drop("pin")
            .withColumn("page", F.floor(F.col("pos") / PAGE_SIZE).cast("int")))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task-run log from ``events``: event_type is the task, value > 5 is a
    success, ``ts`` is the end time; all rows belong to dag ``ingest``."""
    e = read_table(spark, sf_dir, "events")
    return e.select(F.lit("ingest").alias("dag_id"), F.col("event_type").alias("task_id"),
                    F.when(F.col("value") > 5, "SUCCESS").otherwise("FAILED").alias("state"),
                    F.col("ts").cast("timestamp_ntz").alias("end_date"))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt table from the turns of ``conversations``."""
    c = read_table(spark, sf_dir, "conversations")
    pid = F.col("conv_id") * 1000 + F.col("turn")
    return (c.select(pid.alias("id"), F.col("text").alias("prompt"),
                    (pid % 5 == 0).alias("in_use")))


EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriber emails found in the documents (with repeats)."""
    d = read_table(spark, sf_dir, "documents")
    found = d.select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(EMAIL_PATTERN), 0))
                     .alias("k", "email"))
    return found.select((F.col("doc_id") * 1000 + F.col("k")).alias("id"), "email")


def source_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules table, one row per source: payload kind (even-ranked sources
    publish a JSON listing, the others an RSS feed) and the categories their
    feed allowlist accepts."""
    from pressroom.operators.ingest import RULES

    a = authority(spark, sf_dir).select(
        F.col("name").alias("source"), F.when(F.col("rank") % 2 == 0, "json").otherwise("rss").alias("kind"),
        F.when(F.col("rank") % 2 == 0, "page").alias("stop"), F.when(F.col("rank") % 2 == 0, "en").alias("lang"),
        F.lit("article").alias("container"))
    return a.select(*[F.col(f.name) if f.name in a.columns else F.lit(None).cast(f.dataType).alias(f.name)
                      for f in T.StructType.fromDDL(RULES)])


def source_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the sources' parse tasks: a success in the second half of August;
    every fifth source never ran."""
    a = authority(spark, sf_dir).where(F.col("rank") % 5 != 0)
    day = F.date_add(F.lit(_dt.date(2024, 8, 20)), (F.col("rank") % 10).cast("int"))
    return a.select(F.lit("ingest").alias("dag_id"), F.concat(F.lit("parse_and_save_"), "name").alias("task_id"),
                    F.lit("SUCCESS").alias("state"), day.cast("timestamp_ntz").alias("end_date"))


def article_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page of every article: its text as the markup of an <article>."""
    body = F.replace(F.replace("content", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return news(spark, sf_dir).select("url", F.concat(F.lit("<body><nav>menu</nav><article>"), body,
                                                      F.lit("</article></body>")).alias("html"))


def category_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, category) pairs accepted by the RSS category gate: the
    English and German items of every source."""
    d = read_table(spark, sf_dir, "documents")
    return (d.where(F.col("lang").isin("en", "de"))
            .select("source", F.col("lang").alias("category")).distinct())


def _page_id(source: Column, page: Column) -> Column:
    return (F.regexp_extract(source, r"([0-9]+)$", 1).cast("long") * 1_000_000 + page).alias("feed_id")


def feeds(spark: SparkSession, sf_dir: str, listing_df: DataFrame | None = None) -> DataFrame:
    """One RSS document per listing page (20 items at most, so a document's
    size is bounded however large a source grows)."""
    item = F.concat(
        F.lit("<item><title>Doc "), F.col("id").cast("string"), F.lit("</title><link>"), F.col("url"),
        F.lit("</link><pubDate>"), format_ntz("published_at", "EEE, dd MMM yyyy HH:mm:ss"),
        F.lit(" +0000</pubDate><category>"), F.col("lang"), F.lit("</category></item>"))
    src = listing(spark, sf_dir) if listing_df is None else listing_df
    pages = (src.groupBy("source", "page")
             .agg(F.array_sort(F.collect_list(F.struct("pos", item.alias("x")))).alias("items")))
    return pages.select(_page_id(F.col("source"), F.col("page")), "source", "page",
                        F.concat(F.lit("<rss><channel>"),
                                 F.array_join(F.transform("items", lambda s: s["x"]), ""),
                                 F.lit("</channel></rss>")).alias("xml"))


def listings_json(spark: SparkSession, sf_dir: str, listing_df: DataFrame | None = None) -> DataFrame:
    """One JSON listing page per (source, page): hits.hit[].fields with the
    post title, content, epoch-seconds date and url."""
    from pressroom.functions.dates import ntz_epoch_seconds

    hit = F.struct("pos", F.struct(F.struct(
        F.col("title").alias("post_title"), F.col("content").alias("post_content"),
        ntz_epoch_seconds("published_at").alias("post_date_gmt"),
        F.col("url").alias("post_url")).alias("fields")).alias("h"))
    src = listing(spark, sf_dir) if listing_df is None else listing_df
    # a post's text joins its listing row by id, once the position is known
    src = src.join(news(spark, sf_dir).select("id", "title", "content"), "id")
    pages = (src.groupBy("source", "page")
             .agg(F.array_sort(F.collect_list(hit)).alias("hits")))
    doc = F.to_json(F.struct(F.struct(F.transform("hits", lambda s: s["h"]).alias("hit")).alias("hits")))
    return pages.select("source", "page", doc.alias("json"))


def damaged(payloads: DataFrame, payload: str, by: Column, other: str) -> DataFrame:
    """Payloads of which some were cut short, came empty or are something else."""
    return payloads.withColumn(payload, F.when(by % 5 == 0, F.left(payload, F.length(payload) - 1)).when(by % 5 == 1, F.lit(other))
                               .when(by % 5 == 2, F.lit(" ")).otherwise(F.col(payload)))
