"""Streaming queries: incremental ingest with upsert, re-delivery dedupe and
weekly counts, each drained with ``availableNow`` and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressroom.functions.dates import utc_ntz
from pressroom.plans import bindings as B
from pressroom.plans.duck import with_
from pressroom.plans.registry import query
from pressroom.sources.staging import staging_path
from pressroom.sources.tables import read_table, table_path
from pressroom.streaming import incremental as S

col = F.col


def _stream_of(spark, sf_dir, table):
    return S.table_stream(spark, table_path(sf_dir, table), read_table(spark, sf_dir, table).schema)


@query("stream_ingest", "L1 K1 D6j", with_(["news"], "SELECT id, url, source, published_at FROM news"))
def stream_ingest(spark, sf_dir):
    articles = B.news_from(_stream_of(spark, sf_dir, "documents"))
    log = S.upsert_ingest(spark, articles, staging_path(spark, "news-log"))
    return S.current_rows(spark, log).select("id", "url", "source", "published_at")


@query("stream_dedupe", "L2 A5", with_(["news"], "SELECT url, source FROM news"))
def stream_dedupe(spark, sf_dir):
    first = B.news_from(_stream_of(spark, sf_dir, "documents")).select("url", "source", "published_at")
    again = B.news_from(_stream_of(spark, sf_dir, "documents")).select("url", "source", "published_at")
    log = S.dedupe_ingest(spark, first.unionByName(again), staging_path(spark, "dedupe"), "url")
    return spark.read.parquet(log).select("url", "source")


#: Odd-ranked sources stop at the first old row, the others after the first old page.
_STOPS = "CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 2"
_LO, _HI = "TIMESTAMP '2024-06-20 00:00:00'", "TIMESTAMP '2024-08-31 23:59:59'"


@query("stream_early_stop", "L1 C4 C5 F1", with_(["listing"], f"""
SELECT id, source, page, pos FROM (
  SELECT *, {_STOPS} AS by_row, coalesce(max(CASE WHEN published_at < {_LO} THEN 1 ELSE 0 END) OVER (
    PARTITION BY source ORDER BY page RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped_page,
    max(CASE WHEN published_at < {_LO} THEN 1 ELSE 0 END) OVER (
    PARTITION BY source ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stopped_row
  FROM listing)
WHERE CASE WHEN by_row = 1 THEN stopped_row ELSE stopped_page END = 0 AND published_at BETWEEN {_LO} AND {_HI}"""))
def stream_early_stop(spark, sf_dir):
    """Listing rows land as many small files in crawl order and are read by a
    stream, some files a batch."""
    from pressroom.functions.dates import ntz
    from pressroom.sources.staging import write_parquet

    listing = B.listing(spark, sf_dir).select("source", "page", "pos", "id", "published_at")
    landing = write_parquet(listing.repartitionByRange(24, "page", "source"), staging_path(spark, "landing"))
    by_row = F.regexp_extract("source", "([0-9]+)$", 1).cast("long") % 2 == 1
    windows = listing.select("source").distinct().select(
        "source", F.when(by_row, "row").otherwise("page").alias("stop"),
        ntz(B.WINDOW_MIN).alias("lo"), ntz(B.WINDOW_MAX).alias("hi"))
    stream = S.landing_stream(spark, landing, "*.parquet", listing.schema, files_per_batch=8)
    base = S.crawl_ingest(spark, stream, windows, staging_path(spark, "crawl"))
    return S.crawled(spark, base).select("id", "source", "page", "pos")


@query("stream_weekly_counts", "L3 I11", """
SELECT CAST(date_trunc('week', ts) AS TIMESTAMP) AS week_start, event_type, count(*) AS n
FROM events GROUP BY ALL""")
def stream_weekly_counts(spark, sf_dir):
    events = _stream_of(spark, sf_dir, "events").withColumn("ts", col("ts").cast("timestamp_ntz"))
    out = S.write_complete(spark, S.weekly_counts(events, "ts", "event_type"), staging_path(spark, "weekly"))
    return spark.read.parquet(out).select(utc_ntz(col("w.start")).alias("week_start"), "event_type",
                                          col("n").cast("long").alias("n"))


@query("stream_weekly_final", "L3 (append mode, watermark: closed weeks only)", """
SELECT CAST(date_trunc('week', ts) AS TIMESTAMP) AS week_start, event_type, count(*) AS n
FROM events GROUP BY ALL
HAVING CAST(date_trunc('week', min(ts)) AS TIMESTAMP) + INTERVAL 7 DAY
       <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""")
def stream_weekly_final(spark, sf_dir):
    events = _stream_of(spark, sf_dir, "events").withColumn("ts", col("ts").cast("timestamp_ntz"))
    out = S.write_append(spark, S.weekly_counts_final(events, "ts", "event_type", "1 day"),
                         staging_path(spark, "weekly-final"))
    return spark.read.parquet(out).select(utc_ntz(col("w.start")).alias("week_start"), "event_type",
                                          col("n").cast("long").alias("n"))
