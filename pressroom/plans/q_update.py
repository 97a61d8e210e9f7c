"""Update algebra, staging sinks and schema evolution queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressroom.functions.dates import ntz
from pressroom.operators import evolve as EV
from pressroom.operators import relate as R
from pressroom.operators.score import collect_replies
from pressroom.operators.sequence import append_ids
from pressroom.plans import bindings as B
from pressroom.plans.duck import with_
from pressroom.plans.q_score import SCORE_SELECT, scored, score_ctes
from pressroom.plans.registry import query
from pressroom.schemas import NEWS, NEWS_DEFAULTS
from pressroom.sources import staging as ST
from pressroom.sources.tables import read_table

col = F.col


def _translation_updates(news):
    """Updates from a translate step over the non-target-language rows:
    new content (null when the text was empty: a null never overwrites),
    is_translated, and a column the base does not have (ignored)."""
    return (news.where(col("lang") != B.TARGET_LANG)
            .select("id",
                    F.when(col("content") == "", F.lit(None).cast("string"))
                    .otherwise(F.concat(F.lit("[en] "), col("content"))).alias("content"),
                    F.lit(True).alias("is_translated"),
                    F.lit("x").alias("not_in_base")))


@query("masked_update", "D2j D36", with_(["news"], """
SELECT n.id, coalesce(u.content, n.content) AS content, coalesce(u.is_translated, n.is_translated) AS is_translated,
  n.lang
FROM news n LEFT JOIN (
  SELECT id, CASE WHEN content = '' THEN NULL ELSE '[en] ' || content END AS content, true AS is_translated
  FROM news WHERE lang <> 'en') u ON n.id = u.id"""))
def masked_update(spark, sf_dir):
    n = B.news(spark, sf_dir)
    return R.masked_update(n, _translation_updates(n)).select("id", "content", "is_translated", "lang")


@query("publish_upsert", "D6j A6 K4 (publish) D1", with_(["news", "replies", "authority"], f"""
SELECT id, is_scored, score FROM ({SCORE_SELECT}) s
UNION ALL
SELECT id, is_scored, score FROM news WHERE id NOT IN (SELECT id FROM work)""", score_ctes()))
def publish_upsert(spark, sf_dir):
    changes = scored(spark, sf_dir).select("id", "is_scored", "score")
    base = B.news(spark, sf_dir).select("id", "is_scored", "score")
    return R.upsert(base, changes, "id")


@query("publish_buckets", "D6j A6 K4 (changed buckets only)", with_(["news", "replies", "authority"], f"""
SELECT id, is_scored, score FROM ({SCORE_SELECT}) s
UNION ALL
SELECT id, is_scored, score FROM news WHERE id NOT IN (SELECT id FROM work)""", score_ctes()))
def publish_buckets(spark, sf_dir):
    """The score job's rows merged into the bucketed article table."""
    from pressroom.sources import layout as L

    columns = ["id", "is_scored", "score"]
    root = L.write_buckets(B.news(spark, sf_dir).select(*columns), ST.staging_path(spark, "articles"), buckets=16)
    L.merge_buckets(spark, root, scored(spark, sf_dir).select(*columns), buckets=16)
    return L.read_buckets(spark, root).select(*columns)


@query("append_new_ids", "A5 H5 F2 D1", with_(["news"], """
SELECT id, url, source FROM news WHERE published_at < TIMESTAMP '2024-06-20'
UNION ALL
SELECT (SELECT max(id) FROM news WHERE published_at < TIMESTAMP '2024-06-20')
         + row_number() OVER (ORDER BY source, url) AS id, url, source
FROM news WHERE published_at >= TIMESTAMP '2024-06-20'"""))
def append_new_ids(spark, sf_dir):
    n = B.news(spark, sf_dir)
    existing = n.where(col("published_at") < ntz(B.WINDOW_MIN)).select("id", "url", "source")
    incoming = n.where(col("published_at") >= ntz(B.WINDOW_MIN)).select("url", "source")
    top = existing.agg(F.max("id")).scalar()
    added = append_ids(top, incoming, [col("source").asc(), col("url").asc()])
    return existing.unionByName(added.select("id", "url", "source"))


@query("combine_sources", "A4 H1", with_(["news"], """
SELECT id, nullif(title, '') AS title, nullif(content, '') AS content, url, source, lang, published_at FROM news WHERE lang = 'en'
UNION ALL
SELECT id, nullif(title, ''), NULL, url, source, lang, published_at FROM news WHERE lang <> 'en'"""))
def combine_sources(spark, sf_dir):
    n = B.news(spark, sf_dir)
    html_family = n.where(col("lang") == "en").select("id", "title", "content", "url", "source", "lang",
                                                     "published_at")
    rss_family = n.where(col("lang") != "en").select("published_at", "lang", "source", "url", "title", "id")
    staged = [ST.write_csv(df, ST.staging_path(spark, "family")) for df in (html_family, rss_family)]
    schema = NEWS.__class__([NEWS[c] for c in html_family.columns])
    return ST.union_csv(spark, staged, schema)


_CSV_COLS = ["id", "title", "content", "published_at", "source", "is_public"]


@query("csv_roundtrip", "A2 A3 D2", with_(["news"], """
SELECT id, nullif(title, '') AS title, nullif(content, '') AS content, published_at, source, is_public FROM news"""))
def csv_roundtrip(spark, sf_dir):
    n = B.news(spark, sf_dir).select(*_CSV_COLS)
    path = ST.write_csv(n, ST.staging_path(spark, "news-csv"))
    schema = NEWS.__class__([NEWS[c] for c in _CSV_COLS])
    return ST.read_csv(spark, path, schema)


@query("export_csv", "A7 A8 I18", with_(["news"], """
SELECT nullif(title, '') AS Title, nullif(content, '') AS Content, lang AS Language, source AS Source,
  strftime(published_at, '%Y-%m-%d %H:%M:%S') || '+0000' AS Date, url AS Url FROM news"""))
def export_csv(spark, sf_dir):
    path = ST.staging_path(spark, "export")
    n = B.news(spark, sf_dir)
    ST.export_csv(n.where(col("lang") != "en"), path, accumulate=False)
    ST.export_csv(n.where(col("lang") == "en"), path, accumulate=True)
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(dst, T.StringType()) for _, dst in ST.EXPORT_COLUMNS])
    return ST.read_csv(spark, path, schema)


@query("dedupe_exact", "H4", r"""
SELECT min(doc_id) AS doc_id, count(*) AS n_copies FROM (
  SELECT doc_id, md5(trim(regexp_replace(lower(text), '[\s\x0B]+', ' ', 'g'))) AS h FROM documents)
GROUP BY h""")
def dedupe_exact(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return EV.dedupe_exact(d, "doc_id", "text").select("doc_id", "n_copies")


def _article_vectors(spark, sf_dir):
    """Vectors of articles; every third article comes again with nearly its vector."""
    v = read_table(spark, sf_dir, "embeddings").select(col("vec_id").alias("id"), col("embedding").cast("array<double>").alias("vec"))
    again = v.where(col("id") % 3 == 0).select((col("id") * -1 - 1).alias("id"), F.transform(
        "vec", lambda x, i: x * (1 + (i % 7) * 0.01)).alias("vec"))
    return v.unionByName(again)


@query("dedupe_near", "H4 I9", """
WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec FROM embeddings
           UNION ALL SELECT -vec_id - 1, list_transform(embedding::DOUBLE[], lambda x, i: x * (1 + ((i - 1) % 7) * 0.01))
           FROM embeddings WHERE vec_id % 3 = 0)
SELECT id FROM v a WHERE NOT EXISTS (
  SELECT 1 FROM v b WHERE b.id < a.id AND list_cosine_similarity(a.vec, b.vec) >= 0.95)""")
def dedupe_near(spark, sf_dir):
    from pressroom.operators.similar import dedupe_near as near

    return near(_article_vectors(spark, sf_dir), "id", "vec").select("id")


_OLD = ["id", "title", "content", "summary", "published_at", "source", "url", "lang",
        "is_vectorized", "is_translated", "is_public"]


@query("evolve_add_columns", "M1 M4", with_(["news"], """
SELECT id, title, content, summary, published_at, source, url, vectorized_content, lang, is_vectorized,
  is_translated, is_public, false AS is_requested_for_summarization, false AS is_summarized,
  '' AS summarization_request_id, false AS is_scored, false AS is_requested_for_scoring,
  '' AS score_request_id, CAST(0.0 AS DOUBLE) AS score FROM news"""))
def evolve_add_columns(spark, sf_dir):
    old = B.news(spark, sf_dir).select(*_OLD)
    return EV.add_missing_columns(old, NEWS, NEWS_DEFAULTS)


@query("backfill_nulls", "M3 J4", with_(["news", "replies"], """
SELECT n.id, coalesce(CASE WHEN r.done THEN r.text END, '') AS summary
FROM news n LEFT JOIN replies r ON n.summarization_request_id = r.request_id AND n.summarization_request_id <> ''"""))
def backfill_nulls(spark, sf_dir):
    n = B.news(spark, sf_dir).drop("summary")
    polled = collect_replies(n, B.replies(spark, sf_dir), "summarization_request_id",
                             col("summarization_request_id") != "", "summary")
    return EV.backfill_nulls(polled.select("id", "summary"), {"summary": ""})
