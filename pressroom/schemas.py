"""Declared schemas of the article data model (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, B, D, I = T.StringType(), T.LongType(), T.BooleanType(), T.DoubleType(), T.IntegerType()
TS = T.TimestampNTZType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# The article table and its column defaults (fixed values of the data model).
NEWS = _struct(
    ("id", L, False),
    ("title", S, True),
    ("content", S, True),
    ("summary", S, True),
    ("published_at", TS, True),
    ("source", S, True),
    ("url", S, True),
    ("vectorized_content", T.ArrayType(D), True),
    ("lang", S, True),
    ("is_vectorized", B, True),
    ("is_translated", B, True),
    ("is_public", B, True),
    ("is_requested_for_summarization", B, True),
    ("is_summarized", B, True),
    ("summarization_request_id", S, True),
    ("is_scored", B, True),
    ("is_requested_for_scoring", B, True),
    ("score_request_id", S, True),
    ("score", D, True),
)

NEWS_DEFAULTS = {
    "summary": "",
    "lang": "ru",
    "is_vectorized": False,
    "is_translated": False,
    "is_public": True,
    "is_requested_for_summarization": False,
    "is_summarized": False,
    "summarization_request_id": "",
    "is_scored": False,
    "is_requested_for_scoring": False,
    "score_request_id": "",
    "score": 0.0,
}

# Columns the publish step writes, in this order; anything else
# (id, rate) is dropped before the write.
UPLOAD_COLUMNS = (
    "title", "content", "summary", "published_at", "source", "url",
    "vectorized_content", "lang", "is_vectorized", "is_translated",
    "is_public", "is_requested_for_summarization", "is_summarized",
    "summarization_request_id", "is_requested_for_scoring", "score",
    "score_request_id", "is_scored",
)

ARTICLES = _struct(
    ("title", S, True), ("content", S, True), ("url", S, True),
    ("lang", S, True), ("source", S, True), ("published_at", TS, True),
)

DIGEST = _struct(("id", L, False), ("start_date", T.DateType(), True),
                 ("end_date", T.DateType(), True), ("is_public", B, True))
PROMPT = _struct(("id", L, False), ("prompt", S, True), ("in_use", B, True))
EMAIL = _struct(("id", L, False), ("email", S, True))
RUN_LOG = _struct(("dag_id", S, True), ("task_id", S, True), ("state", S, True),
                  ("end_date", TS, True))
AUTHORITY = _struct(("rank", L, False), ("name", S, True))
THEMES = _struct(("code", L, False), ("keyword", S, True))
FEEDS = _struct(("feed_id", L, False), ("source", S, True), ("xml", S, True))
LISTINGS_JSON = _struct(("source", S, True), ("page", I, True), ("json", S, True))
PAGES = _struct(("page_id", L, True), ("url", S, True), ("html", S, True))
REPLIES = _struct(("request_id", S, True), ("done", B, True), ("text", S, True))

# Payload schemas for from_xml / from_json.
RSS_ITEM = _struct(("title", S, True), ("link", S, True), ("pubDate", S, True),
                   ("category", T.ArrayType(S), True))
RSS_DOC = T.StructType([T.StructField("channel", T.StructType([
    T.StructField("item", T.ArrayType(RSS_ITEM), True)]), True)])

HIT_FIELDS = _struct(("post_title", S, True), ("post_content", S, True),
                     ("post_date_gmt", L, True), ("post_url", S, True))
HITS_DOC = T.StructType([T.StructField("hits", T.StructType([
    T.StructField("hit", T.ArrayType(T.StructType([T.StructField("fields", HIT_FIELDS, True)])),
                  True)]), True)])
# Answers that carry listing HTML: items[].html, rendered, or html.
HTML_DOC = T.StructType([T.StructField("items", T.ArrayType(_struct(("html", S, True))), True),
                         T.StructField("rendered", S, True), T.StructField("html", S, True)])
