"""Score job (flagship) and its parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressroom.functions.dates import age_days
from pressroom.functions.text import first_int
from pressroom.operators import score as S
from pressroom.operators.select import queue_results
from pressroom.plans import bindings as B
from pressroom.plans.duck import with_
from pressroom.plans.registry import query
from pressroom.sources.lists import read_ranked_list
from pressroom.sources.staging import staging_path, write_csv

SCORE_COLS = ["id", "source", "rate", "rate_num", "age_days", "source_rank", "is_scored", "score"]


REPORT_ROWS = 50   # length of the top-score report


def scored(spark, sf_dir, listed=None):
    work = B.news(spark, sf_dir).where(queue_results())
    out = S.score_news(work, B.replies(spark, sf_dir), B.authority(spark, sf_dir, listed), B.AS_OF)
    return out.withColumn("score", F.round("score", 9))   # for comparison with the oracle


SCORE_SELECT = """
SELECT id, source, rate, rate_num, age_days, source_rank, is_scored,
  round(coalesce(CASE WHEN r_hi = r_lo THEN NULL ELSE (rate_num - r_lo) / (r_hi - r_lo) END, 0)
      + coalesce(CASE WHEN a_hi = a_lo THEN NULL ELSE (age_days - a_lo) / (a_hi - a_lo) END, 0)
      + coalesce(CASE WHEN s_hi = s_lo THEN NULL ELSE (source_rank - s_lo) / (s_hi - s_lo) END, 0), 9) AS score
FROM sig2, bounds"""


def score_ctes(listed: int | None = None) -> list[tuple[str, str]]:
    auth = "SELECT name, min(rank) AS rank FROM authority"
    auth += f" WHERE rank <= {listed}" if listed is not None else ""
    auth += " GROUP BY name"
    return [
        ("work", """SELECT * FROM news WHERE (NOT is_summarized AND is_requested_for_summarization)
                     OR (is_requested_for_scoring AND NOT is_scored)"""),
        ("polled", """SELECT w.*, CASE WHEN r.done THEN r.text END AS reply,
                        (w.is_requested_for_scoring AND NOT w.is_scored) AS q
                      FROM work w LEFT JOIN replies r
                        ON w.score_request_id = r.request_id AND w.is_requested_for_scoring AND NOT w.is_scored"""),
        ("auth", auth),
        ("sig", """SELECT id, source, CASE WHEN q THEN coalesce(reply, '') ELSE '' END AS rate,
                     CASE WHEN q THEN reply IS NOT NULL ELSE is_scored END AS is_scored,
                     a.rank AS source_rank,
                     CAST(date_diff('day', CAST(published_at AS DATE), DATE '2024-09-30') AS BIGINT) AS age_days
                   FROM polled p LEFT JOIN auth a ON p.source = a.name"""),
        ("sig2", """SELECT *, coalesce(TRY_CAST(nullif(regexp_extract(rate, '[0-9]+', 0), '') AS DOUBLE), 0.0)
                     AS rate_num FROM sig"""),
        ("bounds", """SELECT min(rate_num) AS r_lo, max(rate_num) AS r_hi,
                        CAST(min(age_days) AS DOUBLE) AS a_lo, CAST(max(age_days) AS DOUBLE) AS a_hi,
                        CAST(min(source_rank) AS DOUBLE) AS s_lo, CAST(max(source_rank) AS DOUBLE) AS s_hi
                      FROM sig2"""),
    ]


def _score_sql(listed: int | None = None, tail: str = "") -> str:
    return with_(["news", "replies", "authority"], SCORE_SELECT + " " + tail, score_ctes(listed))


@query("news_score", "K4 C8 C13 J4 D2j I6 I14 D3j E2 I15 I16", _score_sql())
def news_score(spark, sf_dir):
    return scored(spark, sf_dir).select(*SCORE_COLS)


@query("news_score_unlisted", "K4 D8 (unlisted sources -> 0, excluded from bounds)", _score_sql(18))
def news_score_unlisted(spark, sf_dir):
    return scored(spark, sf_dir, listed=18).select(*SCORE_COLS)


@query("top_scored", "G6", _score_sql(tail=f"ORDER BY score DESC, id LIMIT {REPORT_ROWS}"))
def top_scored(spark, sf_dir, rows=REPORT_ROWS):
    return (scored(spark, sf_dir).select(*SCORE_COLS)
            .orderBy(F.col("score").desc(), F.col("id")).limit(rows))


@query("minmax_norm", "E2 I15", with_(["news"], """
SELECT id, round(coalesce(CASE WHEN hi = lo THEN NULL ELSE (n_chars_d - lo) / (hi - lo) END, 0), 9) AS norm
FROM (SELECT id, CAST(length(content) AS DOUBLE) AS n_chars_d FROM news) x,
     (SELECT CAST(min(length(content)) AS DOUBLE) AS lo, CAST(max(length(content)) AS DOUBLE) AS hi FROM news) b"""))
def minmax_norm(spark, sf_dir):
    n = B.news(spark, sf_dir).select("id", F.length("content").cast("double").alias("x"))
    b = n.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    return n.select("id", F.round(S.minmax(F.col("x"), b["lo"], b["hi"]), 9).alias("norm"))


@query("authority_rank", "D3j F3 A12", with_(["news", "authority"], """
SELECT n.id, n.source, a.rank AS source_rank FROM news n
LEFT JOIN (SELECT name, row_number() OVER (ORDER BY rank) AS rank FROM authority) a ON n.source = a.name"""))
def authority_rank(spark, sf_dir):
    # the list as a file: a header, a column before the name, lines in rank order
    path = write_csv(B.authority(spark, sf_dir).orderBy("rank").select(
        F.concat(F.lit("no. "), "rank").alias("label"), "name"), staging_path(spark, "authority"))
    n = B.news(spark, sf_dir).select("id", "source")
    return S.authority_rank(n, read_ranked_list(spark, path)).select("id", "source", "source_rank")


@query("first_int", "I6", with_(["replies"], """
SELECT request_id, coalesce(TRY_CAST(nullif(regexp_extract(coalesce(text, ''), '[0-9]+', 0), '') AS DOUBLE), 0.0)
  AS rate_num FROM replies"""))
def first_int_q(spark, sf_dir):
    return B.replies(spark, sf_dir).select("request_id", first_int("text").alias("rate_num"))


@query("age_days", "I14 D9", with_(["news"], """
SELECT id, CAST(date_diff('day', CAST(published_at AS DATE), DATE '2024-09-30') AS BIGINT) AS age_days
FROM news"""))
def age_days_q(spark, sf_dir):
    return B.news(spark, sf_dir).select("id", age_days("published_at", B.AS_OF).alias("age_days"))
