"""Scalar-function queries: whitespace cleaning, date rules, time zones,
run-log windows, JSON paths, prompt building and the vector text codec."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F, types as T

from pressroom.functions import dates as DT
from pressroom.functions import text as TX
from pressroom.functions.themes import PROMPT_MIDDLE, PROMPT_PREFIX, PROMPT_SUFFIX, themes_joined
from pressroom.operators.ingest import last_success
from pressroom.operators.select import to_classify
from pressroom.plans import bindings as B
from pressroom.plans.duck import with_
from pressroom.plans.registry import query
from pressroom.sources.tables import read_table

col = F.col
AS_OF_TS = _dt.datetime(2024, 9, 30)
RUN_AS_OF = _dt.date(2024, 2, 1)   # "today" of the run-log queries (events span January 2024)

_STRIP = r"'^[\s\p{Z}\x0B]+|[\s\p{Z}\x0B]+$'"


def _docs(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


@query("clean_ws_v1", "I1 I4", rf"""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, ' +', ' ', 'g'), '[\r\n]+', chr(10), 'g'),
  {_STRIP}, '', 'g') AS clean FROM documents""")
def clean_ws_v1(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", TX.clean_ws_v1("text").alias("clean"))


@query("clean_ws_v2", "I2 I4", rf"""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '\n+', chr(10), 'g'), {_STRIP}, '', 'g'),
  ' +', ' ', 'g') AS clean FROM documents""")
def clean_ws_v2(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", TX.clean_ws_v2("text").alias("clean"))


@query("clean_ws_v3", "I3", r"""
SELECT doc_id, regexp_replace(text, '\n+', chr(10), 'g') AS clean FROM documents""")
def clean_ws_v3(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", TX.clean_ws_v3("text").alias("clean"))


@query("blank_text", "I5", r"""
SELECT doc_id, coalesce(regexp_replace(text, {s}, '', 'g'), '') = '' AS blank, length(text) > 0 AS non_empty
FROM documents""".replace("{s}", _STRIP))
def blank_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", TX.is_blank("text").alias("blank"),
                                       (F.length("text") > 0).alias("non_empty"))


# --- dates ---------------------------------------------------------------------

_RU = "['" + "','".join(DT.RU_MONTHS_GENITIVE) + "']"
_DAY = "CAST(CAST(published_at AS DATE) AS TIMESTAMP)"
_PARSE_DATES_SQL = with_(["news"], f"""
SELECT id, rule, text, parsed FROM (
  SELECT id, 'rfc822' AS rule, strftime(published_at, '%a, %d %b %Y %H:%M:%S') || ' +0000' AS text,
         published_at AS parsed FROM news
  UNION ALL SELECT id, 'iso_zone', strftime(published_at, '%Y-%m-%dT%H:%M:%S') || '+0000', published_at FROM news
  UNION ALL SELECT id, 'iso_nozone', strftime(published_at, '%Y-%m-%dT%H:%M:%S'), published_at FROM news
  UNION ALL SELECT id, 'iso_prefix', strftime(published_at, '%Y-%m-%dT%H:%M:%S') || '.000Z', {_DAY} FROM news
  UNION ALL SELECT id, 'dotted', strftime(published_at, '%d.%m.%Y'), {_DAY} FROM news
  UNION ALL SELECT id, 'long_en', strftime(published_at, '%-d %B %Y'), {_DAY} FROM news
  UNION ALL SELECT id, 'long_ru', CAST(day(published_at) AS VARCHAR) || ' ' || {_RU}[month(published_at)]
         || ' ' || CAST(year(published_at) AS VARCHAR), {_DAY} FROM news
  UNION ALL SELECT id, 'us_long', strftime(published_at, '%B %-d, %Y'), {_DAY} FROM news
  UNION ALL SELECT id, 'epoch', CAST(CAST(epoch(published_at) AS BIGINT) AS VARCHAR), published_at FROM news
  UNION ALL SELECT id, 'relative', CAST(date_diff('hour', published_at, TIMESTAMP '2024-09-30') AS VARCHAR)
         || ' hours ago', published_at FROM news)""")


@query("parse_dates", "I10 I22 I8 I18", _PARSE_DATES_SQL)
def parse_dates(spark, sf_dir):
    n = B.news(spark, sf_dir).select("id", "published_at")
    rendered = n.select("id", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), DT.render_date("published_at", r, AS_OF_TS).alias("text"))
        for r in DT.RULES])).alias("d")).select("id", "d.rule", "d.text")
    parsed = None
    for r in DT.RULES:
        p = DT.parse_date(col("text"), r, AS_OF_TS)
        parsed = F.when(col("rule") == r, p) if parsed is None else parsed.when(col("rule") == r, p)
    return rendered.withColumn("parsed", parsed)


@query("tz_modes", "I17 D16 D17", with_(["news"], """
SELECT id, strftime(published_at + INTERVAL 3 HOUR, '%Y-%m-%dT%H:%M:%S') || '+0300' AS text,
  published_at AS utc, published_at + INTERVAL 3 HOUR AS wall FROM news"""))
def tz_modes(spark, sf_dir):
    n = B.news(spark, sf_dir)
    local = F.timestamp_add("HOUR", F.lit(3), col("published_at"))
    text = F.concat(DT.format_ntz(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+0300"))
    return (n.select("id", text.alias("text"))
            .select("id", "text", DT.parse_date(col("text"), "iso_zone").alias("utc"),
                    DT.parse_date(col("text"), "iso_zone", tz_mode="drop").alias("wall")))


_LAST_SQL = """
SELECT dag_id, task_id, coalesce(CAST(CAST(max(end_date) FILTER (WHERE state = 'SUCCESS') AS DATE) AS TIMESTAMP),
  TIMESTAMP '0001-01-01') AS last_success FROM run_log GROUP BY dag_id, task_id"""


@query("last_success", "E1", with_(["run_log"], _LAST_SQL + """
UNION ALL
SELECT dag_id, '*', coalesce(CAST(CAST(max(end_date) FILTER (WHERE state = 'SUCCESS') AS DATE) AS TIMESTAMP),
  TIMESTAMP '0001-01-01') FROM run_log GROUP BY dag_id"""))
def last_success_q(spark, sf_dir):
    rl = B.run_log(spark, sf_dir)
    per_dag = last_success(rl, per_task=False).select("dag_id", "task_id", "last_success")
    return last_success(rl).unionByName(per_dag)


@query("ingest_window", "I11 I12 I13 E1 D33 D34", with_(["run_log"], f"""
SELECT dag_id, task_id, last_success,
  greatest(CAST(date_trunc('week', DATE '{RUN_AS_OF}') AS TIMESTAMP), last_success + INTERVAL 1 DAY) AS start_at,
  TIMESTAMP '{RUN_AS_OF} 00:00:00' - INTERVAL 1 SECOND AS end_at
FROM ({_LAST_SQL})"""))
def ingest_window(spark, sf_dir):
    ls = last_success(B.run_log(spark, sf_dir))
    start, end = DT.ingest_window(RUN_AS_OF, col("last_success"))
    return ls.select("dag_id", "task_id", "last_success", start.alias("start_at"), end.alias("end_at"))


# --- replies, prompts, vectors ----------------------------------------------------

REPLY_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("done", T.BooleanType()),
    T.StructField("response", T.StructType([T.StructField("alternatives", T.ArrayType(
        T.StructType([T.StructField("message", T.StructType([
            T.StructField("text", T.StringType())]))])))]))])


@query("reply_json", "I21 J4", with_(["replies"], "SELECT request_id, done, text FROM replies"))
def reply_json(spark, sf_dir):
    r = B.replies(spark, sf_dir)
    payload = F.to_json(F.struct(
        col("request_id").alias("id"), col("done"),
        F.struct(F.array(F.struct(F.struct(col("text").alias("text")).alias("message")))
                 .alias("alternatives")).alias("response")))
    parsed = r.select(payload.alias("json")).select(
        F.get_json_object("json", "$.id").alias("request_id"),
        F.from_json("json", REPLY_SCHEMA).alias("j"))
    return parsed.select("request_id", col("j.done").alias("done"),
                         col("j.response.alternatives").getItem(0)["message"]["text"].alias("text"))


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


@query("build_prompt", "I7 A13 J8", with_(["news"], f"""
SELECT id, {_sql_str(PROMPT_PREFIX + themes_joined() + PROMPT_MIDDLE)} || content || {_sql_str(PROMPT_SUFFIX)}
  AS prompt FROM news WHERE is_translated AND NOT is_scored"""))
def build_prompt(spark, sf_dir):
    from pressroom.operators.enrich import classification_prompt
    n = B.news(spark, sf_dir).where(to_classify())
    return n.select("id", classification_prompt(col("content")).alias("prompt"))


@query("vector_codec", "I9 M2 D27 D32", """
SELECT vec_id, len(embedding) AS dims,
  round(list_sum(list_transform(embedding, lambda x: abs(CAST(x AS DOUBLE)))), 6) AS l1, true AS round_trip
FROM embeddings""")
def vector_codec(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    back = TX.text_to_vector(TX.vector_to_text("embedding"))
    exact = F.transform("embedding", lambda x: x.cast("double"))
    return e.select(
        "vec_id", F.size("embedding").cast("long").alias("dims"),
        F.round(F.aggregate(back, F.lit(0.0), lambda a, x: a + F.abs(x)), 6).alias("l1"),
        (back == exact).alias("round_trip"))
