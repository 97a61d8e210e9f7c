"""Hand-written edge rows for the semantics decisions and the
date rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from pressroom.functions import dates as DT
from pressroom.functions import text as TX
from pressroom.operators import extract as X
from pressroom.operators import relate as R
from pressroom.operators import score as S
from pressroom.operators.serve import mark_in_use, save_prompt

TS = dt.datetime


def one(spark, col, value, dtype=T.StringType()):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("x", dtype)]))
    return df.select(col.alias("y")).first()["y"]


@pytest.mark.parametrize("reply,expected", [
    ("", 0.0), (None, 0.0), ("none", 0.0), ("12 or 3", 12.0), ("theme 7 of 12", 7.0),
    ("code 1234567890123456789012345", 1.234567890123456789012345e24),
])
def test_first_int(spark, reply, expected):
    assert one(spark, TX.first_int(F.col("x")), reply) == pytest.approx(expected)


def test_strip_nbsp_and_ws_variants(spark):
    assert one(spark, TX.strip(F.col("x")), "  a b  \n") == "a b"
    assert one(spark, TX.clean_ws_v1(F.col("x")), "  a   b \r\n\n c  ") == "a b \n c"
    assert one(spark, TX.clean_ws_v2(F.col("x")), "\n\n a  \n\n b   ") == "a \n b"
    assert one(spark, TX.clean_ws_v3(F.col("x")), "a\n\n\nb") == "a\nb"


def test_vector_codec(spark):
    assert one(spark, TX.text_to_vector(F.col("x")), "") is None
    assert one(spark, TX.text_to_vector(F.col("x")), "1e-05,2.5") == [1e-05, 2.5]
    assert one(spark, TX.text_to_vector(TX.vector_to_text(F.col("x"))), [1e-05, 0.1],
               T.ArrayType(T.DoubleType())) == [1e-05, 0.1]


@pytest.mark.parametrize("rule,text,expected", [
    ("rfc822", "Wed, 05 Jun 2024 10:20:30 +0300", TS(2024, 6, 5, 7, 20, 30)),
    ("iso_zone", "2024-06-05T10:20:30+0300", TS(2024, 6, 5, 7, 20, 30)),
    ("iso_zone", "2024-06-05T10:20:30+03:00", TS(2024, 6, 5, 7, 20, 30)),
    ("iso_nozone", "2024-06-05T10:20:30", TS(2024, 6, 5, 10, 20, 30)),
    ("iso_prefix", "2024-06-05T23:59:59.000Z", TS(2024, 6, 5)),
    ("dotted", "05.06.2024", TS(2024, 6, 5)),
    ("long_en", "5 June 2024", TS(2024, 6, 5)),
    ("long_ru", "5 июня 2024", TS(2024, 6, 5)),
    ("us_long", "June 5, 2024", TS(2024, 6, 5)),
    ("epoch", "1717582830", TS(2024, 6, 5, 10, 20, 30)),
    ("relative", "3 hours ago", TS(2024, 9, 29, 21, 0)),
    ("relative", "a while ago", TS(2024, 9, 30)),
    ("dotted", "not a date", None),
])
def test_date_rules(spark, rule, text, expected):
    got = one(spark, DT.parse_date(F.col("x"), rule, as_of=TS(2024, 9, 30)), text)
    assert got == expected


def test_tz_drop_keeps_wall_clock(spark):
    got = one(spark, DT.parse_date(F.col("x"), "rfc822", tz_mode="drop"), "Wed, 05 Jun 2024 10:20:30 +0300")
    assert got == TS(2024, 6, 5, 10, 20, 30)


def test_age_days_and_week_start(spark):
    df = spark.createDataFrame([(TS(2024, 9, 30, 5),), (TS(2024, 9, 25),), (TS(2024, 4, 11),)],
                               "p timestamp_ntz")
    ages = [r[0] for r in df.select(DT.age_days("p", dt.date(2024, 9, 30))).collect()]
    assert ages == [0, 5, 172]
    weeks = {r[0] for r in df.select(DT.week_start("p")).collect()}
    assert TS(2024, 9, 30) in weeks and TS(2024, 9, 23) in weeks


def _work(spark, rows):
    schema = ("id long, source string, published_at timestamp_ntz, is_requested_for_scoring boolean, "
              "is_scored boolean, score_request_id string")
    return spark.createDataFrame(rows, schema)


def test_score_constant_signals_and_unlisted_source(spark):
    now = TS(2024, 9, 1)
    work = _work(spark, [(1, "a", now, True, False, "r1"), (2, "b", now, True, False, "r2"),
                         (3, "zz", now, False, False, "")])
    replies = spark.createDataFrame([("r1", True, "5"), ("r2", False, "9")], "request_id string, done boolean, text string")
    auth = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "rank long, name string")
    out = {r["id"]: r for r in S.score_news(work, replies, auth, dt.date(2024, 9, 30)).collect()}
    # same age for all -> age component 0; pending reply -> rate '' -> 0
    assert out[1]["rate"] == "5" and out[2]["rate"] == "" and out[2]["is_scored"] is False
    assert out[1]["is_scored"] is True
    # ranks: a -> 1 (first occurrence), b -> 2, zz unlisted -> null, excluded from bounds
    assert out[1]["source_rank"] == 1 and out[3]["source_rank"] is None
    assert out[1]["score"] == pytest.approx(1.0)     # rate 5 is the max
    assert out[2]["score"] == pytest.approx(1.0)     # rank 2 is the max
    assert out[3]["score"] == pytest.approx(0.0)
    assert all(0.0 <= r["score"] <= 3.0 for r in out.values())


def test_masked_update_null_and_unknown(spark):
    base = spark.createDataFrame([(1, "old", False), (2, "keep", False)], "id long, content string, t boolean")
    upd = spark.createDataFrame([(1, None, True), (9, "new", True)], "id long, content string, t boolean")
    out = {r["id"]: r for r in R.masked_update(base, upd).collect()}
    assert out[1]["content"] == "old" and out[1]["t"] is True
    assert out[2]["content"] == "keep" and 9 not in out
    # idempotent
    again = R.masked_update(R.masked_update(base, upd), upd)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, R.masked_update(base, upd).collect()))


def test_upsert_replaces_and_appends(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    ch = spark.createDataFrame([(2, "B"), (3, "c")], "id long, v string")
    assert sorted(map(tuple, R.upsert(base, ch).collect())) == [(1, "a"), (2, "B"), (3, "c")]


def test_digest_end_is_midnight(spark):
    digest = spark.createDataFrame([(1, dt.date(2024, 6, 1), dt.date(2024, 6, 7), True)],
                                   "id long, start_date date, end_date date, is_public boolean")
    news = spark.createDataFrame([
        (10, TS(2024, 6, 7, 0, 0, 0), True), (11, TS(2024, 6, 7, 0, 0, 1), True),
        (12, TS(2024, 6, 7, 18, 0), True), (13, TS(2024, 6, 1), True), (14, TS(2024, 6, 3), False),
    ], "id long, published_at timestamp_ntz, is_public boolean")
    ids = sorted(r["id"] for r in R.digest_news(digest, news).collect())
    assert ids == [10, 13]
    whole = sorted(r["id"] for r in R.digest_news(digest, news, inclusive_end_day=True).collect())
    assert whole == [10, 11, 12, 13]
    assert R.digest_counts(digest, news).first()["news_count"] == 2
    assert R.digest_counts(digest, news, inclusive_end_day=True).first()["news_count"] == 4


def test_prompts_two_selected_stay_active(spark):
    p = spark.createDataFrame([(1, "a", True), (2, "b", False), (3, "c", False)], "id long, prompt string, in_use boolean")
    sel = p.where(F.col("id").isin(2, 3))
    out = {r["id"]: r for r in mark_in_use(p, sel).collect()}
    assert [out[i]["in_use"] for i in (1, 2, 3)] == [False, True, True]
    assert out[1]["selection_active"] == 0
    saved = save_prompt(p, spark.createDataFrame([(4, "d", True)], p.schema))
    assert sorted((r["id"], r["in_use"]) for r in saved.collect()) == [(1, False), (2, False), (3, False), (4, True)]


def test_rss_edge_feeds(spark):
    feeds = spark.createDataFrame([
        (1, "s", "<rss><channel><item><title>A</title><link>u1</link>"
                 "<pubDate>Wed, 05 Jun 2024 10:20:30 +0300</pubDate></item></channel></rss>"),
        (2, "s", "<rss><channel><item><title>B"),
    ], "feed_id long, source string, xml string")
    items = X.rss_items(feeds).collect()
    assert len(items) == 1 and items[0]["category"] is None
    assert items[0]["published_at"] == TS(2024, 6, 5, 7, 20, 30)
    allow = spark.createDataFrame([("s", "x")], "source string, category string")
    assert X.category_gate(X.rss_items(feeds), allow).count() == 0


def test_unclosed_paragraphs(spark):
    html = "<article><h1>T</h1><p><b>one.<br><p>two &amp; more</p><p>three</article>"
    assert one(spark, X.first_paragraph(F.col("x")), html) == "one."
    assert one(spark, X.paragraphs_joined(F.col("x")), html) == "one.\ntwo & more\nthree\n"
    assert one(spark, X.first_paragraph(F.col("x")), "<html>no article</html>") == ""


def test_formatting_and_literals_ignore_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([(TS(2024, 3, 10, 2, 30, 5),)], "t timestamp_ntz")
        row = df.select(DT.format_ntz("t", "EEE, dd MMM yyyy HH:mm:ss").alias("a"),
                        DT.ntz(TS(2024, 3, 10, 2, 30, 5)).alias("b"),
                        DT.render_date("t", "epoch").alias("e")).first()
        assert row["a"] == "Sun, 10 Mar 2024 02:30:05"
        assert row["b"] == TS(2024, 3, 10, 2, 30, 5)
        assert row["e"] == "1710037805"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_score_invert_options(spark):
    df = spark.createDataFrame([(1, 0.0, 10, 1), (2, 5.0, 20, 3)],
                               "id long, rate_num double, age_days long, source_rank long")
    lit = {r["id"]: r["score"] for r in S.add_score(df).collect()}
    inv = {r["id"]: r["score"] for r in S.add_score(df, invert_age=True, invert_rank=True).collect()}
    assert lit == {1: 0.0, 2: 3.0}
    assert inv == {1: 2.0, 2: 1.0}


def test_job_options_skip_empty_and_skip_requested(spark, sf_dir):
    from pressroom.operators import select as C
    from pressroom.plans import bindings as B
    from pressroom.plans.q_enrich import translate_summarize_job, vectorize_and_request

    news = B.news(spark, sf_dir).withColumn("content", F.when(F.col("id") % 17 == 0, "").otherwise(F.col("content")))

    def new_empty_requests(df):
        return df.where((F.col("content") == "") & F.col("is_translated")
                        & F.col("summarization_request_id").rlike("^[0-9a-f]{32}$")).count()

    assert new_empty_requests(translate_summarize_job(news)) > 0
    assert new_empty_requests(translate_summarize_job(news, skip_empty=True)) == 0
    # rows already requested for scoring keep their request id when skipped
    work = B.news(spark, sf_dir).where(C.queue_results())
    already = {r["id"]: r["score_request_id"] for r in work.where(
        C.to_classify() & F.col("is_requested_for_scoring")).collect()}
    out = {r["id"]: r["score_request_id"] for r in vectorize_and_request(
        spark, sf_dir, skip_requested=True).collect()}
    assert all(out[i] == rid for i, rid in already.items())
