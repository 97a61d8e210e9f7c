"""Readers, sinks and streaming upserts on small hand-written files."""

import time

import pytest

from pyspark.sql import functions as F

from pressroom.functions.themes import THEME_TEXT, themes_joined
from pressroom.operators import extract as X
from pressroom.operators.enrich import _Throttle
from pressroom.sources import lists as L
from pressroom.streaming import incremental as S


def test_ranked_list_keeps_first_position(spark, tmp_path):
    p = tmp_path / "authorities.csv"
    p.write_text("name\nsrc3\nsrc1\nsrc3\nsrc7\n")
    got = {r["name"]: r["rank"] for r in L.read_ranked_list(spark, str(p)).collect()}
    assert got == {"src3": 1, "src1": 2, "src7": 4}


def test_keyword_list_matches_fixed_text(spark, tmp_path):
    p = tmp_path / "themes.txt"
    p.write_text(THEME_TEXT, encoding="utf-8")
    kws = L.read_keyword_list(spark, str(p))
    assert spark.range(1).select(L.keyword_string(kws)).first()[0] == themes_joined()
    assert kws.where(F.col("keyword") == "ИИ ").count() == 1  # trailing space kept


def test_rss_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text(
        "<rss><channel><item><title>One</title><link>u1</link><category>en</category></item>"
        "<item><title>Two</title><link>u2</link></item></channel></rss>")
    items = L.read_rss_files(spark, str(tmp_path / "a.xml")).collect()
    assert sorted(r["title"] for r in items) == ["One", "Two"]


def test_pager_size(spark):
    df = spark.createDataFrame([('<div><button class="pager total"> 7 </button></div>',), ("<p>x</p>",),
                                ('<a class="page-pagination__item page-pagination__item_total" href="#">12</a>',),
                                ('<a class="subtotals">3</a>',)], "h string")
    assert [r[0] for r in df.select(X.pager_size(F.col("h"))).collect()] == [7, 1, 12, 1]


def test_throttle_spaces_calls():
    t = _Throttle(per_sec=50.0)
    start = time.monotonic()
    for _ in range(11):
        t.wait(1)
    assert time.monotonic() - start >= 0.18


def test_streaming_upsert_across_batches(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    schema = "id long, v string"
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], schema).coalesce(1).write.parquet(str(landing / "b1"))
    table = str(tmp_path / "log")

    def stream():
        return spark.readStream.schema(schema).parquet(str(landing / "*"))

    S.upsert_ingest(spark, stream(), table)
    spark.createDataFrame([(2, "B"), (4, "d")], schema).coalesce(1).write.parquet(str(landing / "b2"))
    S.upsert_ingest(spark, stream(), table)
    S.upsert_ingest(spark, stream(), table)     # nothing new: what has landed stays
    got = sorted(map(tuple, S.current_rows(spark, table).collect()))
    assert got == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    out = S.compact(spark, table, str(tmp_path / "v2"))
    assert spark.read.parquet(out).count() == 4


def test_weekly_counts_append_mode_drops_late_rows(spark, tmp_path):
    import datetime as dt

    landing = tmp_path / "events"
    landing.mkdir()
    schema = "ts timestamp_ntz, event_type string"

    def land(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(landing / name))

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(landing / "*"))
        S.write_append(spark, S.weekly_counts_final(stream, "ts", "event_type", "1 day"),
                       str(tmp_path / "out"))

    # week of Mon 2024-01-01: two views; then an event three weeks later moves the watermark on
    land("b1", [(dt.datetime(2024, 1, 2), "view"), (dt.datetime(2024, 1, 3), "view")])
    land("b2", [(dt.datetime(2024, 1, 24), "view")])
    run()
    # a late view for the first week (far behind the watermark) and an on-time one
    land("b3", [(dt.datetime(2024, 1, 4), "view"), (dt.datetime(2024, 1, 25), "view")])
    land("b4", [(dt.datetime(2024, 2, 20), "view")])
    run()
    from pressroom.functions.dates import utc_ntz

    out = spark.read.parquet(str(tmp_path / "out")).select(utc_ntz(F.col("w.start")).alias("week"), "n")
    got = {r["week"]: r["n"] for r in out.collect()}
    assert got == {dt.datetime(2024, 1, 1): 2,    # the late row of this week was dropped
                   dt.datetime(2024, 1, 22): 2}   # the week of Feb 19 is still open


def test_publish_version_keeps_the_previous_version(spark, tmp_path):
    from pressroom.sources.staging import publish_version, save_bucketed

    v1 = save_bucketed(spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"), "articles_v1", "id", 4,
                       str(tmp_path / "v1"))
    ch = spark.createDataFrame([(2, "B"), (3, "c")], "id long, v string")
    v2 = publish_version(v1, ch, "articles", 2, buckets=4, root=str(tmp_path))
    assert sorted(map(tuple, v2.collect())) == [(1, "a"), (2, "B"), (3, "c")]
    assert sorted(map(tuple, spark.table("articles_v1").collect())) == [(1, "a"), (2, "b")]


def test_ranked_list_takes_the_named_column(spark, tmp_path):
    p = tmp_path / "authorities.csv"
    p.write_text("id,name\n1,src3\n2,src1\n")
    assert {r["name"]: r["rank"] for r in L.read_ranked_list(spark, str(p)).collect()} == {"src3": 1, "src1": 2}
    p.write_text("id,title\n1,src3\n")
    with pytest.raises(ValueError):
        L.read_ranked_list(spark, str(p))


def test_csv_is_read_and_united_by_name(spark, tmp_path):
    from pyspark.sql import types as T

    from pressroom.sources import staging as ST

    schema = T.StructType([T.StructField("title", T.StringType()), T.StructField("url", T.StringType()),
                           T.StructField("id", T.LongType())])
    (tmp_path / "a.csv").write_text('url,title,id,more\nu1,"t ""1""\nx",1,z\n')
    (tmp_path / "b.csv").write_text("id,url\n2,u2\n")
    got = ST.read_csv(spark, str(tmp_path / "a.csv"), schema).collect()
    assert [tuple(r) for r in got] == [('t "1"\nx', "u1", 1)]
    with pytest.raises(ValueError):
        ST.read_csv(spark, str(tmp_path / "b.csv"), schema)
    both = ST.union_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], schema)
    assert sorted(map(tuple, both.collect()), key=lambda r: r[2]) == [('t "1"\nx', "u1", 1), (None, "u2", 2)]
    # a folder whose files disagree is an error, not a swap
    (tmp_path / "mixed").mkdir()
    (tmp_path / "mixed" / "1.csv").write_text("title,url,id\nt,u,1\n")
    (tmp_path / "mixed" / "2.csv").write_text("url,title,id\nu,t,2\n")
    with pytest.raises(Exception, match="header"):
        ST.read_csv(spark, str(tmp_path / "mixed"), schema).collect()


def test_export_accumulates_or_replaces(spark, tmp_path):
    import datetime as dt

    from pressroom.sources import staging as ST

    df = spark.createDataFrame([("t", "c", "en", "s", dt.datetime(2024, 1, 2, 3, 4, 5), "u")],
                               "title string, content string, lang string, source string, published_at timestamp_ntz, url string")
    path = str(tmp_path / "export")
    read = lambda: spark.read.options(**ST.CSV_OPTIONS).csv(path).collect()
    ST.export_csv(df, path)
    ST.export_csv(df, path)
    assert [r["Date"] for r in read()] == ["2024-01-02 03:04:05+0000"] * 2
    ST.export_csv(df, path, accumulate=False)
    assert len(read()) == 1


def test_bucketed_table_has_a_file_per_bucket(spark, tmp_path):
    from pressroom.sources.staging import save_bucketed

    save_bucketed(spark.range(0, 1000, 1, 20).withColumnRenamed("id", "k"), "bucketed_files", "k", 8, str(tmp_path / "b"))
    assert len(list((tmp_path / "b").glob("part-*"))) == 8


def test_item_with_several_categories(spark):
    feeds = spark.createDataFrame([("s", "<rss><channel><item><title>1</title><category>x</category><category>en</category></item>"
                                    "<item><title>2</title><category>y</category></item><item><title>3</title></item></channel></rss>")],
                                  "source string, xml string")
    items = X.rss_items(feeds)
    assert {r["title"]: r["category"] for r in items.collect()} == {"1": "x", "2": "y", "3": None}
    allow = spark.createDataFrame([("s", "en"), ("s", "de"), ("t", "y")], "source string, category string")
    assert [r["title"] for r in X.category_gate(items, allow).collect()] == ["1"]


def test_dates_that_strptime_reads(spark):
    import datetime as dt

    from pressroom.functions.dates import parse_date

    cases = [("rfc822", "Wed, 5 Jun 2024 10:00:00 +0300", dt.datetime(2024, 6, 5, 7)),
             ("rfc822", "Wed, 05 Jun 2024 10:00:00 +03:00", dt.datetime(2024, 6, 5, 7)),
             ("iso_zone", "2024-06-05T10:00:00+03:00", dt.datetime(2024, 6, 5, 7)),
             ("iso_zone", "2024-06-05T10:00:00+0300", dt.datetime(2024, 6, 5, 7)),
             ("iso_zone", "2024-06-05T10:00:00Z", dt.datetime(2024, 6, 5, 10)),
             ("dotted", "5.6.2024", dt.datetime(2024, 6, 5)), ("dotted", "05.06.2024", dt.datetime(2024, 6, 5))]
    for rule, text, want in cases:
        df = spark.createDataFrame([(text,)], "s string")
        assert df.select(parse_date("s", rule)).first()[0] == want, (rule, text)


def test_task_that_never_ran_has_a_row(spark):
    import datetime as dt

    from pressroom.operators.ingest import last_success

    log = spark.createDataFrame([("d", "a", "SUCCESS", dt.datetime(2024, 5, 1, 8))],
                                "dag_id string, task_id string, state string, end_date timestamp_ntz")
    tasks = spark.createDataFrame([("d", "a"), ("d", "b")], "dag_id string, task_id string")
    got = {r["task_id"]: r["last_success"] for r in last_success(log, tasks=tasks).collect()}
    assert got == {"a": dt.datetime(2024, 5, 1), "b": dt.datetime(1, 1, 1)}


def test_reversed_digest_counts_nothing(spark):
    import datetime as dt

    from pressroom.operators import relate as R

    digest = spark.createDataFrame([(1, dt.date(2024, 6, 7), dt.date(2024, 6, 1), True),
                                    (2, dt.date(2024, 6, 1), dt.date(2024, 6, 7), True)],
                                   "id long, start_date date, end_date date, is_public boolean")
    news = spark.createDataFrame([(1, dt.datetime(2024, 6, 3, 5), True)], "id long, published_at timestamp_ntz, is_public boolean")
    assert {r["id"]: r["news_count"] for r in R.digest_counts(digest, news).collect()} == {1: 0, 2: 1}
    assert [r["digest_id"] for r in R.digest_news(digest, news).collect()] == [2]


def test_redelivered_reply_counts_once(spark):
    from pressroom.operators.score import collect_replies

    df = spark.createDataFrame([(1, "r1"), (2, ""), (3, "r3"), (4, None)], "id long, rid string")
    replies = spark.createDataFrame([("r1", True, "x"), ("r1", True, "x"), ("r3", False, "y"), ("", True, "z")],
                                    "request_id string, done boolean, text string")
    got = sorted(map(tuple, collect_replies(df, replies, "rid", F.col("rid") != "", "reply").select("id", "reply").collect()))
    assert got == [(1, "x"), (2, None), (3, None), (4, None)]


def _landed(spark, folder, rows, files, schema):
    for k in range(files):
        spark.createDataFrame(rows[k::files], schema).coalesce(1).write.mode("append").parquet(str(folder))


def test_stream_dedupe_over_many_batches(spark, tmp_path):
    # old rows arrive late, every row twice, over 110 files and many micro-batches
    landing = tmp_path / "landing"
    rows = [(k, f"u{k}") for k in range(330)]
    df = spark.createDataFrame([(k * 40, u) for k, u in reversed(rows)] + [(k * 40 + 1, u) for k, u in rows], "day int, url string")
    df.repartition(110).write.parquet(str(landing))

    def stream():
        return spark.readStream.schema("day int, url string").option("maxFilesPerTrigger", 16).parquet(str(landing))

    out = str(tmp_path / "out")
    S.dedupe_ingest(spark, stream(), out, "url")
    assert sorted(r["url"] for r in spark.read.parquet(out).collect()) == sorted(u for _, u in rows)
    S.dedupe_ingest(spark, stream(), out, "url")            # a second call keeps what has landed
    df.limit(5).write.mode("append").parquet(str(landing))
    S.dedupe_ingest(spark, stream(), out, "url")
    assert spark.read.parquet(out).count() == 330


def test_scratch_folder_only_for_local_masters(spark, monkeypatch):
    from pressroom import session

    class Elsewhere:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})()
        sparkContext = type("S", (), {"master": "spark://host:7077", "applicationId": "app-1"})()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Elsewhere())
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert session.ensure_checkpoint_dir(spark) and spark.conf.get("spark.checkpoint.dir", None) == before


def test_one_bad_text_in_a_batch(spark):
    from pyspark.sql import types as T

    from pressroom.operators import enrich as E

    class Flaky:
        def call(self, texts):
            if "boom" in texts:
                raise ValueError("bad text")
            return [t.upper() for t in texts]

    df = spark.createDataFrame([(i, "boom" if i == 3 else f"t{i}") for i in range(40)], "id long, x string")
    out = E.enrich(df, "id", "x", Flaky, T.StringType(), "y", batch_size=40, num_partitions=1).collect()
    assert [r["id"] for r in out if r["status"] != "ok"] == [3] and sum(r["y"] is not None for r in out) == 39
