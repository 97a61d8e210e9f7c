"""Streams with state: what a batch reads, null keys, early stop over many files."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from pressroom.operators import extract as X
from pressroom.streaming import incremental as S


def stream_of(spark, folder, schema, files=16):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(str(folder))


def land(spark, folder, rows, schema, files=1):
    spark.createDataFrame(rows, schema).repartition(files).write.mode("append").parquet(str(folder))


def test_dedupe_reads_no_landed_rows(spark, tmp_path):
    schema, landing, out = "key string, n int", tmp_path / "in", str(tmp_path / "out")
    land(spark, landing, [(f"k{i % 500}", i) for i in range(2000)], schema, 110)
    S.dedupe_ingest(spark, stream_of(spark, landing, schema), out, "key")
    assert spark.read.parquet(out).count() == 500
    # nothing that has landed is needed: later batches know the keys without it
    for f in glob.glob(f"{out}/epoch=*/part-*"):
        os.truncate(f, 0)
    before = set(os.listdir(out))
    land(spark, landing, [("k7", 1), ("new", 2), (None, 3), (None, 4), ("new", 5), ("k9", 6)], schema)
    S.dedupe_ingest(spark, stream_of(spark, landing, schema), out, "key")
    later = [f"{out}/{d}" for d in set(os.listdir(out)) - before]
    got = sorted((r.key or "", r.n) for r in spark.read.schema(schema).parquet(*later).collect())
    assert [k for k, _ in got] == ["", "", "new"] and [n for _, n in got][:2] == [3, 4]


def test_state_is_rocksdb_and_settings_come_back(spark, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    land(spark, tmp_path / "in", [("a", 1)], "key string, n int")
    S.dedupe_ingest(spark, stream_of(spark, tmp_path / "in", "key string, n int"), str(tmp_path / "out"), "key")
    assert spark.conf.get(name) == before
    state = S.checkpoint_of(str(tmp_path / "out")) + "/state/0"
    assert glob.glob(f"{state}/*/*.changelog") or glob.glob(f"{state}/*/*.zip")


def test_keys_are_forgotten_by_arrival(spark, tmp_path):
    schema, landing, out = "key string, arrived timestamp", tmp_path / "in", str(tmp_path / "out")
    at = lambda day: dt.datetime(2024, 6, day, 12)
    run = lambda: S.dedupe_ingest(spark, stream_of(spark, landing, schema), out, "key", "arrived", "2 days")
    for day, keys in ((1, "ab"), (2, "ac"), (9, "d"), (9, "ad"), (9, "a")):
        land(spark, landing, [(k, at(day)) for k in keys], schema)
        run()
    got = sorted((r.key, r.arrived.day) for r in spark.read.parquet(out).collect())
    assert got == [("a", 1), ("a", 9), ("b", 1), ("c", 2), ("d", 9)]
    with pytest.raises(ValueError):
        S.dedupe_ingest(spark, stream_of(spark, landing, schema), out, "key", forget_after="1 day")


def test_upsert_keeps_rows_without_a_key(spark, tmp_path):
    schema, landing, table = "id long, x string", tmp_path / "in", str(tmp_path / "t")
    run = lambda: S.upsert_ingest(spark, stream_of(spark, landing, schema), table)
    land(spark, landing, [(1, "a"), (None, "p"), (None, "q"), (None, "p")], schema)
    run()
    land(spark, landing, [(1, "b"), (None, "r"), (2, "c")], schema)
    run()
    got = sorted((r.id or 0, r.x) for r in S.current_rows(spark, table).collect())
    assert got == [(0, "p"), (0, "p"), (0, "q"), (0, "r"), (1, "b"), (2, "c")]


SCHEMA = "source string, page int, pos long, published_at timestamp_ntz"
LO, HI = dt.datetime(2024, 6, 3), dt.datetime(2024, 6, 9)


def listing_rows():
    day = lambda k: dt.datetime(2024, 6, 1) + dt.timedelta(hours=k % 240)
    rows = [(f"s{s}", p // 5, p, day(238 - p * (s + 1) + (97 * p * s) % 13)) for s in range(5) for p in range(70)]
    return rows + [("s1", 20, 100, None), (None, 0, 0, day(200)), ("unknown", 0, 0, day(200))]


@pytest.mark.parametrize("files, per_batch, in_order", [(120, 16, True), (120, 50, False), (3, 1, True)])
def test_early_stop_over_files_equals_the_batch_operators(spark, tmp_path, files, per_batch, in_order):
    rows = spark.createDataFrame(listing_rows(), SCHEMA)
    dealt = rows.repartitionByRange(files, "pos", "source") if in_order else rows.repartition(files)
    dealt.write.parquet(str(tmp_path / "in"))
    stops = {f"s{k}": ["page", "row", None][k % 3] for k in range(5)}
    windows = spark.createDataFrame([(s, m, LO, HI) for s, m in stops.items()],
                                    "source string, stop string, lo timestamp_ntz, hi timestamp_ntz")
    base = S.crawl_ingest(spark, stream_of(spark, tmp_path / "in", SCHEMA, per_batch), windows, str(tmp_path / "out"))
    got = sorted((r.source, r.pos) for r in S.crawled(spark, base).collect())
    by = {m: rows.where(F.col("source").isin([s for s, x in stops.items() if x == m])) for m in set(stops.values())}
    want = [(r.source, r.pos) for f in (X.early_stop_page(by["page"], LO, HI), X.early_stop_row(by["row"], LO, HI),
                                       by[None].where(F.col("published_at").between(LO, HI))) for r in f.collect()]
    assert got == sorted(want) and len(got) > 20
    newest = rows.where(F.col("published_at").between(LO, HI)).groupBy("source").agg(F.max("published_at").alias("x"))
    marks = {r.source: r.high_water for r in S.crawl_marks(spark, base).collect()}
    assert marks == {r.source: r.x for r in newest.collect() if r.source in stops}
    # later files of a source that has stopped don't land
    land(spark, tmp_path / "in", [("s3", 50, 500, dt.datetime(2024, 6, 5))], SCHEMA)
    landed = spark.read.parquet(f"{base}/rows").count()
    S.crawl_ingest(spark, stream_of(spark, tmp_path / "in", SCHEMA, per_batch), windows, base)
    assert spark.read.parquet(f"{base}/rows").count() == landed
    assert sorted((r.source, r.pos) for r in S.crawled(spark, base).collect()) == got


@pytest.mark.parametrize("as_folder", [False, True])
def test_tables_are_streamed_from_a_file_or_a_folder(spark, tmp_path, as_folder):
    import pyarrow.parquet as pq

    from pressroom.plans import bindings as B
    from pressroom.plans import q_stream as Q

    docs = spark.createDataFrame([(k, f"Title {k}\ntext", "en", f"src{k % 3}") for k in range(60)],
                                 "doc_id long, text string, lang string, source string")
    days = [dt.datetime(2024, 6, 1) + dt.timedelta(days=k) for k in range(60)]
    events = spark.createDataFrame([(k, d, f"e{k % 2}") for k, d in enumerate(days)],
                                   "event_id long, ts timestamp_ntz, event_type string")
    for name, rows in (("documents", docs), ("events", events)):
        at = str(tmp_path / f"{name}.parquet")
        if as_folder:
            rows.repartition(5).write.parquet(at)
        else:
            pq.write_table(rows.toArrow(), at)
    sf_dir, news = str(tmp_path), B.news(spark, str(tmp_path))
    found = lambda df: sorted(map(tuple, df.collect()))
    assert found(Q.stream_ingest(spark, sf_dir)) == found(news.select("id", "url", "source", "published_at"))
    assert found(Q.stream_dedupe(spark, sf_dir)) == found(news.select("url", "source"))
    weekly = found(Q.stream_weekly_counts(spark, sf_dir))
    assert sum(n for *_, n in weekly) == 60
    last = max(days) - dt.timedelta(days=1)
    assert found(Q.stream_weekly_final(spark, sf_dir)) == [w for w in weekly if w[0] + dt.timedelta(days=7) <= last]
