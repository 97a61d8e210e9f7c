"""Layouts and the search index: same rows, and how little is read or written."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from pressroom.operators import relate as R, search as X
from pressroom.operators.select import text_search
from pressroom.sources import layout as L


def scanned(df) -> int:
    """Rows that the scan of a plan without exchanges gave out."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def files_read(spark, df, column) -> int:
    """Files that a plan's scans of ``column`` read."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan()
        df._jdf.queryExecution().toRdd().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    leaves = plan.collectLeaves()
    scans = [leaves.apply(k) for k in range(leaves.size())]
    return sum(x.metrics().apply("numFiles").value() for x in scans if f"{column}#" in x.toString())


def files_of(root):
    return {f: (os.path.getsize(f), os.stat(f).st_mtime_ns) for f in glob.glob(f"{root}/bucket=*/part-*")}


def test_merge_touches_changed_buckets_only(spark, tmp_path):
    root, schema = str(tmp_path / "t"), "id long, x string"
    base = spark.createDataFrame([(k, f"v{k}" * 20) for k in range(2000)] + [(None, "n")], schema)
    L.write_buckets(base, root, buckets=32)
    before = files_of(root)
    assert len(before) == 32
    changes = spark.createDataFrame([(5, "five"), (77, None), (5000, "new")], schema)
    want = sorted(map(repr, R.upsert(base, changes).collect()))
    merged = L.merge_buckets(spark, root, changes, buckets=32)
    assert sorted(map(repr, L.read_buckets(spark, root).collect())) == want
    after = files_of(root)
    kept = {f for f in before if after.get(f) == before[f]}
    assert 29 <= len(kept) < 32 and len(after) == 32
    assert sum(size for f, (size, _) in after.items() if f not in kept) < 0.15 * sum(size for size, _ in after.values())
    L.replace_buckets(merged, root)  # once more, as after a write that died
    assert sorted(map(repr, L.read_buckets(spark, root).collect())) == want
    L.merge_buckets(spark, root, changes.where("false"), buckets=32)
    L.merge_buckets(spark, root, spark.createDataFrame([(None, "m")], schema), buckets=32)
    assert sorted(map(repr, L.read_buckets(spark, root).collect())) == sorted([*want, repr(changes.first()).replace("id=5, x='five'", "id=None, x='m'")])


def test_a_feed_page_reads_one_folder(spark, tmp_path):
    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(hours=k % 50)) for k in range(1003)]
    feed = spark.createDataFrame(rows, "id long, published_at timestamp_ntz")
    root = L.write_feed(feed, str(tmp_path / "feed"), [F.col("published_at").desc(), F.col("id").desc()], 20, 10)
    order = [k for k, _ in sorted(rows, key=lambda r: (r[1], r[0]), reverse=True)]
    for page in (0, 9, 10, 50, 51, 400):
        got = L.feed_page(spark, root, feed.schema, page, 10)
        assert [r.id for r in got.collect()] == order[page * 20:page * 20 + 20]
        assert len(got.inputFiles()) == (1 if page < 51 else 0 if page > 60 else 1)
    empty = L.write_feed(feed.where("false"), str(tmp_path / "none"), [F.col("id")])
    assert L.feed_page(spark, empty, feed.schema, 0).collect() == []


def test_row_groups_are_skipped(spark, tmp_path):
    rows = spark.range(0, 60_000, 1, 8).select(
        F.xxhash64("id").alias("id"), F.concat(F.lit("src"), F.pmod(F.hash("id"), F.lit(40))).alias("source"),
        (F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.hash("id", F.lit(7)), F.lit(20_000_000))).cast("timestamp_ntz")).alias("published_at"))
    rows = rows.unionByName(spark.createDataFrame([(None, None, None), (7, "", None)],
                                                  "id long, source string, published_at timestamp_ntz"))
    path = L.write_zordered(rows, str(tmp_path / "z"), ["source", "published_at"], 32, bloom=["id"], keys_per_file=3000, row_group_bytes=1 << 16)
    stored, total = spark.read.parquet(path), 60_002
    assert sorted(map(repr, stored.select(*rows.columns).collect())) == sorted(map(repr, rows.collect()))
    by_source = stored.where(F.col("source") == "src7")
    by_date = stored.where(L.time_between("published_at", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 5)))
    one = rows.where("id > 1000").first().id
    by_id = stored.where(F.col("id") == one)
    for found, share in ((by_source, 0.35), (by_date, 0.35), (by_id, 0.2)):
        assert 0 < scanned(found) < share * total
    assert by_date.count() == rows.where(F.col("published_at").between(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 5))).count()
    assert by_id.count() == 1 and by_source.count() == rows.where("source = 'src7'").count()


FIELDS = ("title", "body")


@pytest.mark.parametrize("query", ["needle", "NEEDLE hay", "éta", "ab", "a b", "zzzz", "needle zzz", "two words", "  ", "文字列", "🙂🙂🙂", "w1 w1 w1"])
def test_search_by_index_equals_the_scan(spark, tmp_path_factory, query):
    rows = [(k, f"title {k}", f"hay {'needle' if k % 7 == 0 else 'other'} w{k % 5}") for k in range(200)]
    rows += [(300, "Été", None), (301, None, "the ÉTAT"), (302, "ab", "a"), (303, "", ""), (304, "nee", "dle"), (305, "文字列検索", "🙂🙂🙂🙂")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "id long, title string, body string, gram int")
    root = str(tmp_path_factory.getbasetemp() / "search")
    if not os.path.exists(root):
        X.write_index(df, root, "id", FIELDS, 8)
    got = X.search_index(spark, root, "id", query, FIELDS, 8)
    assert sorted(map(repr, got.select(*df.columns).collect())) == sorted(map(repr, text_search(df, query, FIELDS).collect()))


def test_a_search_reads_the_buckets_of_candidates(spark, tmp_path):
    df = spark.createDataFrame([(k, f"title {k}", "needle" if k == 42 else "hay") for k in range(500)], "id long, title string, body string")
    root = X.write_index(df, str(tmp_path / "s"), "id", FIELDS, 16)
    got = X.search_index(spark, root, "id", "needle", FIELDS, 16)
    assert [r.id for r in got.collect()] == [42]
    again = got.select("id", "title", "body")
    assert files_read(spark, again, "body") == 1
    assert [r.gram for r in spark.sql("SELECT 1").select(F.explode(X.grams(F.lit("aBcabc🙂x"))).alias("gram")).collect()] == [
        "abc", "bca", "cab", "bc🙂", "c🙂x"]


def test_postings_hold_the_grams_of_each_row(spark, tmp_path, monkeypatch):
    rows = [(k, "".join(chr(97 + (k * j) % 7) for j in range(k % 60)), f"Éa{k}文字列🙂z" if k % 3 else None) for k in range(300)]
    rows += [(1000 + k, "", "".join(map(chr, range(0x4E00 + 700 * k, 0x4E00 + 700 * (k + 1))))) for k in range(20)]
    rows.append((2000, "".join(f"{k} " for k in range(9000)), "a\0b\0c"))
    df = spark.createDataFrame(rows, "id long, title string, body string")
    want = {(k, t[i:i + 3]) for k, *texts in rows for t in (x.lower() for x in texts if x) for i in range(len(t) - 2)}
    root = X.write_index(df, str(tmp_path / "s"), "id", FIELDS, 16)
    stored = spark.read.parquet(f"{root}/postings")
    assert stored.where("n <> size(keys)").count() == 0
    got = [(k, r.gram) for r in stored.collect() for k in r["keys"]]
    assert set(got) == want and len(got) == len(want)
    # a row per gram and run of rows, not one per gram and row
    common = sum(set(g) <= set("abcdefg") for _, g in want)
    assert common > 1500 and stored.where("gram rlike '^[a-g]+$'").count() < 0.5 * common
    sizes = {r.gram: r.n for r in spark.read.parquet(f"{root}/sizes").collect()}
    assert sum(sizes.values()) == len(want)
    # runs cut within a row, and runs of more letters than fit a number with their rows
    import pyarrow as pa

    arrow = lambda: iter(df.select("id", *[F.lower(F.coalesce(f, F.lit(""))).alias(f) for f in FIELDS]).toArrow().to_batches())
    monkeypatch.setattr(X, "RUN_BYTES", 1000)
    cut = pa.Table.from_batches(X._gather(arrow())).to_pylist()
    assert {(k, r["gram"]) for r in cut for k in r["keys"]} == want and sum(r["n"] for r in cut) == len(want)
    wide = [(k, "".join(map(chr, range(0x3400 + 3000 * k, 0x3400 + 3000 * (k + 1))))) for k in range(7)]
    wide += [(k, f"x{k}y") for k in range(7, 1 << 18)]
    monkeypatch.setattr(X, "RUN_BYTES", 1 << 30)
    (some,) = pa.Table.from_pylist([{"key": k, "f0": t} for k, t in wide]).to_batches()
    out = pa.Table.from_batches(X._gather(iter([some]))).to_pylist()
    assert {(k, r["gram"]) for r in out for k in r["keys"]} == {(k, t[i:i + 3]) for k, t in wide for i in range(len(t) - 2)}


@pytest.mark.parametrize("query", ["🙂xyz", "one\u00a0two", "x🙂yz"])
def test_search_words_are_those_of_the_scan(spark, tmp_path, query):
    df = spark.createDataFrame([(1, "🙂xyz", "x🙂yz"), (2, "two", "one"), (3, None, "other")], "id long, title string, body string")
    root = X.write_index(df, str(tmp_path / "s"), "id", FIELDS, 4)
    got = [r.id for r in X.search_index(spark, root, "id", query, FIELDS, 4).collect()]
    assert got == [r.id for r in text_search(df, query, FIELDS).collect()] and len(got) == 1
