"""Near duplicates by cosine, and articles of date ranges."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressroom.operators import relate as R, similar as N


def brute(ids, v, threshold):
    v = v / np.linalg.norm(v, axis=1, keepdims=True)
    order = np.argsort(ids)
    near = np.tril((v[order] @ v[order].T) >= threshold, -1)
    return {int(ids[order][i]) for i in np.flatnonzero(near.any(axis=1))}


@pytest.mark.parametrize("threshold, bits", [(0.95, 20), (0.8, 12)])
def test_recall_on_clusters(spark, threshold, bits):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((60, 32))
    noise = rng.uniform(0, 0.9, (1500, 1))
    v = centres[rng.integers(0, 60, 1500)] + noise * rng.standard_normal((1500, 32))
    v[:300] = v[0]  # a group of equal vectors
    v[300:320] = v[0] * 3  # and of one direction
    ids = rng.permutation(1500) + 2**53
    df = spark.createDataFrame([(int(i), x.tolist(), 1) for i, x in zip(ids, v)], "id long, vec array<double>, hash int")
    got = {r.key for r in N.near_duplicates(df, "id", "vec", threshold, bits, block=64).collect()}
    want = brute(ids, v, threshold)
    assert got <= want and len(got) >= 0.999 * len(want) and len(want) > 400
    kept = N.dedupe_near(df, "id", "vec", threshold=threshold, bits=bits)
    assert kept.columns == df.columns and kept.count() == 1500 - len(got)


def test_vectors_that_are_none(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [1.0, None]), (7, [1.0, 0.0, 0.0]),
            (8, []), (9, [float("inf"), 0.0]), (10, [-1.0, 0.0]), (11, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "key long, vec array<double>")
    assert sorted(r.key for r in N.near_duplicates(df, "key", "vec").collect()) == [2, 11]
    assert sorted(r.key for r in N.dedupe_near(df, "key", "vec").collect()) == [1, 3, 4, 5, 6, 7, 8, 9, 10]
    assert N.near_duplicates(df.where("false"), "key", "vec").collect() == []
    with pytest.raises(ValueError):
        N.near_duplicates(df, "key", "vec", threshold=0)


DAY = dt.date(1, 1, 1)


def test_stretches_cover_each_day_once(spark):
    rng = np.random.default_rng(2)
    ranges = [(int(a), int(a + n)) for a, n in zip(rng.integers(700_000, 740_000, 60), rng.integers(-3, 500, 60))] + [(719_163, 719_163)]
    df = spark.createDataFrame([(k, DAY + dt.timedelta(a), DAY + dt.timedelta(b)) for k, (a, b) in enumerate(ranges)],
                               "id int, a date, b date")
    for r in df.select("id", R.stretches(F.col("a"), F.col("b")).alias("p")).collect():
        a, b = ranges[r.id]
        days = sorted(d for p in r.p for d in range(p.at << p.level, (p.at + 1) << p.level))
        epoch = (dt.date(1970, 1, 1) - DAY).days
        assert days == list(range(a - epoch, b - epoch + 1)) and len(r.p) <= 2 * 9


def test_ranges_of_centuries(spark):
    digest = spark.createDataFrame([
        (1, dt.date(1, 1, 1), dt.date(9999, 12, 31), True), (2, dt.date(1600, 2, 3), dt.date(2024, 6, 2), True),
        (3, dt.date(2024, 6, 2), dt.date(2024, 6, 2), False), (4, dt.date(2024, 6, 9), dt.date(2024, 6, 1), True),
        (5, dt.date(1950, 1, 1), dt.date(1969, 12, 31), True)], "id long, start_date date, end_date date, is_public boolean")
    times = [dt.datetime(1969, 12, 31), dt.datetime(1969, 12, 31, 0, 0, 1), dt.datetime(1600, 2, 3), dt.datetime(1600, 2, 2, 23),
             dt.datetime(2024, 6, 2), dt.datetime(2024, 6, 2, 12), dt.datetime(9999, 12, 30, 23), dt.datetime(1, 1, 1), None]
    news = spark.createDataFrame([(k, t, k != 7) for k, t in enumerate(times)] + [(20 + k, times[4], True) for k in range(200)],
                                 "id long, published_at timestamp_ntz, is_public boolean")
    rows = [tuple(r) for r in news.where("is_public").collect()]
    for whole in (False, True):
        want = sorted((d.id, i) for d in digest.collect() for i, t, _ in rows if t is not None and dt.datetime.combine(
            d.start_date, dt.time()) <= t <= dt.datetime.combine(d.end_date, dt.time.max if whole else dt.time()))
        pairs = R.digest_news(digest, news, inclusive_end_day=whole)
        assert sorted((r.digest_id, r.id) for r in pairs.collect()) == want
        counts = {r.id: r.news_count for r in R.digest_counts(digest, news, whole).collect()}
        assert counts == {d: sum(x == d for x, _ in want) for d in range(1, 6)}
    pieces = R._pieces(digest)
    assert pieces.count() < 100  # not a row for each of 3.6 million days
    assert "NestedLoop" not in pairs._jdf.queryExecution().executedPlan().toString()
