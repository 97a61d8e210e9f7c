"""Properties and plan shapes."""


from pyspark.sql import Window, functions as F, types as T

from pressroom.functions.dates import ntz
from pressroom.operators import enrich as E
from pressroom.operators import extract as X
from pressroom.operators.sequence import append_ids, number_within
from pressroom.plans import bindings as B
from pressroom.plans.registry import load_all

REG = load_all()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_number_within_matches_row_number_with_hot_key(spark):
    # one key holds about a third of the rows
    df = spark.range(0, 3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 17).cast("string")).alias("g"),
        ((F.col("id") * 7919) % 1000).alias("k"))
    ours = number_within(df, ["g"], [F.col("k").desc(), F.col("id").asc()], "pos", num_partitions=8)
    w = Window.partitionBy("g").orderBy(F.col("k").desc(), F.col("id").asc())
    ref = df.withColumn("pos", (F.row_number().over(w) - 1).cast("long"))
    assert sorted(map(tuple, ours.select("id", "pos").collect())) == \
        sorted(map(tuple, ref.select("id", "pos").collect()))


def test_append_ids_continue_after_max(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "u string")
    out = append_ids(F.lit(41), df, [F.col("u").asc()])
    assert sorted((r["u"], r["id"]) for r in out.collect()) == [("a", 42), ("b", 43), ("c", 44)]


def test_early_stop_is_subset_of_window_and_equal_without_pins(spark, sf_dir):
    listing = B.listing(spark, sf_dir)
    lo, hi = B.WINDOW_MIN, B.WINDOW_MAX
    window = listing.where(F.col("published_at").between(ntz(lo), ntz(hi))).select("id")
    by_page = X.early_stop_page(listing, lo, hi).select("id")
    by_row = X.early_stop_row(listing, lo, hi).select("id")
    assert by_page.subtract(window).count() == 0
    assert by_row.subtract(window).count() == 0
    # without pinned posts the listing is sorted newest first: stop == filter
    sorted_listing = number_within(B.news(spark, sf_dir), ["source"], [F.col("id").desc()], "pos") \
        .withColumn("page", F.floor(F.col("pos") / 20).cast("int"))
    w2 = sorted_listing.where(F.col("published_at").between(ntz(lo), ntz(hi))).select("id")
    assert X.early_stop_page(sorted_listing, lo, hi).select("id").exceptAll(w2).count() == 0
    assert w2.exceptAll(X.early_stop_row(sorted_listing, lo, hi).select("id")).count() == 0


def test_enrich_reports_errors_and_keeps_rows(spark):
    class Flaky:
        def call(self, texts):
            if any(t and "boom" in t for t in texts):
                raise ValueError("remote failure")
            return [t.upper() for t in texts]

    df = spark.createDataFrame([(i, "boom" if i == 3 else f"t{i}") for i in range(10)], "id long, x string")
    out = E.enrich(df, "id", "x", Flaky, T.StringType(), "y", batch_size=1, num_partitions=3).collect()
    assert len(out) == 10
    bad = [r for r in out if r["status"] != "ok"]
    assert [r["id"] for r in bad] == [3] and bad[0]["y"] is None
    assert {r["id"]: r["y"] for r in out}[4] == "T4"


def test_classifier_engines_agree(spark, sf_dir):
    n = B.news(spark, sf_dir).select("id", "content")
    a = E.classify_themes(n, engine="automaton").select("id", F.col("theme").alias("a"))
    j = E.classify_themes(n, engine="jvm").select("id", F.col("theme").alias("j"))
    assert a.join(j, "id").where(F.col("a") != F.col("j")).count() == 0


def test_stream_ingest_equals_batch(spark, sf_dir):
    stream = REG["stream_ingest"].build(spark, sf_dir)
    batch = B.news(spark, sf_dir).select("id", "url", "source", "published_at")
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0


def test_filters_reach_the_scan(spark, sf_dir):
    plan = _plan(REG["facet_filter"].build(spark, sf_dir))
    assert "EqualTo(source,src3)" in plan and "EqualTo(lang,en)" in plan
    scan = _plan(REG["to_embed"].build(spark, sf_dir))
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in scan


def test_no_nested_loop_or_cartesian_joins(spark, sf_dir):
    for name in ("digest_news", "digest_counts", "news_score", "early_stop_page", "classify_themes",
                 "job_ingest"):
        plan = _plan(REG[name].build(spark, sf_dir))
        assert "BroadcastNestedLoopJoin" not in plan, name
        assert "CartesianProduct" not in plan, name


def test_score_has_no_unpartitioned_window(spark, sf_dir):
    df = REG["news_score"].build(spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    plan = _plan(df)
    assert "Window" not in plan


def test_digest_news_is_broadcast_equi_join(spark, sf_dir):
    df = REG["digest_news"].build(spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    plan = _plan(df)
    assert "BroadcastHashJoin" in plan


def test_ingest_ids_are_unique_and_follow_the_stored_ones(spark, sf_dir):
    out = REG["job_ingest"].build(spark, sf_dir)
    ids = [r["id"] for r in out.select("id").collect()]
    assert len(ids) == len(set(ids))
    stored_max = B.news(spark, sf_dir).where(F.col("published_at") < ntz(B.WINDOW_MIN)).agg(F.max("id")).first()[0]
    new = sorted(i for i in ids if i > stored_max)
    assert new == list(range(stored_max + 1, stored_max + 1 + len(new)))


def test_digest_news_without_broadcast_is_still_an_equi_join(spark, sf_dir):
    from pressroom.operators import relate as R

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(R.digest_news(B.digest(spark, sf_dir), B.news(spark, sf_dir)))
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_enrichment_jobs_call_each_client_once_per_row(spark, sf_dir, tmp_path):
    import os
    import uuid

    from pressroom.operators import select as C
    from pressroom.plans.q_enrich import translate_and_summarize, vectorize_and_request

    log_dir = str(tmp_path)

    def counting(inner_factory, tag):
        def factory():
            inner = inner_factory()

            class Counting:
                def call(self, texts):
                    with open(os.path.join(log_dir, f"{tag}-{uuid.uuid4().hex}"), "w") as f:
                        f.write("\n".join("x" for _ in texts))
                    return inner.call(texts)
            return Counting()
        return factory

    def calls(tag):
        n = 0
        for name in os.listdir(log_dir):
            if name.startswith(tag + "-"):
                with open(os.path.join(log_dir, name)) as f:
                    n += len(f.read().splitlines())
        return n

    out = translate_and_summarize(spark, sf_dir, counting(lambda: E.TranslateStub("en"), "tr"),
                                  counting(lambda: E.SubmitStub("summary"), "sum"))
    out.write.format("noop").mode("overwrite").save()
    out.select("id").distinct().count()          # a second consumer of the same results
    work = C.derive_flags(B.news(spark, sf_dir).where(C.queue_translate("en")))
    due_tr = work.where(C.to_translate_pred()).count()
    assert calls("tr") == min(200, due_tr)
    assert calls("sum") == out.where(F.col("is_translated")).count()

    out2 = vectorize_and_request(spark, sf_dir, counting(E.EmbedStub, "emb"),
                                 counting(lambda: E.SubmitStub("pro"), "cls"))
    out2.write.format("noop").mode("overwrite").save()
    out2.count()
    work2 = B.news(spark, sf_dir).where(C.queue_results())
    assert calls("emb") == work2.where(C.to_embed("en")).count()
    assert calls("cls") == work2.where(C.to_classify()).count()


def test_bucketed_article_table_joins_without_shuffling_it(spark, sf_dir):
    from pressroom.operators import relate as R
    from pressroom.sources.staging import save_bucketed

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        news = save_bucketed(B.news(spark, sf_dir).select("id", "is_scored", "score"), "news_bucketed", "id", 8)
        changes = B.news(spark, sf_dir).where(F.col("id") % 7 == 0).select(
            "id", F.lit(True).alias("is_scored"), F.lit(1.0).alias("score"))
        out = R.upsert(news, changes, "id")
        out.write.format("noop").mode("overwrite").save()
        plan = _plan(out)
        # one shuffle: the change set into the table's buckets; the table itself is read as is
        assert plan.count("Exchange hashpartitioning") == 1
        assert out.count() == B.news(spark, sf_dir).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
