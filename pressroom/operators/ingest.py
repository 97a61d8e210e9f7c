"""The ingest job on payload tables: windows from the run log, parsing by each
source's rule, early stop on what was parsed, texts, guard and append."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pressroom.functions.dates import ingest_window, ntz, parse_date
from pressroom.operators import extract as X
from pressroom.operators import markup as M
from pressroom.operators.select import allowlist_projection, canonical_articles
from pressroom.operators.sequence import append_ids
from pressroom.sources.staging import materialize

col = F.col

#: One row per source. ``kind``: rss (feeds), json (hits with their text) or html
#: (fragments with cards). ``lang`` and ``label``: constants, or null for what the
#: payload says. ``stop``: page, row, or null (the window alone). ``allow``:
#: categories that pass, or null for all.
RULES = ("source string, kind string, lang string, label string, base string, stop string, allow array<string>, "
         "card string, title string, link string, date string, date_rule string, container string, drop string, take string")
DATE_RULES = ("rfc822", "iso_zone", "iso_nozone", "iso_prefix", "dotted", "long_en", "long_ru", "us_long", "epoch", "relative")
PARSED = ("source", "page", "part", "pos", "title", "url", "content", "language", "published_at")


def last_success(run_log: DataFrame, per_task: bool = True, tasks: DataFrame | None = None) -> DataFrame:
    """Day of the latest successful run per (dag, task), or per dag;
    0001-01-01 when there is none. ``tasks(dag_id, task_id)`` names tasks that
    are to have a row even if they never ran."""
    if tasks is not None:
        never = tasks.select("dag_id", "task_id", F.lit(None).cast("string").alias("state"),
                             F.lit(None).cast("timestamp_ntz").alias("end_date"))
        run_log = run_log.select(*never.columns).unionByName(never)
    keys = ["dag_id", "task_id"] if per_task else ["dag_id"]
    ok = F.when(col("state") == "SUCCESS", col("end_date"))
    out = run_log.groupBy(*keys).agg(F.max(ok).alias("_mx"))
    out = out.select(*keys, F.coalesce(F.to_date("_mx").cast("timestamp_ntz"), ntz(_dt.datetime(1, 1, 1)))
                     .alias("last_success"))
    return out if per_task else out.withColumn("task_id", F.lit("*"))


def source_windows(rules: DataFrame, run_log: DataFrame, as_of: _dt.date, dag: str, task_prefix: str) -> DataFrame:
    """``source, lo, hi``: each source's ingest window on day ``as_of``; one
    that never ran starts at this week's Monday."""
    tasks = rules.select(F.lit(dag).alias("dag_id"), F.concat(F.lit(task_prefix), "source").alias("task_id"))
    last = last_success(run_log.where(col("dag_id") == dag), tasks=tasks)
    lo, hi = ingest_window(as_of, "last_success")
    return (last.select(F.expr(f"substring(task_id, {len(task_prefix) + 1})").alias("source"), lo.alias("lo"), hi.alias("hi"))
            .join(rules.select("source"), "source", "left_semi"))


def _dated(text: Column, rule: Column, as_of: _dt.datetime) -> Column:
    return F.coalesce(*[F.when(rule == r, parse_date(text, r, as_of)) for r in DATE_RULES])


def parse_payloads(feeds: DataFrame, listings: DataFrame, rules: DataFrame, as_of: _dt.date) -> DataFrame:
    """Rows PARSED of every payload whose source has a rule, each at its place
    ``page, part, pos`` (page of the source, fragment of the page, entry of the
    fragment). ``feeds(source, xml[, page])``, ``listings(source, page, json)``. A payload
    that gives no entries has one row without ``pos``, with its ``fault`` (see
    ``extract``) and, if there is one, the ``payload``. Only the kinds that the
    rules name are planned."""
    none, now = F.lit(None).cast("string"), _dt.datetime.combine(as_of, _dt.time())
    kind = lambda k: rules.where(col("kind") == k)
    kinds = {r["kind"] for r in rules.where(col("kind").isin("rss", "json", "html")).select("kind").distinct().collect()}
    page = col("page").cast("int") if "page" in feeds.columns else F.lit(0)
    lost = lambda c: [col("fault"), F.when(col("fault").isNotNull(), col(c)).alias("payload")]
    own = feeds.select("source", page.alias("page"), "xml").join(kind("rss").select("source", "allow"), "source")
    rss = X.rss_payloads(own).where(col("pos").isNull() | col("allow").isNull() | F.arrays_overlap("categories", "allow"))
    rss = rss.select("source", "page", F.lit(0).alias("part"), "pos", "title", "url", none.alias("content"),
                     col("category").alias("language"), "published_at", *lost("xml"))
    own = listings.select("source", col("page").cast("int").alias("page"), "json")
    hits = X.json_payloads(own.join(kind("json").select("source"), "source")).select(
        "source", "page", F.lit(0).alias("part"), "pos", "title", "url", "content", none.alias("language"), "published_at",
        *lost("json"))
    if "html" not in kinds:
        return rss.unionByName(hits)
    parts = X.fragment_payloads(own.join(kind("html").select("source"), "source"))
    cards = M.extract_cards(parts.where(col("part").isNotNull()).drop("json", "fault"), kind("html"), "source")
    cards = cards.join(kind("html").select("source", "date_rule"), "source").select(
        "source", "page", "part", col("pos").cast("int").alias("pos"), F.trim("title").alias("title"), col("link").alias("url"),
        none.alias("content"), none.alias("language"), _dated(F.trim("date"), col("date_rule"), now).alias("published_at"),
        none.alias("fault"), none.alias("payload"))
    broken = parts.where(col("fault").isNotNull()).select(
        "source", "page", "part", none.cast("int").alias("pos"), none.alias("title"), none.alias("url"), none.alias("content"),
        none.alias("language"), none.cast("timestamp_ntz").alias("published_at"), *lost("json"))
    return rss.unionByName(hits).unionByName(cards).unionByName(broken)


def payload_report(parsed: DataFrame) -> DataFrame:
    """``source, page, reason, n_items`` of each payload in ``parse_payloads``'
    rows; ``reason`` is null for a sound one."""
    return parsed.groupBy("source", "page").agg(F.max("fault").alias("reason"), F.count("pos").alias("n_items"))


@dataclass(frozen=True)
class IngestRun:
    """What a run leaves: ``articles`` (stored ones and this run's); ``quarantine``,
    sources that gave nothing (``source, reason``); ``broken``, payloads that
    couldn't be read (``source, page, reason, payload``)."""

    articles: DataFrame
    quarantine: DataFrame
    broken: DataFrame


def ingest_run(feeds: DataFrame, listings: DataFrame, pages: DataFrame, stored: DataFrame, run_log: DataFrame,
               rules: DataFrame, as_of: _dt.date, dag: str = "ingest", task_prefix: str = "parse_and_save_") -> IngestRun:
    """One run of the ingest job over payload tables.

    Each source is read with its own window and stops by its own rule; articles
    without a text get that of their page (``pages(url, html)``; of a page fetched
    more than once the greatest ``html``, or the one of the latest ``fetched_at`` if there is
    such a column), or '' if it couldn't be fetched. Neither a source without
    rows nor a broken payload stops the others."""
    windows = source_windows(rules, run_log, as_of, dag, task_prefix)
    # written once: read for the articles, for the guard and for what was broken
    parsed = materialize(parse_payloads(feeds, listings, rules, as_of), "parsed")
    items = parsed.where(col("pos").isNotNull())
    ruled = items.join(rules.select("source", "stop", "base", "label", col("lang").alias("_lang")), "source")
    timed = ruled.join(windows, "source").withColumn(
        "url", F.when(col("url").startswith("/"), F.concat(F.coalesce("base", F.lit("")), "url")).otherwise(col("url")))
    # one pass for both kinds of stop: the first page or row that is too old
    old, at = col("published_at") < col("lo"), F.struct("page", "part", "pos")
    stops = timed.groupBy("source").agg(F.min(F.when(old, col("page"))).alias("_page"), F.min(F.when(old, at)).alias("_row"))
    reached = (F.when(col("stop") == "page", col("_page").isNull() | (col("page") <= col("_page")))
               .when(col("stop") == "row", col("_row").isNull() | (at < col("_row"))).otherwise(F.lit(True)))
    # written once: read for the texts wanted, for the articles and for the guard
    kept = materialize(timed.join(stops, "source").where(reached & col("published_at").between(col("lo"), col("hi")))
                       .select(*PARSED, "label", "_lang"), "kept")

    # texts of the pages that are needed, by their source's rule
    wanted = kept.where(col("content").isNull()).select("url", "source").distinct()
    fetched = "fetched_at" in pages.columns
    chosen = wanted.join(pages.select("url", "html", *(["fetched_at"] if fetched else [])), "url").groupBy("url", "source").agg(
        (F.max_by("html", "fetched_at") if fetched else F.max("html")).alias("html"))
    texts = M.extract_container(chosen, rules, "source").select("url", "source", col("text").alias("_text"))
    full = kept.join(texts, ["url", "source"], "left").withColumn("content", F.coalesce("content", "_text"))

    records = full.select("title", "content", "url", F.coalesce("_lang", "language").alias("language"),
                          F.coalesce("label", "source").alias("source"), col("published_at").alias("date"))
    # written once: numbering reads its input twice (sample, then sort)
    incoming = materialize(allowlist_projection(canonical_articles(records)), "incoming")
    top = F.coalesce(stored.agg(F.max("id")).scalar(), F.lit(0))
    added = append_ids(top, incoming, [col("source").asc(), col("url").asc()])
    articles = stored.unionByName(added.select(*stored.columns))

    counts = (rules.select("source")
              .join(items.groupBy("source").agg(F.count(F.lit(1)).alias("n_parsed")), "source", "left")
              .join(kept.groupBy("source").agg(F.count(F.lit(1)).alias("n_kept")), "source", "left"))
    quarantine = counts.where(col("n_kept").isNull()).select(
        "source", F.when(col("n_parsed").isNull(), "no items").otherwise("no items in the window").alias("reason"))
    broken = parsed.where(col("fault").isNotNull()).select("source", "page", col("fault").alias("reason"), "payload")
    return IngestRun(articles, quarantine, broken)


def ingest_job(*tables: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(articles, quarantine) of ``ingest_run``."""
    run = ingest_run(*tables, **options)
    return run.articles, run.quarantine
