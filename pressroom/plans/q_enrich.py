"""Enrichment queries (translate, submit, poll, embed, classify) and the two
enrichment jobs."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from pressroom.functions.themes import PROMPT_MIDDLE, PROMPT_PREFIX, PROMPT_SUFFIX, keywords, themes_joined
from pressroom.operators import enrich as E
from pressroom.operators import relate as R
from pressroom.operators import select as C
from pressroom.operators.score import collect_replies
from pressroom.plans import bindings as B
from pressroom.plans.duck import with_
from pressroom.plans.registry import query
from pressroom.sources.staging import materialize
from pressroom.sources.tables import read_table

col = F.col

# Oracle text of the translate queue after flag derivation (C7 -> C20).
_WORK = ("work", """SELECT id, coalesce(content, '') AS content, lang, is_translated OR lang = 'en' AS is_translated,
  is_requested_for_summarization, summarization_request_id FROM news
  WHERE (NOT is_translated AND lang <> 'en') OR NOT is_requested_for_summarization""")
_TT = ("tt", "SELECT id FROM work WHERE NOT is_translated AND length(content) > 0 ORDER BY id LIMIT 200")


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


TRANSLATE_BUDGET = 200   # rows translated per run (the reference's fixed budget)


def translate_queue(news, target_lang: str = B.TARGET_LANG, budget: int = TRANSLATE_BUDGET):
    """(work set of the translate job, its first ``budget`` rows to translate)."""
    work = C.derive_flags(news.where(C.queue_translate(target_lang)), target_lang)
    return work, C.first_n(work, C.to_translate_pred(), budget)


def _translate_queue(spark, sf_dir):
    return translate_queue(B.news(spark, sf_dir))


@query("enrich_translate", "J1 J6 F4", with_(["news"], """
SELECT w.id, '[en] ' || w.content AS content, 'ok' AS status FROM work w JOIN tt ON w.id = tt.id""",
                                            [_WORK, _TT]))
def enrich_translate(spark, sf_dir):
    _, tt = _translate_queue(spark, sf_dir)
    return E.enrich(tt, "id", "content", lambda: E.TranslateStub(B.TARGET_LANG), T.StringType(), "content",
                    num_partitions=max(1, TRANSLATE_BUDGET // 25))


@query("submit_requests", "J2 J7", with_(["news"], """
SELECT id, md5('summary' || content) AS request_id, 'ok' AS status FROM work WHERE is_translated""", [_WORK]))
def submit_requests(spark, sf_dir):
    work, _ = _translate_queue(spark, sf_dir)
    return E.enrich(work.where(C.to_summarize()), "id", "content", lambda: E.SubmitStub("summary"),
                    T.StringType(), "request_id")


@query("collect_replies", "J4 D4 D14", with_(["news", "replies"], """
SELECT n.id, CASE WHEN r.done THEN r.text END AS summary, r.request_id IS NOT NULL AS polled
FROM news n LEFT JOIN replies r ON n.summarization_request_id = r.request_id AND n.summarization_request_id <> ''"""))
def collect_replies_q(spark, sf_dir):
    n = B.news(spark, sf_dir).drop("summary")
    r = B.replies(spark, sf_dir)
    polled = collect_replies(n, r, "summarization_request_id", col("summarization_request_id") != "", "summary")
    seen = r.select(col("request_id").alias("summarization_request_id"), F.lit(True).alias("polled"))
    return (polled.join(seen, "summarization_request_id", "left")
            .select("id", "summary", F.coalesce(col("polled"), F.lit(False)).alias("polled")))


@query("attach_embeddings", "J5 (join form)", with_(["news"], """
SELECT n.id, len(e.embedding) AS dims, e.vec_id IS NOT NULL AS is_vectorized
FROM news n LEFT JOIN embeddings e ON n.id = e.vec_id"""))
def attach_embeddings(spark, sf_dir):
    n = B.news(spark, sf_dir).select("id")
    e = read_table(spark, sf_dir, "embeddings").select(col("vec_id").alias("id"), "embedding")
    j = n.join(e, "id", "left")
    return j.select("id", F.when(col("embedding").isNotNull(), F.size("embedding")).cast("long").alias("dims"),
                    col("embedding").isNotNull().alias("is_vectorized"))


def _features_sql(s: str) -> str:
    cnt = "(length({s}) - length(replace({s}, '{c}', '')))"
    return (f"CASE WHEN trim(coalesce({s}, ''), ' ' || chr(9) || chr(10) || chr(13)) = '' THEN NULL ELSE "
            f"[CAST(length({s}) AS DOUBLE), CAST({cnt.format(s=s, c=' ')} AS DOUBLE), "
            f"CAST({cnt.format(s=s, c=chr(10))} AS DOUBLE), CAST({cnt.format(s=s, c='.')} AS DOUBLE)] END")


@query("embed_texts", "J5 (operator form) D27 D38", with_(["news"], f"""
SELECT id, v[1] AS chars, v[4] AS dots, len(v) AS dims, 'ok' AS status FROM (
  SELECT id, {_features_sql('content')} AS v FROM news WHERE NOT is_vectorized AND (is_translated OR lang = 'en'))"""))
def embed_texts(spark, sf_dir):
    todo = B.news(spark, sf_dir).where(C.to_embed(B.TARGET_LANG))
    out = E.enrich(todo, "id", "content", E.EmbedStub, T.ArrayType(T.DoubleType()), "v")
    return out.select("id", col("v")[0].alias("chars"), col("v")[3].alias("dots"),
                      F.when(col("v").isNotNull(), F.size("v")).cast("long").alias("dims"), "status")


def _classify_sql() -> str:
    kws = "[" + ", ".join(_sql_str(k.lower()) for k in keywords()) + "]"
    return with_(["news"], f"""
SELECT id, CASE WHEN n > 0 THEN code ELSE 0 END AS theme FROM (
  SELECT id, code, n, row_number() OVER (PARTITION BY id ORDER BY n DESC, code) AS rn FROM (
    SELECT t.id, k.code,
      CAST(floor((length(t.low) - length(replace(t.low, k.kw, ''))) / CAST(length(k.kw) AS DOUBLE)) AS BIGINT) AS n
    FROM (SELECT id, lower(coalesce(content, '')) AS low FROM news WHERE is_translated AND NOT is_scored) t,
         (SELECT unnest(range(1, {len(keywords()) + 1})) AS code, unnest({kws}) AS kw) k))
WHERE rn = 1""")


@query("classify_themes", "J8 A13", _classify_sql())
def classify_themes(spark, sf_dir):
    n = B.news(spark, sf_dir).where(C.to_classify())
    return E.classify_themes(n, "content", "theme").select("id", "theme")


# --- jobs -----------------------------------------------------------------------


def translate_summarize_job(news, translator=None, summarizer=None, target_lang: str = B.TARGET_LANG,
                            budget: int = TRANSLATE_BUDGET, skip_empty: bool = False):
    """K2 on an article table: translate the first ``budget`` untranslated rows, then submit every
    translated row for a summary; results merge back by masked update.

    ``translator`` / ``summarizer`` are client factories (default: the
    offline stand-ins); each client is called once per due row.
    ``skip_empty`` leaves rows with empty content out of the summary
    requests (literal behaviour submits them)."""
    translator = translator or (lambda: E.TranslateStub(target_lang))
    summarizer = summarizer or (lambda: E.SubmitStub("summary"))
    work, tt = translate_queue(news, target_lang, budget)
    # Remote results are written once before reuse: the translated rows feed
    # both the summary requests and the merge, and a lazy frame would call
    # the model again for each consumer.
    # The budget bounds this input: size its tasks from the budget (about 25
    # rows per task), not from the cluster-wide shuffle partition count.
    tr = materialize(E.enrich(tt, "id", "content", translator, T.StringType(), "content",
                              num_partitions=max(1, budget // 25)), "translated")
    work = R.masked_update(work, tr.where(col("status") == "ok")
                           .select("id", "content", F.lit(True).alias("is_translated")), unique=True)
    due = C.to_summarize() & (F.length("content") > 0) if skip_empty else C.to_summarize()
    req = materialize(E.enrich(work.where(due), "id", "content", summarizer,
                               T.StringType(), "rid"), "summary-requests")
    upd = req.select("id", F.coalesce(col("rid"), F.lit("")).alias("summarization_request_id"),
                     col("rid").isNotNull().alias("is_requested_for_summarization"))
    return R.masked_update(work, upd, unique=True)


def translate_and_summarize(spark, sf_dir, *clients, **options):
    """K2 on the fixture article table (see ``translate_summarize_job``)."""
    return translate_summarize_job(B.news(spark, sf_dir), *clients, **options)


@query("job_translate_summarize", "K2 C7 I20 C20 C9 J1 D2j C10 J2 D29 D30", with_(["news"], """
SELECT id, content, is_translated,
  CASE WHEN is_translated THEN md5('summary' || content) ELSE summarization_request_id END AS summarization_request_id,
  is_translated OR is_requested_for_summarization AS is_requested_for_summarization
FROM (SELECT w.id, CASE WHEN tt.id IS NOT NULL THEN '[en] ' || w.content ELSE w.content END AS content,
        w.is_translated OR tt.id IS NOT NULL AS is_translated, w.summarization_request_id,
        w.is_requested_for_summarization
      FROM work w LEFT JOIN tt ON w.id = tt.id)""", [_WORK, _TT]))
def job_translate_summarize(spark, sf_dir):
    out = translate_and_summarize(spark, sf_dir)
    return out.select("id", "content", "is_translated", "summarization_request_id",
                      "is_requested_for_summarization")


def vectorize_request_job(news, replies, embedder=None, classifier=None, target_lang: str = B.TARGET_LANG,
                          embed_col: str = "summary", skip_requested: bool = False):
    """K3 on an article table and a replies table (request_id, done, text):
    poll summaries, embed the summaries of rows due for a vector, then
    submit every translated, unscored row for classification.

    ``embedder`` / ``classifier`` are client factories (default: the offline
    stand-ins); each client is called once per due row. ``embed_col`` is the
    text that is embedded (default the summary, a null text gives no
    vector); ``skip_requested`` does not resubmit rows already requested for
    scoring (literal behaviour resubmits them)."""
    embedder = embedder or E.EmbedStub
    classifier = classifier or (lambda: E.SubmitStub("pro"))
    work = news.where(C.queue_results()).drop("summary")
    polled_cond = col("summarization_request_id") != ""
    work = collect_replies(work, replies, "summarization_request_id", polled_cond, "summary")
    work = work.withColumn("is_summarized", F.when(polled_cond, col("summary").isNotNull())
                           .otherwise(col("is_summarized")))
    vec = materialize(E.enrich(work.where(C.to_embed(target_lang)), "id", embed_col, embedder,
                               T.ArrayType(T.DoubleType()), "vectorized_content"), "vectors")
    work = R.masked_update(work, vec.select("id", "vectorized_content",
                                            col("vectorized_content").isNotNull().alias("is_vectorized")),
                           unique=True)
    prompts = work.where(C.to_classify(skip_requested)).select(
        "id", E.classification_prompt(col("content")).alias("prompt"))
    req = materialize(E.enrich(prompts, "id", "prompt", classifier, T.StringType(),
                               "score_request_id"), "score-requests")
    return R.masked_update(work, req.select("id", "score_request_id", F.lit(False).alias("is_scored"),
                                            col("score_request_id").isNotNull()
                                            .alias("is_requested_for_scoring")), unique=True)


def vectorize_and_request(spark, sf_dir, *clients, **options):
    """K3 on the fixture tables (see ``vectorize_request_job``)."""
    return vectorize_request_job(B.news(spark, sf_dir), B.replies(spark, sf_dir), *clients, **options)


_PROMPT_HEAD = _sql_str(PROMPT_PREFIX + themes_joined() + PROMPT_MIDDLE)


@query("job_vectorize_request", "K3 C8 J4 C20 C11 J5 D2j C12 I7 J2 D13 D14 D38", with_(["news", "replies"], f"""
SELECT id, is_summarized, summary,
  CASE WHEN to_embed THEN v IS NOT NULL ELSE is_vectorized END AS is_vectorized,
  CASE WHEN to_embed AND v IS NOT NULL THEN v[1] END AS vec_chars,
  CASE WHEN is_translated AND NOT is_scored
       THEN md5('pro' || {_PROMPT_HEAD} || content || {_sql_str(PROMPT_SUFFIX)}) ELSE score_request_id END
    AS score_request_id,
  CASE WHEN is_translated AND NOT is_scored THEN true ELSE is_requested_for_scoring END AS is_requested_for_scoring
FROM (
  SELECT *, {_features_sql('summary')} AS v FROM (
    SELECT w.*, CASE WHEN w.summarization_request_id <> '' THEN r.summary ELSE NULL END AS summary,
      CASE WHEN w.summarization_request_id <> '' THEN r.summary IS NOT NULL ELSE w.is_summarized0 END AS is_summarized,
      NOT w.is_vectorized AND (w.is_translated OR w.lang = 'en') AS to_embed
    FROM (SELECT * EXCLUDE (summary, is_summarized), is_summarized AS is_summarized0 FROM news
          WHERE (NOT is_summarized AND is_requested_for_summarization)
             OR (is_requested_for_scoring AND NOT is_scored)) w
    LEFT JOIN (SELECT request_id, CASE WHEN done THEN text END AS summary FROM replies) r
      ON w.summarization_request_id = r.request_id AND w.summarization_request_id <> ''))"""))
def job_vectorize_request(spark, sf_dir):
    out = vectorize_and_request(spark, sf_dir)
    return out.select("id", "is_summarized", "summary", "is_vectorized",
                      col("vectorized_content")[0].alias("vec_chars"), "score_request_id",
                      "is_requested_for_scoring")


@query("generate_sync", "J3 J7", with_(["news"], """
SELECT id, 'summary:' || CAST(length(content) AS VARCHAR) AS summary, 'ok' AS status FROM work WHERE is_translated""",
                                         [_WORK]))
def generate_sync(spark, sf_dir):
    work, _ = _translate_queue(spark, sf_dir)
    return E.enrich(work.where(C.to_summarize()), "id", "content", lambda: E.GenerateStub("summary"),
                    T.StringType(), "summary")
