"""Row predicates and projections of the workflow queues and serving views.

Predicates are plain Column expressions so Catalyst pushes them into the
parquet scan where the columns come straight from storage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pressroom.schemas import UPLOAD_COLUMNS

col = F.col


def queue_translate(target_lang: str = "en") -> Column:
    """(not translated and not in the target language) or not yet requested
    for summarization."""
    return ((~col("is_translated") & (col("lang") != target_lang))
            | ~col("is_requested_for_summarization"))


def queue_results() -> Column:
    """Summary requested but not received, or score requested but not received."""
    return ((~col("is_summarized") & col("is_requested_for_summarization"))
            | (col("is_requested_for_scoring") & ~col("is_scored")))


def to_translate_pred() -> Column:
    return ~col("is_translated") & (F.length(F.coalesce(col("content"), F.lit(""))) > 0)


def to_summarize() -> Column:
    return col("is_translated")


def to_embed(target_lang: str = "en") -> Column:
    return ~col("is_vectorized") & (col("is_translated") | (col("lang") == target_lang))


def to_classify(skip_requested: bool = False) -> Column:
    p = col("is_translated") & ~col("is_scored")
    return p & ~col("is_requested_for_scoring") if skip_requested else p


def to_collect_rate() -> Column:
    return col("is_requested_for_scoring") & ~col("is_scored")


def first_n(df: DataFrame, where: Column, n: int, order: list[Column] | None = None) -> DataFrame:
    """First ``n`` matching rows in key order (a top-k, not a full sort)."""
    return df.where(where).orderBy(*(order or [col("id").asc()])).limit(n)


def date_window(df: DataFrame, lo, hi, ts_col: str = "published_at") -> DataFrame:
    """Closed window lo <= ts <= hi."""
    from pressroom.functions.dates import ntz
    return df.where(col(ts_col).between(ntz(lo), ntz(hi)))


def allowlist_projection(df: DataFrame, allowed=UPLOAD_COLUMNS) -> DataFrame:
    """Keep the allowed columns that exist, in allowlist order."""
    return df.select(*[c for c in allowed if c in df.columns])


def canonical_articles(df: DataFrame) -> DataFrame:
    """Extractor output -> the article schema."""
    return df.select(col("title"), F.coalesce(col("content"), F.lit("")).alias("content"),
                     col("url"), col("language").alias("lang"), col("source"),
                     col("date").alias("published_at"))


def text_search(df: DataFrame, query: str, fields=("title", "content", "source")) -> DataFrame:
    """Admin search: every word must occur (case-insensitively) in at least
    one of the fields."""
    cond = F.lit(True)
    for word in query.split():
        w = word.lower()
        any_field = F.lit(False)
        for f in fields:
            any_field = any_field | F.coalesce(F.instr(F.lower(col(f)), w) > 0, F.lit(False))
        cond = cond & any_field
    return df.where(cond)


def derive_flags(df: DataFrame, target_lang: str = "en") -> DataFrame:
    """Workflow flag derivation before the translate step: content null -> '',
    target-language rows count as translated, request flags follow request ids,
    and is_vectorized is a real boolean."""
    return (df.withColumn("content", F.coalesce(col("content"), F.lit("")))
            .withColumn("is_translated", col("is_translated") | (col("lang") == target_lang))
            .withColumn("is_requested_for_summarization",
                        col("is_requested_for_summarization")
                        | (F.coalesce(col("summarization_request_id"), F.lit("")) != ""))
            .withColumn("is_vectorized", F.coalesce(col("is_vectorized"), F.lit(False))))
