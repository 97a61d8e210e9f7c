"""Article scoring: reply code + age + source authority, each min-max
normalised over the scored work set and added.

Bounds come from one global aggregate used as a scalar subquery
(``DataFrame.scalar()``): partial min/max per task, one tiny final merge, and
the values are inlined into the projection -- no unpartitioned window, no
cross join, nothing collected by user code.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, functions as F

from pressroom.functions.dates import age_days
from pressroom.functions.text import first_int
from pressroom.operators.select import to_collect_rate


def minmax(x: Column, lo: Column, hi: Column) -> Column:
    """(x - lo) / (hi - lo); 0 when the signal is constant or x is null."""
    return F.coalesce(F.try_divide(x - lo, hi - lo), F.lit(0.0))


def authority_rank(df: DataFrame, authority: DataFrame, source_col: str = "source",
                   out_col: str = "source_rank") -> DataFrame:
    """1-based rank of each row's source in the ranked list (first occurrence
    wins); null for unlisted sources."""
    ranks = authority.groupBy("name").agg(F.min("rank").alias(out_col))
    return (df.join(ranks, df[source_col] == ranks["name"], "left").drop("name"))


def collect_replies(df: DataFrame, replies: DataFrame, id_col: str, where: Column,
                    out_col: str) -> DataFrame:
    """Poll replies: for rows matching ``where`` attach the reply text of
    request ``id_col`` when that reply is done (null while pending).

    Only those rows are joined; the others, which mostly share the empty
    request id, pass by and never meet in one task. A reply delivered more than
    once counts once (the greatest text, should they differ)."""
    r = replies.groupBy(F.col("request_id").alias("_rid")).agg(
        F.max(F.when(F.col("done"), F.col("text"))).alias(out_col))
    due = F.coalesce(where, F.lit(False))
    polled = df.where(due).join(r, F.col(id_col) == F.col("_rid"), "left").drop("_rid")
    return polled.unionByName(df.where(~due).withColumn(out_col, F.lit(None).cast("string")))


def signals(work: DataFrame, replies: DataFrame, authority: DataFrame,
            as_of: _dt.date) -> DataFrame:
    """Work set with the scoring inputs: polled rate, is_scored, rate_num,
    age_days and source_rank."""
    queue = to_collect_rate()
    polled = collect_replies(work, replies, "score_request_id", queue, "_reply")
    polled = (polled
              .withColumn("rate", F.when(queue, F.coalesce(F.col("_reply"), F.lit("")))
                          .otherwise(F.lit("")))
              .withColumn("is_scored", F.when(queue, F.col("_reply").isNotNull())
                          .otherwise(F.col("is_scored")))
              .drop("_reply"))
    with_rank = authority_rank(polled, authority)
    return (with_rank
            .withColumn("rate_num", first_int("rate"))
            .withColumn("age_days", age_days("published_at", as_of)))


def add_score(df: DataFrame, invert_age: bool = False, invert_rank: bool = False) -> DataFrame:
    """score = norm(rate_num) + norm(age_days) + norm(source_rank).

    Literal by default: older articles and lower-listed sources score higher;
    ``invert_*`` flips a signal to 1 - norm."""
    b = df.agg(F.struct(
        F.min("rate_num").alias("r_lo"), F.max("rate_num").alias("r_hi"),
        F.min("age_days").cast("double").alias("a_lo"), F.max("age_days").cast("double").alias("a_hi"),
        F.min("source_rank").cast("double").alias("s_lo"),
        F.max("source_rank").cast("double").alias("s_hi"),
    ).alias("b")).scalar()
    # One scalar subquery, bound to a column once and read by field.
    df = df.withColumn("_b", b)
    lo_hi = {k: F.col(f"_b.{k}") for k in ("r_lo", "r_hi", "a_lo", "a_hi", "s_lo", "s_hi")}
    n_rate = minmax(F.col("rate_num"), lo_hi["r_lo"], lo_hi["r_hi"])
    n_age = minmax(F.col("age_days").cast("double"), lo_hi["a_lo"], lo_hi["a_hi"])
    n_src = minmax(F.col("source_rank").cast("double"), lo_hi["s_lo"], lo_hi["s_hi"])
    if invert_age:
        n_age = F.lit(1.0) - n_age
    if invert_rank:
        n_src = F.when(F.col("source_rank").isNotNull(), F.lit(1.0) - n_src).otherwise(0.0)
    return df.withColumn("score", n_rate + n_age + n_src).drop("_b")


SIGNAL_COLS = ("id", "source", "rate", "rate_num", "age_days", "source_rank", "is_scored")


def score_news(work: DataFrame, replies: DataFrame, authority: DataFrame,
               as_of: _dt.date, materialized: bool = True) -> DataFrame:
    """Scores of the work set (columns SIGNAL_COLS + score).

    The bounds and the scores both read the signals. Left lazy, the reply
    join (two shuffles of the work set and the replies) would run once for
    the bounds subquery and again for the scores, since Spark does not
    reuse an exchange across a scalar subquery. So the narrow signal
    columns are written once to the shared staging folder and read twice.
    This also cuts the lineage before the final projection."""
    sig = signals(work, replies, authority, as_of).select(*SIGNAL_COLS)
    if materialized:
        from pressroom.sources.staging import materialize
        sig = materialize(sig, "signals")
    return add_score(sig)
