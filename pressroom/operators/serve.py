"""Prompt-table operations of the admin (one-active-prompt invariant)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pressroom.operators.relate import upsert


def mark_in_use(prompts: DataFrame, selected: DataFrame) -> DataFrame:
    """Admin action: selected prompts become active, all others inactive.

    ``selection_active`` is the number of selected prompts that were already
    active (the action warns when it is 0). Several prompts may stay active."""
    sel = selected.select(F.col("id").alias("_sel"))
    active_before = selected.where(F.col("in_use")).agg(F.count(F.lit(1))).scalar()
    marked = prompts.join(sel, prompts["id"] == sel["_sel"], "left")
    return (marked.withColumn("in_use", F.col("_sel").isNotNull())
            .withColumn("selection_active", active_before)
            .drop("_sel"))


def save_prompt(prompts: DataFrame, saved: DataFrame) -> DataFrame:
    """Save rows of ``saved``: when one is saved with ``in_use``, every other
    prompt is set inactive first; the saved rows then replace or append."""
    activating = saved.where(F.col("in_use")).agg(F.count(F.lit(1))).scalar() > 0
    cleared = prompts.withColumn("in_use", F.when(activating, F.lit(False)).otherwise(F.col("in_use")))
    return upsert(cleared, saved.select(*prompts.columns), "id")
