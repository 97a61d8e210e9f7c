"""Schema evolution as data jobs and exact duplicate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def add_missing_columns(df: DataFrame, target: T.StructType, defaults: dict) -> DataFrame:
    """Add every column of ``target`` that ``df`` lacks, filled with its
    default (null when none), and return the columns in ``target`` order."""
    cols = []
    for f in target.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def backfill_nulls(df: DataFrame, values: dict) -> DataFrame:
    """``UPDATE t SET c = v WHERE c IS NULL`` for each (c, v)."""
    return df.na.fill(values)


def content_key(text_col: str) -> F.Column:
    """md5 of the normalised text: lower-cased, whitespace runs collapsed, trimmed."""
    norm = F.trim(F.regexp_replace(F.lower(F.col(text_col)), r"[\s\x0B]+", " "))
    return F.md5(norm)


def dedupe_exact(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """Keep one row per normalised text -- the lowest key -- with the size of its
    copy group. The group is reduced on narrow rows (hash and key, partially
    aggregated per task, so a text copied a million times is one row after the
    map side); whole rows are only joined by key. ``key`` must be unique."""
    keyed = df.withColumn("_h", content_key(text_col))
    keep = keyed.groupBy("_h").agg(F.min(key).alias(key), F.count(F.lit(1)).alias("n_copies")).drop("_h")
    return df.join(keep, key).select(*df.columns, "n_copies")
