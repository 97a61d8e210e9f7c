"""Readers for small list files: the ranked authority list (CSV, order =
rank), the theme keyword list (one keyword per line) and RSS feed files.

File order becomes an explicit 1-based ``rank``/``code`` column, computed
with the distributed numbering operator (no single-partition window).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressroom.operators.sequence import number_within
from pressroom.schemas import RSS_ITEM


def _in_file_order(df: DataFrame, out_col: str) -> DataFrame:
    """1-based position of each row in file order (file name, then offset)."""
    tagged = df.withColumn("_file", F.input_file_name()).withColumn("_o", F.monotonically_increasing_id())
    numbered = number_within(tagged, [], [F.col("_file").asc(), F.col("_o").asc()], "_pos")
    return numbered.withColumn(out_col, F.col("_pos") + 1).drop("_file", "_o", "_pos")


def read_ranked_list(spark: SparkSession, path: str, name_col: str = "name") -> DataFrame:
    """Authority list: header CSV with a ``name`` column; rank = line order.
    A name listed twice keeps its first (lowest) rank."""
    raw = spark.read.option("header", "true").csv(path)   # columns by the header's names, all text
    if name_col not in raw.columns:
        raise ValueError(f"no column {name_col!r} in {path}: {raw.columns}")
    raw = raw.select(name_col)
    ranked = _in_file_order(raw, "rank")
    return ranked.groupBy(F.col(name_col).alias("name")).agg(F.min("rank").alias("rank")).select("rank", "name")


def read_keyword_list(spark: SparkSession, path: str) -> DataFrame:
    """Theme keywords: one per line, empty lines dropped, no trimming;
    ``code`` = position among the kept lines."""
    lines = spark.read.text(path)
    lines = _in_file_order(lines, "_line")
    kept = lines.where(F.col("value") != "")
    numbered = number_within(kept, [], [F.col("_line").asc()], "_k")
    return numbered.select((F.col("_k") + 1).alias("code"), F.col("value").alias("keyword"))


def keyword_string(keywords: DataFrame) -> Column:
    """Comma-joined keywords in code order (the prompt's theme list), as a
    scalar subquery for use in a prompt expression."""
    in_order = F.array_sort(F.collect_list(F.struct("code", "keyword")))
    return keywords.agg(F.array_join(F.transform(in_order, lambda k: k["keyword"]), ",")).scalar()


def read_rss_files(spark: SparkSession, path: str) -> DataFrame:
    """RSS/XML files: one row per ``item`` with the source file name."""
    items = (spark.read.format("xml").option("rowTag", "item").schema(RSS_ITEM).load(path))
    return items.withColumn("feed_file", F.input_file_name())
