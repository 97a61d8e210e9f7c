"""Layouts of the article table that let a job touch little of it.

* buckets: a folder per hash bucket of the key; an upsert rewrites the buckets that
  its changes fall into and leaves the other files as they are;
* feed: rows numbered in feed order, a folder per run of pages; one page is read
  from one folder;
* Z-order: rows sorted along a curve through several columns, with Bloom filters for
  lookups by key; filters on any of the columns skip most row groups.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pressroom.functions.dates import ntz
from pressroom.operators.relate import upsert
from pressroom.operators.sequence import number_within
from pressroom.sources.staging import materialize

# --- buckets --------------------------------------------------------------------------


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, root: str, key: str = "id", buckets: int = 64) -> str:
    """Store ``df`` as folders ``bucket=<n>`` of one file each, sorted by ``key``. A null
    key has a bucket like any other."""
    (df.withColumn("bucket", bucket_of(key, buckets)).repartition(buckets, "bucket").sortWithinPartitions("bucket", key)
     .write.mode("overwrite").partitionBy("bucket").parquet(root))
    return root


def read_buckets(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root).drop("bucket")


def replace_buckets(rows: DataFrame, root: str) -> None:
    """Put the buckets of ``rows`` in the place of those under ``root``; the others
    stay. The same call again has the same effect."""
    (rows.repartition("bucket").sortWithinPartitions("bucket").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(root))


def merge_buckets(spark: SparkSession, root: str, changes: DataFrame, key: str = "id", buckets: int = 64) -> DataFrame:
    """Upsert ``changes`` into the buckets under ``root`` (written with this number of
    buckets). Only the buckets that some change falls into are read, joined and
    written: their numbers (``buckets`` at most) prune the read. Returns the new
    buckets, which are staged before they replace the old ones: if that last step
    dies, ``replace_buckets`` with them completes it."""
    changed = materialize(changes.withColumn("bucket", bucket_of(key, buckets)), "changes")
    touched = [r["bucket"] for r in changed.select("bucket").distinct().collect()]
    stored = spark.read.parquet(root)
    merged = materialize(upsert(stored.where(F.col("bucket").isin(touched)), changed.select(*stored.columns), key)
                         .repartition(F.col("bucket")).sortWithinPartitions("bucket", key), "merged")
    replace_buckets(merged, root)
    return merged


# --- feed -----------------------------------------------------------------------------


def write_feed(df: DataFrame, root: str, order: list[Column], page_size: int = 20, pages_per_file: int = 500) -> str:
    """Store ``df`` in feed order with ``pos`` (from 0) and ``page``: the pages
    ``n * pages_per_file`` up are the one file of folder ``chunk=<n>``. ``order`` is a
    total order."""
    numbered = number_within(df, [], order, "pos").withColumn("page", F.floor(F.col("pos") / page_size).cast("long"))
    (numbered.withColumn("chunk", F.floor(F.col("page") / pages_per_file).cast("long")).repartition("chunk")
     .sortWithinPartitions("chunk", "pos").write.mode("overwrite").partitionBy("chunk").parquet(root))
    return root


def feed_page(spark: SparkSession, root: str, schema: T.StructType, page: int, pages_per_file: int = 500) -> DataFrame:
    """One page of a feed whose rows have this ``schema``, in order. It lists and
    reads one folder however long the feed is; a page past its end is empty."""
    full = T.StructType([*schema.fields, T.StructField("pos", T.LongType()), T.StructField("page", T.LongType())])
    try:
        rows = spark.read.schema(full).parquet(f"{root}/chunk={page // pages_per_file}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], full)
    return rows.where(F.col("page") == page).orderBy("pos")


# --- Z-order ---------------------------------------------------------------------------


def _as_number(df: DataFrame, c: str) -> Column:
    """A number in the order of the column's values; strings by their first bytes."""
    kind = df.schema[c].dataType
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.col(c).cast("binary"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.col(c).cast("date").cast("timestamp").cast("double") + F.hour(c) * 3600 + F.minute(c) * 60
    if isinstance(kind, T.DateType):
        return F.col(c).cast("timestamp").cast("double")
    return F.col(c).cast("double")


def _rank(value: Column, cuts: list[float]) -> Column:
    """How many of the cuts lie at or below a value, 0 for a null."""
    if not cuts:
        return F.lit(0).cast("long")
    below = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda x: x <= value))
    return F.when(value.isNull(), 0).otherwise(below).cast("long")


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 8) -> Column:
    """Place on a Z-curve: each column's quantile number (of ``2^bits``, by approximate
    quantiles over all rows), their bits interleaved. Nulls come first."""
    steps = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = df.select(*[F.percentile_approx(_as_number(df, c), steps, 10_000).alias(c) for c in columns]).first()
    out = F.lit(0).cast("long")
    for k, c in enumerate(columns):
        at = _rank(_as_number(df, c), cuts[c] or [])
        for b in range(bits):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(at, b).bitwiseAND(1), b * len(columns) + k))
    return out


def day_column(column: str) -> str:
    return f"{column}_day"


def time_between(column: str, lo: _dt.datetime, hi: _dt.datetime) -> Column:
    """``lo <= column <= hi`` on a layout written by ``write_zordered``."""
    return F.col(day_column(column)).between(lo.date(), hi.date()) & F.col(column).between(ntz(lo), ntz(hi))


def write_zordered(df: DataFrame, path: str, columns: Sequence[str], files: int, bloom: Sequence[str] = (),
                   keys_per_file: int = 1_000_000, row_group_bytes: int = 32 << 20) -> str:
    """Store ``df`` in ``files`` files along a Z-curve through ``columns``, with Bloom
    filters of the ``bloom`` columns, whose values lie scattered over the files. Filters
    on times without a zone don't reach the files, so such a column of the curve gets its day
    as ``<column>_day``; ``time_between`` uses both."""
    days = {day_column(c): F.to_date(c) for c in columns if isinstance(df.schema[c].dataType, T.TimestampNTZType)}
    w = df.withColumns({**days, "_z": z_value(df, columns)}).repartitionByRange(files, "_z").sortWithinPartitions("_z").drop("_z").write
    for c in bloom:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", keys_per_file)
    w.mode("overwrite").option("parquet.block.size", row_group_bytes).parquet(path)
    return path
