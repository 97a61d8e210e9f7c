"""Staging and export sinks (CSV and Parquet) and the JDBC article table.

Staging paths live under the shared folder named by ``spark.checkpoint.dir``
(never a machine-local temp folder on a cluster). Every write goes to a new
path, so a retried task or a re-run never reads the path it is overwriting.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pressroom.functions.dates import format_ntz
from pressroom.session import ensure_checkpoint_dir

CSV_OPTIONS = {"header": "true", "escape": '"', "quote": '"', "multiLine": "true",
               "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/staging/{name}-{uuid.uuid4().hex}"


# A file of quoted multi-line fields is read by one task, so files are kept short.
CSV_ROWS_PER_FILE = 50_000


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Header CSV with quoted multi-line fields (one header per part file)."""
    df.write.mode(mode).options(**CSV_OPTIONS).option("maxRecordsPerFile", CSV_ROWS_PER_FILE).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read staged CSV by the names in its header, with declared types (no
    inference). Columns may stand in any order; a header without one of the
    declared names is an error, other columns are ignored, and every file under
    ``path`` must have the same header. As with any CSV hop, an empty string
    reads back as null."""
    header = spark.read.options(**CSV_OPTIONS).csv(path).columns
    missing = [f.name for f in schema if f.name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    kinds = {f.name: f.dataType for f in schema}
    placed = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in header])
    return (spark.read.options(**CSV_OPTIONS).option("enforceSchema", "false").schema(placed).csv(path)
            .select(*schema.names))


def union_csv(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Union by name of staged CSV folders, each with its own column order; a
    column that a folder lacks is null for its rows."""
    out = None
    for path in paths:
        header = spark.read.options(**CSV_OPTIONS).csv(path).columns
        own = read_csv(spark, path, T.StructType([f for f in schema if f.name in header]))
        own = own.select(*[F.col(f.name) if f.name in header else F.lit(None).cast(f.dataType).alias(f.name)
                           for f in schema])
        out = own if out is None else out.unionByName(own)
    return out


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a parquet table in the shared staging folder and
    read it back: cuts the lineage (a lost executor re-reads the table, it
    does not recompute the inputs) and lets several consumers share one
    computation."""
    spark = df.sparkSession
    return spark.read.parquet(write_parquet(df, staging_path(spark, name)))


EXPORT_COLUMNS = (("title", "Title"), ("content", "Content"), ("lang", "Language"),
                  ("source", "Source"), ("published_at", "Date"), ("url", "Url"))


def export_frame(articles: DataFrame) -> DataFrame:
    """Articles in the export layout: capitalised names, date as
    'yyyy-MM-dd HH:mm:ss+0000' (UTC)."""
    cols = []
    for src, dst in EXPORT_COLUMNS:
        c = F.col(src)
        if src == "published_at":
            c = F.concat(format_ntz(c, "yyyy-MM-dd HH:mm:ss"), F.lit("+0000"))
        cols.append(c.alias(dst))
    return articles.select(*cols)


def export_csv(articles: DataFrame, path: str, accumulate: bool = True) -> str:
    """Accumulating export (append, header per part file) or one-shot overwrite."""
    return write_csv(export_frame(articles), path, mode="append" if accumulate else "overwrite")


def read_jdbc(spark: SparkSession, url: str, query: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, partitions: int = 8,
              driver: str | None = None) -> DataFrame:
    """Article table over JDBC: ``query`` is pushed to the database; with a
    numeric partition column the read is split into ``partitions`` ranges."""
    r = spark.read.format("jdbc").option("url", url)
    if driver:
        r = r.option("driver", driver)
    if partition_column:
        r = (r.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
             .option("lowerBound", lower).option("upperBound", upper)
             .option("numPartitions", partitions))
    else:
        r = r.option("query", query)
    return r.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               driver: str | None = None) -> None:
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).mode(mode)
    if driver:
        w = w.option("driver", driver)
    w.save()


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Store ``df`` as a catalog table bucketed and sorted by ``key``.

    The article table is joined on ``id`` by every masked update and by the
    upsert publish. Bucketed by ``id``, those joins read it without a
    shuffle: only the (much smaller) change set is shuffled into the
    matching buckets. Rows are dealt by the key first, so there is one file a
    bucket, not one for each task and bucket. ``path`` defaults to the shared
    staging folder."""
    spark = df.sparkSession
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", path or staging_path(spark, table)).saveAsTable(table))
    return spark.table(table)


def publish_version(base: DataFrame, changes: DataFrame, table: str, version: int, key: str = "id",
                    buckets: int = 64, *, root: str) -> DataFrame:
    """Publish an upsert of ``changes`` into ``base`` as a new table version
    ``<table>_v<version>`` under ``root`` (the version being read is never
    overwritten), bucketed by ``key`` for the next round of id joins."""
    from pressroom.operators.relate import upsert

    path = f"{root.rstrip('/')}/v{version}"
    return save_bucketed(upsert(base, changes, key), f"{table}_v{version}", key, buckets, path)
