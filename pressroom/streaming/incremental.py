"""Incremental jobs on Structured Streaming.

The batch jobs keep a high-water mark and status flags; the streaming form
reads the landing folder with a fixed schema and processes only new files,
with progress in a checkpoint under the shared ``spark.checkpoint.dir``.
``trigger(availableNow=True)`` drains what is there and stops, so the same
code runs as a scheduled batch or continuously.

Each micro-batch lands as its own partition of a log table and never
overwrites a path it reads, so a retried batch rewrites only its own files.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pressroom.functions.dates import ntz_epoch_micros


def landing_stream(spark: SparkSession, folder: str, file_glob: str, schema,
                   files_per_batch: int = 64) -> DataFrame:
    """Stream of the parquet files in ``folder`` whose names match ``file_glob``."""
    return (spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
            .option("maxFilesPerTrigger", files_per_batch).parquet(folder))


def table_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 64) -> DataFrame:
    """Stream of the parquet table at ``path``, which is one file or a folder of files."""
    folder, name = path.rstrip("/").rsplit("/", 1)
    # a stream's plain path has to be a folder; what a pattern finds may be either
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .parquet(f"{folder}/{{{name}}}"))


def checkpoint_of(out: str) -> str:
    """The checkpoint that belongs to an output path. Progress is tied to the
    output, so a second call goes on where the first one stopped instead of
    starting at epoch 0 again and replacing what has landed."""
    return out.rstrip("/") + "-checkpoint"


def instant_utc(ntz_col) -> F.Column:
    """timestamp_ntz holding UTC wall time -> TIMESTAMP instant (watermarks
    need TIMESTAMP), independent of the session time zone."""
    return F.timestamp_micros(ntz_epoch_micros(ntz_col))


def finish(q: StreamingQuery) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def run_available(query_builder) -> None:
    finish(query_builder.trigger(availableNow=True).start())


def upsert_ingest(spark: SparkSession, stream: DataFrame, table_base: str, key: str = "id") -> str:
    """Land each micro-batch as its own partition ``table_base/epoch=<n>``, one
    row per key (of a key delivered twice in a batch, any one row). Rows without
    a key can't replace one another: all of them land.

    Writing a batch costs O(batch), never O(table); a retried batch
    overwrites only its own partition (idempotent). The upserted table is
    ``current_rows`` over the log; ``compact`` folds the log into a new path."""
    def land(batch: DataFrame, epoch: int) -> None:
        keyed = batch.where(F.col(key).isNotNull()).dropDuplicates([key])
        (keyed.unionByName(batch.where(F.col(key).isNull()))
         .write.mode("overwrite").parquet(f"{table_base}/epoch={epoch}"))

    run_available(stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint_of(table_base)))
    return table_base


def current_rows(spark: SparkSession, table_base: str, key: str = "id") -> DataFrame:
    """Latest version of every key across the landed batches (later epoch
    wins), and every row without a key. The newest epoch per key is a narrow
    aggregate; whole rows are only joined, so columns that aren't selected are
    not read."""
    log = spark.read.parquet(table_base)
    newest = log.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("epoch").alias("epoch"))
    keyless = log.where(F.col(key).isNull())
    return log.join(newest, [key, "epoch"]).unionByName(keyless).drop("epoch")


def compact(spark: SparkSession, table_base: str, out: str, key: str = "id") -> str:
    """Write the current rows of the log as a new table version at ``out``."""
    current_rows(spark, table_base, key).write.mode("overwrite").parquet(out)
    return out


#: State of streaming queries on disk, of which a batch uploads its changes only.
KEYED_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB (a query takes these
    settings with it when it starts); the session's own settings come back."""
    before = {k: spark.conf.get(k, None) for k in KEYED_STATE}
    try:
        for k, v in KEYED_STATE.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def dedupe_ingest(spark: SparkSession, stream: DataFrame, table_base: str, key: str,
                  arrival: str | None = None, forget_after: str | None = None) -> str:
    """Land the first delivery of every key and drop re-deliveries; rows without a
    key are no re-deliveries of each other and all land.

    The keys seen are the query's own state: partitioned by key, kept in RocksDB
    and checkpointed as the batch's changes. A batch looks up its own keys and
    reads nothing that has landed, so it costs the same however long the log is.
    By default keys are remembered for good, so a re-delivery is known however
    late it comes. With ``arrival`` (a timestamp column: when the row came in, which
    only moves forward) and ``forget_after`` (an interval) a key is forgotten that
    long after its first delivery, which bounds the state. A retried batch replaces
    its own partition ``table_base/epoch=<n>``."""
    keyed = stream.where(F.col(key).isNotNull())
    if forget_after:
        if not arrival:
            raise ValueError("forget_after needs the arrival column")
        first = keyed.withWatermark(arrival, forget_after).dropDuplicatesWithinWatermark([key])
    else:
        first = keyed.dropDuplicates([key])
    once = first.unionByName(stream.where(F.col(key).isNull()))

    def land(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_base}/epoch={epoch}")

    with keyed_state(spark):
        query = (once.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint_of(table_base))
                 .trigger(availableNow=True).start())
    finish(query)
    return table_base


# --- early stop ----------------------------------------------------------------------


def reached(prefix: str = "") -> F.Column:
    """Rows that a crawl with early stop gets to, given its source's marks."""
    page, pos = F.col(f"{prefix}stop_page"), F.col(f"{prefix}stop_pos")
    return (F.when(F.col("stop") == "page", page.isNull() | (F.col("page") <= page))
            .when(F.col("stop") == "row", pos.isNull() | (F.col("pos") < pos)).otherwise(F.lit(True)))


def crawl_ingest(spark: SparkSession, stream: DataFrame, windows: DataFrame, table_base: str,
                 key: str = "source") -> str:
    """Early stop over listing rows that arrive in any number of files and batches.

    ``stream`` has ``key, page, pos, published_at`` and whatever else is to land;
    ``windows(key, stop, lo, hi)`` names each source's bounds and how it stops
    (``page``, ``row`` or null). What a batch leaves for the next ones is one row a
    source: the first page and the first position that were too old (the stop
    flags) and the newest time in the window (the high-water mark). The marks of
    epoch ``n`` are those of ``n - 1`` lowered by the batch's own, which are a grouped
    minimum, so a source with most of the rows isn't gathered; a batch reads its own
    files and one small table.

    ``table_base/rows`` gets the rows that the marks let pass, so once a source has
    stopped, what it delivers later doesn't land. ``crawled`` applies the last
    marks to what landed before them: files may come in any order. Rows of a
    source without a window, or of a null source, don't land."""
    rows, marks_at = f"{table_base}/rows", f"{table_base}/marks"
    bounds = windows.select(key, "stop", F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))

    def land(batch: DataFrame, epoch: int) -> None:
        timed = batch.join(bounds, key)
        old, inside = F.col("published_at") < F.col("_lo"), F.col("published_at").between(F.col("_lo"), F.col("_hi"))
        seen = timed.groupBy(key).agg(F.min(F.when(old, F.col("page"))).alias("stop_page"),
                                      F.min(F.when(old, F.col("pos"))).alias("stop_pos"),
                                      F.max(F.when(inside, F.col("published_at"))).alias("high_water"))
        if epoch:
            earlier = spark.read.schema(seen.schema).parquet(f"{marks_at}/epoch={epoch - 1}")
            seen = seen.unionByName(earlier).groupBy(key).agg(
                F.min("stop_page").alias("stop_page"), F.min("stop_pos").alias("stop_pos"),
                F.max("high_water").alias("high_water"))
        seen.write.mode("overwrite").parquet(f"{marks_at}/epoch={epoch}")
        marks = spark.read.schema(seen.schema).parquet(f"{marks_at}/epoch={epoch}")
        kept = timed.join(marks, key).where(reached() & inside).select(*batch.columns, "stop")
        kept.write.mode("overwrite").parquet(f"{rows}/epoch={epoch}")

    run_available(stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint_of(table_base)))
    return table_base


def crawl_marks(spark: SparkSession, table_base: str) -> DataFrame:
    """The last marks: ``key, stop_page, stop_pos, high_water`` of each source."""
    marks = spark.read.parquet(f"{table_base}/marks")
    last = marks.select("epoch").distinct().agg(F.max("epoch")).first()[0]
    return marks.where(F.col("epoch") == F.lit(last)).drop("epoch")


def crawled(spark: SparkSession, table_base: str, key: str = "source") -> DataFrame:
    """The rows of a crawl under its last marks."""
    rows = spark.read.parquet(f"{table_base}/rows").drop("epoch")
    return rows.join(crawl_marks(spark, table_base), key).where(reached()).drop(
        "stop", "stop_page", "stop_pos", "high_water")


# --- counts ---------------------------------------------------------------------------


def weekly_counts(stream: DataFrame, ts_col: str, key: str) -> DataFrame:
    """Counts per Monday-aligned week and key (tumbling 7-day windows shifted
    4 days from the Thursday epoch)."""
    return (stream.withColumn("_t", instant_utc(F.col(ts_col)))
            .groupBy(F.window("_t", "7 days", "7 days", "4 days").alias("w"), key)
            .agg(F.count(F.lit(1)).alias("n")))


def weekly_counts_final(stream: DataFrame, ts_col: str, key: str, delay: str) -> DataFrame:
    """Weekly counts emitted once per week when the watermark passes its end
    (append mode): state for closed weeks is dropped, and rows arriving
    later than ``delay`` behind the newest event are ignored."""
    return (stream.withColumn("_t", instant_utc(F.col(ts_col)))
            .withWatermark("_t", delay)
            .groupBy(F.window("_t", "7 days", "7 days", "4 days").alias("w"), key)
            .agg(F.count(F.lit(1)).alias("n")))


def write_complete(spark: SparkSession, agg: DataFrame, out: str) -> str:
    """Run a streaming aggregate in complete mode; every batch overwrites ``out``."""
    def sink(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    run_available(agg.writeStream.outputMode("complete").foreachBatch(sink)
                  .option("checkpointLocation", checkpoint_of(out)))
    return out


def write_append(spark: SparkSession, stream: DataFrame, out: str) -> str:
    """Append a stream to a parquet folder (file sink: exactly-once via its log)."""
    run_available(stream.writeStream.format("parquet").option("path", out)
                  .option("checkpointLocation", checkpoint_of(out)))
    return out
