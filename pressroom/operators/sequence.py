"""Exact row numbering without funnelling a group through one task.

``row_number() over (partition by g order by k)`` puts every row of a group in
one task; a source holding a third of all rows would then run in a single
task. ``number_within`` gives the same numbers with range partitioning:

1. range-partition on (group, order keys) and sort within partitions, so a
   hot group is spread over many contiguous partitions;
2. tag each row with its partition and its index in the partition;
3. count rows per (group, partition) -- a table of at most
   partitions + groups rows -- and turn the counts into offsets with a
   window over that small table;
4. join the offsets back (an equi-join on (group, partition); the offsets are
   few, so AQE broadcasts them) and add the in-partition index.

The tagged frame is read twice (counts, join back), and Spark does not reuse
the range exchange between the two branches. Recomputing it would be unsafe
when the input comes out of an upstream shuffle: row order inside a shuffle
partition is not fixed, so the range partitioner's samples, and with them
the tags, could differ between the branches. The tagged rows are therefore
written once to the shared staging folder and both branches read the same
files (one range shuffle instead of two; a lost executor re-reads the file).
The order keys must be a total order (include a unique key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def number_within(df: DataFrame, group_cols: list[str], order: list[Column],
                  out_col: str, num_partitions: int | None = None) -> DataFrame:
    """0-based position of each row within its group (global if no group)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(g).asc() for g in group_cols] + list(order)
    from pressroom.sources.staging import materialize

    tagged = materialize(df.repartitionByRange(n, *keys)
                         .sortWithinPartitions(*keys)
                         .withColumn("_part", F.spark_partition_id())
                         .withColumn("_tag", F.monotonically_increasing_id()), "numbered")
    counts = tagged.groupBy(*group_cols, "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_tag").alias("_first"))
    before = Window.partitionBy(*group_cols).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1) if group_cols else \
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group_cols, "_part", "_first",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    offsets = offsets.select(F.col("_part").alias("_p"), "_first", "_offset",
                             *[F.col(g).alias(f"_g{k}") for k, g in enumerate(group_cols)])
    on = F.col("_part") == F.col("_p")
    for k, g in enumerate(group_cols):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{k}"))
    joined = tagged.join(offsets, on, "inner").drop("_part", "_p", *[f"_g{k}" for k in range(len(group_cols))])
    return (joined.withColumn(out_col, (F.col("_offset") + F.col("_tag") - F.col("_first"))
                              .cast("long"))
            .drop("_tag", "_first", "_offset"))


def append_ids(existing_max: Column, df: DataFrame, order: list[Column],
               out_col: str = "id") -> DataFrame:
    """Fresh ids ``max(existing id) + 1 + position`` for rows being appended."""
    numbered = number_within(df, [], order, "_pos")
    return numbered.withColumn(out_col, (existing_max + 1 + F.col("_pos")).cast("long")).drop("_pos")
