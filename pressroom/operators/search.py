"""Text search by an index of character trigrams.

The index under ``root`` holds the rows (a folder per hash bucket of the key, sorted by
key), the postings (``gram, n, keys``: a row per gram and run of rows, with the keys of the
``n`` rows that hold it; a folder per hash bucket of the gram, sorted by gram) and how many
rows hold each gram. A search takes the
grams of each word, reads the postings of the rarest ones, intersects them rarest
first, and looks at the texts of what is left: so it finds what ``text_search`` finds,
but reads the texts of the buckets with candidates only.

A word of fewer than three characters has no gram; if no word has one, all texts are
read. Null fields hold nothing. Keys are unique and not null.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pressroom.operators.select import text_search

SIZE = 3
RUN_BYTES = 1 << 22     # texts whose postings are gathered at once
SPREAD = 4              # tasks that share a bucket of postings


def grams(text: Column) -> Column:
    """The distinct trigrams of a lower-cased text, as an expression of Spark."""
    # a look-ahead matches at every character, in one pass over the text
    every = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"(?s)(?=(.{{{SIZE}}}))"), 1)
    return F.array_distinct(every)


def _bucket(c: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


def _letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, and the row of each."""
    texts = texts.cast(pa.large_string())
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data or b"", np.uint8)[ends[0]:ends[-1]]
    sizes = np.diff(ends)
    points = raw
    if len(raw) and raw.max() >= 128:
        points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
        begun = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
        sizes = np.diff(begun[ends - ends[0]])
    return points, np.repeat(np.arange(len(texts), dtype=np.int32), sizes)


def _distinct(codes: np.ndarray) -> np.ndarray:
    codes = np.sort(codes)
    return codes[np.concatenate(([True], codes[1:] != codes[:-1]))] if len(codes) else codes


def _postings(keys: pa.Array, fields: list[pa.Array]) -> Iterator[tuple]:
    """``gram, n, keys`` of a run of rows. A gram of a row is one number: the places of its
    letters among those that occur in the run, then the row."""
    found = [_letters(f) for f in fields]
    seen = np.zeros(1 + max((int(p.max()) for p, _ in found if len(p)), default=0), dtype=bool)
    for points, _ in found:
        seen[points] = True
    letters = np.flatnonzero(seen)
    place = np.zeros(len(seen), dtype=np.int64)
    place[letters] = np.arange(len(letters))
    bits, row_bits = max(len(letters) - 1, 1).bit_length(), (len(keys) - 1).bit_length()
    if SIZE * bits + row_bits > 63:     # one row always fits: code points have 21 bits
        half = len(keys) // 2
        yield from _postings(keys[:half], [f[:half] for f in fields])
        yield from _postings(keys[half:], [f[half:] for f in fields])
        return
    parts = []
    for points, row in found:
        for at in range(0, len(points) - SIZE + 1, RUN_BYTES):
            p, w = place[points[at:at + RUN_BYTES + SIZE - 1]], row[at:at + RUN_BYTES + SIZE - 1]
            codes = (((p[:-2] << bits | p[1:-1]) << bits | p[2:]) << row_bits | w[:-2])[w[:-2] == w[2:]]
            parts.append(_distinct(codes) if len(points) > RUN_BYTES else codes)
    codes = _distinct(np.concatenate(parts)) if parts else np.zeros(0, dtype=np.int64)
    if not len(codes):
        return
    gram = codes >> row_bits
    starts = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
    own, mask = gram[starts], (1 << bits) - 1
    names = letters[np.stack([own >> 2 * bits, own >> bits & mask, own & mask], axis=1)].astype("<u4").tobytes().decode("utf-32-le")
    ends = np.append(starts, len(codes)).astype(np.int32)
    yield (pa.array([names[k:k + SIZE] for k in range(0, len(names), SIZE)], pa.string()), pa.array(np.diff(ends)),
           pa.ListArray.from_arrays(pa.array(ends), keys.take(pa.array(codes & ((1 << row_bits) - 1)))))


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of rows ``key, field...``, run by run of RUN_BYTES of text or one longer row."""
    for batch in batches:
        keys, *fields = batch.columns
        size = np.cumsum(sum(pc.binary_length(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in fields))
        at = 0
        while at < len(keys):
            held = size[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(size, held + RUN_BYTES, side="right")))
            for columns in _postings(keys[at:to], [f[at:to] for f in fields]):
                yield pa.RecordBatch.from_arrays(list(columns), names=["gram", "n", "keys"])
            at = to


def write_index(df: DataFrame, root: str, key: str, fields: Sequence[str], buckets: int = 64) -> str:
    """Build the index of ``df`` over ``fields``. A task gathers the postings of a run
    of rows before they are dealt by gram, so that lists of keys are moved and sorted, not a
    row per gram and row."""
    rows = df.withColumn("bucket", _bucket(key, buckets))
    # by number: hashes of few buckets would put several of them into one task
    rows.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket", key).write.mode("overwrite").partitionBy(
        "bucket").parquet(f"{root}/rows")
    spark = df.sparkSession
    texts = spark.read.parquet(f"{root}/rows").select(F.col(key).alias("key"), *[
        F.lower(F.coalesce(F.col(f), F.lit(""))).alias(f"f{k}") for k, f in enumerate(fields)])
    held = texts.mapInArrow(_gather, T.StructType([
        T.StructField("gram", T.StringType()), T.StructField("n", T.IntegerType()),
        T.StructField("keys", T.ArrayType(texts.schema["key"].dataType))])).withColumn("part", _bucket("gram", buckets))
    # a common gram's postings are spread by key as well, so that it isn't one task
    (held.repartitionById(buckets * SPREAD, F.col("part") * SPREAD + F.pmod(F.xxhash64(F.col("keys")[0]), F.lit(SPREAD)).cast("int"))
     .sortWithinPartitions("part", "gram").write.mode("overwrite").partitionBy("part").parquet(f"{root}/postings"))
    postings = spark.read.parquet(f"{root}/postings")
    postings.groupBy("part", "gram").agg(F.sum("n").alias("n")).repartition(buckets, "part").sortWithinPartitions(
        "part", "gram").write.mode("overwrite").partitionBy("part").parquet(f"{root}/sizes")
    return root


def candidates(spark: SparkSession, root: str, query: str, buckets: int = 64, use: int = 4) -> DataFrame | None:
    """``key, bucket`` of rows that hold the ``use`` rarest grams of the query; null if it
    has no gram."""
    words = [w.lower() for w in query.split()]   # as text_search takes them
    asked = sorted({w[k:k + SIZE] for w in words for k in range(len(w) - SIZE + 1)})
    if not asked:
        return None
    here = {r["gram"]: r["part"] for r in spark.createDataFrame([(g,) for g in asked], "gram string").select(
        "gram", _bucket("gram", buckets).alias("part")).collect()}
    pruned = lambda name, some: spark.read.parquet(f"{root}/{name}").where(
        F.col("part").isin(sorted({here[g] for g in some})) & F.col("gram").isin(some))
    listed = lambda df: df.select(F.explode("keys").alias("key")).withColumn("bucket", _bucket("key", buckets))
    sizes = {r["gram"]: r["n"] for r in pruned("sizes", asked).collect()}
    if len(sizes) < len(asked):  # some gram stands nowhere
        return listed(spark.read.parquet(f"{root}/postings").where("false"))
    out = None
    for gram in sorted(asked, key=lambda g: (sizes[g], g))[:use]:
        has = listed(pruned("postings", [gram]))
        out = has if out is None else out.join(has.select("key"), "key", "left_semi")
    return out


def search_index(spark: SparkSession, root: str, key: str, query: str, fields: Sequence[str], buckets: int = 64) -> DataFrame:
    """The rows that ``text_search`` finds, by the index."""
    rows = spark.read.parquet(f"{root}/rows")
    found = candidates(spark, root, query, buckets)
    if found is not None:
        places = [r["bucket"] for r in found.select("bucket").distinct().collect()]   # as many as buckets at most
        rows = rows.where(F.col("bucket").isin(places)).join(found.select(F.col("key").alias(key)), key, "left_semi")
    return text_search(rows, query, fields).drop("bucket")
