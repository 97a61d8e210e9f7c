"""Near duplicates by the cosine of embeddings.

A row goes if a row with a smaller key has a cosine of ``threshold`` or more to it.
Signs of random projections are cut into bands of ``bits``; rows that agree on a band
are candidates, and candidates are compared exactly, in double precision. The
number of bands follows from the threshold, so that a pair that just reaches it is
missed with probability ``miss`` at most (a closer pair far less often).

Equal vectors are reduced to one before anything else. A bucket of any size is
compared block by block: its rows are dealt into blocks of about ``block`` rows, each
pair of blocks is one group, and a group says of each of its rows at most once that
it goes. So no group outgrows a task, and pairs are never written out.

Null, zero and non-finite vectors (or components) are near to nothing; vectors of
different lengths as well. Keys are unique and not null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pressroom.sources.staging import materialize

SEED = 20240601


def bands_for(threshold: float, bits: int, miss: float) -> int:
    """Bands of ``bits`` signs that a pair at the threshold misses with at most
    this probability."""
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return 1 if same >= 1 else math.ceil(math.log(miss) / math.log1p(-same))


@lru_cache(8)
def _planes(size: int, n: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).standard_normal((size, n))


def _signatures(bits: int, bands: int):
    def keys(vectors: pd.Series) -> pd.Series:
        out, sizes = [None] * len(vectors), np.array([len(v) for v in vectors])
        weights = 1 << np.arange(bits, dtype=np.int64)
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            signs = np.stack([vectors.iloc[i] for i in at]) @ _planes(int(size), bits * bands) >= 0
            for i, k in zip(at, signs.reshape(len(at), bands, bits) @ weights):
                out[i] = k
        return pd.Series(out)

    return F.pandas_udf(keys, "array<long>")


GROUP = ["band", "sign", "size", "a", "b"]


def _comparer(threshold: float):
    """Compares the groups of rows that stand together; a group may run on over
    batches."""
    def compare(keys: np.ndarray, vectors: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(keys, kind="stable")
        v, keys = np.stack([vectors[i] for i in order]), keys[order]
        v = v / np.linalg.norm(v, axis=1, keepdims=True)
        near = np.tril(v @ v.T >= threshold, -1)  # to a row with a smaller key
        gone = np.flatnonzero(near.any(axis=1))
        return keys[gone], keys[near[gone].argmax(axis=1)]

    def whole(rows: pd.DataFrame, cuts: list[int]) -> pd.DataFrame:
        keys, vectors = rows["key"].to_numpy(), rows["vec"].to_list()
        out = [compare(keys[i:j], vectors[i:j]) for i, j in zip(cuts, cuts[1:])]
        return pd.DataFrame({c: np.concatenate([o[k] for o in out]) for k, c in enumerate(("key", "first"))}).drop_duplicates()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            group = rows[GROUP].to_numpy()
            cuts = [0, *(np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1).tolist()]
            if len(cuts) > 1:
                yield whole(rows, cuts)
            held = rows.iloc[cuts[-1]:]
        if held is not None and len(held):
            yield whole(held, [0, len(held)])

    return run


def near_duplicates(df: DataFrame, key: str, vec_col: str, threshold: float = 0.95, bits: int = 20,
                    miss: float = 1e-4, block: int = 1024) -> DataFrame:
    """``key, first``: the rows that go, each with the smallest key found that it
    is near to."""
    if not 0 < threshold <= 1 or not 0 < bits < 63:
        raise ValueError("a threshold in (0, 1] and 1 to 62 bits")
    kind = df.schema[key].dataType.simpleString()
    vec = F.col("vec")
    rows = df.select(F.col(key).alias("key"), F.col(vec_col).cast("array<double>").alias("vec")).where(
        vec.isNotNull() & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(vec, lambda x: x != 0))
    hashed = rows.withColumn("hash", F.md5(F.to_json("vec")))
    # one row a vector: copies are reduced within each task first
    one = materialize(hashed.groupBy("hash").agg(F.min("key").alias("key"), F.first("vec").alias("vec")), "vectors")
    copies = hashed.select("key", "hash").join(one.select("hash", F.col("key").alias("first")), "hash").where("key <> first")
    keyed = one.select("key", F.posexplode(_signatures(bits, bands_for(threshold, bits, miss))("vec")).alias("band", "sign"),
                       F.size("vec").alias("size"))
    keyed = materialize(keyed, "signs")
    bucket = ["band", "sign", "size"]
    # buckets of more than one row, and into how many blocks they are dealt
    full = materialize(keyed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        *bucket, F.ceil(F.col("n") / block).cast("int").alias("blocks")), "buckets")
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least(o, own).alias("a"), F.greatest(o, own).alias("b")))
    dealt = keyed.join(full, bucket).select("key", *bucket, F.explode(pairs).alias("pair"))
    near = (dealt.join(one.select("key", "vec"), "key").select("key", "vec", *bucket, "pair.a", "pair.b")
            .repartition(*GROUP).sortWithinPartitions(*GROUP).mapInPandas(_comparer(threshold), f"key {kind}, first {kind}"))
    return copies.select("key", "first").unionByName(near).groupBy("key").agg(F.min("first").alias("first"))


def dedupe_near(df: DataFrame, key: str, vec_col: str, **options) -> DataFrame:
    """``df`` without the rows that are near to one with a smaller key; rows without
    a vector stay."""
    gone = near_duplicates(df, key, vec_col, **options)
    return df.join(gone.select(F.col("key").alias(key)), key, "left_anti")
