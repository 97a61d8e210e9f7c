"""Mixing sources to target weights by Poisson replication.

A document of source ``s`` is repeated ``Poisson(rate_s)`` times, where
``rate_s = weight_s * budget / n_s`` is the repetition rate that gives ``s`` its
share of the budget in expectation. The Poisson variable is inverted from a
uniform number hashed from (seed, document), so any retry, executor or
partitioning gives the same copies. A rate above ``MAX_RATE`` is the sum of
independent draws of bounded rate, each with a hash of its own (``ORACLE`` holds
for rates up to about 130). Rows are exploded by their count, those of many copies
in chunks that any task can take, and globally shuffled by a second hash (a range
exchange, no hot key).

Sources without a weight of their own form one group, ``REST``; so the rates are
a fixed-size row, however many sources exist, and join nothing. A weight of 0
drops its source; a source without rows has no effect on the others' rates.

A document is hashed by its id if that names one text, else (a null id, or an id
of several texts) by id and text, so that different texts are drawn on their own.
``ORACLE`` hashes ids only: it holds for tables whose ids are distinct.

Null ids, sources and texts are values like any other (a null source is in
``REST``); rows equal in id and text have equal hashes and are repeated alike,
told apart by ``copy`` only; an empty table gives an empty result. All columns of the input
are kept; the two added ones replace input columns of those names.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from pressroom.llm.common import free_name, materialize, partitions

REST = ""
#: Production weights: relative shares of the mixed corpus.
TARGET_WEIGHTS = {"src0": 0.10, "src1": 0.08, "src2": 0.06, "src3": 0.04, REST: 0.72}
SEED = 17
#: The highest rate of one draw (exp(-rate) is a normal double), and the most
#: copies that a row is exploded to at once.
MAX_RATE, CHUNK = 700.0, 2048


def source_rates(docs: DataFrame, weights: Mapping[str, float], budget: float | None = None,
                 source_col: str = "source") -> dict[str, float]:
    """Repetition rate per weighted source (and ``REST``), from exact counts of
    all rows: one aggregate row of ``len(weights) + 1`` numbers."""
    named = [s for s in weights if s != REST]
    src = F.col(source_col)
    counts = docs.agg(F.count(F.lit(1)).alias("n"),
                      *[F.count_if(src == s).alias(f"n{i}") for i, s in enumerate(named)]).first()
    n = {s: counts[f"n{i}"] for i, s in enumerate(named)}
    n[REST] = counts["n"] - sum(n.values())
    share = {s: weights.get(s, 0.0) for s in n if n[s] and weights.get(s, 0.0) > 0}
    total = sum(share.values())
    size = counts["n"] if budget is None else budget
    return {s: (share[s] / total * size / n[s] if s in share else 0.0) for s in n}


def poisson_cdf(rate: float) -> list[float]:
    """P(X <= k) for k = 0, 1, ... until it is 1 in double precision; ``rate`` is
    ``MAX_RATE`` at most."""
    p, total, k, out = math.exp(-rate), 0.0, 0, []
    while True:
        total += p
        out.append(total)
        k += 1
        p *= rate / k
        if k > rate and total + p == total:
            return out


def uniform(seed: int, salt: str, *keys: Column) -> Column:
    """A number in [0, 1) hashed from the keys: 52 bits of md5."""
    text = F.concat_ws("|", F.lit(f"{seed}:{salt}"), *[F.coalesce(k.cast("string"), F.lit("null")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def with_document(docs: DataFrame, id_col: str, text_col: str, out: str) -> DataFrame:
    """``docs`` with ``out``: the id, or the id and the text's md5 if the id is null
    or stands at several texts."""
    mark = free_name(docs, "several")
    key = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    several = materialize(docs.where(F.col(id_col).isNotNull()).select(id_col, key.alias("k")).groupBy(id_col).agg(
        F.min("k").alias("low"), F.max("k").alias("high")).where("low < high").select(
            id_col, F.lit(True).alias(mark)), "several-texts")
    own = F.col(id_col).isNotNull() & F.col(mark).isNull()
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    return docs.join(several, id_col, "left").withColumn(
        out, F.when(own, name).otherwise(F.concat_ws("|", name, key))).drop(mark)


def mix_sources(docs: DataFrame, weights: Mapping[str, float] = TARGET_WEIGHTS, budget: float | None = None,
                seed: int = SEED, id_col: str = "doc_id", source_col: str = "source",
                text_col: str = "text") -> DataFrame:
    """``docs`` repeated to the target weights (``budget`` rows expected; as many
    as there are by default), in globally shuffled order, with ``copy`` (from 1)
    and ``shuffle_key``."""
    rates = source_rates(docs, weights, budget, source_col)
    name, begin = free_name(docs, "document"), free_name(docs, "begin")
    document, src = F.col(name), F.col(source_col)
    u = uniform(seed, "count", document)

    # copies are numbered by int; only rates near 2^31 need long
    number = "int" if max(rates.values()) < 1 << 30 else "long"

    def draw(rate: float, u: Column) -> Column:
        # the smallest k with u < P(X <= k): as many as there are bounds at or below u
        return F.size(F.filter(F.array(*map(F.lit, poisson_cdf(rate))), lambda c: c <= u))

    def count(rate: float) -> Column:
        if rate <= MAX_RATE:
            return (draw(rate, u) if rate else F.lit(0)).cast(number)
        parts = math.ceil(rate / MAX_RATE)
        return F.aggregate(F.sequence(F.lit(1), F.lit(parts)), F.lit(0).cast(number), lambda n, j: n + draw(
            rate / parts, uniform(seed, "part", document, j)))

    n = count(rates[REST])
    for s, rate in rates.items():
        if s != REST:
            n = F.when(src == s, count(rate)).otherwise(n)
    kept = [c for c in docs.columns if c not in ("copy", "shuffle_key")]
    named = with_document(docs, id_col, text_col, name)
    counted, copy = named.select(*kept, name, n.alias("copy")).where(F.col("copy") > 0), F.col("copy")
    copies = counted.where(copy <= CHUNK).withColumn("copy", F.explode(F.sequence(F.lit(1).cast(number), copy)))
    if max(rates.values()) > MAX_RATE:
        starts = F.explode(F.sequence(F.lit(1).cast(number), copy, F.lit(CHUNK).cast(number)))
        chunks = counted.where(copy > CHUNK).withColumn(begin, starts).repartition(partitions(docs.sparkSession))
        copies = copies.unionByName(chunks.withColumn("copy", F.explode(F.sequence(
            begin, F.least(copy, F.col(begin) + F.lit(CHUNK - 1))))).drop(begin))
    return (copies
            .withColumn("shuffle_key", uniform(seed, "order", document, F.col("copy")))
            .drop(name).orderBy("shuffle_key", id_col, "copy"))


def op6_mix_sources(spark, sf_dir):
    from pressroom.llm.common import read

    return mix_sources(read(spark, sf_dir, "documents")).select(
        "doc_id", "source", "copy", "shuffle_key", "text", "lang", "n_chars")


def _uniform_sql(salt: str, *keys: str) -> str:
    text = " || '|' || ".join([f"'{SEED}:{salt}'", *[f"coalesce(cast({k} AS VARCHAR), 'null')" for k in keys]])
    return f"(('0x' || substr(md5({text}), 1, 13))::BIGINT::DOUBLE / {float(1 << 52)!r})"


def mix_sql(docs: str, columns: str) -> str:
    """The same rows in DuckDB SQL (unordered)."""
    named = ", ".join(f"'{s}'" for s in TARGET_WEIGHTS if s != REST)
    weights = ", ".join(f"('{s}', {w!r}::DOUBLE)" for s, w in TARGET_WEIGHTS.items())
    return f"""
WITH RECURSIVE grp AS (SELECT *, CASE WHEN source IN ({named}) THEN source ELSE '' END AS grp FROM {docs}),
weights(grp, w) AS (VALUES {weights}),
sizes AS (SELECT grp, count(*) AS n, (SELECT count(*) FROM grp) AS total FROM grp GROUP BY grp),
rates AS (SELECT grp, w / (SELECT sum(w) FROM sizes JOIN weights USING (grp)) * total / n AS rate
          FROM sizes JOIN weights USING (grp) WHERE w > 0),
cdf(grp, rate, k, p, total) AS (
  SELECT grp, rate, 0, exp(-rate), exp(-rate) FROM rates
  UNION ALL SELECT grp, rate, k + 1, p * rate / (k + 1), total + p * rate / (k + 1) FROM cdf
  WHERE k < 200 AND (k <= rate OR total + p * rate / (k + 1) > total)),
drawn AS (SELECT g.*, {_uniform_sql('count', 'doc_id')} AS u FROM grp g),
counted AS (SELECT d.*, (SELECT count(*) FROM cdf c WHERE c.grp = d.grp AND c.total <= d.u) AS copies FROM drawn d)
SELECT {columns} FROM (SELECT *, unnest(range(1, copies + 1))::INTEGER AS copy FROM counted WHERE copies > 0)
"""


ORACLE = mix_sql("documents", "doc_id, source, copy, " + _uniform_sql("order", "doc_id", "copy")
                 + " AS shuffle_key, text, lang, n_chars")
