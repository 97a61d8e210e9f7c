"""Enrichment: remote-model calls (translate, generate, embed) as one
partition-parallel operator.

``enrich`` spreads the rows over ``num_partitions`` tasks (a 200-row budget
would otherwise sit in one partition), builds the client once per partition
inside ``mapInPandas``, sends texts in batches, throttles each partition to
its share of the global call rate, and reports failures in a ``status``
column instead of failing the job. Results are joined back by key with the
masked update, so a failed batch leaves the old values in place.

The clients shipped here are deterministic offline stand-ins (no network);
a real client implements the same ``call(texts) -> list`` method.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pressroom.functions.themes import PROMPT_MIDDLE, PROMPT_PREFIX, PROMPT_SUFFIX, keywords, themes_joined


class TranslateStub:
    """Marks the text as translated: '[<lang>] text' (HTML mode keeps tags)."""

    def __init__(self, target: str = "en", is_html: bool = False):
        self.target, self.is_html = target, is_html

    def call(self, texts: list) -> list:
        return [None if t is None else f"[{self.target}] {t}" for t in texts]


class SubmitStub:
    """Asynchronous generation: returns a request id per text, md5(model || text)."""

    def __init__(self, model: str = "summary"):
        self.model = model

    def call(self, texts: list) -> list:
        return [None if t is None else hashlib.md5((self.model + t).encode("utf-8")).hexdigest()
                for t in texts]


class GenerateStub:
    """Synchronous generation: the reply text itself, '<model>:<characters>'."""

    def __init__(self, model: str = "summary"):
        self.model = model

    def call(self, texts: list) -> list:
        return [None if t is None else f"{self.model}:{len(t)}" for t in texts]


class EmbedStub:
    """Text -> small feature vector [chars, spaces, newlines, dots];
    blank/null text -> no vector."""

    def call(self, texts: list) -> list:
        out = []
        for t in texts:
            if t is None or not t.strip():
                out.append(None)
            else:
                out.append([float(len(t)), float(t.count(" ")), float(t.count("\n")),
                            float(t.count("."))])
        return out


class _Throttle:
    """Token bucket: at most ``per_sec`` calls per second in this task."""

    def __init__(self, per_sec: float | None):
        self.per_sec, self.next_at = per_sec, 0.0

    def wait(self, n: int) -> None:
        if not self.per_sec:
            return
        now = time.monotonic()
        if self.next_at > now:
            time.sleep(self.next_at - now)
        self.next_at = max(now, self.next_at) + n / self.per_sec


def enrich(df: DataFrame, key: str, input_col: str, client_factory: Callable[[], object],
           result_type: T.DataType, out_col: str = "result", batch_size: int = 64,
           rate_per_sec: float | None = None, num_partitions: int | None = None) -> DataFrame:
    """(key, out_col, status) for every input row; status is 'ok' or the error.

    A batch that fails is called again row by row, so one bad text is one error.
    With a rate, there are no more tasks than can run at once: each holds its
    share of the rate, and together they reach it and never exceed it."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if rate_per_sec:
        n = min(n, spark.sparkContext.defaultParallelism)
    per_task = (rate_per_sec / n) if rate_per_sec else None
    key_type = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, key_type), T.StructField(out_col, result_type),
                           T.StructField("status", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = client_factory()
        throttle = _Throttle(per_task)
        for pdf in batches:
            for start in range(0, len(pdf), batch_size):
                part = pdf.iloc[start:start + batch_size]
                texts = [None if pd.isna(x) else x for x in part[input_col].tolist()]
                throttle.wait(len(texts))
                try:
                    res, status = client.call(texts), ["ok"] * len(texts)
                except Exception:  # noqa: BLE001 -- reported per row below
                    res, status = [], []
                    for text in texts:
                        throttle.wait(1)
                        try:
                            res += client.call([text])
                            status.append("ok")
                        except Exception as e:  # noqa: BLE001 -- the row's own error
                            res.append(None)
                            status.append(f"error: {type(e).__name__}")
                yield pd.DataFrame({key: part[key].values, out_col: res, "status": status})

    return df.select(key, input_col).repartition(n, key).mapInPandas(run, schema)


def classification_prompt(text: Column) -> Column:
    """Prompt asking the model for the theme code of ``text``."""
    return F.concat(F.lit(PROMPT_PREFIX + themes_joined() + PROMPT_MIDDLE), text, F.lit(PROMPT_SUFFIX))


def classify_themes(df: DataFrame, text_col: str = "content", out_col: str = "theme",
                    engine: str = "automaton") -> DataFrame:
    """Offline stand-in for the classification reply: the code (1-based list
    position) of the keyword with the most non-overlapping, case-insensitive
    occurrences in the text, ties to the lower code; 0 when none occurs.

    ``engine='automaton'`` matches all keywords in one pass per text
    (Aho-Corasick in an Arrow-batched pandas UDF); ``'jvm'`` is a pure
    Spark-expression form (one replace per keyword, interpreted lambda). The
    caller chooses; nothing depends on what the driver can import. Lower-casing
    is done by Spark in both, so they agree character for character."""
    df = df.withColumn("_low", F.lower(F.coalesce(F.col(text_col), F.lit(""))))
    if engine == "automaton":
        return df.withColumn(out_col, _theme_code_udf()(F.col("_low"))).drop("_low")
    return _classify_jvm(df, out_col)


_AUTOMATON = None


def _automaton():
    global _AUTOMATON
    if _AUTOMATON is None:
        import ahocorasick

        a = ahocorasick.Automaton()
        for code, kw in enumerate(keywords(), start=1):
            a.add_word(kw.lower(), (code, len(kw.lower())))
        a.make_automaton()
        _AUTOMATON = a
    return _AUTOMATON


def best_theme(low: str, automaton) -> int:
    """Theme code of one lower-cased text (see ``classify_themes``)."""
    counts: dict[int, int] = {}
    last_end: dict[int, int] = {}
    for end, (code, length) in automaton.iter(low):
        if end - length + 1 > last_end.get(code, -1):
            counts[code] = counts.get(code, 0) + 1
            last_end[code] = end
    if not counts:
        return 0
    return min(counts, key=lambda c: (-counts[c], c))


def _theme_code_udf():
    @F.pandas_udf(T.LongType())
    def theme_code(texts: pd.Series) -> pd.Series:
        a = _automaton()
        return pd.Series([best_theme(t or "", a) for t in texts], dtype="int64")
    return theme_code


def _classify_jvm(df: DataFrame, out_col: str) -> DataFrame:
    low = F.col("_low")
    arr = F.array(*[F.lit(k.lower()) for k in keywords()])

    def hits(k: Column) -> Column:
        return F.floor((F.length(low) - F.length(F.replace(low, k, F.lit("")))) / F.length(k))

    scored = F.transform(arr, lambda k, i: F.struct(hits(k).cast("long").alias("n"),
                                                    (-i).alias("neg_code")))
    return (df.withColumn("_best", F.array_max(scored))
            .withColumn(out_col, F.when(F.col("_best.n") > 0, (-F.col("_best.neg_code") + 1).cast("long"))
                        .otherwise(F.lit(0).cast("long")))
            .drop("_low", "_best"))
