"""Quality classifier: kernel ridge on document statistics.

1. ``document_stats`` reduces each whole text to a fixed vector of statistics
   (character classes, word and line repetition, lengths).
2. Random Fourier features approximate a Gaussian kernel over the standardised
   vectors; the frequencies are drawn from a fixed seed.
3. Every partition sums its part of the normal equations; the sums have a fixed
   size, and the ridge weights are solved from their total.
4. Scores of labelled rows that the fit has not seen are binned, and isotonic
   regression (pool adjacent violators) over the bins turns a raw score into the
   probability of label 1, linear between block centres.

Only labelled rows train, at most about ``fit_rows`` of them (a hash of the id
decides, so it is the same sample on any cluster); statistics and scores cover
every document. Labels, language, source and id are no inputs of a score.

A null text counts as empty; an empty text has a score like any other. Several
labels of one id are averaged, null labels ignored; repeated documents are scored
one by one; a null id is never labelled and not held out. Without labels of both
kinds every score is the share of label 1 (0.5 without any). Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pressroom.llm.common import materialize, read

FEATURES = 512
RIDGE = 1e-3
SEED = 11
FIT_ROWS = 200_000
THRESHOLD = 0.7
SUM_TASKS = 16
BINS = 2048
LOW, HIGH = -0.5, 1.5
CLASSES = ("upper", "lower", "letter", "digit", "space", "punct", "symbol", "other")
MARKS = "!|%$&*#.,\n"


def _char_table() -> np.ndarray:
    """Class of each code point below 65,536 (index into CLASSES)."""
    kind = {"Lu": 0, "Ll": 1, "Nd": 3, "Zs": 4, "Cc": 4}
    group = {"L": 2, "N": 3, "Z": 4, "P": 5, "S": 6}
    return np.array([kind.get(c, group.get(c[0], 7)) for c in map(unicodedata.category, map(chr, range(1 << 16)))],
                    dtype=np.uint8)


def stats_of(text: str, table: np.ndarray) -> list[float]:
    """The statistics of one text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = max(len(codes), 1)
    kinds = np.bincount(table[np.minimum(codes, 0xFFFF)], minlength=len(CLASSES)) / n
    marks = [text.count(m) / n for m in MARKS]
    words = text.split()
    w = max(len(words), 1)
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x]
    fives = Counter(zip(words, words[1:], words[2:], words[3:], words[4:])) if len(words) > 4 else Counter()
    grams = max(len(words) - 4, 1)
    sizes = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.zeros(1)
    letters = max(kinds[0] + kinds[1] + kinds[2], 1e-9)
    return [*kinds, kinds[0] / letters, *marks, np.log1p(len(codes)), np.log1p(len(words)), np.log1p(len(lines)),
            sizes.mean(), sizes.std(), len(seen) / w if words else 1.0,
            seen.most_common(1)[0][1] / w if words else 0.0,
            sum(a == b for a, b in zip(words, words[1:])) / w,
            1 - len(set(lines)) / max(len(lines), 1) if lines else 0.0,
            1 - len(fives) / grams if fives else 0.0,
            sum(1 for x in words if len(x) == 1) / w, sum(1 for x in words if not x[-1].isalnum()) / w]


def document_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, stats`` of every document."""
    def stats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = _char_table()
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "stats": [
                np.array(stats_of(t or "", table), dtype=np.float64) for t in batch["text"]]})

    # ids pass through Python as strings: pandas would make numbers beside a null inexact
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInPandas(stats, "id string, stats array<double>").select(
        F.col("id").cast(docs.schema[id_col].dataType).alias("id"), "stats")


def fold(id_col: Column) -> Column:
    """crc32 of the id's text modulo 4 (null for a null id)."""
    return F.crc32(id_col.cast("string").cast("binary")) % 4


class Model:
    """Standardisation, frequencies, ridge weights and calibration (all of fixed size)."""

    def __init__(self, mean, std, features: int, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.std = mean, np.where(std > 1e-9, std, 1.0)
        self.omega = rng.standard_normal((len(mean), features)) / np.sqrt(len(mean))
        self.phase = rng.uniform(0, 2 * np.pi, features)
        self.weights = np.zeros(features + 1)
        self.xs, self.ys = np.array([0.0]), np.array([0.5])

    def lift(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.std, -8, 8) @ self.omega + self.phase
        return np.hstack([np.sqrt(2 / len(self.phase)) * np.cos(z), np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.lift(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.xs, self.ys)


def isotonic(totals: np.ndarray, ones: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins: (block centre, share of ones), rising."""
    blocks: list[list[float]] = []
    for n, k, x in zip(totals, ones, centres):
        if n:
            blocks.append([n, k, n * x])
            while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
                last = blocks.pop()
                blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks])


def _partition_sums(rows: DataFrame, size: int, add) -> np.ndarray:
    """Total of ``add(batch, sums)`` over all rows. Each of at most SUM_TASKS tasks
    has one array of fixed size; these are added up slice by slice in a second
    step, so the driver gets one array, whatever the number of tasks."""
    width = -(-size // SUM_TASKS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(size)
        for batch in batches:
            if len(batch):
                add(np.stack(batch["stats"].to_numpy()), batch["label"].to_numpy(dtype=np.float64), sums)
        for k in range(0, size, width):
            yield pd.DataFrame({"slice": [k // width], "sums": [sums[k:k + width].tobytes()]})

    def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(batch["slice"], batch["sums"]):
                found[k] = found.get(k, 0.0) + np.frombuffer(part)
        yield pd.DataFrame({"slice": list(found), "sums": [x.tobytes() for x in found.values()]})

    kind = "slice int, sums binary"
    parts = (rows.coalesce(SUM_TASKS).mapInPandas(run, kind).repartition(SUM_TASKS, "slice")
             .mapInPandas(total, kind).collect())
    out = np.zeros(size)
    for r in parts:
        out[r["slice"] * width:(r["slice"] + 1) * width] = np.frombuffer(r["sums"])
    return out


def fit_quality(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
                features: int = FEATURES, ridge: float = RIDGE, seed: int = SEED,
                fit_rows: int = FIT_ROWS) -> Model:
    """A model from ``stats(id, stats)`` and the labels outside fold 2: folds 0
    and 1 fit the ridge, fold 3 the calibration."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
             .where("id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg(F.avg("label").alias("label"))
             .withColumn("fold", fold(F.col("id"))).where("fold <> 2"))
    n = known.count()
    if n > fit_rows:
        cut = int(fit_rows / n * (1 << 32))
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 32)) < cut)
    rows = materialize(stats.join(known, "id"), "labelled")
    part = rows.where("fold <> 3")

    size = len(stats_of("", _char_table()))

    def moments(x, y, sums):
        sums += np.concatenate([[len(x)], x.sum(0), (x * x).sum(0), [y.sum()]])

    total = _partition_sums(part, 2 * size + 2, moments)
    count, ones = total[0], total[-1]
    mean = total[1:size + 1] / max(count, 1)
    model = Model(mean, np.sqrt(np.maximum(total[size + 1:-1] / max(count, 1) - mean ** 2, 0)), features, seed)
    if not 0 < ones < count:
        model.ys = np.array([ones / count if count else 0.5])
        return model
    width = features + 1

    def normal(x, y, sums):
        z = model.lift(x)
        sums += np.concatenate([(z.T @ z).ravel(), z.T @ y])

    total = _partition_sums(part, width * width + width, normal)
    gram = total[:width * width].reshape(width, width) + ridge * count * np.eye(width) / width
    weights = np.linalg.solve(gram, total[width * width:])
    model.weights = weights

    def bins(x, y, sums):
        at = np.clip(((model.raw(x) - LOW) / (HIGH - LOW) * BINS).astype(int), 0, BINS - 1)
        sums += np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, minlength=BINS)])

    total = _partition_sums(rows.where("fold = 3"), 2 * BINS, bins)
    if total[:BINS].sum():
        centres = LOW + (np.arange(BINS) + 0.5) * (HIGH - LOW) / BINS
        model.xs, model.ys = isotonic(total[:BINS], total[BINS:], centres)
    else:  # nothing to calibrate on: the raw score within 0 and 1
        model.xs, model.ys = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def score_stats(stats: DataFrame, model: Model) -> DataFrame:
    """``id, score`` of every row of ``stats(id, stats)``."""
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.stack(batch["stats"].to_numpy()) if len(batch) else np.zeros((0, len(model.mean)))
            yield pd.DataFrame({"id": batch["id"], "score": np.clip(model.score(x), 0, 1)})

    return stats.select(F.col("id").cast("string").alias("id"), "stats").mapInPandas(score, "id string, score double").select(
        F.col("id").cast(stats.schema["id"].dataType).alias("id"), "score")


def score_column(model: Model, text: Column) -> Column:
    """The score of a text column, for filters that keep whole rows."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = _char_table()
        for texts in batches:
            x = np.array([stats_of(t or "", table) for t in texts]).reshape(len(texts), len(model.mean))
            yield pd.Series(np.clip(model.score(x), 0, 1))

    return score(F.coalesce(text, F.lit("")))


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     threshold: float = THRESHOLD, **fit) -> DataFrame:
    """``id_col, held_out, score, predicted`` for every document."""
    stats = materialize(document_stats(docs, id_col, text_col), "stats")
    scored = score_stats(stats, fit_quality(stats, labels, id_col, **fit))
    return scored.select(F.col("id").alias(id_col), F.coalesce(fold(F.col("id")) == 2, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op3_quality(spark, sf_dir):
    return classify_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
